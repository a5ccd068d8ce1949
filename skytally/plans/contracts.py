"""Every declared assertion, counted.

Row-level assertions on a table share one pass over it; each uniqueness or
reference assertion needs an aggregation of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import count_where
from skytally.operators.quality import (
    identity_columns,
    is_violation,
    orphans,
    outside_range,
    outside_values,
    repeated_keys,
)
from skytally.schemas import (
    ALTITUDE_BANDS,
    AUTH_MODES,
    DAILY_GRAIN,
    HEALTH_GRAIN,
    HOURLY_GRAIN,
    OBSERVATION_KEY,
    RUN_STATUSES,
)
from skytally.sources.tables import Marts


@dataclass(frozen=True)
class RowRule:
    """An assertion on single rows; ``broken`` is true for a violating one."""

    kind: str
    column: str
    broken: Column


def _nn(*columns: str) -> list[RowRule]:
    return [RowRule("not_null", c, F.col(c).isNull()) for c in columns]


def _values(column: str, values) -> RowRule:
    return RowRule("accepted_values", column, outside_values(column, values))


def _range(column: str, low=None, high=None) -> RowRule:
    return RowRule("accepted_range", column, outside_range(column, low, high))


def row_rules() -> dict[str, list[RowRule]]:
    track = F.col("true_track_deg")
    return {
        "state_vectors": _nn("icao24", "observed_at", "ingestion_run_id", "on_ground"),
        "ingestion_runs": [
            *_nn("run_id", "status"),
            _values("status", RUN_STATUSES),
            _values("auth_mode", AUTH_MODES),
        ],
        "staged_observations": [
            *_nn("icao24", "observed_at", "observed_hour", "on_ground", "has_position", "ingestion_run_id"),
            _range("latitude", -90, 90),
            _range("longitude", -180, 180),
            RowRule("expression_is_true", "true_track_deg", is_violation(~((track >= 0) & (track < 360)))),
        ],
        "staged_runs": [
            *_nn("run_id", "status", "rows_received", "rows_inserted"),
            _values("status", RUN_STATUSES),
            _range("rows_received", 0),
            _range("rows_inserted", 0),
            _range("credits_estimated", 1, 4),
        ],
        "gridded_observations": [
            *_nn("icao24", "grid_lat", "grid_lon", "altitude_band"),
            _range("grid_lat", -90, 90),
            _range("grid_lon", -180, 180),
            _values("altitude_band", ALTITUDE_BANDS),
        ],
        "hourly": [
            *_nn(
                "activity_hour", "grid_lat", "grid_lon", "altitude_band", "observation_count",
                "distinct_aircraft", "track_sample_count", "contributing_run_count", "last_ingested_at",
            ),
            _values("altitude_band", ALTITUDE_BANDS),
            _range("observation_count", 1),
            _range("distinct_aircraft", 1),
            _range("dominant_track_deg", 0, 360),
            _range("track_concentration", 0, 1),
            _range("track_sample_count", 0),
        ],
        "daily": [
            *_nn("activity_date", "altitude_band", "observation_count", "distinct_aircraft", "distinct_grid_cells"),
            _values("altitude_band", ALTITUDE_BANDS),
            _range("observation_count", 1),
            _range("distinct_aircraft", 1),
            _range("distinct_grid_cells", 1),
        ],
        "health": [
            *_nn("health_hour", "run_count", "credits_consumed"),
            _range("run_count", 1),
            _range("success_rate_pct", 0, 100),
            _range("reject_rate_pct", 0, 100),
            _range("credits_consumed", 0),
        ],
    }


UNIQUE_KEYS = {
    "ingestion_runs": ("run_id",),
    "staged_observations": OBSERVATION_KEY,
    "staged_runs": ("run_id",),
    "gridded_observations": OBSERVATION_KEY,
    "hourly": HOURLY_GRAIN,
    "daily": DAILY_GRAIN,
    "health": HEALTH_GRAIN,
}

# child table -> (column, parent table, parent column)
REFERENCES = {
    "state_vectors": ("ingestion_run_id", "ingestion_runs", "run_id"),
    "staged_observations": ("ingestion_run_id", "staged_runs", "run_id"),
}

PUBLISHED = ("hourly", "daily", "health")


def _outcome(table: str, kind: str, column: str, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("assertion"),
        F.lit(column).alias("column_name"),
        violations.cast("bigint").alias("violations"),
    ]


def _row_level(table: str, df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """One row per rule, and for a published table one for the identity guard."""
    counts = df.agg(*[count_where(r.broken).alias(f"_{i}") for i, r in enumerate(rules)])
    outcomes = [_outcome(table, r.kind, r.column, F.col(f"_{i}")) for i, r in enumerate(rules)]
    if table in PUBLISHED:
        leaks = F.lit(len(identity_columns(df.schema)))
        outcomes.append(_outcome(table, "no_identity", "*", leaks))
    return counts.select(F.inline(F.array(*[F.struct(*o) for o in outcomes])))


def contract_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, assertion, column_name, violations)`` for every table given."""
    parts = []
    for table, rules in row_rules().items():
        if table in tables:
            parts.append(_row_level(table, tables[table], rules))
    for table, key in UNIQUE_KEYS.items():
        if table in tables:
            repeats = repeated_keys(tables[table], *key).agg(F.count("*").alias("_n"))
            parts.append(repeats.select(*_outcome(table, "unique", ",".join(key), F.col("_n"))))
    for table, (column, parent, parent_column) in REFERENCES.items():
        if table in tables and parent in tables:
            lost = orphans(tables[table], column, tables[parent], parent_column)
            count = lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("_n"))
            parts.append(count.select(*_outcome(table, "relationships", column, F.col("_n"))))
    return reduce(DataFrame.unionByName, parts)


def stored_identity(marts: Marts) -> DataFrame:
    """``(table_name, column_count, identity_columns)`` of what the published tables' files hold.

    Read from the footers of every file, whoever wrote it, so a column that no
    declared schema has is found too.
    """
    found = [(name, len(kind.fields), len(identity_columns(kind))) for name, kind in marts.stored_columns().items()]
    return marts.spark.createDataFrame(found, "table_name string, column_count long, identity_columns long")
