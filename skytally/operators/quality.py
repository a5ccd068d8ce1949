"""Data-quality operators. Each returns what violates it; no rows means it holds.

Nulls pass except where ``not_null`` is asked for; as members of a key they are
equal to each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from skytally.functions.columns import instant, seconds_between
from skytally.schemas import AUTH_MODES, IDENTITY_COLUMNS, RUN_STATUSES

# Age of the newest landed row, in seconds; fixed values.
WARN_AFTER_SECONDS = 30 * 60
ERROR_AFTER_SECONDS = 6 * 3600


# --- predicates: true for a violating row, never null ------------------------


def is_violation(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def outside_values(column: str, values: Iterable[str]) -> Column:
    return is_violation(~F.col(column).isin(*values))


def outside_range(column: str, low=None, high=None, *, inclusive: bool = True) -> Column:
    c = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (c < low if inclusive else c <= low)
    if high is not None:
        broken = broken | (c > high if inclusive else c >= high)
    # A NaN is in no range; Spark would order it above every number.
    return is_violation(broken | F.isnan(c.cast("double")))


# --- row level ----------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    return df.where(outside_values(column, values))


def accepted_range(df: DataFrame, column: str, low=None, high=None, *, inclusive: bool = True) -> DataFrame:
    return df.where(outside_range(column, low, high, inclusive=inclusive))


def expression_is_true(df: DataFrame, expression: Column) -> DataFrame:
    return df.where(is_violation(~expression))


def ledger_balance(runs: DataFrame) -> DataFrame:
    """Succeeded runs whose counts do not add up."""
    parts = F.col("rows_rejected") + F.col("rows_inserted") + F.coalesce("rows_duplicate", F.lit(0))
    return runs.where((F.col("status") == "succeeded") & (F.col("rows_received") != parts))


def state_vector_rules() -> dict[str, Column]:
    return {
        "latitude_range": outside_range("latitude", -90, 90),
        "longitude_range": outside_range("longitude", -180, 180),
        "true_track_range": outside_range("true_track_deg", 0) | is_violation(F.col("true_track_deg") >= 360),
        "icao24_form": is_violation(
            (F.col("icao24") != F.lower("icao24")) | ~F.length("icao24").between(1, 12)
        ),
    }


def landing_rules() -> dict[str, Column]:
    """What a row must keep to be landed: its key, its run and its flag are there, and its values in range."""
    needed = ("icao24", "observed_at", "on_ground", "ingestion_run_id")
    return {f"{c}_missing": F.col(c).isNull() for c in needed} | state_vector_rules()


def ingestion_run_rules() -> dict[str, Column]:
    return {
        "status_known": outside_values("status", RUN_STATUSES),
        "auth_mode_known": outside_values("auth_mode", AUTH_MODES),
        "finished_unless_running": is_violation(
            (F.col("status") == "running") != F.col("finished_at").isNull()
        ),
    }


def ledger_rules() -> dict[str, Column]:
    """What an event must keep to be recorded: its run and its start are there, and its values are known."""
    return {f"{c}_missing": F.col(c).isNull() for c in ("run_id", "started_at")} | ingestion_run_rules()


def with_broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``broken_rules``; rows where it is empty may be written, the others are set aside."""
    hits = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return df.withColumn("broken_rules", F.array_compact(hits))


# --- across rows and tables -----------------------------------------------------


def repeated_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keys held by more than one row. Counting starts before the shuffle."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return repeated_keys(df.where(F.col(column).isNotNull()), column)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """References without a parent, and how many rows make each.

    The child is counted per reference first, so one reference held by a third of
    the rows reaches the join as one row.
    """
    references = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    parents = parent.select(F.col(parent_column).alias(column))
    return references.join(parents, column, "left_anti")


def attributed_rows(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """How many rows can be traced to a run and to what it asked for."""
    per_run = (
        landed.where(F.col("ingested_at").isNotNull() & F.col("api_snapshot_time").isNotNull())
        .groupBy(F.col("ingestion_run_id").alias("run_id"))
        .agg(F.count("*").alias("_rows"))
    )
    described = runs.where(F.col("request_bbox").isNotNull() & F.col("auth_mode").isNotNull())
    return per_run.join(described.select("run_id"), "run_id").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("attributed_rows")
    )


def reconcile_hourly(hourly: DataFrame, gridded: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Closed hours whose published count differs from the observations."""
    this_hour = F.date_trunc("hour", instant(as_of))
    published = (
        hourly.where(F.col("activity_hour") < this_hour)
        .groupBy("activity_hour")
        .agg(F.sum("observation_count").alias("mart_observations"))
    )
    observed = (
        gridded.where(F.col("observed_hour") < this_hour)
        .groupBy(F.col("observed_hour").alias("activity_hour"))
        .agg(F.count("*").alias("source_observations"))
    )
    return published.join(observed, "activity_hour", "full_outer").where(
        ~F.col("mart_observations").eqNullSafe(F.col("source_observations"))
    )


def newest_ingest(landed: DataFrame) -> DataFrame:
    """One row: ``last_ingested_at``. A frame of just that column, as a lake keeps it, is passed through."""
    if landed.columns == ["last_ingested_at"]:
        return landed
    return landed.agg(F.max("ingested_at").alias("last_ingested_at"))


def source_freshness(landed: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Whether the landing is fresh, worth a warning, or an error; an empty one is an error.

    Takes landed rows, or the one row of :func:`newest_ingest`.
    """
    age = F.col("age_seconds")
    return (
        newest_ingest(landed)
        .withColumn("age_seconds", seconds_between(instant(as_of), F.col("last_ingested_at")))
        .withColumn(
            "status",
            F.when(age.isNull() | (age > ERROR_AFTER_SECONDS), "error")
            .when(age > WARN_AFTER_SECONDS, "warn")
            .otherwise("pass"),
        )
    )


# --- identity ---------------------------------------------------------------------


def _names(kind: DataType, prefix: str = "") -> Iterable[tuple[str, str]]:
    """(path, last name) of every field, inside structs, arrays and maps too."""
    if isinstance(kind, StructType):
        for field in kind:
            path = f"{prefix}{field.name}"
            yield path, field.name
            yield from _names(field.dataType, f"{path}.")
    elif isinstance(kind, ArrayType):
        yield from _names(kind.elementType, prefix)
    elif isinstance(kind, MapType):
        yield from _names(kind.keyType, prefix)
        yield from _names(kind.valueType, prefix)


def identity_columns(schema: StructType) -> list[str]:
    """Columns of a published table that must not be there."""
    return [path for path, name in _names(schema) if name.lower() in IDENTITY_COLUMNS]
