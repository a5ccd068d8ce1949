"""Streaming forms of the tables, complete however the input is cut or ordered.

Each micro-batch adds partial results as a part of a versioned table, and
reading merges them. Nothing waits for a watermark, so no late row is dropped.
Four parts of a tier are merged into one of the next, so that after n batches a
read opens some log n folders. A batch that is replayed is found to be counted
already; an input that is read again from the start needs a new checkpoint and
a new path. Distinct counts are exact: the partials hold each member of a cell once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skytally.functions.columns import count_where, mean_bearing, percentage, resultant_length
from skytally.operators.landing import ARRIVAL_ORDER, first_wins
from skytally.plans.staging import grid_observations, stage_observations, stage_runs
from skytally.schemas import HOURLY_ACTIVITY, conform
from skytally.sources.versions import Part, Version, VersionedTable
from skytally.streaming.landing import query_id

HOURLY_KEY = ("activity_hour", "grid_lat", "grid_lon", "altitude_band")

#: Parts of a tier that become one of the next, and versions whose folders are kept for readers under way.
FAN_IN = 4
KEPT_VERSIONS = 10


def append_partials(
    stream: DataFrame,
    partial: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    merge: Callable[[DataFrame], DataFrame] = lambda parts: parts,
) -> StreamingQuery:
    """Add ``partial`` of each micro-batch and stop once all present input is read.

    ``merge`` makes partials of several batches one, without changing what they add up to.
    """
    spark = stream.sparkSession

    def add(batch: DataFrame, batch_id: int) -> None:
        add_partial(spark, partial(batch), path, query_id(spark, checkpoint), batch_id, merge)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def add_partial(
    spark: SparkSession, rows: DataFrame, path: str, query: str, batch_id: int, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """One batch of one query. A part notes the first and last batch it holds of each query."""
    table = VersionedTable(spark, path, rows.schema)
    current = table.current()
    held = [p.facts["batches"].get(query) for p in current.parts]
    if not any(span and span[0] <= batch_id <= span[1] for span in held):
        part = table.write(rows, {"tier": 0, "batches": {query: [batch_id, batch_id]}})
        current = table.commit(current, [*current.parts, part], {"schema": json.loads(rows.schema.json())})
    _merge_tiers(table, current, merge)


def _merge_tiers(table: VersionedTable, current: Version, merge: Callable[[DataFrame], DataFrame]) -> None:
    tier = 0
    while any(p.facts["tier"] >= tier for p in current.parts):
        full = sorted((p for p in current.parts if p.facts["tier"] == tier), key=lambda p: p.added)[:FAN_IN]
        if len(full) == FAN_IN:
            rows = merge(table.read(Version(parts=tuple(full))))
            merged = table.write(rows, {"tier": tier + 1, "batches": _spans(full)})
            current = table.commit(current, [*(p for p in current.parts if p not in full), merged])
            table.vacuum(KEPT_VERSIONS)
        tier += 1


def _spans(parts: list[Part]) -> dict[str, list[int]]:
    """First and last batch of each query; the oldest parts of a tier hold neighbours."""
    spans: dict[str, list[int]] = {}
    for part in parts:
        for query, (first, last) in part.facts["batches"].items():
            known = spans.setdefault(query, [first, last])
            known[:] = min(known[0], first), max(known[1], last)
    return spans


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    table = VersionedTable(spark, path, StructType())
    version = table.current()
    return table.read(version, schema=StructType.fromJson(version.facts["schema"]))


def _summed(column: str, own: Column) -> list[Column]:
    value = F.when(own, F.col(column))
    return [F.sum(value).alias(f"{column}_sum"), F.count(value).alias(f"{column}_n")]


def _mean(column: str) -> Column:
    return F.try_divide(F.col(f"{column}_sum"), F.col(f"{column}_n"))


MEANS = ("baro_altitude_ft", "velocity_kts", "track_sin", "track_cos")
#: What a partial row is about: the cell itself, or one of its members.
CELL, AIRCRAFT, RUN = "cell", "aircraft", "run"


def hourly_partials(landed: DataFrame, grid_degrees: float = 1) -> DataFrame:
    """Mergeable parts of the hourly table, for :func:`merged_hours`: cells, their aircraft and their runs.

    One pass: each observation counts for its cell, its aircraft there and its run
    there, and is added up per task before anything is shuffled.
    """
    gridded = grid_observations(stage_observations(landed), grid_degrees)
    members = F.array(
        *[F.struct(F.lit(kind).alias("kind"), member.alias("member")) for kind, member in (
            (CELL, F.lit(None).cast("string")), (AIRCRAFT, F.col("icao24")), (RUN, F.col("ingestion_run_id")),
        )]
    )
    own = F.col("kind") == CELL
    return (
        gridded.select("*", F.inline(members))
        .groupBy(F.col("observed_hour").alias("activity_hour"), *HOURLY_KEY[1:], "kind", "member")
        .agg(
            F.count(F.when(own, 1)).alias("observation_count"),
            *(part for c in MEANS for part in _summed(c, own)),
            F.min(F.when(own, F.col("observed_at"))).alias("first_observed_at"),
            F.max(F.when(own, F.col("observed_at"))).alias("last_observed_at"),
            F.max(F.when(own, F.col("ingested_at"))).alias("last_ingested_at"),
        )
    )


def merge_hours(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one."""
    added = ("observation_count", *(f"{c}_{part}" for c in MEANS for part in ("sum", "n")))
    merged = partials.groupBy(*HOURLY_KEY, "kind", "member").agg(
        *(F.sum(c).alias(c) for c in added),
        F.min("first_observed_at").alias("first_observed_at"),
        F.max("last_observed_at").alias("last_observed_at"),
        F.max("last_ingested_at").alias("last_ingested_at"),
    )
    return merged.select(partials.columns)


def merged_hours(partials: DataFrame) -> DataFrame:
    """The hourly table of all batches."""
    own = F.col("kind") == CELL
    measures = ("observation_count", *(f"{c}_{part}" for c in MEANS for part in ("sum", "n")))
    moments = ("first_observed_at", "last_observed_at", "last_ingested_at")
    totals = (
        merge_hours(partials)
        .groupBy(*HOURLY_KEY)
        .agg(
            *(F.max(F.when(own, F.col(c))).alias(c) for c in (*measures, *moments)),
            count_where(F.col("kind") == AIRCRAFT).alias("distinct_aircraft"),
            count_where((F.col("kind") == RUN) & F.col("member").isNotNull()).alias("contributing_run_count"),
        )
    )
    hours = totals.withColumns(
        {
            "avg_baro_altitude_ft": F.round(_mean("baro_altitude_ft"), 0),
            "avg_velocity_kts": F.round(_mean("velocity_kts"), 1),
            "track_sample_count": F.col("track_sin_n"),
            "dominant_track_deg": mean_bearing(_mean("track_sin"), _mean("track_cos")),
            "track_concentration": resultant_length(_mean("track_sin"), _mean("track_cos")),
        }
    )
    return conform(hours, HOURLY_ACTIVITY)


RUN_SUMS = ("rows_received", "rows_inserted", "rows_duplicate", "rows_rejected", "credits_estimated")
LAGS = ("duration_seconds", "end_to_end_lag_seconds")


def health_partials(runs: DataFrame) -> DataFrame:
    """Mergeable parts of the hourly health, for :func:`merged_health`. The stream holds each run once."""
    return stage_runs(runs).groupBy(F.col("started_hour").alias("health_hour"), "status").agg(
        F.count("*").alias("run_count"),
        *(F.sum(c).alias(c) for c in RUN_SUMS),
        *(part for c in LAGS for part in _summed(c, F.lit(True))),
        F.max("end_to_end_lag_seconds").alias("max_lag_seconds"),
        F.max("finished_at").alias("last_finished_at"),
    )


def merge_health(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one."""
    added = ("run_count", *RUN_SUMS, *(f"{c}_{part}" for c in LAGS for part in ("sum", "n")))
    merged = partials.groupBy("health_hour", "status").agg(
        *(F.sum(c).alias(c) for c in added),
        F.max("max_lag_seconds").alias("max_lag_seconds"),
        F.max("last_finished_at").alias("last_finished_at"),
    )
    return merged.select(partials.columns)


def merged_health(partials: DataFrame) -> DataFrame:
    def runs_that(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("run_count"))), F.lit(0))

    return partials.groupBy("health_hour").agg(
        F.sum("run_count").alias("run_count"),
        runs_that("succeeded").alias("succeeded_count"),
        runs_that("failed").alias("failed_count"),
        runs_that("running").alias("still_running_count"),
        percentage(runs_that("succeeded"), F.sum("run_count"), 1).alias("success_rate_pct"),
        *(F.sum(c).alias(c) for c in RUN_SUMS[:4]),
        percentage(F.sum("rows_rejected"), F.sum("rows_received"), 3).alias("reject_rate_pct"),
        F.round(F.try_divide(F.sum("duration_seconds_sum"), F.sum("duration_seconds_n")), 3).alias("avg_duration_seconds"),
        F.round(F.try_divide(F.sum("end_to_end_lag_seconds_sum"), F.sum("end_to_end_lag_seconds_n")), 1).alias(
            "avg_lag_seconds"
        ),
        F.round(F.max("max_lag_seconds"), 1).alias("max_lag_seconds"),
        F.sum("credits_estimated").alias("credits_consumed"),
        F.max("last_finished_at").alias("last_finished_at"),
    )


def deduplicated(reports: DataFrame, order: tuple[str, ...] = ARRIVAL_ORDER) -> DataFrame:
    """The first report of every key; as partial of a batch and again over all of them."""
    return first_wins(reports, order)
