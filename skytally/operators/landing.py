"""Idempotent landing: the first report of a key wins, later ones are counted."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions.columns import instant
from skytally.operators import ledger
from skytally.operators.parse import explode_states, validate
from skytally.schemas import OBSERVATION_KEY
from skytally.settings import Feed
from skytally.sources.payloads import open_payloads
from skytally.sources.tables import Lake

ARRIVAL_ORDER = ("api_snapshot_time", "source_file", "pos")


class LoadConflict(ValueError):
    """A load id that is already taken by other payloads."""


def first_wins(rows: DataFrame, order: tuple[str, ...] = ARRIVAL_ORDER, key=OBSERVATION_KEY) -> DataFrame:
    """Keep the earliest row of every key.

    Ranking with a limit of one lets Spark drop the losers of each input partition
    before the shuffle, so a key repeated over a third of the input still sends
    one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def not_landed(
    candidates: DataFrame, landed_keys: DataFrame, key=OBSERVATION_KEY, wanted: DataFrame | None = None
) -> DataFrame:
    """Candidates whose key is not landed yet.

    The landing is cut down to the candidates' keys first. That join may broadcast
    the (usually much smaller) candidates if Spark measures them as small, so the
    landing need not be shuffled; what is left is never larger than the candidates.
    ``wanted`` holds the candidates' keys where they are cheaper to get than from
    the ranked rows.
    """
    wanted = candidates.select(*key) if wanted is None else wanted
    clashes = landed_keys.select(*key).join(wanted, list(key), "left_semi")
    return candidates.join(clashes, list(key), "left_anti")


def account(validated: DataFrame, inserted: DataFrame, scope: list[str]) -> DataFrame:
    """Counts per run, such that received = rejected + inserted + duplicate.

    ``validated`` may hold a row with a null ``pos`` for a payload without states;
    it keeps the run in the result and counts as nothing. ``inserted`` is matched on
    as much of the scope as it carries.
    """
    received = F.count("pos")
    rejected = F.count(F.when(F.col("pos").isNotNull(), F.col("reason")))
    per_run = validated.groupBy(*scope).agg(
        received.alias("rows_received"), rejected.alias("rows_rejected")
    )
    identity = [c for c in scope if c in inserted.columns]
    counted = per_run.join(inserted.groupBy(*identity).agg(F.count("*").alias("rows_inserted")), identity, "left")
    landed = F.coalesce("rows_inserted", F.lit(0))
    return counted.select(
        *scope,
        "rows_received",
        "rows_rejected",
        landed.alias("rows_inserted"),
        (F.col("rows_received") - F.col("rows_rejected") - landed).alias("rows_duplicate"),
    )


def stamp(rows: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """Provenance of every row: its run, the snapshot's own time, and when it landed."""
    return rows.withColumnRenamed("run_id", "ingestion_run_id").withColumn("ingested_at", instant(ingested_at))


def reject_maps(validated: DataFrame) -> DataFrame:
    """``(run_id, reject_reasons)``: how many rows of a run were rejected for which reason."""
    counts = validated.where(F.col("pos").isNotNull() & F.col("reason").isNotNull()).groupBy("run_id", "reason").count()
    entries = F.array_sort(F.collect_list(F.struct("reason", "count")))  # one for each reason there is
    return counts.groupBy("run_id").agg(F.map_from_entries(entries).alias("reject_reasons"))


def judge(payloads: DataFrame, load_id: str, as_of: dt.datetime) -> DataFrame:
    """Payloads to validated rows, in one pass; payloads without rows keep one empty row."""
    opened = open_payloads(payloads.withColumn("run_id", ledger.run_id(load_id)))
    return validate(explode_states(opened, keep_empty=True), as_of)


def _require_same_runs(lake: Lake, load_id: str, runs: DataFrame) -> None:
    recorded = lake.ledger(load_id=load_id).select("run_id").distinct()
    if recorded.isEmpty():
        return
    both = recorded.withColumn("recorded", F.lit(1)).join(runs.withColumn("given", F.lit(1)), "run_id", "full_outer")
    if not both.where("recorded is null or given is null").isEmpty():
        raise LoadConflict(f"load {load_id!r} has been recorded with other payloads")


def land_snapshots(
    payloads: DataFrame,
    lake: Lake,
    load_id: str,
    as_of: dt.datetime,
    feed: Feed | None = None,
    finished_at: dt.datetime | None = None,
) -> None:
    """Land a set of payloads; every payload is a run of its own.

    Repeating a load with the same ``load_id`` leaves the tables as one run would.
    With other payloads it would replace what the first one landed, so that is refused.
    """
    feed = feed or Feed()
    runs = payloads.select(ledger.run_id(load_id).alias("run_id")).distinct()
    _require_same_runs(lake, load_id, runs)
    lake.record(ledger.started(runs, feed, load_id, as_of))

    # Parsing is the expensive part and its result is needed three times. A lost
    # block is parsed again from the payloads, with the same outcome.
    validated = judge(payloads, load_id, as_of).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid = validated.where(F.col("pos").isNotNull() & F.col("reason").isNull())
        # One row; the days lie between the earliest plausible one and tomorrow.
        span = valid.agg(
            F.min(F.unix_micros("observed_at")).alias("first"),
            F.max(F.unix_micros("observed_at")).alias("last"),
            F.collect_set(F.to_date("observed_at")).alias("dates"),
        ).first()
        seen = lake.observations.current()
        fresh = first_wins(valid)
        if span.dates:
            landed = lake.landing(span.dates, version=seen, without=load_id).where(
                F.col("observed_at").between(
                    F.timestamp_micros(F.lit(span.first)), F.timestamp_micros(F.lit(span.last))
                )
            )
            wanted = valid.select(*OBSERVATION_KEY).distinct()
            fresh = not_landed(fresh, landed, wanted=wanted)
        unread = validated.where(F.col("pos").isNotNull() & F.col("reason").isNotNull())
        rejected = unread.select("run_id", "reason", "raw", instant(as_of).alias("ingested_at"))
        lake.append(stamp(fresh, as_of), load_id, rejected, seen)

        # Counted from the table itself: what was cached could be recomputed
        # against a landing that already holds this load.
        inserted = lake.landing(span.dates, load_id=load_id).select(F.col("ingestion_run_id").alias("run_id"))
        scope = ["run_id", "payload_status", "api_snapshot_time"]
        done = finished_at or dt.datetime.now(dt.timezone.utc)
        accounting = account(validated, inserted, scope).join(reject_maps(validated), "run_id", "left")
        lake.record(ledger.finished(accounting, feed, load_id, as_of, done))
    except Exception as error:
        done = finished_at or dt.datetime.now(dt.timezone.utc)
        message = f"{type(error).__name__}: {error}"[: ledger.ERROR_LENGTH]
        lake.record(ledger.failed(runs, feed, load_id, as_of, done, message))
        raise
    finally:
        validated.unpersist()
