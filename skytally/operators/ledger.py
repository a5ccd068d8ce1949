"""The run ledger without updates: two events per run, folded into its present state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import instant, seconds_between
from skytally.schemas import INGESTION_RUNS
from skytally.settings import (
    SECONDS_PER_DAY,
    Feed,
    bbox_area,
    credit_cost,
    daily_allowance,
)
from skytally.sources.payloads import PAYLOAD_ERRORS

ERROR_LENGTH = 2000
STARTED, FINISHED = ("started", 0), ("finished", 1)


def run_id(load_id: str) -> Column:
    """The run of a payload(payload, source_file): the same payload in the same load is always the same run.

    An archive may repeat a file name, so the content counts too.
    """
    return F.sha2(F.concat_ws("|", F.lit(load_id), F.col("source_file"), F.sha2("payload", 256)), 256)


def _event(runs: DataFrame, feed: Feed, load_id: str, started_at: dt.datetime, kind, **outcome: Column) -> DataFrame:
    name, seq = kind
    reasons = outcome.pop("reject_reasons", F.lit(None))
    known = {
        "source": F.lit(feed.source),
        "source_endpoint": F.lit(feed.endpoint),
        "request_bbox": feed.region.as_struct(),
        "auth_mode": F.lit(feed.auth_mode),
        "credits_estimated": credit_cost(F.lit(feed.region.area_sq_deg)),
        "started_at": instant(started_at),
        **outcome,
    }
    columns = [
        known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
        for f in INGESTION_RUNS
        if f.name != "run_id"
    ]
    return runs.select(
        "run_id",
        *columns,
        F.lit(seq).alias("event_seq"),
        reasons.cast("map<string,bigint>").alias("reject_reasons"),
        F.lit(load_id).alias("load_id"),
        F.lit(name).alias("event"),
    )


def started(runs: DataFrame, feed: Feed, load_id: str, started_at: dt.datetime) -> DataFrame:
    """Written before any work, so that a run that dies stays visible as running."""
    return _event(runs, feed, load_id, started_at, STARTED, status=F.lit("running"))


def finished(
    accounting: DataFrame, feed: Feed, load_id: str, started_at: dt.datetime, finished_at: dt.datetime
) -> DataFrame:
    """Outcome per run; a run whose payload was unusable has failed and has no counts.

    ``accounting`` may carry ``reject_reasons``, the counts by reason.
    """
    reasons = F.col("reject_reasons") if "reject_reasons" in accounting.columns else F.lit(None)
    usable = F.col("payload_status") == "ok"
    messages = F.create_map(*[F.lit(x) for pair in PAYLOAD_ERRORS.items() for x in pair])
    return _event(
        accounting,
        feed,
        load_id,
        started_at,
        FINISHED,
        finished_at=instant(finished_at),
        status=F.when(usable, "succeeded").otherwise("failed"),
        http_status=F.when(usable, 200),
        api_snapshot_time=F.col("api_snapshot_time"),
        error_message=F.when(~usable, clipped(F.try_element_at(messages, F.col("payload_status")))),
        reject_reasons=F.when(usable, reasons),
        **{c: F.when(usable, F.col(c)) for c in ("rows_received", "rows_rejected", "rows_inserted", "rows_duplicate")},
    )


def failed(
    runs: DataFrame, feed: Feed, load_id: str, started_at: dt.datetime, finished_at: dt.datetime, error: str
) -> DataFrame:
    return _event(
        runs,
        feed,
        load_id,
        started_at,
        FINISHED,
        finished_at=instant(finished_at),
        status=F.lit("failed"),
        error_message=clipped(F.lit(error)),
    )


def clipped(message: Column) -> Column:
    return F.nullif(F.substring(message, 1, ERROR_LENGTH), F.lit(""))


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: its latest event.

    The latest of whole rows is found by sorting. Rows of a run are brought
    together first, or every reading task would sort all it reads, and a file
    of gathered events holds very many.
    """
    columns = [f.name for f in INGESTION_RUNS]
    return (
        events.repartition("run_id")
        .groupBy("run_id")
        .agg(F.max_by(F.struct(*columns[1:]), F.col("event_seq")).alias("latest"))
        .select("run_id", "latest.*")
    )


def run_reject_reasons(events: DataFrame) -> DataFrame:
    """``(run_id, reason, row_count)`` as the runs' last events hold them."""
    latest = events.groupBy("run_id").agg(F.max_by("reject_reasons", "event_seq").alias("reasons"))
    return latest.select("run_id", F.explode("reasons").alias("reason", "row_count"))


def snapshot_lag(runs: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Age of the served snapshot when it was received, in seconds."""
    return runs.where(F.col("api_snapshot_time").isNotNull()).withColumn(
        "lag_seconds", F.round(seconds_between(instant(as_of), F.col("api_snapshot_time")), 1)
    )


def box_costs(runs: DataFrame) -> DataFrame:
    """Distinct requested boxes with their area and price."""
    return (
        runs.select("request_bbox")
        .distinct()
        .withColumn("area_sq_deg", bbox_area(F.col("request_bbox")))
        .withColumn("credits", credit_cost(F.col("area_sq_deg")))
    )


def cadence_budget(runs: DataFrame, poll_interval_seconds: int) -> DataFrame:
    """Daily spend of every configuration found in the ledger, polled at one cadence."""
    polls = SECONDS_PER_DAY // poll_interval_seconds
    return (
        runs.groupBy("auth_mode", "request_bbox")
        .agg(F.count("*").alias("run_count"))
        .withColumn("credit_cost", credit_cost(bbox_area(F.col("request_bbox"))))
        .withColumn("daily_credit_budget", F.lit(polls) * F.col("credit_cost"))
        .withColumn("daily_allowance", daily_allowance(F.col("auth_mode")))
        .withColumn("over_budget", F.col("daily_credit_budget") > F.col("daily_allowance"))
    )
