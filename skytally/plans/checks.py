"""Health checks of the ingestion: ``(name, ok, detail, value, threshold)`` each.

All of them come from one pass over the recent runs and one over the landing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import count_where, hours_before, instant, seconds_between
from skytally.operators.quality import newest_ingest
from skytally.settings import Feed

# Limits; fixed values.
STALENESS_POLLS = 3
STUCK_MINUTES = 15
MAX_FAILURE_PCT = 20.0
MAX_REJECT_PCT = 1.0
CREDIT_FRACTION = 0.9

DETAIL = {
    "freshness_empty": "no observation has been landed yet",
    "freshness": "last landed %.1f minutes ago, allowed are %.1f",
    "no_runs": "not judged: no run started within the hour",
    "failures": "failed within the hour: %d of %d runs, %.1f%%",
    "stuck": "%d unfinished for more than %d minutes",
    "none_stuck": "every run has finished or is recent",
    "no_rows": "not judged: no row received within the hour",
    "rejects": "rejected within the hour: %d of %d rows, %.3f%%",
    "credits": "%.0f of %d daily credits used (%s)",
}


def _result(name: str, ok: Column, detail: Column, value: Column, threshold: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        ok.alias("ok"),
        detail.alias("detail"),
        value.cast("double").alias("value"),
        threshold.cast("double").alias("threshold"),
    )


def _rows(measures: DataFrame, *results: Column) -> DataFrame:
    return measures.select(F.inline(F.array(*results)))


def _run_measures(runs: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """One row. Only the last day, and runs never finished, can matter."""
    now = instant(as_of)
    started, status = F.col("started_at"), F.col("status")
    last_hour = started >= hours_before(now, 1)
    last_day = started >= hours_before(now, 24)
    judged = last_hour & (status == "succeeded")
    stuck = (status == "running") & (started < now - F.make_dt_interval(mins=F.lit(STUCK_MINUTES)))
    return runs.where(last_day | (status == "running")).agg(
        count_where(last_hour).alias("runs"),
        count_where(last_hour & (status == "failed")).alias("failed"),
        count_where(stuck).alias("stuck"),
        F.coalesce(F.sum(F.when(judged, F.col("rows_received"))), F.lit(0)).alias("received"),
        F.coalesce(F.sum(F.when(judged, F.col("rows_rejected"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(last_day, F.col("credits_estimated"))), F.lit(0)).alias("credits"),
    )


def _unless(empty: Column, value: Column) -> Column:
    return F.when(~empty, value)


def _failure_rate() -> Column:
    none = F.col("runs") == 0
    rate = F.lit(100.0) * F.col("failed") / F.nullif(F.col("runs"), F.lit(0))
    text = F.format_string(DETAIL["failures"], "failed", "runs", rate)
    return _result(
        "run_failure_rate",
        none | F.coalesce(rate <= MAX_FAILURE_PCT, F.lit(False)),
        F.when(none, DETAIL["no_runs"]).otherwise(text),
        F.round(rate, 1),
        _unless(none, F.lit(MAX_FAILURE_PCT)),
    )


def _stuck() -> Column:
    count = F.col("stuck")
    text = F.format_string(DETAIL["stuck"], count, F.lit(STUCK_MINUTES))
    return _result(
        "no_stuck_runs",
        count == 0,
        F.when(count == 0, DETAIL["none_stuck"]).otherwise(text),
        count,
        F.lit(0),
    )


def _reject_rate() -> Column:
    none = F.col("received") == 0
    rate = F.lit(100.0) * F.col("rejected") / F.nullif(F.col("received"), F.lit(0))
    text = F.format_string(DETAIL["rejects"], "rejected", "received", rate)
    return _result(
        "reject_rate",
        none | F.coalesce(rate <= MAX_REJECT_PCT, F.lit(False)),
        F.when(none, DETAIL["no_rows"]).otherwise(text),
        F.round(rate, 3),
        _unless(none, F.lit(MAX_REJECT_PCT)),
    )


def _credits(feed: Feed) -> Column:
    limit = feed.allowance * CREDIT_FRACTION
    spent = F.col("credits").cast("double")
    text = F.format_string(DETAIL["credits"], spent, F.lit(feed.allowance), F.lit(feed.auth_mode))
    return _result("credit_budget", spent <= limit, text, spent, F.lit(limit))


def check_freshness(landed: DataFrame, as_of: dt.datetime | Column, feed: Feed | None = None) -> DataFrame:
    """Is data still arriving? An empty landing fails."""
    limit = (feed or Feed()).poll_interval_seconds * STALENESS_POLLS / 60
    age = seconds_between(instant(as_of), F.col("last_ingested_at")) / 60
    text = F.format_string(DETAIL["freshness"], age, F.lit(limit))
    return _rows(
        newest_ingest(landed),
        _result(
            "freshness",
            F.coalesce(age <= limit, F.lit(False)),
            F.when(age.isNull(), DETAIL["freshness_empty"]).otherwise(text),
            F.round(age, 1),
            F.lit(limit),
        ),
    )


def check_run_failure_rate(runs: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    return _rows(_run_measures(runs, as_of), _failure_rate())


def check_no_stuck_runs(runs: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    return _rows(_run_measures(runs, as_of), _stuck())


def check_reject_rate(runs: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Of succeeded runs only; the published health table counts all of them."""
    return _rows(_run_measures(runs, as_of), _reject_rate())


def check_credit_budget(runs: DataFrame, as_of: dt.datetime | Column, feed: Feed | None = None) -> DataFrame:
    return _rows(_run_measures(runs, as_of), _credits(feed or Feed()))


def run_health_checks(
    landed: DataFrame, runs: DataFrame, as_of: dt.datetime | Column, feed: Feed | None = None
) -> DataFrame:
    """Every check's row. A failed check is a row, not an error."""
    feed = feed or Feed()
    of_runs = _rows(
        _run_measures(runs, as_of), _failure_rate(), _stuck(), _reject_rate(), _credits(feed)
    )
    return check_freshness(landed, as_of, feed).unionByName(of_runs)


def health_summary(results: DataFrame) -> DataFrame:
    failed = ~F.col("ok")
    return results.agg(
        F.count("*").alias("total"),
        count_where(failed).alias("failed"),
        F.array_sort(F.collect_list(F.when(failed, F.col("name")))).alias("failed_checks"),
    )
