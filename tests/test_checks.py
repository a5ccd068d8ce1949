import datetime as dt

import pytest
from pyspark.sql import functions as F

from skytally.operators import quality
from skytally.plans import checks, contracts
from skytally.schemas import INGESTION_RUNS, STATE_VECTORS
from skytally.settings import Feed

NOW = dt.datetime(2025, 9, 10, 12)
UTC = dt.timezone.utc


def run_rows(spark, *rows):
    """(minutes ago, status, received, rejected, credits)"""
    data = []
    for i, (ago, status, received, rejected, credits) in enumerate(rows):
        started = NOW.replace(tzinfo=UTC) - dt.timedelta(minutes=ago)
        finished = None if status == "running" else started
        data.append((f"r{i}", "s", "/e", (49.0, 61.0, -10.0, 3.0), "anonymous", credits, started, finished, status,
                     None, None, received, rejected, None, None, None))
    return spark.createDataFrame(data, INGESTION_RUNS)


def landed(spark, *minutes_ago):
    rows = [
        tuple(
            NOW.replace(tzinfo=UTC) - dt.timedelta(minutes=m) if f.name == "ingested_at" else None
            for f in STATE_VECTORS
        )
        for m in minutes_ago
    ]
    return spark.createDataFrame(rows, STATE_VECTORS)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_freshness(spark):
    fresh = only(checks.check_freshness(landed(spark, 300, 5), NOW))
    assert (fresh.name, fresh.ok, fresh.value, fresh.threshold) == ("freshness", True, 5.0, 6.0)
    assert fresh.detail == "last landed 5.0 minutes ago, allowed are 6.0"
    assert not only(checks.check_freshness(landed(spark, 7), NOW)).ok
    assert only(checks.check_freshness(landed(spark, 7), NOW, Feed(poll_interval_seconds=300))).ok
    empty = only(checks.check_freshness(landed(spark), NOW))
    assert (empty.ok, empty.value, empty.threshold) == (False, None, 6.0) and empty.detail == "no observation has been landed yet"


def test_failure_rate(spark):
    assert only(checks.check_run_failure_rate(run_rows(spark, *[(5, "failed", None, None, 3)] * 3), NOW)).value == 100.0
    row = only(checks.check_run_failure_rate(run_rows(spark, (5, "failed", None, None, 3), *[(9, "succeeded", 1, 0, 3)] * 4), NOW))
    assert (row.ok, row.value, row.detail) == (True, 20.0, "failed within the hour: 1 of 5 runs, 20.0%")
    old = only(checks.check_run_failure_rate(run_rows(spark, (61, "failed", None, None, 3)), NOW))
    assert (old.ok, old.value, old.threshold) == (True, None, None) and old.detail.startswith("not judged")


def test_stuck_runs(spark):
    row = only(checks.check_no_stuck_runs(run_rows(spark, (120, "running", None, None, 3), (3000, "running", None, None, 3), (14, "running", None, None, 3)), NOW))
    assert (row.ok, row.value) == (False, 2.0)
    assert row.detail == "2 unfinished for more than 15 minutes"
    assert only(checks.check_no_stuck_runs(run_rows(spark, (15, "running", None, None, 3)), NOW)).ok


def test_reject_rate(spark):
    row = only(checks.check_reject_rate(run_rows(spark, (5, "succeeded", 100, 50, 3), (5, "failed", 900, 0, 3)), NOW))
    assert (row.ok, row.value, row.detail) == (False, 50.0, "rejected within the hour: 50 of 100 rows, 50.000%")
    assert only(checks.check_reject_rate(run_rows(spark, (5, "succeeded", 100, 1, 3)), NOW)).ok
    assert only(checks.check_reject_rate(run_rows(spark, (5, "succeeded", 0, 0, 3)), NOW)).value is None


def test_credit_budget(spark):
    many = run_rows(spark, *[(10 + i, "succeeded", 1, 0, 3) for i in range(130)], (1500, "succeeded", 1, 0, 4))
    row = only(checks.check_credit_budget(many, NOW))
    assert (row.ok, row.value, row.threshold) == (False, 390.0, 360.0)
    assert row.detail == "390 of 400 daily credits used (anonymous)"
    assert only(checks.check_credit_budget(many, NOW, Feed(registered=True))).ok


def test_all_checks_and_summary(spark):
    results = checks.run_health_checks(landed(spark), run_rows(spark, (120, "running", None, None, 3)), NOW)
    assert sorted(r.name for r in results.collect()) == [
        "credit_budget", "freshness", "no_stuck_runs", "reject_rate", "run_failure_rate",
    ]
    summary = only(checks.health_summary(results))
    assert (summary.total, summary.failed, summary.failed_checks) == (5, 2, ["freshness", "no_stuck_runs"])


@pytest.mark.parametrize(("ago", "status"), [((30,), "pass"), ((31,), "warn"), ((360,), "warn"), ((361,), "error"), ((), "error")])
def test_source_freshness(spark, ago, status):
    assert only(quality.source_freshness(landed(spark, *ago), NOW)).status == status


def test_newest_ingest_may_lie_in_an_old_day(spark, lake):
    rows = landed(spark, 500, 3)
    rows = rows.withColumn("observed_at", F.when(F.minute("ingested_at") == 57, NOW - dt.timedelta(days=9)).otherwise(F.lit(NOW)))
    # Only rows with a key, a run and a flag are landed.
    needed = {"icao24": F.lit("a"), "on_ground": F.lit(False), "ingestion_run_id": F.lit("run")}
    lake.append(rows.withColumns(needed), "a")
    newest = only(quality.newest_ingest(lake.landing())).last_ingested_at
    assert newest == only(rows.agg(F.max("ingested_at").alias("m"))).m
    assert only(lake.newest_ingest()).last_ingested_at == newest


def test_ranges(spark):
    rows = spark.createDataFrame([(None,), (0.0,), (1.0,), (1.5,), (-0.1,), (float("nan"),)], "x double")
    bad = [r.x for r in quality.accepted_range(rows, "x", 0, 1).collect()]
    assert len(bad) == 3 and {1.5, -0.1} <= set(bad)
    assert quality.accepted_range(rows, "x", 0, 1, inclusive=False).count() == 5
    assert quality.accepted_range(rows, "x", low=0).count() == 2


def test_null_passes_unless_forbidden(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 1), ("b", 2), (None, 1)], "s string, k int")
    assert quality.accepted_values(rows, "s", ["a"]).count() == 1
    assert quality.expression_is_true(rows, F.col("s") == "a").count() == 1
    assert quality.not_null(rows, "s").count() == 2
    assert quality.unique(rows, "s").count() == 0
    assert quality.repeated_keys(rows, "s", "k").collect()[0].row_count == 2
    assert quality.orphans(rows, "s", spark.createDataFrame([("a",)], "id string"), "id").collect()[0].s == "b"


def test_identity_guard_turns_red(spark):
    clean = spark.createDataFrame([], "activity_hour timestamp, grid_lat double")
    assert quality.identity_columns(clean.schema) == []
    leaky = spark.createDataFrame([], "a int, ICAO24 string, s struct<x: int, Squawk: string>, l array<struct<callsign: string>>")
    assert quality.identity_columns(leaky.schema) == ["ICAO24", "s.Squawk", "l.callsign"]
    report = contracts.contract_report(
        {"health": spark.createDataFrame([], "health_hour timestamp, run_count bigint, success_rate_pct double, "
                                             "reject_rate_pct double, credits_consumed bigint, spi boolean")}
    )
    assert [r.violations for r in report.where("assertion = 'no_identity'").collect()] == [1]


def test_rule_split(spark):
    rows = run_rows(spark, (5, "running", None, None, 3), (5, "paused", None, None, 3))
    broken = quality.with_broken_rules(rows, quality.ingestion_run_rules())
    assert {r.status: list(r.broken_rules) for r in broken.collect()} == {"running": [], "paused": ["status_known"]}
