import datetime as dt

import pytest
from conftest import AS_OF, EPOCH, airborne, normal, payload_text, three_rows
from pyspark.sql import functions as F

from skytally.operators import landing, ledger, quality
from skytally.settings import Feed, Region, credit_cost
from skytally.sources.tables import MartsNotBuilt

LATER = AS_OF + dt.timedelta(minutes=2)


def land(lake, payloads, load_id, as_of=AS_OF, **kw):
    landing.land_snapshots(payloads, lake, load_id, as_of, finished_at=as_of + dt.timedelta(seconds=3), **kw)


def runs(lake, load_id=None):
    events = lake.ledger() if load_id is None else lake.ledger().where(F.col("load_id") == load_id)
    return ledger.run_states(events)


def counts(row):
    return row.rows_received, row.rows_rejected, row.rows_inserted, row.rows_duplicate


def test_second_load_inserts_nothing_and_keeps_provenance(lake, payloads):
    source = payloads(payload_text(three_rows()))
    land(lake, source, "a")
    before = normal(lake.landing().collect())
    land(lake, source, "b", LATER)
    assert normal(lake.landing().collect()) == before
    assert counts(runs(lake, "a").first()) == (3, 0, 3, 0)
    assert counts(runs(lake, "b").first()) == (3, 0, 0, 3)
    assert quality.attributed_rows(lake.landing(), runs(lake)).first()[0] == 3
    assert quality.orphans(lake.landing(), "ingestion_run_id", runs(lake), "run_id").count() == 0


def test_repeating_a_load_changes_nothing(lake, payloads):
    source = payloads(payload_text(three_rows()), payload_text(three_rows(EPOCH + 50), EPOCH + 50))
    land(lake, source, "a")
    before, ledger_before = normal(lake.landing().collect()), normal(runs(lake).collect())
    land(lake, source, "a")
    assert normal(lake.landing().collect()) == before
    assert normal(runs(lake).collect()) == ledger_before


def test_first_report_wins_across_the_payloads_of_a_load(lake, payloads):
    early = airborne("aaaaaa", EPOCH, 51.0, 0.0, 10.0, velocity=1.0)
    late = airborne("aaaaaa", EPOCH, 51.0, 0.0, 10.0, velocity=2.0)
    # The payload that is older by its own time comes second in the input.
    source = payloads(payload_text([late, late], EPOCH + 10), payload_text([early, late], EPOCH + 5))
    land(lake, source, "a")
    row = lake.landing().first()
    assert lake.landing().count() == 1 and row.velocity_ms == 1.0
    assert sorted(counts(r) for r in runs(lake).collect()) == [(2, 0, 0, 2), (2, 0, 1, 1)]


def test_unusable_payload_is_a_failed_run_without_rows(lake, payloads):
    land(lake, payloads("[]", payload_text(three_rows()), payload_text(None)), "a")
    by_status = {(r.status, r.error_message): counts(r) for r in runs(lake).collect() if r.status == "failed"}
    assert by_status == {("failed", "payload is not a JSON object"): (None, None, None, None)}
    assert sorted(counts(r) for r in runs(lake).collect() if r.status == "succeeded") == [(0, 0, 0, 0), (3, 0, 3, 0)]
    assert lake.landing().count() == 3
    assert quality.ledger_balance(runs(lake)).count() == 0
    assert runs(lake).where("status = 'succeeded'").first().http_status == 200


def test_failure_of_the_job_is_recorded(lake, payloads, monkeypatch):
    def broken(*_):
        raise RuntimeError("x" * 5000)

    monkeypatch.setattr(lake, "append", broken)
    with pytest.raises(RuntimeError):
        land(lake, payloads(payload_text(three_rows())), "a")
    run = runs(lake).first()
    assert run.status == "failed" and len(run.error_message) == 2000
    assert run.error_message.startswith("RuntimeError: x")
    assert lake.landing().count() == 0


def test_a_load_id_is_not_taken_twice(lake, payloads):
    land(lake, payloads(payload_text(three_rows())), "a")
    with pytest.raises(landing.LoadConflict):
        land(lake, payloads(payload_text(three_rows(EPOCH + 60)), prefix="other"), "a")
    land(lake, payloads(payload_text(three_rows())), "a")
    assert lake.landing().count() == 3 and runs(lake).count() == 1


def test_a_file_name_may_repeat_within_a_load(spark, lake):
    rows = [(payload_text(three_rows()), "same"), (payload_text(three_rows(EPOCH + 60), EPOCH + 60), "same")]
    rows.append(rows[0])
    land(lake, spark.createDataFrame(rows, "payload string, source_file string"), "a", AS_OF + dt.timedelta(minutes=5))
    counts = sorted((r.rows_received, r.rows_inserted, r.rows_duplicate) for r in runs(lake).collect())
    assert counts == [(3, 3, 0), (6, 3, 3)]
    assert lake.landing().count() == 6


def test_a_started_run_is_visible_as_running(lake, payloads):
    started = payloads("x").select(ledger.run_id("a").alias("run_id"))
    lake.record(ledger.started(started, Feed(), "a", AS_OF))
    run = runs(lake).first()
    assert (run.status, run.finished_at, run.credits_estimated) == ("running", None, 3)
    assert run.request_bbox.asDict() == {"lamin": 49.0, "lamax": 61.0, "lomin": -10.0, "lomax": 3.0}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_splitting_the_input_does_not_change_what_lands(lake, payloads, order):
    texts = [payload_text(three_rows(EPOCH + 60 * i) + three_rows(), EPOCH + 60 * i) for i in range(3)]
    for n, i in enumerate(order):
        land(lake, payloads(texts[i], prefix=f"s{i}"), f"load-{n}", AS_OF + dt.timedelta(minutes=5))
    landed = lake.landing()
    assert landed.count() == 9
    assert quality.repeated_keys(landed, "icao24", "observed_at").count() == 0
    assert quality.ledger_balance(runs(lake)).count() == 0


def test_one_key_holding_a_third_of_all_rows(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("icao24"),
        F.timestamp_seconds(F.lit(EPOCH)).alias("observed_at"),
        (F.lit(30000) - F.col("id")).alias("pos"),
    )
    kept = landing.first_wins(rows, ("pos",))
    assert kept.count() == 20001
    assert kept.where("icao24 = 'hot'").first().pos == 3
    # Losers are dropped before the shuffle.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:]


def test_only_the_folders_of_the_batch_are_read(lake, payloads):
    land(lake, payloads(payload_text(three_rows())), "a")
    day = AS_OF.date()
    assert lake.landing([day]).count() == 3
    assert lake.landing([day - dt.timedelta(days=1)]).count() == 0
    assert lake.landing([day - dt.timedelta(days=1), day]).count() == 3


AREAS = [(1.0, 1), (25.0, 1), (25.1, 2), (100.0, 2), (100.1, 3), (156.0, 3), (400.0, 3), (400.1, 4), (64800.0, 4)]


def test_credit_bands(spark):
    rows = spark.createDataFrame(AREAS, "area double, expected int")
    assert rows.where(credit_cost(F.col("area")) != F.col("expected")).count() == 0
    assert Region().area_sq_deg == 156.0


def test_cadence_budget(spark, lake, payloads):
    land(lake, payloads("x"), "a", feed=Feed(registered=True))
    slow, fast = (ledger.cadence_budget(runs(lake), s).first() for s in (120, 60))
    assert (slow.daily_credit_budget, slow.over_budget) == (2160, False)
    assert (fast.daily_credit_budget, fast.daily_allowance, fast.over_budget) == (4320, 4000, True)


@pytest.mark.parametrize(
    "edges", [(61, 49, -10, 3), (49, 61, 3, -10), (50, 50, -10, 3), (49, 91, -10, 3), (49, 61, -181, 3)]
)
def test_bad_regions_are_refused(edges):
    with pytest.raises(ValueError):
        Region(*map(float, edges))


def test_poll_interval_has_a_floor():
    with pytest.raises(ValueError):
        Feed(poll_interval_seconds=1)


def test_region_keeps_its_edges(spark):
    rows = spark.createDataFrame([(49.0, -10.0), (61.0, 3.0), (48.9, 0.0), (50.0, 3.1), (None, 0.0)], "lat double, lon double")
    assert rows.where(Region().contains(F.col("lat"), F.col("lon"))).count() == 2


def test_reading_before_building(marts):
    with pytest.raises(MartsNotBuilt):
        marts.hourly()
    assert marts.latest_hour() is None
