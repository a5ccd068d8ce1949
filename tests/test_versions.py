"""Stored tables: versions, two writers, what is set aside, gathering of loads, incremental builds."""

import datetime as dt

import pytest
from conftest import AS_OF, EPOCH, SF_DIR, normal, payload_text, three_rows
from pyspark.sql import functions as F
from test_landing import counts, land, runs
from test_marts import HOUR, hourly, observations, some_rows

from skytally.operators import ledger, quality
from skytally.plans import contracts
from skytally.plans import marts as plans
from skytally.sources import driver_tables as src
from skytally.sources.tables import Lake
from skytally.sources.versions import Conflict, VersionedTable

KEY = ("icao24", "observed_at")
DAY = dt.timedelta(days=1)


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, day string").schema
    return VersionedTable(spark, str(tmp_path / "table"), schema, "day")


def days(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, day string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_see_a_write_when_it_is_committed(spark, table):
    assert table.current().number == 0 and ids(table.read()) == []
    part = table.write(days(spark, (1, "a"), (2, "b")), {"by": "me"}, n=F.count("*"), top=F.max("id"))
    assert ids(table.read()) == []
    first = table.commit(table.current(), [part])
    assert ids(table.read()) == [1, 2] and first.parts[0].facts == {"by": "me", "n": 2, "top": 2}
    assert ids(table.read(leaves=lambda leaf: leaf == "day=b")) == [2]
    table.commit(first, [*first.parts, table.write(days(spark, (3, "b")))])
    assert ids(table.read()) == [1, 2, 3] and ids(table.read(first)) == [1, 2]


def test_of_two_commits_on_one_version_the_second_fails(spark, table):
    base = table.current()
    table.commit(base, [table.write(days(spark, (1, "a")))])
    with pytest.raises(Conflict):
        table.commit(base, [table.write(days(spark, (2, "a")))])
    assert ids(table.read()) == [1]


def test_gathering_keeps_rows_numbers_and_what_comes_meanwhile(spark, table, monkeypatch):
    for i in range(4):
        table.commit(table.current(), [*table.current().parts, table.write(days(spark, (i, "a"), (10 + i, "b")))])
    write = table.write

    def interrupted(rows, *args, **kwargs):
        made = write(rows, *args, **kwargs)
        table.commit(table.current(), [*table.current().parts, write(days(spark, (99, "a")))])
        return made

    monkeypatch.setattr(table, "write", interrupted)
    table.compact(lambda leaf: leaf == "day=a", "id")
    assert ids(table.read()) == [0, 1, 2, 3, 10, 11, 12, 13, 99]
    holders = [p for p in table.current().parts if "day=a" in p.leaves]
    assert sorted(p.added for p in holders) == [4, 5]
    monkeypatch.undo()
    assert table.compact(lambda leaf: False) is None


def test_vacuum_spares_what_is_listed_or_not_yet_listed(spark, table):
    for i in range(3):
        table.commit(table.current(), [table.write(days(spark, (i, "a")))])
    pending = table.write(days(spark, (7, "a")))
    assert len(table.vacuum(keep=1)) == 2
    assert ids(table.read()) == [2]
    table.commit(table.current(), [*table.current().parts, pending])
    assert ids(table.read()) == [2, 7]


def test_writers_of_the_same_key_are_settled_by_their_commits(spark, tmp_path):
    first, second = (Lake(spark, str(tmp_path / "raw")) for _ in range(2))
    looked = first.observations.current()
    row = ("a", HOUR, 51.0, 0.0, 1.0, False)
    second.append(observations(spark, [row, ("b", HOUR, 51.0, 0.0, 1.0, False)]), "second")
    first.append(observations(spark, [row, ("c", HOUR, 51.0, 0.0, 1.0, False)]), "first", seen=looked)
    landed = {(r.icao24, r.load_id) for r in first.landing().collect()}
    assert landed == {("a", "second"), ("b", "second"), ("c", "first")}


def test_rule_breakers_are_set_aside_and_none_vanishes(spark, lake):
    faulty = src.to_faulty_observations(src.events(spark, SF_DIR)).persist()
    lake.append(faulty, "a")
    broken = quality.with_broken_rules(lake.landing(), quality.landing_rules()).where(F.size("broken_rules") > 0)
    assert broken.count() == 0
    aside = lake.quarantine()
    assert lake.landing().count() + aside.count() == faulty.count() and aside.count() > 0
    odd = aside.where("reason = 'latitude_range'").select(F.get_json_object("raw", "$.latitude").alias("l"))
    assert {r.l for r in odd.collect()} == {"95.0"}


def test_rejects_of_a_load_are_kept_with_their_counts(lake, payloads):
    bad = three_rows()
    bad[0][6], bad[1][8] = 91.0, "no"
    source = payloads(payload_text([*bad, None]), payload_text(three_rows(EPOCH + 60), EPOCH + 60))
    for _ in range(2):  # repeated, a load replaces what it set aside
        land(lake, source, "a", AS_OF + dt.timedelta(minutes=5))
        aside = {(r.reason, r.load_id) for r in lake.quarantine().collect()}
        assert lake.quarantine().count() == 3 and lake.landing().count() == 4
        assert aside == {(reason, "a") for reason in ("latitude_out_of_range", "on_ground_not_boolean", "row_not_array")}
    reasons = ledger.run_reject_reasons(lake.ledger())
    assert {(r.reason, r.row_count) for r in reasons.collect()} == {(reason, 1) for reason, _ in aside}
    assert {r.run_id for r in reasons.collect()} == {r.run_id for r in lake.quarantine().collect()}
    assert sorted(counts(r) for r in runs(lake).collect()) == [(3, 0, 3, 0), (4, 3, 1, 0)]


def test_a_load_of_rejects_alone(lake, payloads):
    land(lake, payloads(payload_text([None, []])), "a")
    assert lake.landing().count() == 0 and lake.quarantine().count() == 2
    assert counts(runs(lake).first()) == (2, 2, 0, 0)


def test_broken_events_stay_out_of_the_ledger(spark, lake):
    events = src.to_faulty_runs(src.orders(spark, SF_DIR)).withColumns(
        {"event_seq": F.lit(1), "reject_reasons": F.lit(None), "load_id": F.lit("a"), "event": F.lit("finished")}
    )
    lake.record(events)
    lake.record(events.limit(1).withColumns({"started_at": F.lit(None), "load_id": F.lit("b")}))
    assert lake.ledger(load_id="b").count() == 0 and lake.changed_starts(0)
    kept = quality.with_broken_rules(lake.ledger(), quality.ledger_rules())
    assert kept.where(F.size("broken_rules") > 0).count() == 0
    assert lake.broken_events().count() > 1 and lake.ledger().count() + lake.broken_events().count() == events.count() + 1
    with pytest.raises(ValueError):
        lake.record(events.withColumn("load_id", F.col("run_id")))


def folders(lake, day):
    return sum(f"outcome=landed/observed_date={day}" in p.leaves for p in lake.observations.current().parts)


def test_closed_days_are_gathered_and_loads_stay_repeatable(lake, payloads):
    source = [payloads(payload_text(three_rows(EPOCH + 60 * i), EPOCH + 60 * i), prefix=f"p{i}") for i in range(4)]
    for i, one in enumerate(source):
        land(lake, one, f"load-{i}", AS_OF + dt.timedelta(minutes=5))
    day = AS_OF.date()
    before, states = normal(lake.landing().collect()), normal(runs(lake).collect())
    assert folders(lake, day) == 4
    lake.compact(day)
    assert folders(lake, day) == 4  # the day is still open
    lake.compact(day + DAY)
    assert folders(lake, day) == 1 and len(lake.events.current().parts) == 1
    assert normal(lake.landing().collect()) == before and normal(runs(lake).collect()) == states
    # A load that is repeated finds its rows among those that were gathered.
    land(lake, source[2], "load-2", AS_OF + dt.timedelta(minutes=5))
    assert normal(lake.landing().collect()) == before
    assert counts(runs(lake, "load-2").first()) == (3, 0, 3, 0)
    assert quality.repeated_keys(lake.landing(), *KEY).count() == 0


def test_a_build_that_dies_halfway_changes_nothing(spark, lake, marts, monkeypatch):
    lake.append(observations(spark, [("a", HOUR, 51.0, 0.0, 1.0, False)]), "a")
    plans.refresh_hourly(lake, marts)
    before = normal(marts.hourly().collect())
    lake.append(observations(spark, [("b", HOUR, 51.0, 0.0, 1.0, False)]), "b")

    def dies(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(marts.hourly_table, "commit", dies)
    with pytest.raises(RuntimeError):
        plans.refresh_hourly(lake, marts)
    monkeypatch.undo()
    assert normal(marts.hourly().collect()) == before
    plans.refresh_hourly(lake, marts)
    assert marts.hourly().first().observation_count == 2


def test_only_days_with_new_rows_are_rebuilt(spark, lake, marts, monkeypatch):
    import random

    rng = random.Random(4)
    for n in range(3):
        lake.append(observations(spark, some_rows(rng, 24 * n, 24 * n + 10, 30, f"{n}x")), f"load-{n}")
    plans.refresh_daily(lake, marts)
    asked = []
    opened = lake.landing
    monkeypatch.setattr(lake, "landing", lambda *a, **k: asked.append(a) or opened(*a, **k))
    plans.refresh_daily(lake, marts)
    assert asked == []  # nothing new: nothing is opened
    lake.append(observations(spark, some_rows(rng, 1, 9, 5, "late")), "late")
    lake.compact(HOUR.date() + 2 * DAY)
    plans.refresh_daily(lake, marts)
    assert asked == [([HOUR.date()],)]
    full = plans.daily_activity(plans.grid_observations(plans.stage_observations(opened())))
    assert normal(marts.daily().collect()) == normal(full.collect())


def test_health_is_rebuilt_for_days_with_new_events(lake, marts, payloads):
    for n, later in enumerate((0, 1, 2)):
        as_of = AS_OF + later * DAY
        land(lake, payloads(payload_text(three_rows(EPOCH + 60 * n), EPOCH + 60 * n), prefix=f"p{n}"), f"l{n}", as_of)
        plans.refresh_health(lake, marts)
    full = plans.ingestion_health(plans.stage_runs(runs(lake)))
    assert normal(marts.health().collect()) == normal(full.collect()) and marts.health().count() == 3


def test_freshness_opens_no_rows(spark, lake):
    assert quality.source_freshness(lake.newest_ingest(), HOUR).first().status == "error"
    for n in range(3):
        lake.append(observations(spark, [(f"a{n}", HOUR + dt.timedelta(minutes=n), 51.0, 0.0, 1.0, False)]), f"load-{n}")
    stored = quality.source_freshness(lake.newest_ingest(), HOUR + dt.timedelta(minutes=40))
    assert "FileScan" not in stored._jdf.queryExecution().executedPlan().toString()
    assert normal(stored.collect()) == normal(quality.source_freshness(lake.landing(), HOUR + dt.timedelta(minutes=40)).collect())
    assert stored.first().status == "warn"


def test_the_newest_hour_opens_no_rows(spark, lake, marts):
    lake.append(observations(spark, [("a", HOUR + dt.timedelta(minutes=9), 51.0, 0.0, 1.0, False)]), "a")
    plans.refresh_hourly(lake, marts)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("newest", "")
    assert marts.latest_hour() == HOUR
    assert len(jobs.getJobIdsForGroup("newest")) == 0


def test_a_foreign_file_with_an_identity_is_found(spark, lake, marts):
    lake.append(observations(spark, [("a", HOUR, 51.0, 0.0, 1.0, False)]), "a")
    plans.build_marts(lake, marts)
    leaks = {r.table_name: r.identity_columns for r in contracts.stored_identity(marts).collect()}
    assert leaks == dict.fromkeys(leaks, 0) and len(leaks) == 3
    nested = hourly(lake.landing()).withColumn("detail", F.struct(F.lit("a").alias("icao24")))
    nested.write.parquet(f"{marts.hourly_table.root}/data/somebody")
    leaks = {r.table_name: r.identity_columns for r in contracts.stored_identity(marts).collect()}
    assert leaks["airspace_activity_hourly"] == 1 and leaks["airspace_activity_daily"] == 0


@pytest.mark.parametrize("least", [2, 4])
def test_no_total_tells_of_fewer_aircraft_than_allowed(spark, lake, marts, least):
    import random

    rng = random.Random(8)
    rows = some_rows(rng, 0, 40, 400, "a") + [("alone", HOUR + 3 * DAY, 51.5, 0.5, 1.0, False)]
    rows = [(f"a{rng.randrange(9)}", t, la, lo, tr, g) if a != "alone" else (a, t, la, lo, tr, g) for a, t, la, lo, tr, g in rows]
    for n, part in enumerate((rows[:300], rows[300:], [("late", HOUR, 51.5, 0.5, 1.0, False)])):
        lake.append(observations(spark, part), f"load-{n}")
        plans.build_marts(lake, marts, min_aircraft=least)
    seen = plans.grid_observations(plans.stage_observations(lake.landing())).select(
        "observed_date", "altitude_band", "observed_hour", "grid_lat", "grid_lon", "icao24"
    )
    told = marts.hourly().selectExpr("activity_hour AS observed_hour", "grid_lat", "grid_lon", "altitude_band")
    withheld = seen.join(told, ["observed_hour", "grid_lat", "grid_lon", "altitude_band"], "left_anti")
    hidden = withheld.groupBy("observed_date", "altitude_band").agg(F.countDistinct("icao24").alias("n"))
    daily = marts.daily().withColumnRenamed("activity_date", "observed_date")
    assert daily.where(F.col("distinct_aircraft") < least).count() == 0 and daily.count() > 0
    # What a day's total counts beyond its hours is nothing, or enough aircraft.
    assert daily.join(hidden, ["observed_date", "altitude_band"]).where(F.col("n") < least).count() == 0
    assert marts.hourly().where(F.col("distinct_aircraft") < least).count() == 0
    counted = seen.groupBy("observed_date", "altitude_band").agg(F.count("*").alias("n"))
    assert daily.join(counted, ["observed_date", "altitude_band"]).where("n <> observation_count").count() == 0
