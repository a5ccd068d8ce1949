import datetime as dt
import json
import math
import random

import pytest
from conftest import AS_OF, EPOCH, airborne, normal, payload_text, three_rows
from pyspark.sql import functions as F

from skytally.operators import landing, ledger, quality
from skytally.plans import marts as plans
from skytally.plans import reads, staging, views
from skytally.schemas import HOURLY_ACTIVITY, STATE_VECTORS, conform
from skytally.sources.tables import SchemaDrift, write_rows_json

HOUR = dt.datetime(2025, 9, 10, 10)
UTC = dt.timezone.utc


def observations(spark, rows):
    """(icao24, observed_at, lat, lon, track, on_ground) to landed rows."""
    made = spark.createDataFrame(
        [(a, t.replace(tzinfo=UTC).timestamp(), la, lo, tr, g) for a, t, la, lo, tr, g in rows],
        "icao24 string, second double, latitude double, longitude double, true_track_deg double, on_ground boolean",
    )
    known = set(made.columns)
    when = F.timestamp_micros((F.col("second") * 1000000).cast("bigint"))
    extra = {
        "observed_at": when, "last_contact": when, "time_position": when, "api_snapshot_time": when,
        "ingested_at": when, "baro_altitude_m": F.lit(5000.0), "velocity_ms": F.lit(100.0),
        "ingestion_run_id": F.lit("run"),
    }
    for f in STATE_VECTORS:
        if f.name not in known:
            made = made.withColumn(f.name, extra.get(f.name, F.lit(None).cast(f.dataType)))
    return conform(made, STATE_VECTORS)


def gridded(landed, degrees=1):
    return staging.grid_observations(staging.stage_observations(landed), degrees)


def hourly(landed):
    return plans.hourly_activity(gridded(landed))


def test_snapshot_end_to_end(lake, marts, payloads):
    landing.land_snapshots(payloads(payload_text(three_rows())), lake, "a", AS_OF)
    plans.build_marts(lake, marts, ledger.run_states(lake.ledger()))
    total = marts.hourly().agg(F.sum("observation_count"), F.sum("distinct_aircraft")).first()
    assert tuple(total) == (2, 2)
    assert marts.daily().agg(F.sum("observation_count")).first()[0] == 2
    assert staging.position_coverage(staging.stage_observations(lake.landing())).first()[:2] == (3, 1)
    health = marts.health().first()
    assert (health.run_count, health.success_rate_pct, health.rows_inserted) == (1, 100.0, 3)
    stored = marts.stored_columns()
    assert len(stored) == 3 and not any(quality.identity_columns(s) for s in stored.values())


def test_headings_are_averaged_on_the_circle(lake, payloads):
    states = [airborne("aaaaaa", EPOCH, 51.4, -0.6, 350.0), airborne("bbbbbb", EPOCH, 51.6, -0.4, 10.0)]
    landing.land_snapshots(payloads(payload_text(states, EPOCH + 2)), lake, "a", AS_OF)
    row = hourly(lake.landing()).where("grid_lat = 51 and grid_lon = -1").first()
    assert row.track_sample_count == 2
    assert min(row.dominant_track_deg, 360 - row.dominant_track_deg) < 1.0
    assert row.track_concentration > 0.98


def test_rotating_all_headings_rotates_the_mean(spark):
    rng = random.Random(3)
    tracks = [rng.uniform(0, 120) for _ in range(9)]
    rows = [
        (f"a{i}", HOUR, 50.5 + shift, 0.5, (t + 37.0 * shift) % 360, False)
        for shift in range(9)
        for i, t in enumerate(tracks)
    ]
    found = {r.grid_lat - 50: r for r in hourly(observations(spark, rows)).collect()}
    base = found[0].dominant_track_deg
    for shift, row in found.items():
        turned = (base + 37.0 * shift) % 360
        assert abs((row.dominant_track_deg - turned + 180) % 360 - 180) <= 0.11
        assert math.isclose(row.track_concentration, found[0].track_concentration, abs_tol=0.0011)


def test_cells_round_toward_the_south_west(spark):
    rows = [("a", HOUR, -0.5, -0.5, 1.0, False), ("b", HOUR, 0.5, 179.9, 1.0, False), ("c", HOUR, -90.0, -180.0, 1.0, False)]
    cells = {(r.grid_lat, r.grid_lon) for r in gridded(observations(spark, rows)).collect()}
    assert cells == {(-1.0, -1.0), (0.0, 179.0), (-90.0, -180.0)}


def test_band_edges(spark):
    feet = [None, 9999.9, 10000.0, 23999.9, 24000.0, 34999.9, 35000.0]
    rows = spark.createDataFrame([(f, False) for f in feet] + [(None, True), (40000.0, True)], "ft double, g boolean")
    from skytally.functions.columns import altitude_band

    found = [r[0] for r in rows.select(altitude_band(F.col("g"), F.col("ft"))).collect()]
    assert found == ["unknown", "below_10k", "10k_to_24k", "10k_to_24k", "24k_to_35k", "24k_to_35k", "above_35k",
                     "ground", "ground"]


def test_aircraft_on_the_ground_have_no_heading(spark):
    row = hourly(observations(spark, [("a", HOUR, 51.0, 0.0, 90.0, True)])).first()
    assert (row.track_sample_count, row.dominant_track_deg, row.track_concentration) == (0, None, None)


def test_daily_counts_an_aircraft_once(spark):
    rows = [("a", HOUR + dt.timedelta(hours=h), 51.0 + h, 0.0, 90.0, False) for h in range(3)]
    landed = observations(spark, rows)
    assert hourly(landed).agg(F.sum("distinct_aircraft")).first()[0] == 3
    day = plans.daily_activity(gridded(landed)).first()
    assert (day.observation_count, day.distinct_aircraft, day.distinct_grid_cells) == (3, 1, 3)


def arrivals(spark, lake, batches):
    for n, rows in enumerate(batches):
        lake.append(observations(spark, rows), f"load-{n}")


def some_rows(rng, first_hour, last_hour, n, tag):
    return [
        (f"{tag}{i}", HOUR + dt.timedelta(seconds=rng.randrange(first_hour * 3600, last_hour * 3600)),
         rng.uniform(49, 53), rng.uniform(-3, 3), rng.uniform(0, 359), rng.random() < 0.1)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_refresh_equals_full_rebuild_within_the_lookback(spark, lake, marts, seed):
    rng = random.Random(seed)
    for n, (low, high) in enumerate([(0, 4), (2, 6), (4, 8)]):
        rows = some_rows(rng, low, high, 40, f"{n}x")
        # One row in the last hour, so that the next batch reaches back three hours at most.
        rows.append((f"{n}z", HOUR + dt.timedelta(hours=high - 1, minutes=59), 50.0, 0.0, 1.0, False))
        lake.append(observations(spark, rows), f"load-{n}")
        plans.refresh_hourly(lake, marts)
    published = normal(conform(marts.hourly(), HOURLY_ACTIVITY).collect())
    assert published == normal(hourly(lake.landing()).collect())
    assert quality.reconcile_hourly(marts.hourly(), gridded(lake.landing()), AS_OF).count() == 0


def test_rows_older_than_the_lookback_wait_for_a_full_refresh(spark, lake, marts):
    now = HOUR + dt.timedelta(hours=20)
    rng = random.Random(1)
    lake.append(observations(spark, some_rows(rng, 0, 10, 50, "a")), "a")
    plans.refresh_hourly(lake, marts)
    lake.append(observations(spark, [("late", HOUR + dt.timedelta(minutes=5), 50.0, 0.0, 1.0, False)]), "b")
    plans.refresh_hourly(lake, marts)
    stale = quality.reconcile_hourly(marts.hourly(), gridded(lake.landing()), now).collect()
    assert len(stale) == 1 and stale[0].source_observations == stale[0].mart_observations + 1
    # The hour still filling is not compared.
    open_hour = quality.reconcile_hourly(marts.hourly(), gridded(lake.landing()), HOUR + dt.timedelta(minutes=59))
    assert open_hour.count() == 0
    plans.refresh_hourly(lake, marts, full_refresh=True)
    assert quality.reconcile_hourly(marts.hourly(), gridded(lake.landing()), now).count() == 0


def test_lookback_must_be_whole_hours(lake, marts):
    with pytest.raises(ValueError):
        plans.refresh_hourly(lake, marts, lookback_hours=1.5)


def test_fine_grids_need_suppression(spark, lake, marts):
    rows = [("a", HOUR, 51.1, 0.1, 90.0, False), ("b", HOUR, 51.1, 0.1, 90.0, False), ("c", HOUR, 51.6, 0.1, 90.0, False)]
    landed = observations(spark, rows)
    with pytest.raises(ValueError):
        plans.publishable_hourly(landed, 0.25)
    kept = plans.publishable_hourly(landed, 0.25, min_aircraft=2).collect()
    assert [(r.grid_lat, r.grid_lon, r.distinct_aircraft) for r in kept] == [(51.0, 0.0, 2)]
    assert plans.files_per_hour(1) == 1 and plans.files_per_hour(0.25) > 1
    lake.append(landed, "a")
    plans.refresh_hourly(lake, marts, grid_degrees=0.25, min_aircraft=2)
    assert marts.hourly().count() == 1
    # Later refreshes keep both, and others are refused.
    lake.append(observations(spark, [("d", HOUR, 52.6, 0.1, 90.0, False)]), "b")
    plans.refresh_hourly(lake, marts)
    assert marts.hourly().count() == 1
    with pytest.raises(ValueError):
        plans.refresh_hourly(lake, marts, min_aircraft=1)
    plans.refresh_hourly(lake, marts, full_refresh=True, min_aircraft=1)
    assert marts.hourly().count() == 3


def test_schema_drift_is_an_error(spark, marts):
    table = hourly(observations(spark, [("a", HOUR, 51.0, 0.0, 90.0, False)]))
    with pytest.raises(SchemaDrift):
        marts.write_hourly(table.withColumn("icao24", F.lit("x")), replace_all=True)
    with pytest.raises(SchemaDrift):
        marts.write_hourly(table.withColumn("observation_count", F.lit(1)), replace_all=True)


@pytest.mark.parametrize("hours", [0, 721, -1, 1.5, True, "24"])
def test_windows_are_bounded(spark, hours):
    table = spark.createDataFrame([], HOURLY_ACTIVITY)
    for read in (reads.grid_density, reads.hourly_totals, reads.altitude_profile):
        with pytest.raises(ValueError):
            read(table, HOUR, hours)


def test_days_are_bounded(spark):
    with pytest.raises(ValueError):
        reads.daily_profile(spark.createDataFrame([], "activity_date date"), HOUR, 366)


def test_window_keeps_hours_that_start_within_it(spark):
    rows = [("a", HOUR + dt.timedelta(hours=h), 51.0, 0.0, 90.0, False) for h in range(4)]
    table = hourly(observations(spark, rows))
    now = HOUR + dt.timedelta(hours=3, minutes=30)
    assert [r.activity_hour.hour for r in reads.hourly_totals(table, now, 2).collect()] == [12, 13]


def test_freshness_of_an_empty_table_is_one_row(spark):
    row = reads.freshness(spark.createDataFrame([], HOURLY_ACTIVITY), HOUR).collect()
    assert len(row) == 1 and row[0].age_seconds is None


def test_recombined_direction(spark):
    rows = [("a", HOUR, 51.5, 0.5, 350.0, False), ("b", HOUR + dt.timedelta(hours=1), 51.5, 0.5, 10.0, False)]
    row = reads.grid_density(hourly(observations(spark, rows)), HOUR + dt.timedelta(hours=2), 24).first()
    assert min(row.dominant_track_deg, 360 - row.dominant_track_deg) < 0.2
    assert abs(row.track_concentration - math.cos(math.radians(10))) < 0.002


def grid(spark, rows):
    return spark.createDataFrame(
        rows, "grid_lat double, observation_count bigint, track_concentration double, track_sample_count bigint"
    )


def test_flow_and_density(spark):
    cells = grid(spark, [(51.0, 100, 0.55, 3), (52.0, 50, 0.54, 9), (53.0, 1, 0.9, 2), (54.0, 10, None, 5)])
    assert [r.grid_lat for r in views.flow_arrows(cells).collect()] == [51.0]
    bins = {r.grid_lat: r.density_bin for r in views.density_bins(cells).collect()}
    assert bins == {lat: min(5, int((n / 100) ** 0.55 * 6)) for lat, n in ((51.0, 100), (52.0, 50), (53.0, 1), (54.0, 10))}


@pytest.mark.parametrize(
    "lats", [[50.0], [50.0, 53.0], [50.0, 50.25, 53.0], [50.75, 51.0, 53.0], [0.0, 0.5, 1.0], [-0.5, 0.5, 0.75], []]
)
def test_cell_size(spark, lats):
    gaps = [b - a for a, b in zip(sorted(lats), sorted(lats)[1:])]
    cells = grid(spark, [(lat, 1, 1.0, 1) for lat in lats])
    assert views.cell_size(cells).first()[0] == min([1.0, *gaps])


def test_share_of_nothing_is_zero(spark):
    profile = spark.createDataFrame([("ground", 0), ("unknown", 0)], "altitude_band string, observation_count bigint")
    assert {r.share_pct for r in views.altitude_share(profile).collect()} == {0.0}


def test_freshness_classes(spark):
    ages = [(0.0, "ok"), (359.9, "ok"), (360.0, "warn"), (3599.0, "warn"), (3600.0, "bad"), (None, None)]
    found = spark.createDataFrame([(a,) for a, _ in ages], "a double").select(views.freshness_class(F.col("a")))
    assert [r[0] for r in found.collect()] == [c for _, c in ages]


def test_rows_as_json(spark, tmp_path):
    table = hourly(observations(spark, [("a", HOUR, 51.0, 0.0, 90.0, False)]))
    write_rows_json(reads.hourly_totals(table, HOUR, 24), str(tmp_path / "out"), HOUR, window_hours=24)
    line = json.loads(next((tmp_path / "out").glob("part-*.json")).read_text())
    assert line["window_hours"] == 24 and line["observation_count"] == 1 and line["generated_at"].startswith("2025-09-10")
