"""Every operator as a runnable query over the driver's tables.

Results are aggregates, ledger rows or counts of violations; none identifies an
aircraft. Timestamps and dates leave as plain UTC timestamps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from skytally.functions.columns import count_where
from skytally.operators import landing, ledger, parse, quality
from skytally.operators.ledger import run_states
from skytally.plans import checks, contracts, marts, reads, staging, views
from skytally.schemas import OBSERVATION_KEY
from skytally.session import shared_folder
from skytally.settings import Feed, Region
from skytally.sources import driver_tables as src
from skytally.sources.payloads import open_payloads, read_payload_archive, read_payload_files
from skytally.sources.tables import Lake, Marts, MartsNotBuilt, write_rows_json
from skytally.streaming import landing as stream_landing
from skytally.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

NOW = dt.datetime(2024, 1, 31)
RUNS_NOW = dt.datetime(2024, 1, 1, 12)
PAYLOADS_NOW = dt.datetime(2024, 2, 2)
LANDED_UNTIL = dt.datetime(2024, 1, 16)
REGION = Region(50.0, 58.0, -6.0, 2.0)
FEED = Feed(registered=True)
ALL_HOURS, ALL_DAYS = reads.MAX_HOURS, reads.MAX_DAYS

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: _plain(function(spark, sf_dir))
    return function


def _plain(df: DataFrame) -> DataFrame:
    kinds = (TimestampType, DateType)
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, kinds) else f.name
            for f in df.schema
        ]
    )


def _sparse(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that may be missing leave as doubles, which every client can hold a null in."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _observations(spark, sf_dir):
    return src.to_observations(src.events(spark, sf_dir))


def _staged(spark, sf_dir):
    return staging.stage_observations(_observations(spark, sf_dir))


def _gridded(spark, sf_dir):
    return staging.grid_observations(_staged(spark, sf_dir))


def _hourly(spark, sf_dir):
    return marts.hourly_activity(_gridded(spark, sf_dir))


def _runs(spark, sf_dir):
    return src.to_runs(src.orders(spark, sf_dir))


def _health(spark, sf_dir):
    return marts.ingestion_health(staging.stage_runs(_runs(spark, sf_dir)))


def _grid(spark, sf_dir):
    return reads.grid_density(_hourly(spark, sf_dir), NOW, ALL_HOURS)


def _payloads(spark, sf_dir):
    return src.to_payloads(src.events(spark, sf_dir))


def _inbox(spark, sf_dir, root: str) -> DataFrame:
    """The payloads as an archive: a load reads them more than once, and must not put them together each time."""
    _payloads(spark, sf_dir).write.parquet(f"{root}/inbox")
    return read_payload_archive(spark, f"{root}/inbox")


def _judged(spark, sf_dir):
    return landing.judge(_payloads(spark, sf_dir), "batch", PAYLOADS_NOW)


def _states(spark, sf_dir):
    return _judged(spark, sf_dir).where(F.col("pos").isNotNull())


# --- published tables ---------------------------------------------------------


@query
def hourly_activity(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query
def daily_activity(spark, sf_dir):
    return marts.daily_activity(_gridded(spark, sf_dir))


@query
def ingestion_health(spark, sf_dir):
    return _health(spark, sf_dir)


@query
def suppressed_cells(spark, sf_dir):
    """Cells in which a single aircraft was seen are withheld."""
    return marts.publishable_hourly(_observations(spark, sf_dir), min_aircraft=2)


# --- staging ----------------------------------------------------------------------


@query
def staged_profile(spark, sf_dir):
    """Converted units and report ages by day."""
    return (
        _staged(spark, sf_dir)
        .groupBy("observed_date")
        .agg(
            F.count("*").alias("row_count"),
            count_where(F.col("has_position")).alias("positioned_count"),
            F.round(F.max("baro_altitude_ft"), 4).alias("max_baro_altitude_ft"),
            F.round(F.min("geo_altitude_ft"), 4).alias("min_geo_altitude_ft"),
            F.round(F.max("velocity_kts"), 4).alias("max_velocity_kts"),
            F.max("observation_age_seconds").alias("max_age_seconds"),
        )
    )


@query
def stage_quality(spark, sf_dir):
    return staging.position_coverage(_staged(spark, sf_dir))


@query
def staged_runs(spark, sf_dir):
    return _sparse(staging.stage_runs(_runs(spark, sf_dir)).drop("request_bbox"), "http_status")


@query
def altitude_bands(spark, sf_dir):
    return _gridded(spark, sf_dir).groupBy("altitude_band").agg(F.count("*").alias("row_count"))


@query
def grid_cells(spark, sf_dir):
    return _gridded(spark, sf_dir).groupBy("grid_lat", "grid_lon").agg(F.count("*").alias("row_count"))


@query
def heading_components(spark, sf_dir):
    return (
        _gridded(spark, sf_dir)
        .groupBy("altitude_band")
        .agg(
            F.count("track_sin").alias("sample_count"),
            F.round(F.avg("track_sin"), 6).alias("mean_sin"),
            F.round(F.avg("track_cos"), 6).alias("mean_cos"),
        )
    )


@query
def staging_views(spark, sf_dir):
    """The same pipeline read through its views."""
    staging.register_views(_observations(spark, sf_dir), _runs(spark, sf_dir))
    return spark.sql(
        """
        SELECT r.status, count(*) AS row_count, count(DISTINCT g.grid_lat, g.grid_lon) AS cell_count
        FROM gridded_observations g JOIN staged_runs r ON r.run_id = g.ingestion_run_id
        GROUP BY r.status
        """
    )


# --- read queries and their views -----------------------------------------------------


@query
def grid_density(spark, sf_dir):
    return _grid(spark, sf_dir)


@query
def hourly_totals(spark, sf_dir):
    return reads.hourly_totals(_hourly(spark, sf_dir), NOW, ALL_HOURS)


@query
def altitude_profile(spark, sf_dir):
    return reads.altitude_profile(_hourly(spark, sf_dir), NOW, ALL_HOURS)


@query
def daily_profile(spark, sf_dir):
    return reads.daily_profile(marts.daily_activity(_gridded(spark, sf_dir)), NOW, ALL_DAYS)


@query
def health_read(spark, sf_dir):
    return reads.pipeline_health(_health(spark, sf_dir), NOW, ALL_HOURS)


@query
def mart_freshness(spark, sf_dir):
    return views.classified_freshness(reads.freshness(_hourly(spark, sf_dir), NOW))


@query
def flow_arrows(spark, sf_dir):
    return views.flow_arrows(_grid(spark, sf_dir))


@query
def density_bins(spark, sf_dir):
    return views.density_bins(_grid(spark, sf_dir))


@query
def cell_size(spark, sf_dir):
    return views.cell_size(_grid(spark, sf_dir))


@query
def altitude_share(spark, sf_dir):
    return views.altitude_share(reads.altitude_profile(_hourly(spark, sf_dir), NOW, ALL_HOURS))


@query
def headline(spark, sf_dir):
    totals = reads.hourly_totals(_hourly(spark, sf_dir), NOW, ALL_HOURS)
    return views.headline(totals, reads.pipeline_health(_health(spark, sf_dir), NOW, ALL_HOURS))


@query
def recent_health(spark, sf_dir):
    return views.recent_health(reads.pipeline_health(_health(spark, sf_dir), NOW, ALL_HOURS))


# --- payloads and parsing ------------------------------------------------------------------


@query
def payload_status(spark, sf_dir):
    opened = open_payloads(_payloads(spark, sf_dir))
    return opened.groupBy("payload_status").agg(F.count("*").alias("payload_count"))


@query
def reject_reasons(spark, sf_dir):
    return parse.reject_counts(_states(spark, sf_dir))


@query
def other_reject_reasons(spark, sf_dir):
    """States with the faults that the snapshots lack, by reason."""
    judged = parse.validate(src.to_states(src.events(spark, sf_dir)), PAYLOADS_NOW)
    return judged.groupBy("reason").agg(F.count("*").alias("row_count"), F.count("raw").alias("raw_count"))


@query
def accepted_profile(spark, sf_dir):
    """Typed values of accepted states by hour."""
    return (
        parse.accepted(_states(spark, sf_dir))
        .groupBy(F.date_trunc("hour", "observed_at").alias("observed_hour"))
        .agg(
            F.count("*").alias("row_count"),
            F.count("time_position").alias("time_position_count"),
            F.count("origin_country").alias("origin_country_count"),
            F.count("category").alias("category_count"),
            F.sum("position_source").alias("position_source_sum"),
            count_where(F.col("spi")).alias("spi_count"),
            count_where(F.col("on_ground")).alias("on_ground_count"),
            F.countDistinct("icao24").alias("distinct_aircraft"),
            F.max("velocity_ms").alias("max_velocity_ms"),
            F.min("latitude").alias("min_latitude"),
            F.max(F.length("callsign")).alias("max_callsign_length"),
        )
    )


@query
def dry_run(spark, sf_dir):
    """What each load would do, by payload."""
    summary = parse.dry_run_summary(_states(spark, sf_dir), ("source_file",))
    return summary.withColumn("reject_reasons", F.to_json("reject_reasons"))


@query
def dry_run_total(spark, sf_dir):
    return parse.dry_run_summary(_states(spark, sf_dir)).drop("reject_reasons")


# --- landing and ledger --------------------------------------------------------------------


def _kept_per_hour(kept: DataFrame) -> DataFrame:
    return kept.groupBy(F.date_trunc("hour", "observed_at").alias("observed_hour")).agg(
        F.count("*").alias("kept_rows"),
        F.sum("pos").alias("pos_sum"),
        F.max("velocity_ms").alias("max_velocity_ms"),
        F.max("api_snapshot_time").alias("last_snapshot_time"),
    )


@query
def dedup_first_wins(spark, sf_dir):
    reports = src.to_reports(src.events(spark, sf_dir))
    return _kept_per_hour(landing.first_wins(reports, ("api_snapshot_time", "pos")))


@query
def idempotent_insert(spark, sf_dir):
    """Reports served before a moment are landed; the later ones bring only what is new."""
    reports = src.to_reports(src.events(spark, sf_dir))
    cut = F.lit(LANDED_UNTIL.isoformat()).cast("timestamp")
    order = ("api_snapshot_time", "pos")
    landed = landing.first_wins(reports.where(F.col("api_snapshot_time") < cut), order)
    later = landing.first_wins(reports.where(F.col("api_snapshot_time") >= cut), order)
    fresh = landing.not_landed(later, landed)
    per_day = [
        df.groupBy(F.to_date("observed_at").alias("observed_date")).agg(F.count("*").alias(name))
        for df, name in ((landed, "landed_rows"), (later, "later_rows"), (fresh, "inserted_rows"))
    ]
    joined = per_day[0].join(per_day[1], "observed_date", "full_outer").join(per_day[2], "observed_date", "left")
    return joined.na.fill(0)


@query
def load_accounting(spark, sf_dir):
    scope = ["source_file", "payload_status", "api_snapshot_time"]
    # Counted twice over, so what is needed of it is kept: parsing the payloads again would cost as much as all the rest.
    path = shared_folder(spark, "judged")
    narrow = _judged(spark, sf_dir).select(*scope, "pos", "reason", *OBSERVATION_KEY)
    narrow.write.parquet(path)
    judged = spark.read.schema(narrow.schema).parquet(path)
    valid = judged.where(F.col("pos").isNotNull() & F.col("reason").isNull())
    return landing.account(judged, landing.first_wins(valid), scope)


def _ledger_columns(states: DataFrame) -> DataFrame:
    counts = ("rows_received", "rows_inserted")
    return _sparse(states.select("run_id", "status", "started_at", "finished_at", *counts, "error_message"), *counts)


@query
def ledger_state(spark, sf_dir):
    return _ledger_columns(run_states(src.to_ledger_events(src.orders(spark, sf_dir))))


@query
def snapshot_lag(spark, sf_dir):
    lagged = ledger.snapshot_lag(_runs(spark, sf_dir), NOW)
    return lagged.select("run_id", "api_snapshot_time", "lag_seconds")


@query
def credit_cost(spark, sf_dir):
    return ledger.box_costs(_runs(spark, sf_dir)).select(
        F.col("request_bbox.lamax").alias("lamax"),
        F.col("request_bbox.lomax").alias("lomax"),
        "area_sq_deg",
        "credits",
    )


@query
def cadence_budget(spark, sf_dir):
    budget = ledger.cadence_budget(_runs(spark, sf_dir), 60)
    return budget.select(
        "auth_mode",
        F.col("request_bbox.lamax").alias("lamax"),
        F.col("request_bbox.lomax").alias("lomax"),
        "run_count",
        "credit_cost",
        "daily_credit_budget",
        "daily_allowance",
        "over_budget",
    )


@query
def region_filter(spark, sf_dir):
    inside = REGION.contains(F.col("latitude"), F.col("longitude"))
    rows = _observations(spark, sf_dir).where(inside)
    return rows.groupBy(F.to_date("observed_at").alias("observed_date")).agg(F.count("*").alias("row_count"))


# --- joins and quality --------------------------------------------------------------------------


def _faulty_observations(spark, sf_dir):
    return src.to_faulty_observations(src.events(spark, sf_dir))


def _faulty_runs(spark, sf_dir):
    return src.to_faulty_runs(src.orders(spark, sf_dir))


@query
def attributed_rows(spark, sf_dir):
    return quality.attributed_rows(_faulty_observations(spark, sf_dir), _runs(spark, sf_dir))


@query
def orphan_rows(spark, sf_dir):
    return quality.orphans(
        _faulty_observations(spark, sf_dir), "ingestion_run_id", _runs(spark, sf_dir), "run_id"
    )


@query
def dup_keys(spark, sf_dir):
    repeats = quality.repeated_keys(_faulty_observations(spark, sf_dir), "icao24", "observed_at")
    return repeats.groupBy(F.to_date("observed_at").alias("observed_date")).agg(
        F.count("*").alias("key_count"), F.sum("row_count").alias("row_count")
    )


@query
def dup_runs(spark, sf_dir):
    return quality.unique(_faulty_runs(spark, sf_dir), "run_id")


@query
def not_null_violations(spark, sf_dir):
    broken = quality.not_null(_faulty_observations(spark, sf_dir), "icao24")
    return broken.groupBy(F.to_date("observed_at").alias("observed_date")).agg(F.count("*").alias("row_count"))


@query
def range_violations(spark, sf_dir):
    broken = quality.accepted_range(_faulty_observations(spark, sf_dir), "latitude", -90, 90)
    return broken.groupBy(F.to_date("observed_at").alias("observed_date")).agg(F.count("*").alias("row_count"))


@query
def bad_values(spark, sf_dir):
    broken = quality.accepted_values(_faulty_runs(spark, sf_dir), "status", ("running", "succeeded", "failed"))
    return broken.select("run_id", "status")


@query
def expression_violations(spark, sf_dir):
    track = F.col("true_track_deg")
    broken = quality.expression_is_true(_faulty_observations(spark, sf_dir), (track >= 0) & (track < 360))
    return broken.groupBy("true_track_deg").agg(F.count("*").alias("row_count"))


@query
def broken_observation_rules(spark, sf_dir):
    judged = quality.with_broken_rules(_faulty_observations(spark, sf_dir), quality.state_vector_rules())
    rule = F.explode_outer("broken_rules").alias("rule")
    return judged.select(rule).groupBy("rule").agg(F.count("*").alias("row_count"))


@query
def broken_run_rules(spark, sf_dir):
    judged = quality.with_broken_rules(_faulty_runs(spark, sf_dir), quality.ingestion_run_rules())
    rule = F.explode_outer("broken_rules").alias("rule")
    return judged.select(rule).groupBy("rule").agg(F.count("*").alias("row_count"))


@query
def ledger_balance(spark, sf_dir):
    return quality.ledger_balance(_runs(spark, sf_dir)).select(
        "run_id", "rows_received", "rows_rejected", "rows_inserted", "rows_duplicate"
    )


@query
def source_freshness(spark, sf_dir):
    return quality.source_freshness(_observations(spark, sf_dir), dt.datetime(2024, 1, 31, 8))


@query
def contract_report(spark, sf_dir):
    observed, runs = _faulty_observations(spark, sf_dir), _faulty_runs(spark, sf_dir)
    staged = staging.stage_observations(observed)
    gridded = staging.grid_observations(staged)
    staged_runs_ = staging.stage_runs(runs)
    return contracts.contract_report(
        {
            "state_vectors": observed,
            "ingestion_runs": runs,
            "staged_observations": staged,
            "staged_runs": staged_runs_,
            "gridded_observations": gridded,
            "hourly": marts.hourly_activity(gridded),
            "daily": marts.daily_activity(gridded),
            "health": marts.ingestion_health(staged_runs_),
        }
    )


# --- health checks ----------------------------------------------------------------------------------


@query
def check_freshness(spark, sf_dir):
    return checks.check_freshness(_observations(spark, sf_dir), NOW, FEED)


@query
def check_run_failure_rate(spark, sf_dir):
    return checks.check_run_failure_rate(_runs(spark, sf_dir), RUNS_NOW)


@query
def check_no_stuck_runs(spark, sf_dir):
    return checks.check_no_stuck_runs(_runs(spark, sf_dir), NOW)


@query
def check_reject_rate(spark, sf_dir):
    return checks.check_reject_rate(_runs(spark, sf_dir), RUNS_NOW)


@query
def check_credit_budget(spark, sf_dir):
    return checks.check_credit_budget(_runs(spark, sf_dir), RUNS_NOW, FEED)


@query
def health_checks(spark, sf_dir):
    return checks.run_health_checks(_observations(spark, sf_dir), _runs(spark, sf_dir), RUNS_NOW, FEED)


@query
def health_summary(spark, sf_dir):
    results = checks.run_health_checks(_observations(spark, sf_dir), _runs(spark, sf_dir), RUNS_NOW, FEED)
    return checks.health_summary(results).withColumn("failed_checks", F.array_join("failed_checks", ","))


# --- stored tables and streams ---------------------------------------------------------------------


def _late_arrivals(spark, sf_dir, **refresh) -> tuple[Lake, Marts]:
    """Land what had arrived by a moment, publish, land the rest, refresh."""
    root = shared_folder(spark, "refresh")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    observed = _observations(spark, sf_dir)
    early = F.col("ingested_at") < F.lit(LANDED_UNTIL.isoformat()).cast("timestamp")
    lake.append(observed.where(early), "early")
    marts.refresh_hourly(lake, published)
    lake.append(observed.where(~early), "late")
    marts.refresh_hourly(lake, published, **refresh)
    return lake, published


def _published(hourly: DataFrame) -> DataFrame:
    return hourly.drop("activity_date", "hour_of_day")


@query
def late_refresh(spark, sf_dir):
    return _published(_late_arrivals(spark, sf_dir)[1].hourly())


@query
def full_refresh(spark, sf_dir):
    return _published(_late_arrivals(spark, sf_dir, full_refresh=True)[1].hourly())


@query
def reconcile_hourly(spark, sf_dir):
    """Hours that the refresh had to leave stale."""
    lake, published = _late_arrivals(spark, sf_dir)
    gridded = staging.grid_observations(staging.stage_observations(lake.landing()))
    stale = quality.reconcile_hourly(published.hourly(), gridded, NOW)
    return _sparse(stale, "mart_observations", "source_observations")


@query
def built_marts(spark, sf_dir):
    """Totals of the three stored tables after a build."""
    root = shared_folder(spark, "build")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    lake.append(_observations(spark, sf_dir), "all")
    marts.build_marts(lake, published, _runs(spark, sf_dir))
    totals = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.sum(c).alias("total"))
        for name, df, c in (
            ("hourly", published.hourly(), "observation_count"),
            ("daily", published.daily(), "observation_count"),
            ("health", published.health(), "run_count"),
        )
    ]
    return totals[0].unionByName(totals[1]).unionByName(totals[2])


@query
def daily_refresh(spark, sf_dir):
    """Late rows for old days rebuild those days of the daily table, and no others."""
    root = shared_folder(spark, "daily")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    observed = _observations(spark, sf_dir)
    late = (F.day("observed_at") % 7 == 3) & (F.hour("observed_at") == 5)
    for name, part in (("early", ~late), ("late", late)):
        lake.append(observed.where(part), name)
        marts.refresh_daily(lake, published)
    return published.daily()


@query
def protected_marts(spark, sf_dir):
    """Daily rows beside what the hours of their day tell, both with small numbers withheld, late rows included."""
    root = shared_folder(spark, "protected")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    observed = _observations(spark, sf_dir)
    late = (F.day("observed_at") % 7 == 3) & (F.hour("observed_at") == 5)
    for name, part in (("early", ~late), ("late", late)):
        lake.append(observed.where(part), name)
        marts.refresh_hourly(lake, published, min_aircraft=3, beside_daily=True)
        marts.refresh_daily(lake, published)
    hours = published.hourly().groupBy("activity_date", "altitude_band")
    told = hours.agg(F.count("*").alias("published_cells"), F.sum("observation_count").alias("published_observations"))
    daily = published.daily().select("activity_date", "altitude_band", "observation_count", "distinct_aircraft")
    return daily.join(told, ["activity_date", "altitude_band"], "left").na.fill(0)


@query
def payload_files(spark, sf_dir):
    """Payloads as files, one each, read whole and judged."""
    path = f"{shared_folder(spark, 'files')}/inbox"
    _payloads(spark, sf_dir).repartition("source_file").write.partitionBy("source_file").text(path)
    opened = open_payloads(read_payload_files(spark, f"{path}/*"))
    return opened.groupBy("payload_status").agg(
        F.count("*").alias("payload_count"), F.countDistinct("source_file").alias("file_count")
    )


@query
def failed_load(spark, sf_dir):
    """A load whose write dies: its runs have failed with the error, and nothing was landed."""
    lake = _DyingLake(spark, f"{shared_folder(spark, 'failed')}/raw")
    try:
        landing.land_snapshots(_payloads(spark, sf_dir), lake, "all", PAYLOADS_NOW)
    except OSError:
        pass
    states = run_states(lake.ledger()).groupBy("status", "error_message").agg(
        F.count("*").alias("run_count"), F.count("rows_received").alias("counted_runs")
    )
    return states.withColumn("landed_rows", F.lit(lake.landing().count()))


class _DyingLake(Lake):
    def append(self, *args, **kwargs):
        raise OSError("no space left")


@query
def landed_provenance(spark, sf_dir):
    """Landed rows by the run that brought them: when it was served, when it landed."""
    root = shared_folder(spark, "provenance")
    lake = Lake(spark, f"{root}/raw")
    landing.land_snapshots(_inbox(spark, sf_dir, root), lake, "all", PAYLOADS_NOW)
    rows = lake.landing().groupBy("ingestion_run_id", "api_snapshot_time", "ingested_at")
    runs = run_states(lake.ledger()).select(F.col("run_id").alias("ingestion_run_id"), "rows_inserted")
    counted = rows.agg(F.count("*").alias("row_count"), F.countDistinct("load_id").alias("loads"))
    return _sparse(counted.join(runs, "ingestion_run_id").drop("ingestion_run_id"), "rows_inserted")


@query
def json_rows(spark, sf_dir):
    """A read query's rows written as JSON and read back."""
    path = f"{shared_folder(spark, 'json')}/rows"
    totals = reads.hourly_totals(_hourly(spark, sf_dir), NOW, 48)
    write_rows_json(totals, path, NOW, window_hours=48)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in totals.schema)
    return spark.read.schema(f"{kinds}, generated_at string, window_hours int").json(path)


@query
def windowed_reads(spark, sf_dir):
    """Three windows of one table: only hours that start within them count."""
    hourly = _hourly(spark, sf_dir).persist()
    parts = [
        reads.hourly_totals(hourly, NOW, hours).select(F.lit(hours).alias("window_hours"), "activity_hour", "observation_count")
        for hours in (1, 24, 100)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def fine_cells(spark, sf_dir):
    """Observations on a grid of a quarter of a degree."""
    cells = staging.grid_observations(_staged(spark, sf_dir), 0.25).groupBy("grid_lat", "grid_lon")
    return cells.agg(F.count("*").alias("row_count"))


@query
def freshness_classes(spark, sf_dir):
    """One table looked at five minutes, half an hour and a day after its newest row, and an empty one."""
    hourly = _hourly(spark, sf_dir)
    newest = hourly.agg(F.max("last_ingested_at")).scalar()
    looks = [
        reads.freshness(part, newest + F.make_dt_interval(mins=F.lit(minutes))).withColumn("minutes", F.lit(minutes))
        for part, minutes in ((hourly, 5), (hourly, 30), (hourly, 1440), (hourly.where(F.lit(False)), 0))
    ]
    seen = looks[0]
    for look in looks[1:]:
        seen = seen.unionByName(look)
    return views.classified_freshness(seen)


@query
def not_built(spark, sf_dir):
    """Whether each published table can be opened, before and after a build."""
    root = shared_folder(spark, "absent")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    lake.append(_observations(spark, sf_dir), "all")
    found = []
    for built in (False, True):
        if built:
            marts.build_marts(lake, published, _runs(spark, sf_dir))
        for name, open_table in (("hourly", published.hourly), ("daily", published.daily), ("health", published.health)):
            try:
                found.append((built, name, open_table().count()))
            except MartsNotBuilt:
                found.append((built, name, -1))
    return spark.createDataFrame(found, "built boolean, table_name string, row_count long")


@query
def quarantined_rows(spark, sf_dir):
    """Where the rows of a faulty table went: landed by day, or set aside by day and first broken rule."""
    lake = Lake(spark, f"{shared_folder(spark, 'quarantine')}/raw")
    lake.append(_faulty_observations(spark, sf_dir), "all")
    landed = lake.landing().groupBy(F.lit(None).cast("string").alias("reason"), F.col("observed_date").alias("day"))
    aside = lake.quarantine().groupBy("reason", F.col("set_aside_date").alias("day"))
    key = F.get_json_object("raw", "$.ingestion_run_id")
    return (
        landed.agg(F.count("*").alias("row_count"), F.countDistinct("ingestion_run_id").alias("run_count"))
        .unionByName(aside.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("run_count")))
    )


@query
def run_reject_reasons(spark, sf_dir):
    """Rejected rows by reason, as the ledger keeps them for every run of a load."""
    root = shared_folder(spark, "reasons")
    lake = Lake(spark, f"{root}/raw")
    landing.land_snapshots(_inbox(spark, sf_dir, root), lake, "all", PAYLOADS_NOW)
    times = run_states(lake.ledger()).select("run_id", "api_snapshot_time")
    return ledger.run_reject_reasons(lake.ledger()).join(times, "run_id").drop("run_id")


@query
def stored_identity_guard(spark, sf_dir):
    """Columns of the files that a build wrote, and how many of them would identify an aircraft."""
    root = shared_folder(spark, "guard")
    lake, published = Lake(spark, f"{root}/raw"), Marts(spark, f"{root}/marts")
    lake.append(_observations(spark, sf_dir), "all")
    marts.build_marts(lake, published, _runs(spark, sf_dir))
    return contracts.stored_identity(published)


@query
def stored_freshness(spark, sf_dir):
    """Freshness of a lake, from what its writers noted."""
    lake = Lake(spark, f"{shared_folder(spark, 'freshness')}/raw")
    observed = _observations(spark, sf_dir)
    for name, even in (("even", True), ("odd", False)):
        lake.append(observed.where((F.day("observed_at") % 2 == 0) == even), name)
    return quality.source_freshness(lake.newest_ingest(), dt.datetime(2024, 1, 31, 8))


@query
def compacted_ledger(spark, sf_dir):
    """The present state of runs whose events came in four loads and were gathered by day."""
    lake = Lake(spark, f"{shared_folder(spark, 'ledger')}/raw")
    events = src.to_ledger_events(src.orders(spark, sf_dir)).withColumn("reject_reasons", F.lit(None))
    for part in range(4):
        mine = events.where(F.pmod(F.crc32("run_id"), F.lit(4)) == part).withColumn("load_id", F.lit(f"load-{part}"))
        for seq, name in (ledger.STARTED[::-1], ledger.FINISHED[::-1]):
            lake.record(mine.where(F.col("event_seq") == seq).withColumn("event", F.lit(name)))
    lake.compact(RUNS_NOW.date() + dt.timedelta(days=15))
    return _ledger_columns(run_states(lake.ledger()))


@query
def compacted_landing(spark, sf_dir):
    """Five loads of all days, gathered: folders, rows and loads of each day."""
    lake = Lake(spark, f"{shared_folder(spark, 'compact')}/raw")
    for part in range(5):
        rows = _observations(spark, sf_dir).where(F.col("ingestion_run_id").cast("bigint") % 5 == part)
        lake.append(rows, f"load-{part}")
    lake.compact(LANDED_UNTIL.date())
    folder = F.regexp_extract(F.col("_metadata.file_path"), "commit=([0-9a-f]+)", 1)
    return (
        lake.landing()
        .groupBy("observed_date")
        .agg(
            F.countDistinct(folder).alias("folders"),
            F.countDistinct("load_id").alias("loads"),
            F.count("*").alias("row_count"),
        )
    )


class _InterruptedLake(Lake):
    """A lake in which another writer commits between this one's look and its own commit."""

    meanwhile: Callable[[], None] | None = None

    def append(self, *args, **kwargs):
        work, self.meanwhile = self.meanwhile, None
        if work:
            work()
        return super().append(*args, **kwargs)


def _both_feeds(lake: Lake) -> DataFrame:
    totals = run_states(lake.ledger()).agg(
        F.count("*").alias("runs"),
        *(F.sum(c).alias(c) for c in ("rows_received", "rows_rejected", "rows_inserted", "rows_duplicate")),
    )
    landed = lake.landing().agg(
        F.count("*").alias("landed_rows"), F.countDistinct("icao24", "observed_at").alias("landed_keys")
    ).first()
    return totals.withColumns({name: F.lit(n) for name, n in landed.asDict().items()})


@query
def stream_two_writers(spark, sf_dir):
    """Two streams land the same payloads; the second commits while the first is under way."""
    root = shared_folder(spark, "writers")
    _payloads(spark, sf_dir).write.parquet(f"{root}/inbox")
    lake = _InterruptedLake(spark, f"{root}/raw")

    def land(feed: str, into: Lake) -> None:
        inbox = stream_landing.stream_payload_archive(spark, f"{root}/inbox")
        stream_landing.land_stream(inbox, into, f"{root}/{feed}", name=feed, as_of=PAYLOADS_NOW).awaitTermination()

    lake.meanwhile = lambda: land("second", Lake(spark, f"{root}/raw"))
    land("first", lake)
    return _both_feeds(lake)


@query
def stream_two_feeds(spark, sf_dir):
    """The payloads landed twice into one lake: by one stream, then by another in smaller batches.

    Each has its own checkpoint. The second feed brings nothing new and takes nothing away.
    """
    root = shared_folder(spark, "feeds")
    archived = _inbox(spark, sf_dir, root)
    lake = Lake(spark, f"{root}/raw")
    for feed, files in (("first", None), ("second", -(-len(archived.inputFiles()) // 4))):
        inbox = stream_landing.stream_payload_archive(spark, f"{root}/inbox", files)
        stream_landing.land_stream(inbox, lake, f"{root}/{feed}", as_of=PAYLOADS_NOW).awaitTermination()
    return _both_feeds(lake)


@query
def stream_land(spark, sf_dir):
    """Payloads through the stream into the landing; the ledger's account of it."""
    root = shared_folder(spark, "land")
    _payloads(spark, sf_dir).write.parquet(f"{root}/inbox")
    lake = Lake(spark, f"{root}/raw")
    inbox = stream_landing.stream_payload_archive(spark, f"{root}/inbox")
    stream_landing.land_stream(inbox, lake, f"{root}/checkpoint", as_of=PAYLOADS_NOW).awaitTermination()
    counts = ("rows_received", "rows_rejected", "rows_inserted", "rows_duplicate")
    states = run_states(lake.ledger()).select("api_snapshot_time", "status", "error_message", *counts)
    return _sparse(states, *counts)


def _streamed(spark, purpose: str, table: DataFrame, keys: tuple, partial, merge) -> DataFrame:
    """Partials of a table that arrives in five batches, each holding rows of all times; four are merged.

    A batch is several files: as one it would be added up in one task.
    """
    root = shared_folder(spark, purpose)
    files = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 5)
    table.repartition(5 * files, *keys).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    windows.append_partials(stream, partial, f"{root}/out", f"{root}/checkpoint", merge).awaitTermination()
    return windows.read_partials(spark, f"{root}/out")


@query
def stream_hourly(spark, sf_dir):
    events = src.events(spark, sf_dir)
    partial = lambda batch: windows.hourly_partials(src.to_observations(batch))
    return windows.merged_hours(_streamed(spark, "hourly", events, ("event_id",), partial, windows.merge_hours))


@query
def stream_health(spark, sf_dir):
    orders = src.orders(spark, sf_dir)
    partial = lambda batch: windows.health_partials(src.to_runs(batch))
    return windows.merged_health(_streamed(spark, "health", orders, ("o_orderkey",), partial, windows.merge_health))


@query
def stream_dedup(spark, sf_dir):
    order = ("api_snapshot_time", "pos")
    reports = src.to_reports(src.events(spark, sf_dir))
    first = lambda rows: windows.deduplicated(rows, order)
    return _kept_per_hour(first(_streamed(spark, "dedup", reports, ("icao24", "pos"), first, first)))
