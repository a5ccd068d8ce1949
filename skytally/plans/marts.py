"""The three published tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions.columns import (
    count_where,
    instant,
    mean_bearing,
    percentage,
    resultant_length,
)
from skytally.operators.ledger import run_states
from skytally.plans.staging import grid_observations, stage_observations, stage_runs
from skytally.schemas import (
    ALTITUDE_BANDS,
    DAILY_ACTIVITY,
    HOURLY_ACTIVITY,
    INGESTION_HEALTH,
    conform,
)
from skytally.sources.tables import Lake, Marts

# Hours before the newest built one that are rebuilt with it.
LATE_ARRIVAL_LOOKBACK_HOURS = 3
# Cells finer than this would locate single aircraft unless small ones are withheld.
COARSE_GRID_DEGREES = 1
ROWS_PER_FILE = 1_000_000


def _rounded_mean(column: str, places: int) -> Column:
    return F.round(F.avg(column), places)


def hourly_activity(gridded: DataFrame) -> DataFrame:
    """Density and flow by hour, cell and altitude band.

    Both distinct counts come from one pass: Spark deduplicates per task before it
    shuffles, on keys that include the aircraft or the run, so a busy cell is
    spread over many tasks.
    """
    has_track = F.col("track_sample_count") > 0
    totals = gridded.groupBy(
        F.col("observed_hour").alias("activity_hour"), "grid_lat", "grid_lon", "altitude_band"
    ).agg(
        F.count("*").alias("observation_count"),
        F.countDistinct("icao24").alias("distinct_aircraft"),
        _rounded_mean("baro_altitude_ft", 0).alias("avg_baro_altitude_ft"),
        _rounded_mean("velocity_kts", 1).alias("avg_velocity_kts"),
        F.count("track_sin").alias("track_sample_count"),
        F.avg("track_sin").alias("_sin"),
        F.avg("track_cos").alias("_cos"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
        F.countDistinct("ingestion_run_id").alias("contributing_run_count"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    directed = totals.withColumns(
        {
            "dominant_track_deg": F.when(has_track, mean_bearing(F.col("_sin"), F.col("_cos"))),
            "track_concentration": F.when(has_track, resultant_length(F.col("_sin"), F.col("_cos"))),
        }
    )
    return conform(directed, HOURLY_ACTIVITY)


def daily_activity(gridded: DataFrame) -> DataFrame:
    """Daily profile by band, counted from the observations.

    Distinct counts do not add up over hours: one aircraft seen in three hours is
    one aircraft that day.
    """
    totals = gridded.groupBy(F.col("observed_date").alias("activity_date"), "altitude_band").agg(
        F.count("*").alias("observation_count"),
        F.countDistinct("icao24").alias("distinct_aircraft"),
        F.countDistinct(F.struct("grid_lat", "grid_lon")).alias("distinct_grid_cells"),
        _rounded_mean("baro_altitude_ft", 0).alias("avg_baro_altitude_ft"),
        _rounded_mean("velocity_kts", 1).alias("avg_velocity_kts"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
        F.countDistinct("ingestion_run_id").alias("contributing_run_count"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    return conform(totals, DAILY_ACTIVITY)


def health_measures() -> list[Column]:
    """Aggregates over staged runs; used by the batch table and the stream alike."""
    succeeded = count_where(F.col("status") == "succeeded")
    return [
        F.count("*").alias("run_count"),
        succeeded.alias("succeeded_count"),
        count_where(F.col("status") == "failed").alias("failed_count"),
        count_where(F.col("status") == "running").alias("still_running_count"),
        percentage(succeeded, F.count("*"), 1).alias("success_rate_pct"),
        F.sum("rows_received").alias("rows_received"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_duplicate").alias("rows_duplicate"),
        F.sum("rows_rejected").alias("rows_rejected"),
        percentage(F.sum("rows_rejected"), F.sum("rows_received"), 3).alias("reject_rate_pct"),
        _rounded_mean("duration_seconds", 3).alias("avg_duration_seconds"),
        _rounded_mean("end_to_end_lag_seconds", 1).alias("avg_lag_seconds"),
        F.round(F.max("end_to_end_lag_seconds"), 1).alias("max_lag_seconds"),
        F.sum("credits_estimated").alias("credits_consumed"),
        F.max("finished_at").alias("last_finished_at"),
    ]


def ingestion_health(staged_runs: DataFrame) -> DataFrame:
    """Hourly health of the ingestion. Says nothing about the traffic."""
    hourly = staged_runs.groupBy(F.col("started_hour").alias("health_hour")).agg(*health_measures())
    return conform(hourly, INGESTION_HEALTH)


def suppress_small_cells(hourly: DataFrame, min_aircraft: int) -> DataFrame:
    """Withhold cells in which fewer aircraft were seen."""
    return hourly.where(F.col("distinct_aircraft") >= min_aircraft)


def protect_totals(hourly: DataFrame, min_aircraft: int) -> DataFrame:
    """Withhold small cells, and with them one more cell of the same day and band.

    A total over the day less the cells that are published is what was withheld.
    With the smallest cell that is large enough among it, that difference always
    counts at least ``min_aircraft`` aircraft in two cells or more. Where no cell
    is large enough, nothing of that day and band is published by the hour.
    """
    group = Window.partitionBy(F.to_date("activity_hour"), "altitude_band")
    small = F.col("distinct_aircraft") < min_aircraft
    place = F.struct("observation_count", "activity_hour", "grid_lat", "grid_lon")
    marked = hourly.withColumns(
        {
            "_place": place,
            "_small": F.max(small).over(group),
            "_next": F.min(F.when(~small, place)).over(group),
        }
    )
    return marked.where(~small & ~(F.col("_small") & (F.col("_place") == F.col("_next")))).select(hourly.columns)


def protected_daily(daily: DataFrame, min_aircraft: int | None) -> DataFrame:
    """The daily table without rows of too few aircraft."""
    return daily if min_aircraft is None else suppress_small_cells(daily, min_aircraft)


def hourly_cells(landed: DataFrame, grid_degrees: float = 1) -> DataFrame:
    return hourly_activity(grid_observations(stage_observations(landed), grid_degrees))


def publishable_hourly(landed: DataFrame, grid_degrees: float = 1, min_aircraft: int | None = None) -> DataFrame:
    if grid_degrees < COARSE_GRID_DEGREES and min_aircraft is None:
        raise ValueError("a grid finer than 1 degree needs min_aircraft")
    hourly = hourly_cells(landed, grid_degrees)
    return hourly if min_aircraft is None else suppress_small_cells(hourly, min_aircraft)


def files_per_hour(grid_degrees: float) -> int:
    """From the most rows an hour can have on this grid."""
    most_rows = (180 / grid_degrees) * (360 / grid_degrees) * len(ALTITUDE_BANDS)
    return max(1, round(most_rows / ROWS_PER_FILE))


def since_bound(landed: DataFrame, bound: dt.datetime) -> DataFrame:
    """Rows observed at or after an hour; the day filter is what prunes folders."""
    return landed.where(F.col("observed_date") >= F.lit(bound.date())).where(
        F.col("observed_at") >= instant(bound)
    )


def refresh_hourly(
    lake: Lake,
    marts: Marts,
    *,
    full_refresh: bool = False,
    lookback_hours: int = LATE_ARRIVAL_LOOKBACK_HOURS,
    grid_degrees: float | None = None,
    min_aircraft: int | None = None,
    beside_daily: bool | None = None,
) -> None:
    """Rebuild the newest hours whole, from everything landed for them.

    Rows older than the lookback are left out until a full refresh; the hourly
    reconciliation reports them. Grid and suppression are stored with the table and
    hold for every refresh; only a full refresh may change them.

    With ``beside_daily`` a table with suppression can stand beside daily totals
    (:func:`protect_totals`). It is then rebuilt by whole days, from the first one
    that has new rows on: a total that counts more than the hours do would tell
    what was withheld, or what came late.
    """
    if not isinstance(lookback_hours, int) or lookback_hours < 0:
        raise ValueError("the lookback must be a whole number of hours")
    newest = None if full_refresh else marts.latest_hour()
    stored = marts.publishing()
    grid = stored[0] if grid_degrees is None else float(grid_degrees)
    least = stored[1] if min_aircraft is None else min_aircraft
    current = marts.hourly_table.current().facts
    protected = current.get("protected", False) if beside_daily is None else beside_daily
    protected = protected and least is not None
    if newest is not None and protected != current.get("protected", False):
        raise ValueError("the hourly table was built otherwise; protecting totals needs a full refresh")
    if newest is not None and (grid, least) != stored:
        raise ValueError(f"the hourly table was built with {stored}; another grid or suppression needs a full refresh")
    bound = None if newest is None else newest - dt.timedelta(hours=lookback_hours)
    version = lake.observations.current()
    if bound is not None and protected:
        first = min([bound.date(), *lake.changed_days(current["landing_version"])])
        bound = dt.datetime.combine(first, dt.time())
    landed = lake.landing(version=version)
    if bound is not None:
        landed = since_bound(lake.landing(since=bound.date(), version=version), bound)
    hourly = protect_totals(hourly_cells(landed, grid), least) if protected else publishable_hourly(landed, grid, least)
    marts.write_hourly(
        hourly,
        replace_all=bound is None,
        since=bound,
        files_per_hour=files_per_hour(grid),
        grid_degrees=grid,
        min_aircraft=least,
        protected=protected,
        landing_version=version.number,
    )


def refresh_daily(lake: Lake, marts: Marts, *, full_refresh: bool = False) -> None:
    """Rebuild the days that rows have been landed for since the last build, however old they are.

    With suppression, after the hourly table and from the same rows.
    """
    facts_hourly = marts.hourly_table.current().facts
    version = lake.observations.current()
    if facts_hourly.get("min_aircraft") is not None:
        if not facts_hourly["protected"]:
            raise ValueError("daily totals would undo the suppression: build the hourly table beside them")
        version = replace(version, parts=tuple(p for p in version.parts if p.added <= facts_hourly["landing_version"]))
        version = replace(version, number=facts_hourly["landing_version"])
    landed = version.number
    built = marts.daily_table.current()
    grid, least = marts.publishing()
    facts = {"landing_version": landed, "grid_degrees": grid, "min_aircraft": least}
    same = all(built.facts.get(k, facts[k]) == facts[k] for k in ("grid_degrees", "min_aircraft"))
    if full_refresh or not built.number or not same:
        rows = lake.landing(version=version)
        kept = None
    else:
        days = lake.changed_days(built.facts["landing_version"], version)
        if not days:
            return
        rows = lake.landing(days, version=version)
        kept = marts.daily().where(~F.col("activity_date").isin(days))
    daily = protected_daily(daily_activity(grid_observations(stage_observations(rows), grid)), least)
    # A row per day and band: the whole table is a small file.
    marts.write_daily((daily if kept is None else kept.unionByName(daily)).coalesce(1), facts)


def refresh_health(lake: Lake, marts: Marts) -> None:
    """Rebuild the hours of the days whose runs have new events."""
    recorded = lake.events.current().number
    built = marts.health_table.current()
    kept = None
    events = lake.ledger()
    if built.number and "ledger_version" in built.facts:
        days = lake.changed_starts(built.facts["ledger_version"])
        if not days:
            return
        events = lake.ledger(days)
        kept = marts.health().where(~F.to_date("health_hour").isin(days))
    health = ingestion_health(stage_runs(run_states(events)))
    marts.write_health((health if kept is None else kept.unionByName(health)).coalesce(1), {"ledger_version": recorded})


def build_marts(lake: Lake, marts: Marts, runs: DataFrame | None = None, **hourly_options) -> None:
    """All three tables, each brought up to date; health from ``runs`` instead of the ledger if they are given."""
    refresh_hourly(lake, marts, beside_daily=True, **hourly_options)
    refresh_daily(lake, marts, full_refresh=hourly_options.get("full_refresh", False))
    if runs is None:
        refresh_health(lake, marts)
    else:
        marts.write_health(ingestion_health(stage_runs(runs)))
