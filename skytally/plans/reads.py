"""Bounded read queries over the published tables.

``as_of`` stands for the present, so that a result can be repeated. A window of N
hours keeps hours that *start* within it, which leaves out the partly covered one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import (
    hours_before,
    instant,
    mean_bearing,
    resultant_length,
    seconds_between,
)

MAX_HOURS = 720
MAX_DAYS = 365


def _bounded(value: int, limit: int, unit: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not 1 <= value <= limit:
        raise ValueError(f"{unit} must be a whole number from 1 to {limit}")
    return value


def _last_hours(table: DataFrame, column: str, hours: int, as_of: dt.datetime | Column) -> DataFrame:
    _bounded(hours, MAX_HOURS, "hours")
    bound = hours_before(instant(as_of), hours)
    recent = table.where(F.col(column) >= bound)
    if "activity_date" in table.columns:
        # The stored table is foldered by day; the hour filter alone prunes none.
        recent = recent.where(F.col("activity_date") >= F.to_date(bound))
    return recent


def grid_density(hourly: DataFrame, as_of: dt.datetime | Column, hours: int = 24) -> DataFrame:
    """Density and overall flow per cell.

    An hourly bearing and its concentration are the polar form of a mean vector;
    these vectors are added up, weighted by how many headings went into each.
    ``aircraft_bucket_total`` adds up distinct counts and so counts an aircraft
    once per bucket it was seen in.
    """
    weight = F.col("track_sample_count") * F.col("track_concentration")
    angle = F.radians("dominant_track_deg")
    samples = F.nullif(F.sum("track_sample_count"), F.lit(0))
    cells = (
        _last_hours(hourly, "activity_hour", hours, as_of)
        .groupBy("grid_lat", "grid_lon")
        .agg(
            F.sum("observation_count").alias("observation_count"),
            F.sum("distinct_aircraft").alias("aircraft_bucket_total"),
            F.sum("track_sample_count").alias("track_sample_count"),
            (F.sum(weight * F.sin(angle)) / samples).alias("_sin"),
            (F.sum(weight * F.cos(angle)) / samples).alias("_cos"),
        )
    )
    return cells.select(
        "grid_lat",
        "grid_lon",
        "observation_count",
        "aircraft_bucket_total",
        "track_sample_count",
        mean_bearing(F.col("_sin"), F.col("_cos")).alias("dominant_track_deg"),
        resultant_length(F.col("_sin"), F.col("_cos")).alias("track_concentration"),
    ).orderBy("grid_lat", "grid_lon")


def hourly_totals(hourly: DataFrame, as_of: dt.datetime | Column, hours: int = 48) -> DataFrame:
    return (
        _last_hours(hourly, "activity_hour", hours, as_of)
        .groupBy("activity_hour")
        .agg(
            F.sum("observation_count").alias("observation_count"),
            F.sum("distinct_aircraft").alias("aircraft_bucket_total"),
            F.count("*").alias("populated_cells"),
        )
        .orderBy("activity_hour")
    )


def altitude_profile(hourly: DataFrame, as_of: dt.datetime | Column, hours: int = 24) -> DataFrame:
    """The speed is the plain mean of the buckets' means, not weighted by their size."""
    return (
        _last_hours(hourly, "activity_hour", hours, as_of)
        .groupBy("altitude_band")
        .agg(
            F.sum("observation_count").alias("observation_count"),
            F.round(F.avg("avg_velocity_kts"), 1).alias("avg_velocity_kts"),
        )
        .orderBy(F.desc("observation_count"), "altitude_band")
    )


def daily_profile(daily: DataFrame, as_of: dt.datetime | Column, days: int = 14) -> DataFrame:
    """Spans ``days`` + 1 calendar days, today included."""
    _bounded(days, MAX_DAYS, "days")
    return (
        daily.where(F.col("activity_date") >= F.date_sub(F.to_date(instant(as_of)), days))
        .select(
            "activity_date",
            "altitude_band",
            "observation_count",
            "distinct_aircraft",
            "distinct_grid_cells",
        )
        .orderBy("activity_date", "altitude_band")
    )


def pipeline_health(health: DataFrame, as_of: dt.datetime | Column, hours: int = 24) -> DataFrame:
    return (
        _last_hours(health, "health_hour", hours, as_of)
        .select(
            "health_hour",
            "run_count",
            "succeeded_count",
            "failed_count",
            "success_rate_pct",
            "reject_rate_pct",
            "rows_inserted",
            "rows_duplicate",
            "avg_lag_seconds",
            "credits_consumed",
        )
        .orderBy("health_hour")
    )


def freshness(hourly: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """One row, also when the table is empty."""
    return hourly.agg(
        F.max("last_ingested_at").alias("last_ingested_at"),
        F.max("activity_hour").alias("latest_activity_hour"),
    ).withColumn("age_seconds", seconds_between(instant(as_of), F.col("last_ingested_at")))
