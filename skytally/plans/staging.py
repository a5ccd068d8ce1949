"""Landed rows to readable ones: units, buckets and flags. One row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import (
    FEET_PER_METRE,
    KNOTS_PER_METRE_PER_SECOND,
    altitude_band,
    count_where,
    grid_snap,
    heading_part,
    percentage,
    seconds_between,
)


def stage_observations(landed: DataFrame) -> DataFrame:
    """Drops the descriptive identity fields, derives the rest; filters nothing.

    The landing's own partition column serves as the day where there is one, so
    that a filter on it prunes folders.
    """
    day = F.col("observed_date") if "observed_date" in landed.columns else F.to_date("observed_at")
    return landed.select(
        "icao24",
        "observed_at",
        F.date_trunc("hour", "observed_at").alias("observed_hour"),
        day.alias("observed_date"),
        "time_position",
        "last_contact",
        "latitude",
        "longitude",
        "baro_altitude_m",
        "geo_altitude_m",
        (F.col("baro_altitude_m") * FEET_PER_METRE).alias("baro_altitude_ft"),
        (F.col("geo_altitude_m") * FEET_PER_METRE).alias("geo_altitude_ft"),
        "on_ground",
        "velocity_ms",
        (F.col("velocity_ms") * KNOTS_PER_METRE_PER_SECOND).alias("velocity_kts"),
        "true_track_deg",
        "vertical_rate_ms",
        "position_source",
        "category",
        (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("has_position"),
        "ingestion_run_id",
        "api_snapshot_time",
        "ingested_at",
        seconds_between(F.col("api_snapshot_time"), F.col("observed_at")).alias("observation_age_seconds"),
    )


def stage_runs(runs: DataFrame) -> DataFrame:
    """Durations are null while a run is still going; missing counts are zero."""
    return runs.select(
        "run_id",
        F.col("source").alias("source_system"),
        "source_endpoint",
        "request_bbox",
        "auth_mode",
        "credits_estimated",
        "started_at",
        "finished_at",
        F.date_trunc("hour", "started_at").alias("started_hour"),
        seconds_between(F.col("finished_at"), F.col("started_at")).alias("duration_seconds"),
        "status",
        (F.col("status") == "succeeded").alias("is_successful"),
        "http_status",
        "api_snapshot_time",
        seconds_between(F.col("finished_at"), F.col("api_snapshot_time")).alias("end_to_end_lag_seconds"),
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("rows_received", "rows_rejected", "rows_inserted", "rows_duplicate")
        ],
        "error_message",
    )


def grid_observations(staged: DataFrame, grid_degrees: float = 1) -> DataFrame:
    """Positioned rows with their cell, band and heading components.

    The last step that knows which aircraft a row is about; it is needed to count
    distinct ones.
    """
    on_ground, track = F.col("on_ground"), F.col("true_track_deg")
    return staged.where("has_position").select(
        "icao24",
        "observed_at",
        "observed_hour",
        "observed_date",
        grid_snap(F.col("latitude"), grid_degrees).alias("grid_lat"),
        grid_snap(F.col("longitude"), grid_degrees).alias("grid_lon"),
        altitude_band(on_ground, F.col("baro_altitude_ft")).alias("altitude_band"),
        "baro_altitude_ft",
        "velocity_kts",
        "on_ground",
        "true_track_deg",
        heading_part(F.sin, on_ground, track).alias("track_sin"),
        heading_part(F.cos, on_ground, track).alias("track_cos"),
        "ingestion_run_id",
        "ingested_at",
    )


def position_coverage(staged: DataFrame) -> DataFrame:
    """How much of the feed lacks a position."""
    lacking = count_where(~F.col("has_position"))
    return staged.agg(
        F.count("*").alias("row_count"),
        lacking.alias("positionless_count"),
        percentage(lacking, F.count("*"), 3).alias("positionless_pct"),
    )


def register_views(landed: DataFrame, runs: DataFrame, grid_degrees: float = 1) -> None:
    """Staging and intermediate results as views; nothing is stored for them."""
    staged = stage_observations(landed)
    staged.createOrReplaceTempView("staged_observations")
    stage_runs(runs).createOrReplaceTempView("staged_runs")
    grid_observations(staged, grid_degrees).createOrReplaceTempView("gridded_observations")
