"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values -----------------------------------------------------------

ALTITUDE_BANDS = (
    "ground",
    "below_10k",
    "10k_to_24k",
    "24k_to_35k",
    "above_35k",
    "unknown",
)

RUN_STATUSES = ("running", "succeeded", "failed")

AUTH_MODES = ("anonymous", "oauth2_client_credentials")

# Columns that would identify or locate one airframe; none may be published.
IDENTITY_COLUMNS = (
    "icao24",
    "callsign",
    "squawk",
    "registration",
    "tail_number",
    "serial_number",
    "origin_country",
    "spi",
    "sensors",
    "latitude",
    "longitude",
)

# --- landed tables ----------------------------------------------------------

OBSERVATION_KEY = ("icao24", "observed_at")

STATE_VECTORS = StructType(
    [
        StructField("icao24", StringType()),
        StructField("observed_at", TimestampType()),
        StructField("time_position", TimestampType()),
        StructField("last_contact", TimestampType()),
        StructField("callsign", StringType()),
        StructField("origin_country", StringType()),
        StructField("longitude", DoubleType()),
        StructField("latitude", DoubleType()),
        StructField("baro_altitude_m", DoubleType()),
        StructField("geo_altitude_m", DoubleType()),
        StructField("on_ground", BooleanType()),
        StructField("velocity_ms", DoubleType()),
        StructField("true_track_deg", DoubleType()),
        StructField("vertical_rate_ms", DoubleType()),
        StructField("squawk", StringType()),
        StructField("spi", BooleanType()),
        StructField("position_source", ShortType()),
        StructField("category", ShortType()),
        StructField("ingestion_run_id", StringType()),
        StructField("api_snapshot_time", TimestampType()),
        StructField("ingested_at", TimestampType()),
    ]
)

BBOX = StructType([StructField(edge, DoubleType()) for edge in ("lamin", "lamax", "lomin", "lomax")])

INGESTION_RUNS = StructType(
    [
        StructField("run_id", StringType()),
        StructField("source", StringType()),
        StructField("source_endpoint", StringType()),
        StructField("request_bbox", BBOX),
        StructField("auth_mode", StringType()),
        StructField("credits_estimated", IntegerType()),
        StructField("started_at", TimestampType()),
        StructField("finished_at", TimestampType()),
        StructField("status", StringType()),
        StructField("http_status", IntegerType()),
        StructField("api_snapshot_time", TimestampType()),
        StructField("rows_received", IntegerType()),
        StructField("rows_rejected", IntegerType()),
        StructField("rows_inserted", IntegerType()),
        StructField("rows_duplicate", IntegerType()),
        StructField("error_message", StringType()),
    ]
)

# Landing and ledger carry the day they are foldered by, and the load, after the data.
LANDING_TABLE = StructType(
    STATE_VECTORS.fields
    + [StructField("observed_date", DateType()), StructField("load_id", StringType())]
)
LEDGER_TABLE = StructType(
    INGESTION_RUNS.fields
    + [
        StructField("event_seq", IntegerType()),
        StructField("reject_reasons", MapType(StringType(), LongType())),
        StructField("load_id", StringType()),
        StructField("event", StringType()),
    ]
)

# What a writer set aside: rows that could not be read or break a rule.
QUARANTINE_TABLE = StructType(
    [StructField(name, StringType()) for name in ("run_id", "reason", "raw", "load_id")]
    + [StructField("set_aside_date", DateType())]
)

PAYLOADS = StructType(
    [StructField("payload", StringType()), StructField("source_file", StringType())]
)

# --- published tables -------------------------------------------------------

HOURLY_ACTIVITY = StructType(
    [
        StructField("activity_hour", TimestampType()),
        StructField("grid_lat", DoubleType()),
        StructField("grid_lon", DoubleType()),
        StructField("altitude_band", StringType()),
        StructField("observation_count", LongType()),
        StructField("distinct_aircraft", LongType()),
        StructField("avg_baro_altitude_ft", DoubleType()),
        StructField("avg_velocity_kts", DoubleType()),
        StructField("dominant_track_deg", DoubleType()),
        StructField("track_concentration", DoubleType()),
        StructField("track_sample_count", LongType()),
        StructField("first_observed_at", TimestampType()),
        StructField("last_observed_at", TimestampType()),
        StructField("contributing_run_count", LongType()),
        StructField("last_ingested_at", TimestampType()),
    ]
)

DAILY_ACTIVITY = StructType(
    [
        StructField("activity_date", DateType()),
        StructField("altitude_band", StringType()),
        StructField("observation_count", LongType()),
        StructField("distinct_aircraft", LongType()),
        StructField("distinct_grid_cells", LongType()),
        StructField("avg_baro_altitude_ft", DoubleType()),
        StructField("avg_velocity_kts", DoubleType()),
        StructField("first_observed_at", TimestampType()),
        StructField("last_observed_at", TimestampType()),
        StructField("contributing_run_count", LongType()),
        StructField("last_ingested_at", TimestampType()),
    ]
)

INGESTION_HEALTH = StructType(
    [
        StructField("health_hour", TimestampType()),
        StructField("run_count", LongType()),
        StructField("succeeded_count", LongType()),
        StructField("failed_count", LongType()),
        StructField("still_running_count", LongType()),
        StructField("success_rate_pct", DoubleType()),
        StructField("rows_received", LongType()),
        StructField("rows_inserted", LongType()),
        StructField("rows_duplicate", LongType()),
        StructField("rows_rejected", LongType()),
        StructField("reject_rate_pct", DoubleType()),
        StructField("avg_duration_seconds", DoubleType()),
        StructField("avg_lag_seconds", DoubleType()),
        StructField("max_lag_seconds", DoubleType()),
        StructField("credits_consumed", LongType()),
        StructField("last_finished_at", TimestampType()),
    ]
)

HOURLY_GRAIN = ("activity_hour", "grid_lat", "grid_lon", "altitude_band")
DAILY_GRAIN = ("activity_date", "altitude_band")
HEALTH_GRAIN = ("health_hour",)


def conform(df, schema: StructType):
    """Select exactly the declared columns, in order, with the declared types."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
