"""The registered queries once more, in plain SQL over the driver's tables.

Written from the definitions, not generated from the DataFrame code, so that the
two can be compared. Payload faults are known here by their number, while the
Spark side finds them by parsing the text.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
RUNS_NOW = "TIMESTAMP '2024-01-01 12:00:00'"
LANDED_UNTIL = "TIMESTAMP '2024-01-16 00:00:00'"

# --- derived tables, as common table expressions --------------------------------

_OBS_COLUMNS = """
    printf('%06x', user_id) AS icao24,
    ts AS observed_at,
    CASE WHEN event_id % 17 <> 0 THEN 49 + ((event_id * 37) % 1200) / 100e0 END AS latitude,
    CASE WHEN event_id % 17 <> 0 THEN -10 + ((event_id * 53) % 1300) / 100e0 END AS longitude,
    CASE WHEN event_id % 11 <> 0 THEN CAST((event_id * 97) % 13000 AS DOUBLE) END AS baro_altitude_m,
    event_id % 13 = 0 AS on_ground,
    value + 50 AS velocity_ms,
    CASE WHEN event_id % 19 <> 0 THEN CAST((event_id * 29) % 360 AS DOUBLE) END AS true_track_deg,
    CAST(event_id % 500 AS VARCHAR) AS ingestion_run_id,
    ts + to_seconds(event_id % 60) AS api_snapshot_time,
    ts + to_seconds((event_id * 7919) % 28800) AS ingested_at
"""
OBS = f"obs AS (SELECT event_id, {_OBS_COLUMNS} FROM events)"

STAGED = """staged AS (
    SELECT *,
        CAST(date_trunc('hour', observed_at) AS TIMESTAMP) AS observed_hour,
        CAST(observed_at AS DATE) AS observed_date,
        baro_altitude_m * 3.280839895e0 AS baro_altitude_ft,
        (baro_altitude_m + 100) * 3.280839895e0 AS geo_altitude_ft,
        velocity_ms * 1.943844e0 AS velocity_kts,
        latitude IS NOT NULL AND longitude IS NOT NULL AS has_position,
        (epoch_us(api_snapshot_time) - epoch_us(observed_at)) / 1e6 AS observation_age_seconds
    FROM obs)"""


GRIDDED = """gridded AS (
    SELECT *,
        floor(latitude) AS grid_lat,
        floor(longitude) AS grid_lon,
        CASE WHEN on_ground THEN 'ground'
             WHEN baro_altitude_ft IS NULL THEN 'unknown'
             WHEN baro_altitude_ft < 10000 THEN 'below_10k'
             WHEN baro_altitude_ft < 24000 THEN '10k_to_24k'
             WHEN baro_altitude_ft < 35000 THEN '24k_to_35k'
             ELSE 'above_35k' END AS altitude_band,
        CASE WHEN NOT on_ground THEN sin(radians(true_track_deg)) END AS track_sin,
        CASE WHEN NOT on_ground THEN cos(radians(true_track_deg)) END AS track_cos
    FROM staged WHERE has_position)"""


def _bearing(sine: str, cosine: str) -> str:
    return f"round(fmod(degrees(atan2({sine}, {cosine})) + 360, 360), 1)"


def _length(sine: str, cosine: str) -> str:
    return f"round(sqrt({sine} * {sine} + {cosine} * {cosine}), 3)"


def _hourly(rows: str = "gridded") -> str:
    return f"""sums AS (
    SELECT observed_hour AS activity_hour, grid_lat, grid_lon, altitude_band,
        count(*) AS observation_count,
        count(DISTINCT icao24) AS distinct_aircraft,
        round(avg(baro_altitude_ft), 0) AS avg_baro_altitude_ft,
        round(avg(velocity_kts), 1) AS avg_velocity_kts,
        count(track_sin) AS track_sample_count,
        avg(track_sin) AS s, avg(track_cos) AS c,
        min(observed_at) AS first_observed_at,
        max(observed_at) AS last_observed_at,
        count(DISTINCT ingestion_run_id) AS contributing_run_count,
        max(ingested_at) AS last_ingested_at
    FROM {rows} GROUP BY ALL),
hourly AS (
    SELECT * EXCLUDE (s, c),
        CASE WHEN track_sample_count > 0 THEN {_bearing('s', 'c')} END AS dominant_track_deg,
        CASE WHEN track_sample_count > 0 THEN {_length('s', 'c')} END AS track_concentration
    FROM sums)"""


HOURLY = _hourly()

DAILY = """daily AS (
    SELECT observed_date AS activity_date, altitude_band,
        count(*) AS observation_count,
        count(DISTINCT icao24) AS distinct_aircraft,
        count(DISTINCT CAST(grid_lat AS VARCHAR) || '/' || CAST(grid_lon AS VARCHAR)) AS distinct_grid_cells,
        round(avg(baro_altitude_ft), 0) AS avg_baro_altitude_ft,
        round(avg(velocity_kts), 1) AS avg_velocity_kts,
        min(observed_at) AS first_observed_at,
        max(observed_at) AS last_observed_at,
        count(DISTINCT ingestion_run_id) AS contributing_run_count,
        max(ingested_at) AS last_ingested_at
    FROM gridded GROUP BY ALL)"""

RUNS = """runs AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
        CAST(50 + o_orderkey % 12 AS DOUBLE) AS lamax,
        CAST(-9 + (o_orderkey % 5) * 10 AS DOUBLE) AS lomax,
        CASE WHEN o_orderkey % 3 = 0 THEN 'anonymous' ELSE 'oauth2_client_credentials' END AS auth_mode,
        CAST(1 + o_orderkey % 4 AS INTEGER) AS credits_estimated,
        make_timestamp(1704067200000000 + (o_orderkey % 43200) * 60000000) AS started_at,
        CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'succeeded' ELSE 'running' END AS status,
        CASE WHEN o_orderstatus IN ('F', 'P') THEN
            make_timestamp(1704067200000000 + (o_orderkey % 43200) * 60000000 + (o_orderkey % 90) * 1000000)
        END AS finished_at,
        CASE WHEN o_orderstatus = 'P' THEN 200 END AS http_status,
        CASE WHEN o_orderstatus = 'P' THEN
            make_timestamp(1704067200000000 + (o_orderkey % 43200) * 60000000 - (o_orderkey % 45) * 1000000)
        END AS api_snapshot_time,
        CASE WHEN o_orderstatus = 'P' THEN CAST(100 + o_orderkey % 700 AS INTEGER) END AS rows_received,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey % 7 AS INTEGER) END AS rows_rejected,
        CASE WHEN o_orderstatus = 'P' THEN CAST(90 + o_orderkey % 600 AS INTEGER) END AS rows_inserted,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey % 50 AS INTEGER) END AS rows_duplicate,
        CASE WHEN o_orderstatus = 'F' THEN 'source unavailable' END AS error_message
    FROM orders)"""

STAGED_RUNS = """staged_runs AS (
    SELECT run_id, auth_mode, credits_estimated, started_at, finished_at, status, http_status,
        api_snapshot_time, error_message,
        'public_adsb' AS source_system, '/states/all' AS source_endpoint,
        CAST(date_trunc('hour', started_at) AS TIMESTAMP) AS started_hour,
        (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS duration_seconds,
        (epoch_us(finished_at) - epoch_us(api_snapshot_time)) / 1e6 AS end_to_end_lag_seconds,
        status = 'succeeded' AS is_successful,
        coalesce(rows_received, 0) AS rows_received,
        coalesce(rows_rejected, 0) AS rows_rejected,
        coalesce(rows_inserted, 0) AS rows_inserted,
        coalesce(rows_duplicate, 0) AS rows_duplicate
    FROM runs)"""

_HEALTH_COLUMNS = """
        count(*) AS run_count,
        count(*) FILTER (WHERE status = 'succeeded') AS succeeded_count,
        count(*) FILTER (WHERE status = 'failed') AS failed_count,
        count(*) FILTER (WHERE status = 'running') AS still_running_count,
        round(100e0 * count(*) FILTER (WHERE status = 'succeeded') / count(*), 1) AS success_rate_pct,
        CAST(sum(rows_received) AS BIGINT) AS rows_received,
        CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
        CAST(sum(rows_duplicate) AS BIGINT) AS rows_duplicate,
        CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected,
        round(100e0 * CAST(sum(rows_rejected) AS BIGINT) / nullif(CAST(sum(rows_received) AS BIGINT), 0), 3)
            AS reject_rate_pct,
        round(avg(duration_seconds), 3) AS avg_duration_seconds,
        round(avg(end_to_end_lag_seconds), 1) AS avg_lag_seconds,
        round(max(end_to_end_lag_seconds), 1) AS max_lag_seconds,
        CAST(sum(credits_estimated) AS BIGINT) AS credits_consumed,
        max(finished_at) AS last_finished_at
"""
HEALTH = f"""health AS (
    SELECT started_hour AS health_hour, {_HEALTH_COLUMNS}
    FROM staged_runs GROUP BY started_hour)"""

GRID = f"""cells AS (
    SELECT grid_lat, grid_lon,
        CAST(sum(observation_count) AS BIGINT) AS observation_count,
        CAST(sum(distinct_aircraft) AS BIGINT) AS aircraft_bucket_total,
        CAST(sum(track_sample_count) AS BIGINT) AS track_sample_count,
        sum(track_sample_count * track_concentration * sin(radians(dominant_track_deg)))
            / nullif(sum(track_sample_count), 0) AS s,
        sum(track_sample_count * track_concentration * cos(radians(dominant_track_deg)))
            / nullif(sum(track_sample_count), 0) AS c
    FROM hourly WHERE activity_hour >= {NOW} - INTERVAL 720 HOUR
    GROUP BY grid_lat, grid_lon),
grid AS (
    SELECT * EXCLUDE (s, c), {_bearing('s', 'c')} AS dominant_track_deg,
        {_length('s', 'c')} AS track_concentration
    FROM cells)"""

TOTALS = f"""totals AS (
    SELECT activity_hour,
        CAST(sum(observation_count) AS BIGINT) AS observation_count,
        CAST(sum(distinct_aircraft) AS BIGINT) AS aircraft_bucket_total,
        count(*) AS populated_cells
    FROM hourly WHERE activity_hour >= {NOW} - INTERVAL 720 HOUR
    GROUP BY activity_hour)"""

PROFILE = f"""profile AS (
    SELECT altitude_band,
        CAST(sum(observation_count) AS BIGINT) AS observation_count,
        round(avg(avg_velocity_kts), 1) AS avg_velocity_kts
    FROM hourly WHERE activity_hour >= {NOW} - INTERVAL 720 HOUR
    GROUP BY altitude_band)"""

HEALTH_READ = f"""health_read AS (
    SELECT health_hour, run_count, succeeded_count, failed_count, success_rate_pct, reject_rate_pct,
        rows_inserted, rows_duplicate, avg_lag_seconds, credits_consumed
    FROM health WHERE health_hour >= {NOW} - INTERVAL 720 HOUR)"""

# Reports: every observation one to three times.
REPORTS = """reports AS (
    SELECT printf('%06x', user_id) AS icao24, ts AS observed_at, copies.pos AS pos,
        value + 50 + copies.pos AS velocity_ms,
        ts + to_seconds(((copies.pos * 7 + event_id) % 5) * 120) AS api_snapshot_time
    FROM events JOIN (VALUES (0), (1), (2)) AS copies(pos) ON copies.pos <= event_id % 3)"""

# Expected verdict on a state, by event_id % 97.
_VERDICTS = """
        CASE event_id % 97
            WHEN 1 THEN 'icao24_missing' WHEN 2 THEN 'icao24_missing'
            WHEN 3 THEN 'last_contact_not_numeric' WHEN 4 THEN 'last_contact_implausible'
            WHEN 5 THEN 'last_contact_out_of_range' WHEN 6 THEN 'time_position_not_numeric'
            WHEN 7 THEN 'on_ground_not_boolean' WHEN 8 THEN 'longitude_not_numeric'
            WHEN 9 THEN 'longitude_out_of_range' WHEN 10 THEN 'latitude_out_of_range'
            WHEN 11 THEN 'latitude_not_finite' WHEN 12 THEN 'true_track_out_of_range'
            WHEN 13 THEN 'true_track_out_of_range' WHEN 14 THEN 'velocity_not_finite'
            WHEN 15 THEN 'text_field_not_string' WHEN 16 THEN 'text_field_not_string'
            WHEN 17 THEN 'baro_altitude_not_numeric' WHEN 18 THEN 'geo_altitude_not_numeric'
            WHEN 19 THEN 'vertical_rate_not_numeric' WHEN 20 THEN 'position_source_not_numeric'
            WHEN 21 THEN 'category_out_of_range' WHEN 22 THEN 'row_not_array'
            WHEN 23 THEN 'row_too_short' WHEN 24 THEN 'row_not_array'
            WHEN 25 THEN 'icao24_invalid' WHEN 29 THEN 'on_ground_not_boolean'
            WHEN 30 THEN 'text_field_not_string' WHEN 31 THEN 'last_contact_implausible'
        END
"""

# All states in all payloads, usable or not; then the usable ones.
STATES = f"""placed AS (
    SELECT event_id // 100 AS k, 0 AS part, copies.copy AS copy, events.*
    FROM events JOIN (VALUES (0), (1), (2)) AS copies(copy) ON copies.copy <= event_id % 3
    UNION ALL
    SELECT event_id // 100 + 1 AS k, 1 AS part, 0 AS copy, events.* FROM events),
payloads AS (
    SELECT k, printf('snapshot-%012d', k) AS source_file,
        CASE k % 29 WHEN 1 THEN 'time_unusable' WHEN 2 THEN 'time_unusable' WHEN 3 THEN 'not_object'
            WHEN 4 THEN 'states_not_list' WHEN 6 THEN 'not_json' ELSE 'ok' END AS payload_status,
        CASE WHEN k % 29 NOT IN (1, 2, 3, 4, 6) THEN
            make_timestamp((max(epoch_us(ts)) // 1000000 + 10) * 1000000) END AS api_snapshot_time
    FROM placed GROUP BY k),
states AS (
    SELECT placed.*, payloads.source_file, payloads.api_snapshot_time,
        printf('%06x', user_id) AS icao24,
        CASE WHEN event_id % 17 <> 0 THEN ts ELSE ts + INTERVAL 1 SECOND END AS observed_at,
        {_VERDICTS} AS reason
    FROM placed JOIN payloads ON placed.k = payloads.k
    WHERE payload_status = 'ok' AND placed.k % 29 <> 5),
firsts AS (
    SELECT * FROM states WHERE reason IS NULL
    QUALIFY row_number() OVER (
        PARTITION BY icao24, observed_at ORDER BY api_snapshot_time, source_file, part, copy, event_id) = 1),
accounting AS (
    SELECT payloads.source_file, payloads.payload_status, payloads.api_snapshot_time,
        coalesce(a.received, 0) AS rows_received, coalesce(a.rejected, 0) AS rows_rejected,
        coalesce(b.inserted, 0) AS rows_inserted,
        coalesce(a.received, 0) - coalesce(a.rejected, 0) - coalesce(b.inserted, 0) AS rows_duplicate
    FROM payloads
    LEFT JOIN (SELECT k, count(*) AS received, count(reason) AS rejected FROM states GROUP BY k) a ON a.k = payloads.k
    LEFT JOIN (SELECT k, count(*) AS inserted FROM firsts GROUP BY k) b ON b.k = payloads.k)"""

FAULTY_OBS = f"""clean AS (SELECT event_id, {_OBS_COLUMNS} FROM events),
obs AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 101 = 1 THEN 95e0 ELSE latitude END AS latitude,
        CASE WHEN event_id % 101 = 2 THEN -200e0 ELSE longitude END AS longitude,
        CASE event_id % 101 WHEN 3 THEN 360e0 WHEN 4 THEN -1e0 ELSE true_track_deg END AS true_track_deg,
        CASE event_id % 101 WHEN 5 THEN NULL WHEN 6 THEN 'ABCDEF' WHEN 7 THEN '0123456789abc'
            ELSE icao24 END AS icao24,
        CASE WHEN event_id % 101 = 8 THEN '-1' ELSE ingestion_run_id END AS ingestion_run_id,
        CASE WHEN event_id % 101 = 9 THEN NULL ELSE on_ground END AS on_ground)
    FROM clean JOIN (VALUES (1), (2)) AS copies(copy) ON copies.copy = 1 OR (event_id % 101) % 10 = 0)"""

FAULTY_RUNS = RUNS.replace("runs AS (", "clean_runs AS (", 1) + """,
runs AS (
    SELECT * REPLACE (
        CASE WHEN CAST(run_id AS BIGINT) % 103 = 1 THEN 'paused' ELSE status END AS status,
        CASE WHEN CAST(run_id AS BIGINT) % 103 = 2 THEN 'basic' ELSE auth_mode END AS auth_mode,
        CASE WHEN CAST(run_id AS BIGINT) % 103 = 3 THEN NULL ELSE finished_at END AS finished_at,
        CASE WHEN CAST(run_id AS BIGINT) % 103 = 4 THEN 7 ELSE credits_estimated END AS credits_estimated,
        CASE WHEN CAST(run_id AS BIGINT) % 103 = 5 THEN -1 ELSE rows_received END AS rows_received)
    FROM clean_runs JOIN (VALUES (1), (2)) AS copies(copy)
        ON copies.copy = 1 OR CAST(run_id AS BIGINT) % 103 = 6)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


_TO_GRID = (OBS, STAGED, GRIDDED)
_TO_HOURLY = (*_TO_GRID, HOURLY)
_TO_HEALTH = (RUNS, STAGED_RUNS, HEALTH)

KEPT_PER_HOUR = """SELECT CAST(date_trunc('hour', observed_at) AS TIMESTAMP) AS observed_hour,
    count(*) AS kept_rows, CAST(sum(pos) AS BIGINT) AS pos_sum, max(velocity_ms) AS max_velocity_ms,
    max(api_snapshot_time) AS last_snapshot_time
FROM (SELECT * FROM reports QUALIFY row_number() OVER (
    PARTITION BY icao24, observed_at ORDER BY api_snapshot_time, pos) = 1)
GROUP BY 1"""

# Rows landed early, or late but for an hour that the refresh still rebuilds.
REFRESHED = f"""bound AS (
    SELECT max(observed_hour) - INTERVAL 3 HOUR AS hour FROM gridded WHERE ingested_at < {LANDED_UNTIL}),
seen AS (
    SELECT gridded.* FROM gridded, bound
    WHERE ingested_at < {LANDED_UNTIL} OR observed_hour >= bound.hour)"""

_NULLS = {
    "obs": ("state_vectors", ("icao24", "observed_at", "ingestion_run_id", "on_ground")),
    "runs": ("ingestion_runs", ("run_id", "status")),
    "staged": (
        "staged_observations",
        ("icao24", "observed_at", "observed_hour", "on_ground", "has_position", "ingestion_run_id"),
    ),
    "staged_runs": ("staged_runs", ("run_id", "status", "rows_received", "rows_inserted")),
    "gridded": ("gridded_observations", ("icao24", "grid_lat", "grid_lon", "altitude_band")),
    "hourly": (
        "hourly",
        ("activity_hour", "grid_lat", "grid_lon", "altitude_band", "observation_count", "distinct_aircraft",
         "track_sample_count", "contributing_run_count", "last_ingested_at"),
    ),
    "daily": (
        "daily",
        ("activity_date", "altitude_band", "observation_count", "distinct_aircraft", "distinct_grid_cells"),
    ),
    "health": ("health", ("health_hour", "run_count", "credits_consumed")),
}

_BANDS = "('ground', 'below_10k', '10k_to_24k', '24k_to_35k', 'above_35k', 'unknown')"
_STATUSES = "('running', 'succeeded', 'failed')"

# (relation, published name, assertion, column, violating condition)
_CONDITIONS = (
    ("runs", "ingestion_runs", "accepted_values", "status", f"status NOT IN {_STATUSES}"),
    ("runs", "ingestion_runs", "accepted_values", "auth_mode",
     "auth_mode NOT IN ('anonymous', 'oauth2_client_credentials')"),
    ("staged", "staged_observations", "accepted_range", "latitude", "latitude NOT BETWEEN -90 AND 90"),
    ("staged", "staged_observations", "accepted_range", "longitude", "longitude NOT BETWEEN -180 AND 180"),
    ("staged", "staged_observations", "expression_is_true", "true_track_deg",
     "true_track_deg < 0 OR true_track_deg >= 360"),
    ("staged_runs", "staged_runs", "accepted_values", "status", f"status NOT IN {_STATUSES}"),
    ("staged_runs", "staged_runs", "accepted_range", "rows_received", "rows_received < 0"),
    ("staged_runs", "staged_runs", "accepted_range", "rows_inserted", "rows_inserted < 0"),
    ("staged_runs", "staged_runs", "accepted_range", "credits_estimated",
     "credits_estimated NOT BETWEEN 1 AND 4"),
    ("gridded", "gridded_observations", "accepted_range", "grid_lat", "grid_lat NOT BETWEEN -90 AND 90"),
    ("gridded", "gridded_observations", "accepted_range", "grid_lon", "grid_lon NOT BETWEEN -180 AND 180"),
    ("gridded", "gridded_observations", "accepted_values", "altitude_band", f"altitude_band NOT IN {_BANDS}"),
    ("hourly", "hourly", "accepted_values", "altitude_band", f"altitude_band NOT IN {_BANDS}"),
    ("hourly", "hourly", "accepted_range", "observation_count", "observation_count < 1"),
    ("hourly", "hourly", "accepted_range", "distinct_aircraft", "distinct_aircraft < 1"),
    ("hourly", "hourly", "accepted_range", "dominant_track_deg", "dominant_track_deg NOT BETWEEN 0 AND 360"),
    ("hourly", "hourly", "accepted_range", "track_concentration", "track_concentration NOT BETWEEN 0 AND 1"),
    ("hourly", "hourly", "accepted_range", "track_sample_count", "track_sample_count < 0"),
    ("daily", "daily", "accepted_values", "altitude_band", f"altitude_band NOT IN {_BANDS}"),
    ("daily", "daily", "accepted_range", "observation_count", "observation_count < 1"),
    ("daily", "daily", "accepted_range", "distinct_aircraft", "distinct_aircraft < 1"),
    ("daily", "daily", "accepted_range", "distinct_grid_cells", "distinct_grid_cells < 1"),
    ("health", "health", "accepted_range", "run_count", "run_count < 1"),
    ("health", "health", "accepted_range", "success_rate_pct", "success_rate_pct NOT BETWEEN 0 AND 100"),
    ("health", "health", "accepted_range", "reject_rate_pct", "reject_rate_pct NOT BETWEEN 0 AND 100"),
    ("health", "health", "accepted_range", "credits_consumed", "credits_consumed < 0"),
)

_KEYS = (
    ("runs", "ingestion_runs", "run_id"),
    ("staged", "staged_observations", "icao24,observed_at"),
    ("staged_runs", "staged_runs", "run_id"),
    ("gridded", "gridded_observations", "icao24,observed_at"),
    ("hourly", "hourly", "activity_hour,grid_lat,grid_lon,altitude_band"),
    ("daily", "daily", "activity_date,altitude_band"),
    ("health", "health", "health_hour"),
)


def _contracts() -> str:
    def row(name: str, assertion: str, column: str, count: str) -> str:
        return (
            f"SELECT '{name}' AS table_name, '{assertion}' AS assertion, '{column}' AS column_name, "
            f"CAST({count} AS BIGINT) AS violations"
        )

    parts = [
        f"{row(name, 'not_null', c, f'count(*) FILTER (WHERE {c} IS NULL)')} FROM {relation}"
        for relation, (name, columns) in _NULLS.items()
        for c in columns
    ]
    parts += [
        f"{row(name, assertion, c, f'count(*) FILTER (WHERE {broken})')} FROM {relation}"
        for relation, name, assertion, c, broken in _CONDITIONS
    ]
    parts += [
        f"{row(name, 'unique', key, 'count(*)')} FROM "
        f"(SELECT {key} FROM {relation} GROUP BY {key} HAVING count(*) > 1)"
        for relation, name, key in _KEYS
    ]
    for relation, name in (("obs", "state_vectors"), ("staged", "staged_observations")):
        parts.append(
            f"{row(name, 'relationships', 'ingestion_run_id', 'count(*)')} FROM {relation} "
            "WHERE ingestion_run_id IS NOT NULL AND ingestion_run_id NOT IN (SELECT run_id FROM runs)"
        )
    parts += [row(name, "no_identity", "*", "0") for name in ("hourly", "daily", "health")]
    return _with(
        FAULTY_OBS, STAGED, GRIDDED, HOURLY, DAILY, FAULTY_RUNS, STAGED_RUNS, HEALTH,
        select="\nUNION ALL\n".join(parts),
    )


def _by_day(count_of: str, *ctes: str, where: str) -> str:
    return _with(
        *ctes,
        select=f"SELECT CAST(observed_at AS DATE) AS observed_date, count(*) AS row_count "
        f"FROM {count_of} WHERE {where} GROUP BY 1",
    )


def _fixed(value: str, places: int) -> str:
    """Text with a fixed number of decimals."""
    return f"printf('%.{places}f', {value})"


_FAILURES = f"""
    SELECT 'run_failure_rate' AS name, rate <= 20 AS ok,
        'failed within the hour: ' || failed || ' of ' || total || ' runs, ' || {_fixed('rate', 1)} || '%' AS detail,
        round(rate, 1) AS value, 20e0 AS threshold
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'failed') AS failed,
            100e0 * count(*) FILTER (WHERE status = 'failed') / count(*) AS rate
          FROM runs WHERE started_at >= {RUNS_NOW} - INTERVAL 1 HOUR)"""


def _stuck(now: str) -> str:
    return f"""
    SELECT 'no_stuck_runs' AS name, n = 0 AS ok,
        CASE WHEN n = 0 THEN 'every run has finished or is recent'
            ELSE n || ' unfinished for more than 15 minutes' END AS detail,
        CAST(n AS DOUBLE) AS value, 0e0 AS threshold
    FROM (SELECT count(*) AS n FROM runs
          WHERE status = 'running' AND started_at < {now} - INTERVAL 15 MINUTE)"""


_REJECTS = f"""
    SELECT 'reject_rate' AS name, rate <= 1 AS ok,
        'rejected within the hour: ' || rejected || ' of ' || received || ' rows, ' || {_fixed('rate', 3)} || '%' AS detail,
        round(rate, 3) AS value, 1e0 AS threshold
    FROM (SELECT CAST(sum(rows_received) AS BIGINT) AS received, CAST(sum(rows_rejected) AS BIGINT) AS rejected,
            100e0 * CAST(sum(rows_rejected) AS BIGINT) / CAST(sum(rows_received) AS BIGINT) AS rate
          FROM runs WHERE status = 'succeeded' AND started_at >= {RUNS_NOW} - INTERVAL 1 HOUR)"""

_CREDITS = f"""
    SELECT 'credit_budget' AS name, spent <= 3600 AS ok,
        {_fixed('spent', 0)} || ' of 4000 daily credits used (oauth2_client_credentials)' AS detail,
        spent AS value, 3600e0 AS threshold
    FROM (SELECT CAST(sum(credits_estimated) AS DOUBLE) AS spent FROM runs
          WHERE started_at >= {RUNS_NOW} - INTERVAL 24 HOUR)"""


def _fresh(now: str) -> str:
    return f"""
    SELECT 'freshness' AS name, age <= 6 AS ok,
        'last landed ' || {_fixed('age', 1)} || ' minutes ago, allowed are 6.0' AS detail,
        round(age, 1) AS value, 6e0 AS threshold
    FROM (SELECT (epoch_us({now}) - epoch_us(max(ingested_at))) / 1e6 / 60 AS age FROM obs)"""


def _all_checks(select: str) -> str:
    union = "\nUNION ALL\n".join([_fresh(RUNS_NOW), _FAILURES, _stuck(RUNS_NOW), _REJECTS, _CREDITS])
    return _with(OBS, RUNS, f"results AS ({union})", select=select)


_COST = "CASE WHEN area <= 25 THEN 1 WHEN area <= 100 THEN 2 WHEN area <= 400 THEN 3 ELSE 4 END"


# Columns that leave as timestamps although they are dates, and as doubles although they count.
_DATES = {
    "daily_activity": ("activity_date",),
    "daily_profile": ("activity_date",),
    "daily_refresh": ("activity_date",),
    "protected_marts": ("activity_date",),
    "quarantined_rows": ("day",),
    **dict.fromkeys(
        (
            "staged_profile", "idempotent_insert", "region_filter", "dup_keys", "not_null_violations",
            "range_violations", "compacted_landing",
        ),
        ("observed_date",),
    ),
}
_SPARSE = {
    "staged_runs": ("http_status",),
    "ledger_state": ("rows_received", "rows_inserted"),
    "compacted_ledger": ("rows_received", "rows_inserted"),
    "reconcile_hourly": ("mart_observations", "source_observations"),
    "stream_land": ("rows_received", "rows_rejected", "rows_inserted", "rows_duplicate"),
}


def _plain(name: str, sql: str) -> str:
    casts = [f"CAST({c} AS TIMESTAMP) AS {c}" for c in _DATES.get(name, ())]
    casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in _SPARSE.get(name, ())]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


def _two_feeds() -> str:
    return _with(
        STATES,
        select="""SELECT 2 * count(*) AS runs,
            CAST(2 * sum(rows_received) FILTER (WHERE payload_status = 'ok') AS BIGINT) AS rows_received,
            CAST(2 * sum(rows_rejected) FILTER (WHERE payload_status = 'ok') AS BIGINT) AS rows_rejected,
            CAST(sum(rows_inserted) FILTER (WHERE payload_status = 'ok') AS BIGINT) AS rows_inserted,
            CAST(sum(2 * rows_received - 2 * rows_rejected - rows_inserted)
                FILTER (WHERE payload_status = 'ok') AS BIGINT) AS rows_duplicate,
            CAST(sum(rows_inserted) AS BIGINT) AS landed_rows,
            CAST(sum(rows_inserted) AS BIGINT) AS landed_keys
        FROM accounting""",
    )


def statements() -> dict[str, str]:
    return {name: _plain(name, sql) for name, sql in _statements().items()}


def _statements() -> dict[str, str]:
    return {
        "hourly_activity": _with(*_TO_HOURLY, select="SELECT * FROM hourly"),
        "daily_activity": _with(*_TO_GRID, DAILY, select="SELECT * FROM daily"),
        "ingestion_health": _with(*_TO_HEALTH, select="SELECT * FROM health"),
        "suppressed_cells": _with(*_TO_HOURLY, select="SELECT * FROM hourly WHERE distinct_aircraft >= 2"),
        "staged_profile": _with(
            OBS,
            STAGED,
            select="""SELECT observed_date, count(*) AS row_count,
                count(*) FILTER (WHERE has_position) AS positioned_count,
                round(max(baro_altitude_ft), 4) AS max_baro_altitude_ft,
                round(min(geo_altitude_ft), 4) AS min_geo_altitude_ft,
                round(max(velocity_kts), 4) AS max_velocity_kts,
                max(observation_age_seconds) AS max_age_seconds
            FROM staged GROUP BY observed_date""",
        ),
        "stage_quality": _with(
            OBS,
            STAGED,
            select="""SELECT count(*) AS row_count, count(*) FILTER (WHERE NOT has_position) AS positionless_count,
                round(100e0 * count(*) FILTER (WHERE NOT has_position) / count(*), 3) AS positionless_pct
            FROM staged""",
        ),
        "staged_runs": _with(RUNS, STAGED_RUNS, select="SELECT * FROM staged_runs"),
        "altitude_bands": _with(
            *_TO_GRID, select="SELECT altitude_band, count(*) AS row_count FROM gridded GROUP BY altitude_band"
        ),
        "grid_cells": _with(
            *_TO_GRID, select="SELECT grid_lat, grid_lon, count(*) AS row_count FROM gridded GROUP BY ALL"
        ),
        "heading_components": _with(
            *_TO_GRID,
            select="""SELECT altitude_band, count(track_sin) AS sample_count, round(avg(track_sin), 6) AS mean_sin,
                round(avg(track_cos), 6) AS mean_cos FROM gridded GROUP BY altitude_band""",
        ),
        "staging_views": _with(
            *_TO_GRID,
            RUNS,
            select="""SELECT runs.status, count(*) AS row_count,
                count(DISTINCT CAST(grid_lat AS VARCHAR) || '/' || CAST(grid_lon AS VARCHAR)) AS cell_count
            FROM gridded JOIN runs ON runs.run_id = gridded.ingestion_run_id GROUP BY runs.status""",
        ),
        "grid_density": _with(*_TO_HOURLY, GRID, select="SELECT * FROM grid"),
        "hourly_totals": _with(*_TO_HOURLY, TOTALS, select="SELECT * FROM totals"),
        "altitude_profile": _with(*_TO_HOURLY, PROFILE, select="SELECT * FROM profile"),
        "daily_profile": _with(
            *_TO_GRID,
            DAILY,
            select="""SELECT activity_date, altitude_band, observation_count, distinct_aircraft, distinct_grid_cells
            FROM daily WHERE activity_date >= DATE '2024-01-31' - 365""",
        ),
        "health_read": _with(*_TO_HEALTH, HEALTH_READ, select="SELECT * FROM health_read"),
        "mart_freshness": _with(
            *_TO_HOURLY,
            select=f"""SELECT *, CASE WHEN age_seconds < 360 THEN 'ok' WHEN age_seconds < 3600 THEN 'warn'
                WHEN age_seconds IS NOT NULL THEN 'bad' END AS freshness_class
            FROM (SELECT max(last_ingested_at) AS last_ingested_at, max(activity_hour) AS latest_activity_hour,
                (epoch_us({NOW}) - epoch_us(max(last_ingested_at))) / 1e6 AS age_seconds FROM hourly)""",
        ),
        "flow_arrows": _with(
            *_TO_HOURLY,
            GRID,
            select="""SELECT * FROM grid
            WHERE coalesce(track_concentration, 0) >= 0.55e0 AND track_sample_count >= 3""",
        ),
        "density_bins": _with(
            *_TO_HOURLY,
            GRID,
            select="""SELECT *, CAST(least(5, floor(pow(observation_count
                / CAST((SELECT max(observation_count) FROM grid) AS DOUBLE), 0.55e0) * 6)) AS INTEGER) AS density_bin
            FROM grid""",
        ),
        "cell_size": _with(
            *_TO_HOURLY,
            GRID,
            select="""SELECT least(1e0, coalesce(min(gap), 1e0)) AS cell_degrees
            FROM (SELECT grid_lat - lag(grid_lat) OVER (ORDER BY grid_lat) AS gap
                  FROM (SELECT DISTINCT grid_lat FROM grid))""",
        ),
        "altitude_share": _with(
            *_TO_HOURLY,
            PROFILE,
            select="""SELECT *, round(100e0 * observation_count
                / (SELECT CAST(sum(observation_count) AS BIGINT) FROM profile), 1) AS share_pct FROM profile""",
        ),
        "headline": _with(
            *_TO_HOURLY,
            TOTALS,
            *_TO_HEALTH,
            HEALTH_READ,
            select="""SELECT
                (SELECT CAST(sum(observation_count) AS BIGINT) FROM
                    (SELECT observation_count FROM totals ORDER BY activity_hour DESC LIMIT 24)) AS observations_24h,
                CAST(sum(run_count) AS BIGINT) AS run_count,
                CAST(sum(failed_count) AS BIGINT) AS failed_count,
                CAST(sum(credits_consumed) AS BIGINT) AS credits_consumed
            FROM health_read""",
        ),
        "recent_health": _with(
            *_TO_HEALTH,
            HEALTH_READ,
            select="""SELECT *, CASE WHEN failed_count > 0 THEN 'bad' ELSE 'ok' END AS failure_class
            FROM health_read ORDER BY health_hour DESC LIMIT 12""",
        ),
        "payload_status": _with(
            STATES, select="SELECT payload_status, count(*) AS payload_count FROM payloads GROUP BY payload_status"
        ),
        "reject_reasons": _with(
            STATES,
            select="SELECT reason, count(*) AS row_count FROM states WHERE reason IS NOT NULL GROUP BY reason",
        ),
        "other_reject_reasons": """SELECT reason, count(*) AS row_count, count(reason) AS raw_count
            FROM (SELECT CASE event_id % 41
                WHEN 1 THEN 'time_position_out_of_range' WHEN 2 THEN 'time_position_implausible'
                WHEN 3 THEN 'longitude_not_finite' WHEN 4 THEN 'latitude_not_numeric'
                WHEN 5 THEN 'true_track_not_numeric' WHEN 6 THEN 'true_track_not_finite'
                WHEN 7 THEN 'baro_altitude_not_finite' WHEN 8 THEN 'geo_altitude_not_finite'
                WHEN 9 THEN 'velocity_not_numeric' WHEN 10 THEN 'vertical_rate_not_finite'
                WHEN 11 THEN 'text_field_not_string' WHEN 12 THEN 'position_source_not_finite'
                WHEN 13 THEN 'position_source_out_of_range' WHEN 14 THEN 'category_not_numeric'
                WHEN 15 THEN 'category_not_finite' WHEN 16 THEN 'text_field_not_string'
                WHEN 17 THEN 'text_field_not_string' WHEN 18 THEN 'time_position_implausible'
                WHEN 19 THEN 'velocity_not_numeric' END AS reason FROM events) GROUP BY reason""",
        "accepted_profile": _with(
            STATES,
            select="""SELECT CAST(date_trunc('hour', observed_at) AS TIMESTAMP) AS observed_hour, count(*) AS row_count,
                count(*) FILTER (WHERE event_id % 17 <> 0) AS time_position_count,
                count(*) FILTER (WHERE event_id % 7 <> 0) AS origin_country_count,
                count(*) FILTER (WHERE event_id % 97 <> 26) AS category_count,
                CAST(sum(CASE WHEN event_id % 97 = 28 THEN 1 ELSE event_id % 4 END) AS BIGINT) AS position_source_sum,
                count(*) FILTER (WHERE event_id % 97 = 27) AS spi_count,
                count(*) FILTER (WHERE event_id % 13 = 0) AS on_ground_count,
                count(DISTINCT icao24) AS distinct_aircraft,
                max(value + 50) AS max_velocity_ms,
                min(CASE WHEN event_id % 17 <> 0 THEN 49 + ((event_id * 37) % 1200) / 100e0 END) AS min_latitude,
                CAST(max(length('C' || event_id % 1000)) AS INTEGER) AS max_callsign_length
            FROM states WHERE reason IS NULL GROUP BY 1""",
        ),
        "dry_run": _with(
            STATES,
            select="""SELECT t.source_file, t.rows_received, t.rows_valid, t.rows_rejected, t.rows_unique,
                t.rows_valid - t.rows_unique AS rows_duplicate_in_batch,
                coalesce(r.reject_reasons, '{}') AS reject_reasons
            FROM (SELECT source_file, count(*) AS rows_received,
                    count(*) FILTER (WHERE reason IS NULL) AS rows_valid, count(reason) AS rows_rejected,
                    count(DISTINCT CASE WHEN reason IS NULL
                        THEN icao24 || '/' || epoch_us(observed_at) END) AS rows_unique
                  FROM states GROUP BY source_file) t
            LEFT JOIN (SELECT source_file,
                    '{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}' AS reject_reasons
                  FROM (SELECT source_file, reason, count(*) AS n FROM states
                        WHERE reason IS NOT NULL GROUP BY source_file, reason)
                  GROUP BY source_file) r ON r.source_file = t.source_file""",
        ),
        "dry_run_total": _with(
            STATES,
            select="""SELECT *, rows_valid - rows_unique AS rows_duplicate_in_batch
            FROM (SELECT count(*) AS rows_received, count(*) FILTER (WHERE reason IS NULL) AS rows_valid,
                    count(reason) AS rows_rejected,
                    count(DISTINCT CASE WHEN reason IS NULL
                        THEN icao24 || '/' || epoch_us(observed_at) END) AS rows_unique
                  FROM states)""",
        ),
        "dedup_first_wins": _with(REPORTS, select=KEPT_PER_HOUR),
        "idempotent_insert": _with(
            REPORTS,
            f"keys AS (SELECT icao24, observed_at, bool_or(api_snapshot_time < {LANDED_UNTIL}) AS early, "
            f"bool_or(api_snapshot_time >= {LANDED_UNTIL}) AS late FROM reports GROUP BY icao24, observed_at)",
            select="""SELECT CAST(observed_at AS DATE) AS observed_date,
                count(*) FILTER (WHERE early) AS landed_rows, count(*) FILTER (WHERE late) AS later_rows,
                count(*) FILTER (WHERE late AND NOT early) AS inserted_rows
            FROM keys GROUP BY 1""",
        ),
        "load_accounting": _with(STATES, select="SELECT * FROM accounting"),
        "ledger_state": _with(
            RUNS,
            select="""SELECT run_id, status, started_at, finished_at, rows_received, rows_inserted, error_message
            FROM runs""",
        ),
        "snapshot_lag": _with(
            RUNS,
            select=f"""SELECT run_id, api_snapshot_time,
                round((epoch_us({NOW}) - epoch_us(api_snapshot_time)) / 1e6, 1) AS lag_seconds
            FROM runs WHERE api_snapshot_time IS NOT NULL""",
        ),
        "credit_cost": _with(
            RUNS,
            select=f"""SELECT lamax, lomax, area AS area_sq_deg, {_COST} AS credits
            FROM (SELECT DISTINCT lamax, lomax, (lamax - 49) * (lomax + 10) AS area FROM runs)""",
        ),
        "cadence_budget": _with(
            RUNS,
            select=f"""SELECT *, 1440 * credit_cost AS daily_credit_budget,
                1440 * credit_cost > daily_allowance AS over_budget
            FROM (SELECT auth_mode, lamax, lomax, run_count, {_COST} AS credit_cost,
                    CASE WHEN auth_mode = 'anonymous' THEN 400 ELSE 4000 END AS daily_allowance
                  FROM (SELECT auth_mode, lamax, lomax, (lamax - 49) * (lomax + 10) AS area, count(*) AS run_count
                        FROM runs GROUP BY ALL))""",
        ),
        "region_filter": _by_day(
            "obs", OBS, where="latitude BETWEEN 50 AND 58 AND longitude BETWEEN -6 AND 2"
        ),
        "attributed_rows": _with(
            FAULTY_OBS,
            RUNS,
            select="""SELECT count(*) AS attributed_rows FROM obs
            JOIN runs ON runs.run_id = obs.ingestion_run_id""",
        ),
        "orphan_rows": _with(
            FAULTY_OBS,
            RUNS,
            select="""SELECT ingestion_run_id, count(*) AS row_count FROM obs
            WHERE ingestion_run_id NOT IN (SELECT run_id FROM runs) GROUP BY ingestion_run_id""",
        ),
        "dup_keys": _with(
            FAULTY_OBS,
            select="""SELECT CAST(observed_at AS DATE) AS observed_date, count(*) AS key_count,
                CAST(sum(n) AS BIGINT) AS row_count
            FROM (SELECT icao24, observed_at, count(*) AS n FROM obs GROUP BY icao24, observed_at HAVING count(*) > 1)
            GROUP BY 1""",
        ),
        "dup_runs": _with(
            FAULTY_RUNS,
            select="SELECT run_id, count(*) AS row_count FROM runs GROUP BY run_id HAVING count(*) > 1",
        ),
        "not_null_violations": _by_day("obs", FAULTY_OBS, where="icao24 IS NULL"),
        "range_violations": _by_day("obs", FAULTY_OBS, where="latitude NOT BETWEEN -90 AND 90"),
        "bad_values": _with(FAULTY_RUNS, select=f"SELECT run_id, status FROM runs WHERE status NOT IN {_STATUSES}"),
        "expression_violations": _with(
            FAULTY_OBS,
            select="""SELECT true_track_deg, count(*) AS row_count FROM obs
            WHERE NOT (true_track_deg >= 0 AND true_track_deg < 360) GROUP BY true_track_deg""",
        ),
        "broken_observation_rules": _with(
            FAULTY_OBS,
            """broken AS (SELECT unnest(CASE WHEN len(rules) = 0 THEN [NULL] ELSE rules END) AS rule FROM (
                SELECT list_filter([
                    CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude_range' END,
                    CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude_range' END,
                    CASE WHEN NOT (true_track_deg >= 0 AND true_track_deg < 360) THEN 'true_track_range' END,
                    CASE WHEN icao24 <> lower(icao24) OR length(icao24) NOT BETWEEN 1 AND 12 THEN 'icao24_form' END
                ], lambda x: x IS NOT NULL) AS rules FROM obs))""",
            select="SELECT rule, count(*) AS row_count FROM broken GROUP BY rule",
        ),
        "broken_run_rules": _with(
            FAULTY_RUNS,
            f"""broken AS (SELECT unnest(CASE WHEN len(rules) = 0 THEN [NULL] ELSE rules END) AS rule FROM (
                SELECT list_filter([
                    CASE WHEN status NOT IN {_STATUSES} THEN 'status_known' END,
                    CASE WHEN auth_mode NOT IN ('anonymous', 'oauth2_client_credentials') THEN 'auth_mode_known' END,
                    CASE WHEN (status = 'running') <> (finished_at IS NULL) THEN 'finished_unless_running' END
                ], lambda x: x IS NOT NULL) AS rules FROM runs))""",
            select="SELECT rule, count(*) AS row_count FROM broken GROUP BY rule",
        ),
        "ledger_balance": _with(
            RUNS,
            select="""SELECT run_id, rows_received, rows_rejected, rows_inserted, rows_duplicate FROM runs
            WHERE status = 'succeeded' AND rows_received <> rows_rejected + rows_inserted + rows_duplicate""",
        ),
        "source_freshness": _with(
            OBS,
            select="""SELECT *, CASE WHEN age_seconds > 21600 THEN 'error' WHEN age_seconds > 1800 THEN 'warn'
                ELSE 'pass' END AS status
            FROM (SELECT max(ingested_at) AS last_ingested_at,
                (epoch_us(TIMESTAMP '2024-01-31 08:00:00') - epoch_us(max(ingested_at))) / 1e6 AS age_seconds
                FROM obs)""",
        ),
        "contract_report": _contracts(),
        "check_freshness": _with(OBS, select=_fresh(NOW)),
        "check_run_failure_rate": _with(RUNS, select=_FAILURES),
        "check_no_stuck_runs": _with(RUNS, select=_stuck(NOW)),
        "check_reject_rate": _with(RUNS, select=_REJECTS),
        "check_credit_budget": _with(RUNS, select=_CREDITS),
        "health_checks": _all_checks("SELECT * FROM results"),
        "health_summary": _all_checks(
            """SELECT count(*) AS total, count(*) FILTER (WHERE NOT ok) AS failed,
                coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE NOT ok), '') AS failed_checks
            FROM results"""
        ),
        "late_refresh": _with(*_TO_GRID, REFRESHED, _hourly("seen"), select="SELECT * FROM hourly"),
        "full_refresh": _with(*_TO_HOURLY, select="SELECT * FROM hourly"),
        "reconcile_hourly": _with(
            *_TO_GRID,
            REFRESHED,
            select="""SELECT coalesce(a.hour, b.hour) AS activity_hour, a.n AS mart_observations,
                b.n AS source_observations
            FROM (SELECT observed_hour AS hour, count(*) AS n FROM seen GROUP BY 1) a
            FULL JOIN (SELECT observed_hour AS hour, count(*) AS n FROM gridded GROUP BY 1) b ON a.hour = b.hour
            WHERE a.n IS DISTINCT FROM b.n""",
        ),
        "built_marts": _with(
            *_TO_HOURLY,
            DAILY,
            *_TO_HEALTH,
            select="""SELECT 'hourly' AS table_name, count(*) AS row_count,
                CAST(sum(observation_count) AS BIGINT) AS total FROM hourly
            UNION ALL SELECT 'daily', count(*), CAST(sum(observation_count) AS BIGINT) FROM daily
            UNION ALL SELECT 'health', count(*), CAST(sum(run_count) AS BIGINT) FROM health""",
        ),
        "daily_refresh": _with(*_TO_GRID, DAILY, select="SELECT * FROM daily"),
        "protected_marts": _with(
            *_TO_HOURLY,
            DAILY,
            """marked AS (SELECT *, CAST(activity_hour AS DATE) AS day, distinct_aircraft < 3 AS small,
                    bool_or(distinct_aircraft < 3) OVER (PARTITION BY CAST(activity_hour AS DATE), altitude_band) AS any_small,
                    row_number() OVER (PARTITION BY CAST(activity_hour AS DATE), altitude_band, distinct_aircraft < 3
                        ORDER BY observation_count, activity_hour, grid_lat, grid_lon) AS place
                FROM hourly)""",
            """cells AS (SELECT day, altitude_band, count(*) AS published_cells,
                    CAST(sum(observation_count) AS BIGINT) AS published_observations
                FROM marked WHERE NOT small AND NOT (any_small AND place = 1) GROUP BY 1, 2)""",
            select="""SELECT activity_date, altitude_band, observation_count, distinct_aircraft,
                coalesce(published_cells, 0) AS published_cells,
                coalesce(published_observations, 0) AS published_observations
            FROM daily LEFT JOIN cells USING (altitude_band) WHERE day IS NOT DISTINCT FROM activity_date
                AND distinct_aircraft >= 3
            UNION ALL
            SELECT activity_date, altitude_band, observation_count, distinct_aircraft, 0, 0
            FROM daily WHERE distinct_aircraft >= 3
                AND NOT EXISTS (SELECT 1 FROM cells WHERE day = activity_date AND cells.altitude_band = daily.altitude_band)""",
        ),
        "payload_files": _with(
            STATES,
            select="""SELECT payload_status, count(*) AS payload_count, count(*) AS file_count
            FROM payloads GROUP BY payload_status""",
        ),
        "failed_load": _with(
            STATES,
            select="""SELECT 'failed' AS status, 'OSError: no space left' AS error_message, count(*) AS run_count,
                0 AS counted_runs, 0 AS landed_rows FROM payloads""",
        ),
        "landed_provenance": _with(
            STATES,
            select="""SELECT api_snapshot_time, TIMESTAMP '2024-02-02 00:00:00' AS ingested_at, count(*) AS row_count,
                1 AS loads, CAST(count(*) AS DOUBLE) AS rows_inserted
            FROM firsts GROUP BY k, api_snapshot_time""",
        ),
        "json_rows": _with(
            *_TO_HOURLY,
            TOTALS,
            select=f"""SELECT *, '2024-01-31T00:00:00' AS generated_at, 48 AS window_hours FROM totals
            WHERE activity_hour >= {NOW} - INTERVAL 48 HOUR""",
        ),
        "windowed_reads": _with(
            *_TO_HOURLY,
            TOTALS,
            select=f"""SELECT window_hours, activity_hour, observation_count
            FROM totals JOIN (VALUES (1), (24), (100)) AS w(window_hours)
                ON activity_hour >= {NOW} - to_hours(window_hours)""",
        ),
        "fine_cells": _with(
            *_TO_GRID,
            select="""SELECT floor(latitude / 0.25e0) * 0.25e0 AS grid_lat, floor(longitude / 0.25e0) * 0.25e0 AS grid_lon,
                count(*) AS row_count FROM gridded GROUP BY 1, 2""",
        ),
        "freshness_classes": _with(
            *_TO_HOURLY,
            """newest AS (SELECT max(last_ingested_at) AS last_ingested_at, max(activity_hour) AS latest_activity_hour
                FROM hourly)""",
            select="""SELECT minutes, last_ingested_at, latest_activity_hour, minutes * 60e0 AS age_seconds, freshness_class
            FROM newest, (VALUES (5, 'ok'), (30, 'warn'), (1440, 'bad')) AS w(minutes, freshness_class)
            UNION ALL SELECT 0, NULL, NULL, NULL, NULL""",
        ),
        "not_built": _with(
            *_TO_HOURLY,
            DAILY,
            *_TO_HEALTH,
            select="""SELECT false AS built, unnest(['hourly', 'daily', 'health']) AS table_name, -1 AS row_count
            UNION ALL SELECT true, 'hourly', count(*) FROM hourly
            UNION ALL SELECT true, 'daily', count(*) FROM daily
            UNION ALL SELECT true, 'health', count(*) FROM health""",
        ),
        "quarantined_rows": _with(
            FAULTY_OBS,
            """judged AS (SELECT *, CASE WHEN icao24 IS NULL THEN 'icao24_missing'
                    WHEN on_ground IS NULL THEN 'on_ground_missing'
                    WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude_range'
                    WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude_range'
                    WHEN NOT (true_track_deg >= 0 AND true_track_deg < 360) THEN 'true_track_range'
                    WHEN icao24 <> lower(icao24) OR length(icao24) NOT BETWEEN 1 AND 12 THEN 'icao24_form'
                END AS reason FROM obs)""",
            select="""SELECT reason, CAST(CASE WHEN reason IS NULL THEN observed_at ELSE ingested_at END AS DATE) AS day,
                count(*) AS row_count, count(DISTINCT ingestion_run_id) AS run_count
            FROM judged GROUP BY 1, 2""",
        ),
        "run_reject_reasons": _with(
            STATES,
            select="""SELECT api_snapshot_time, reason, count(*) AS row_count FROM states
            WHERE reason IS NOT NULL GROUP BY k, api_snapshot_time, reason""",
        ),
        "stored_identity_guard": """SELECT * FROM (VALUES ('airspace_activity_hourly', 16, 0),
            ('airspace_activity_daily', 11, 0), ('ingestion_health', 16, 0))
            AS t(table_name, column_count, identity_columns)""",
        "stored_freshness": _with(
            OBS,
            select="""SELECT *, CASE WHEN age_seconds > 21600 THEN 'error' WHEN age_seconds > 1800 THEN 'warn'
                ELSE 'pass' END AS status
            FROM (SELECT max(ingested_at) AS last_ingested_at,
                (epoch_us(TIMESTAMP '2024-01-31 08:00:00') - epoch_us(max(ingested_at))) / 1e6 AS age_seconds
                FROM obs)""",
        ),
        "compacted_ledger": _with(
            RUNS,
            select="""SELECT run_id, status, started_at, finished_at, rows_received, rows_inserted, error_message
            FROM runs""",
        ),
        "compacted_landing": _with(
            OBS,
            f"""loads AS (SELECT CAST(observed_at AS DATE) AS observed_date, count(*) AS row_count,
                    count(DISTINCT CAST(ingestion_run_id AS BIGINT) % 5) AS loads FROM obs GROUP BY 1)""",
            select=f"""SELECT observed_date, row_count, loads,
                CASE WHEN observed_date < {LANDED_UNTIL} THEN 1 ELSE loads END AS folders FROM loads""",
        ),
        "stream_two_writers": _two_feeds(),
        "stream_land": _with(
            STATES,
            select="""SELECT api_snapshot_time,
                CASE WHEN payload_status = 'ok' THEN 'succeeded' ELSE 'failed' END AS status,
                CASE payload_status WHEN 'not_json' THEN 'payload is not JSON'
                    WHEN 'not_object' THEN 'payload is not a JSON object'
                    WHEN 'time_unusable' THEN 'payload has no usable ''time'''
                    WHEN 'states_not_list' THEN 'payload ''states'' is not a list' END AS error_message,
                CASE WHEN payload_status = 'ok' THEN CAST(rows_received AS INTEGER) END AS rows_received,
                CASE WHEN payload_status = 'ok' THEN CAST(rows_rejected AS INTEGER) END AS rows_rejected,
                CASE WHEN payload_status = 'ok' THEN CAST(rows_inserted AS INTEGER) END AS rows_inserted,
                CASE WHEN payload_status = 'ok' THEN CAST(rows_duplicate AS INTEGER) END AS rows_duplicate
            FROM accounting""",
        ),
        "stream_two_feeds": _two_feeds(),
        "stream_hourly": _with(*_TO_HOURLY, select="SELECT * FROM hourly"),
        "stream_health": _with(*_TO_HEALTH, select="SELECT * FROM health"),
        "stream_dedup": _with(REPORTS, select=KEPT_PER_HOUR),
    }
