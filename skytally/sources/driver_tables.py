"""Observations, runs and payloads derived from the general-purpose test tables.

Those tables hold no air traffic. Each value below is a fixed function of a row,
so the same table can be derived in plain SQL for comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from skytally.schemas import INGESTION_RUNS, STATE_VECTORS, conform
from skytally.session import configure

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
ORDERS = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_orderpriority", StringType()),
    ]
)

OUTCOME_COLUMNS = (
    "finished_at", "http_status", "api_snapshot_time", "rows_received", "rows_rejected",
    "rows_inserted", "rows_duplicate", "error_message",
)

JANUARY_MICROS = 1704067200000000  # 2024-01-01


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")


def _plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(moment) + seconds * F.lit(1000000))


def _id(factor: int, modulus: int) -> Column:
    return (F.col("event_id") * factor) % modulus


def _latitude() -> Column:
    return F.lit(49) + _id(37, 1200) / F.lit(100)


def _longitude() -> Column:
    return F.lit(-10) + _id(53, 1300) / F.lit(100)


def to_observations(events: DataFrame, *carried: str) -> DataFrame:
    """Events as landed observations, followed by any ``carried`` event columns."""
    located = F.col("event_id") % 17 != 0
    observed = F.col("ts").cast("timestamp")
    altitude = F.when(F.col("event_id") % 11 != 0, _id(97, 13000).cast("double"))
    values = {
        "icao24": F.format_string("%06x", "user_id"),
        "observed_at": observed,
        "time_position": F.when(located, observed),
        "last_contact": observed,
        "callsign": F.concat(F.lit("C"), _id(1, 1000)),
        "origin_country": F.lit(None),
        "longitude": F.when(located, _longitude()),
        "latitude": F.when(located, _latitude()),
        "baro_altitude_m": altitude,
        "geo_altitude_m": altitude + 100,
        "on_ground": F.col("event_id") % 13 == 0,
        "velocity_ms": F.col("value") + 50,
        "true_track_deg": F.when(F.col("event_id") % 19 != 0, _id(29, 360)),
        "vertical_rate_ms": _id(1, 41) - 20,
        "squawk": F.lit(None),
        "spi": F.lit(False),
        "position_source": _id(1, 4),
        "category": _id(1, 20),
        "ingestion_run_id": _id(1, 500),
        "api_snapshot_time": _plus_seconds(observed, _id(1, 60)),
        "ingested_at": _plus_seconds(observed, _id(7919, 28800)),
    }
    typed = [values[f.name].cast(f.dataType).alias(f.name) for f in STATE_VECTORS]
    return events.select(*typed, *carried)


def to_reports(events: DataFrame) -> DataFrame:
    """Each observation reported one to three times, not in the order of ``pos``."""
    repeated = events.select("*", F.explode(F.sequence(F.lit(0), F.col("event_id") % 3)).alias("pos"))
    delay = ((F.col("pos") * 7 + F.col("event_id")) % 5) * 120
    rows = to_observations(repeated, "event_id", "pos")
    return rows.withColumns(
        {
            "velocity_ms": F.col("velocity_ms") + F.col("pos"),
            "api_snapshot_time": _plus_seconds(F.col("observed_at"), delay),
        }
    ).drop("event_id")


def _replaced(column: str, code: Column, **replacements) -> Column:
    value = F.col(column)
    chain = None
    for name, replacement in replacements.items():
        hit = code == int(name.lstrip("c"))
        chain = F.when(hit, replacement) if chain is None else chain.when(hit, replacement)
    return chain.otherwise(value)


def to_faulty_observations(events: DataFrame) -> DataFrame:
    """Observations with values no writer should let through, and some rows twice."""
    code = F.col("event_id") % 101
    text = F.lit(None).cast("string")
    rows = to_observations(events, "event_id").withColumns(
        {
            "latitude": _replaced("latitude", code, c1=95.0),
            "longitude": _replaced("longitude", code, c2=-200.0),
            "true_track_deg": _replaced("true_track_deg", code, c3=360.0, c4=-1.0),
            "icao24": _replaced("icao24", code, c5=text, c6="ABCDEF", c7="0123456789abc"),
            "ingestion_run_id": _replaced("ingestion_run_id", code, c8="-1"),
            "on_ground": _replaced("on_ground", code, c9=F.lit(None).cast("boolean")),
        }
    )
    copies = F.sequence(F.lit(1), F.when(code % 10 == 0, 2).otherwise(1))
    return rows.select("*", F.explode(copies).alias("_copy")).drop("event_id", "_copy")


def to_runs(orders: DataFrame) -> DataFrame:
    """Orders as ingestion runs."""
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "failed")
        .when(F.col("o_orderstatus") == "P", "succeeded")
        .otherwise("running")
    )
    succeeded = F.col("o_orderstatus") == "P"
    started = F.timestamp_micros(F.lit(JANUARY_MICROS) + (k % 43200) * F.lit(60000000))
    box = F.struct(
        F.lit(49.0).alias("lamin"),
        (F.lit(50) + k % 12).cast("double").alias("lamax"),
        F.lit(-10.0).alias("lomin"),
        (F.lit(-9) + (k % 5) * 10).cast("double").alias("lomax"),
    )
    rows = orders.select(
        k.alias("run_id"),
        F.lit("public_adsb").alias("source"),
        F.lit("/states/all").alias("source_endpoint"),
        box.alias("request_bbox"),
        F.when(k % 3 == 0, "anonymous").otherwise("oauth2_client_credentials").alias("auth_mode"),
        (F.lit(1) + k % 4).alias("credits_estimated"),
        started.alias("started_at"),
        F.when(status != "running", _plus_seconds(started, k % 90)).alias("finished_at"),
        status.alias("status"),
        F.when(succeeded, 200).alias("http_status"),
        F.when(succeeded, _plus_seconds(started, -(k % 45))).alias("api_snapshot_time"),
        F.when(succeeded, F.lit(100) + k % 700).alias("rows_received"),
        F.when(succeeded, k % 7).alias("rows_rejected"),
        F.when(succeeded, F.lit(90) + k % 600).alias("rows_inserted"),
        F.when(succeeded, k % 50).alias("rows_duplicate"),
        F.when(F.col("o_orderstatus") == "F", "source unavailable").alias("error_message"),
    )
    return conform(rows, INGESTION_RUNS)


def to_faulty_runs(orders: DataFrame) -> DataFrame:
    """Runs that break the ledger's rules, and some run ids twice."""
    code = F.col("run_id").cast("bigint") % 103
    rows = to_runs(orders).withColumns(
        {
            "status": _replaced("status", code, c1="paused"),
            "auth_mode": _replaced("auth_mode", code, c2="basic"),
            "finished_at": _replaced("finished_at", code, c3=F.lit(None).cast("timestamp")),
            "credits_estimated": _replaced("credits_estimated", code, c4=7),
            "rows_received": _replaced("rows_received", code, c5=-1),
        }
    )
    copies = F.sequence(F.lit(1), F.when(code == 6, 2).otherwise(1))
    return rows.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def to_ledger_events(orders: DataFrame) -> DataFrame:
    """The two ledger events of every run; a running one has only the first."""
    runs = to_runs(orders)
    outcome = [f for f in INGESTION_RUNS if f.name in OUTCOME_COLUMNS]
    opened = runs.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in outcome} | {"status": F.lit("running")}
    ).withColumn("event_seq", F.lit(0))
    closed = runs.where(F.col("status") != "running").withColumn("event_seq", F.lit(1))
    return opened.unionByName(closed)


# --- payloads -----------------------------------------------------------------

EVENTS_PER_PAYLOAD = 100

# What is wrong with the states of an event, by event_id % 97:
# (place in the array, JSON put there). None replaces the whole state.
STATE_FAULTS = {
    1: ((0, "null"),),
    2: ((0, '"   "'),),
    3: ((4, "null"),),
    4: ((4, "100"),),
    5: ((4, "1e400"),),
    6: ((3, '"soon"'),),
    7: ((8, '"no"'),),
    8: ((5, "true"),),
    9: ((5, "-181.0"),),
    10: ((6, "91.0"),),
    11: ((6, "1e400"),),
    12: ((10, "361.0"),),
    13: ((10, "360"),),
    14: ((9, "1e400"),),
    15: ((1, "7"),),
    16: ((14, "2000"),),
    17: ((7, '"high"'),),
    18: ((13, "false"),),
    19: ((11, "[]"),),
    20: ((16, '"radar"'),),
    21: ((17, "40000"),),
    22: ((None, "null"),),
    23: ((None, "[]"),),
    24: ((None, '"state"'),),
    25: ((0, '"0123456789abc"'),),
    26: ((17, None),),
    27: ((15, '"false"'),),
    28: ((16, "1.9"),),
    29: ((6, "91.0"), (8, '"no"')),
    30: ((2, "{}"),),
    31: ((4, "4102444800"),),
}


# The tests of a state that the faults above leave out, by event_id % 41; where
# two are given, the first reason counts.
OTHER_FAULTS = {
    1: ((3, "1e400"),),
    2: ((3, "100"),),
    3: ((5, "1e400"),),
    4: ((6, '"north"'),),
    5: ((10, '"east"'),),
    6: ((10, "1e400"),),
    7: ((7, "1e400"),),
    8: ((13, "1e400"),),
    9: ((9, '"fast"'),),
    10: ((11, "-1e400"),),
    11: ((2, "true"),),
    12: ((16, "1e400"),),
    13: ((16, "40000"),),
    14: ((17, '"heavy"'),),
    15: ((17, "1e400"),),
    16: ((1, "[]"),),
    17: ((14, "{}"),),
    18: ((17, "1e400"), (3, "100")),
    19: ((16, "40000"), (9, '"fast"')),
}


def _json_elements() -> list[Column]:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))

    def epoch(value: Column) -> Column:
        return F.concat(
            F.floor(value / 1000000).cast("string"),
            F.lit("."),
            F.lpad((value % 1000000).cast("string"), 6, "0"),
        )

    def number(value: Column) -> Column:
        return value.cast("string")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('  "'))

    located = F.col("event_id") % 17 != 0
    altitude = F.when(F.col("event_id") % 11 != 0, _id(97, 13000))
    elements = [
        quoted(F.upper(F.format_string("%06x", "user_id"))),
        quoted(F.concat(F.lit("C"), _id(1, 1000))),
        F.when(F.col("event_id") % 7 != 0, F.lit('"Somewhere"')),
        F.when(located, epoch(micros)),
        epoch(micros + 1000000),
        F.when(located, number(_longitude())),
        F.when(located, number(_latitude())),
        number(altitude),
        number(F.col("event_id") % 13 == 0),
        number(F.col("value") + 50),
        F.when(F.col("event_id") % 19 != 0, number(_id(29, 360))),
        number(_id(1, 41) - 20),
        F.lit("null"),
        number(altitude + 100),
        F.lit('"1200"'),
        F.lit("false"),
        number(_id(1, 4)),
        number(_id(1, 20)),
    ]
    return [F.coalesce(e, F.lit("null")) for e in elements]


def _state_text(faults: dict = STATE_FAULTS, modulus: int = 97) -> Column:
    code = (F.col("event_id") % modulus).cast("int")
    elements = _json_elements()
    replacements: dict[int | None, dict[int, str]] = {}
    for fault, changes in faults.items():
        for place, json in changes:
            replacements.setdefault(place, {})[fault] = json

    def replacement(place: int | None) -> Column:
        pairs = replacements[place].items()
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), code)

    short = F.lit(False)
    for place in range(len(elements)):
        if place in replacements:
            dropped = [f for f, json in replacements[place].items() if json is None]
            replacements[place] = {f: json for f, json in replacements[place].items() if json is not None}
            short = short | code.isin(dropped) if dropped else short
            elements[place] = F.coalesce(replacement(place), elements[place])
    last = F.when(~short, elements[-1])
    array = F.concat(F.lit("["), F.concat_ws(",", *elements[:-1], last), F.lit("]"))
    return F.coalesce(replacement(None), array) if None in replacements else array


def to_states(events: DataFrame) -> DataFrame:
    """``(event_id, state)``: a state of every event, with the faults that snapshots do not have."""
    return events.select("event_id", F.parse_json(_state_text(OTHER_FAULTS, 41)).alias("state"))


def to_payloads(events: DataFrame) -> DataFrame:
    """Snapshots of 100 events each: ``(payload, source_file)``.

    A state stands in its snapshot up to three times, and once more in the next
    one. Some snapshots are unusable as a whole, by number % 29.
    """
    block = F.expr(f"event_id div {EVENTS_PER_PAYLOAD}")
    places = F.array(
        F.struct(block.alias("k"), F.lit(0).alias("part")), F.struct((block + 1).alias("k"), F.lit(1).alias("part"))
    )
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000)
    # The narrow rows are shuffled, the texts written where they are put together.
    placed = events.select("event_id", "ts", "user_id", "value", F.inline(places)).repartition("k")
    repeats = F.when(F.col("part") == 0, F.col("event_id") % 3).otherwise(0)
    states = placed.select("k", "part", "event_id", _state_text().alias("state"), seconds.alias("second")).select(
        "*", F.explode(F.sequence(F.lit(0), repeats)).alias("copy")
    )
    # A snapshot holds 400 states at most, so the list is bounded. No element is null,
    # and sort_array compares natively where array_sort interprets a function.
    snapshots = states.groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct("part", "copy", "event_id", "state"))).alias("rows"),
        (F.max("second") + 10).cast("string").alias("time"),
    )
    listed = F.concat(F.lit("["), F.array_join(F.col("rows.state"), ","), F.lit("]"))

    def payload(time: Column, states: Column) -> Column:
        return F.concat(F.lit('{"time": '), time, F.lit(', "states": '), states, F.lit("}"))

    kind = F.col("k") % 29
    text = (
        F.when(kind == 1, F.concat(F.lit('{"states": '), listed, F.lit("}")))
        .when(kind == 2, payload(F.lit('"soon"'), listed))
        .when(kind == 3, listed)
        .when(kind == 4, payload(F.col("time"), F.lit('"none"')))
        .when(kind == 5, payload(F.col("time"), F.lit("null")))
        .when(kind == 6, F.concat(F.lit('{"time": '), F.col("time")))
        .otherwise(payload(F.col("time"), listed))
    )
    return snapshots.select(text.alias("payload"), F.format_string("snapshot-%012d", "k").alias("source_file"))
