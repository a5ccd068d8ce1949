"""Positional state vectors to typed rows, or to the reason they are unusable.

One ordered chain of rules names the first one a row breaks. Every rule looks at
the JSON type before it looks at the value, so nothing is coerced on the way:
``true`` is not 1, ``"1.5"`` is not 1.5.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.columns import instant
from skytally.schemas import OBSERVATION_KEY
from skytally.sources.payloads import (
    as_double,
    epoch_to_timestamp,
    in_calendar,
    is_number,
    kind_of,
)

# Place of each field in the array; 12 is never stored. Fixed values.
POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
    "category": 17,
}
MIN_ELEMENTS = 17
MAX_ICAO24_LENGTH = 12
EARLIEST = dt.datetime(2000, 1, 1)
LATEST_SKEW_DAYS = 1

# Characters that count as blank at either end of a text.
BLANKS = "".join(
    chr(c)
    for span in ((9, 13), (28, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                 (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                 (0x3000, 0x3000))
    for c in range(span[0], span[1] + 1)
)


def explode_states(opened: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per element of ``states``; ``pos`` is its place in the payload.

    ``keep_empty`` leaves a row with a null ``pos`` for a payload without states.
    Such rows are removed after the explosion rather than before: Spark would
    test the array ahead of a plain explode, and parse every payload again for it.
    """
    kept = [c for c in opened.columns if c != "states"]
    exploded = opened.select(*kept, F.posexplode_outer("states").alias("pos", "state"))
    return exploded if keep_empty else exploded.where(F.col("pos").isNotNull())


NUMERIC_FIELDS = (
    "time_position", "last_contact", "longitude", "latitude", "baro_altitude", "velocity",
    "true_track", "vertical_rate", "geo_altitude", "position_source", "category",
)
TEXT_FIELDS = ("callsign", "origin_country", "squawk")

# Every test a row can fail, in the order in which they count: the first one
# failed is the reason given. Fixed values.
TESTS = (
    "row_not_array",
    "row_too_short",
    "icao24_missing",
    "icao24_invalid",
    "last_contact_not_numeric",
    "last_contact_out_of_range",
    "last_contact_implausible",
    "time_position_not_numeric",
    "time_position_out_of_range",
    "time_position_implausible",
    "on_ground_not_boolean",
    "longitude_not_numeric",
    "longitude_not_finite",
    "latitude_not_numeric",
    "latitude_not_finite",
    "longitude_out_of_range",
    "latitude_out_of_range",
    "true_track_not_numeric",
    "true_track_not_finite",
    "true_track_out_of_range",
    "callsign_not_string",
    "origin_country_not_string",
    "baro_altitude_not_numeric",
    "baro_altitude_not_finite",
    "geo_altitude_not_numeric",
    "geo_altitude_not_finite",
    "velocity_not_numeric",
    "velocity_not_finite",
    "vertical_rate_not_numeric",
    "vertical_rate_not_finite",
    "squawk_not_string",
    "position_source_not_numeric",
    "position_source_not_finite",
    "position_source_out_of_range",
    "category_not_numeric",
    "category_not_finite",
    "category_out_of_range",
)


def _reason(test: str) -> str:
    """Texts share one reason, whichever field it was."""
    return "text_field_not_string" if test.endswith("_not_string") else test


def _step(df: DataFrame, *columns) -> DataFrame:
    """A projection that is compiled on its own.

    The JVM does not compile a generated method beyond 8000 bytes, and Spark would
    merge all of the validation into one of twice that, which then runs interpreted.
    A generator of one row ends the method. It also keeps later filters above it;
    pushed below, they would repeat the work they depend on.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def _worst(*failed: tuple[Column, str]) -> Column:
    """Place of the first failed test among these; null when none failed."""
    places = [F.when(condition, F.lit(TESTS.index(test))) for condition, test in failed]
    return F.least(*places)


def _present(field: str) -> Column:
    return F.col(f"_k_{field}") != "VOID"


def _kinds(states: DataFrame, kept: list[str]) -> DataFrame:
    """Open the array and name the JSON type of each element; null where it is missing."""
    opened = states.select(*kept, F.expr("try_cast(state AS ARRAY<VARIANT>)").alias("_cells"))
    kinds = [kind_of(F.get("_cells", F.lit(i))).alias(f"_k_{f}") for f, i in POSITIONS.items()]
    return _step(opened, *kept, "_cells", *kinds)


def _cell(field: str) -> Column:
    return F.get("_cells", F.lit(POSITIONS[field]))


def _numbers(kinds: DataFrame, kept: list[str]) -> DataFrame:
    values = kinds.select(
        *kinds.columns,
        *[F.when(is_number(F.col(f"_k_{f}")), as_double(_cell(f))).alias(f"_n_{f}") for f in NUMERIC_FIELDS],
    )
    failed = [(F.col("_n_last_contact").isNull(), "last_contact_not_numeric")]
    for f in NUMERIC_FIELDS:
        number = F.col(f"_n_{f}")
        if f != "last_contact":
            failed.append((number.isNull() & _present(f), f"{f}_not_numeric"))
        if f"{f}_not_finite" in TESTS:
            failed.append((F.abs(number) == F.lit(float("inf")), f"{f}_not_finite"))
    others = [f"_k_{f}" for f in POSITIONS if f not in NUMERIC_FIELDS]
    return _step(values, *kept, "_cells", *others, *[f"_n_{f}" for f in NUMERIC_FIELDS], _worst(*failed).alias("_worst_number"))


def _truthy(field: str) -> Column:
    """Empty values are false, everything else is true; never a reason to reject."""
    raw, kind = _cell(field), F.col(f"_k_{field}")
    return (
        F.when(kind.isNull() | (kind == "VOID"), False)
        .when(kind == "BOOLEAN", F.try_variant_get(raw, "$", "boolean"))
        .when(kind == "STRING", F.try_variant_get(raw, "$", "string") != "")
        .when(is_number(kind), as_double(raw) != 0)
        .otherwise(~kind.isin("ARRAY<VOID>", "OBJECT<>") | F.coalesce(F.size(raw.try_cast("array<variant>")) > 0, F.lit(False)))
    )


def _others(numbers: DataFrame, kept: list[str]) -> DataFrame:
    """Texts, flags and the shape of the row."""

    def text(field: str) -> Column:
        found = F.when(F.col(f"_k_{field}") == "STRING", F.try_variant_get(_cell(field), "$", "string"))
        return F.btrim(found, F.lit(BLANKS))

    values = numbers.select(
        *numbers.columns,
        F.lower(text("icao24")).alias("icao24"),
        *[text(f).alias(f"_t_{f}") for f in TEXT_FIELDS],
    )
    # A missing type equals nothing, so it has to be asked for by itself.
    no_flag = F.col("_k_on_ground").isNull() | (F.col("_k_on_ground") != "BOOLEAN")
    failed = [
        (F.col("_cells").isNull(), "row_not_array"),
        (F.size("_cells") < MIN_ELEMENTS, "row_too_short"),
        (F.col("icao24").isNull() | (F.col("icao24") == ""), "icao24_missing"),
        (F.length("icao24") > MAX_ICAO24_LENGTH, "icao24_invalid"),
        (no_flag, "on_ground_not_boolean"),
        *[(_present(f) & (F.col(f"_k_{f}") != "STRING"), f"{f}_not_string") for f in TEXT_FIELDS],
    ]
    return _step(
        values,
        *kept,
        "icao24",
        *[F.nullif(F.col(f"_t_{f}"), F.lit("")).alias(f) for f in TEXT_FIELDS],
        F.try_variant_get(_cell("on_ground"), "$", "boolean").alias("on_ground"),
        _truthy("spi").alias("spi"),
        *[f"_n_{f}" for f in NUMERIC_FIELDS],
        "_worst_number",
        _worst(*failed).alias("_worst_other"),
    )


def validate(states: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Adds ``reason`` (null when accepted), ``raw`` (rejected rows only) and the typed fields.

    Columns other than ``state`` pass through, so run stamps survive.
    """
    passthrough = [c for c in states.columns if c != "state"]
    kept = [*passthrough, "state"]
    number = {f: F.col(f"_n_{f}") for f in NUMERIC_FIELDS}
    values = _others(_numbers(_kinds(states, kept), kept), kept).withColumns(
        {
            "time_position": epoch_to_timestamp(number["time_position"]),
            "last_contact": epoch_to_timestamp(number["last_contact"]),
            "position_source": number["position_source"].try_cast("smallint"),
            "category": number["category"].try_cast("smallint"),
        }
    )
    latest = instant(as_of) + F.make_dt_interval(days=F.lit(LATEST_SKEW_DAYS))
    failed = []
    for f in ("last_contact", "time_position"):
        failed.append((~in_calendar(number[f]), f"{f}_out_of_range"))
        failed.append((~F.col(f).between(instant(EARLIEST), latest), f"{f}_implausible"))
    for f in ("position_source", "category"):
        failed.append((number[f].isNotNull() & F.col(f).isNull(), f"{f}_out_of_range"))
    track = number["true_track"]
    failed += [
        (F.abs(number["longitude"]) > 180, "longitude_out_of_range"),
        (F.abs(number["latitude"]) > 90, "latitude_out_of_range"),
        ((track < 0) | (track >= 360), "true_track_out_of_range"),
    ]
    names = F.array(*[F.lit(_reason(t)) for t in TESTS])
    reason = F.get(names, F.least("_worst_number", "_worst_other", _worst(*failed)))
    fields = {
        "icao24": F.col("icao24"),
        "observed_at": F.coalesce("time_position", "last_contact"),
        "time_position": F.col("time_position"),
        "last_contact": F.col("last_contact"),
        "callsign": F.col("callsign"),
        "origin_country": F.col("origin_country"),
        "longitude": number["longitude"],
        "latitude": number["latitude"],
        "baro_altitude_m": number["baro_altitude"],
        "geo_altitude_m": number["geo_altitude"],
        "on_ground": F.col("on_ground"),
        "velocity_ms": number["velocity"],
        "true_track_deg": track,
        "vertical_rate_ms": number["vertical_rate"],
        "squawk": F.col("squawk"),
        "spi": F.col("spi"),
        "position_source": F.col("position_source"),
        "category": F.col("category"),
    }
    judged = _step(values, *kept, reason.alias("reason"), *[c.alias(n) for n, c in fields.items()])
    raw = F.when(F.col("reason").isNotNull(), F.to_json("state"))
    return judged.select(*passthrough, "reason", *fields, raw.alias("raw"))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).drop("reason", "raw")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull()).select("reason", "raw")


def reject_counts(validated: DataFrame) -> DataFrame:
    return (
        validated.where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("row_count"))
    )


def dry_run_summary(validated: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """What a load would do, without writing: one row per ``scope`` (all rows by default).

    Everything comes from one pass: rows are counted per key first (rejected ones have
    none), keys per reason next, and the few reasons last.
    """
    accepts = F.col("reason").isNull()
    keys = [F.when(accepts, F.col(c)).alias(f"_{c}") for c in OBSERVATION_KEY]
    per_key = validated.groupBy(*scope, "reason", *keys).agg(F.count("*").alias("_rows"))
    per_reason = per_key.groupBy(*scope, "reason").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_keys"))

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    reasons = F.collect_list(F.when(~accepts, F.struct("reason", "_rows")))
    valid, unique = total("_rows", accepts), total("_keys", accepts)
    return per_reason.groupBy(*scope).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_received"),
        valid.alias("rows_valid"),
        total("_rows", ~accepts).alias("rows_rejected"),
        unique.alias("rows_unique"),
        (valid - unique).alias("rows_duplicate_in_batch"),
        F.map_from_entries(F.array_sort(reasons)).alias("reject_reasons"),
    )
