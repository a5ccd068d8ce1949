"""Snapshot payloads: where they are read from and what a usable one looks like.

A payload is one JSON object ``{"time": epoch, "states": [[...], ...] | null}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.schemas import PAYLOADS

# What went wrong with a whole payload; stored as the failed run's message.
PAYLOAD_ERRORS = {
    "not_json": "payload is not JSON",
    "not_object": "payload is not a JSON object",
    "time_unusable": "payload has no usable 'time'",
    "time_out_of_range": "payload 'time' is outside years 1 to 9999",
    "states_not_list": "payload 'states' is not a list",
}

# Seconds of 0001-01-01 and of 10000-01-01; fixed values.
FIRST_SECOND = -62135596800
END_SECOND = 253402300800

# JSON as commonly emitted may hold these bare words, which are not JSON.
NON_FINITE_WORDS = r"(?<=[\[,:\s])(?:NaN|-?Infinity)(?=[\],}\s])"


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(payload, source_file)``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file")
    )


def read_payload_archive(spark: SparkSession, path: str) -> DataFrame:
    """Payloads already gathered into Parquet, which avoids millions of tiny files."""
    return spark.read.schema(PAYLOADS).parquet(path)


def is_number(kind: Column) -> Column:
    """True for a JSON number (BIGINT, DECIMAL or DOUBLE), not for booleans or numeric strings."""
    return (kind == "BIGINT") | kind.startswith("D")


def kind_of(value: Column) -> Column:
    """The JSON type of a variant; null when the element is absent."""
    return F.schema_of_variant(value)


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def in_calendar(seconds: Column) -> Column:
    """False also for the infinities."""
    return (seconds >= F.lit(FIRST_SECOND)) & (seconds < F.lit(END_SECOND))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a timestamp; half microseconds go to the even neighbour."""
    whole = F.floor(seconds)
    micros = whole * F.lit(1000000) + F.rint((seconds - whole) * F.lit(1e6)).cast("bigint")
    return F.when(in_calendar(seconds), F.timestamp_micros(micros))


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value; reads it token by token, so of any size."""
    return F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1


def open_payloads(payloads: DataFrame, by_rows: bool = False) -> DataFrame:
    """Judge each payload as a whole.

    A payload that does not fit a variant (16 MiB) is read row by row: every
    element of ``states`` becomes a variant of its own, with the same outcome.
    ``by_rows`` reads all of them that way.

    Adds ``payload_status`` ('ok' or a key of PAYLOAD_ERRORS), ``api_snapshot_time``
    and ``states`` (array of variants, empty unless the status is 'ok'), and drops
    the text. Whether ``states`` is a list is settled by the cast that is needed
    anyway: asking for the type of the whole list would merge the types of all rows.
    """
    repaired = F.regexp_replace("payload", NON_FINITE_WORDS, "1e400")
    plain, mended = is_json(F.col("payload")), is_json(repaired)
    whole = F.when(plain, F.try_parse_json("payload")).when(mended, F.try_parse_json(repaired))
    parsed = payloads.withColumn("_json", F.lit(None).cast("variant") if by_rows else whole)
    # Only what could not be parsed as a whole is looked at again. A row holds a
    # large text once: no step carries on what a later one does not need.
    large = F.when(plain, F.col("payload")).when(mended, repaired)
    kept = [c for c in payloads.columns if c != "payload"]
    texts = parsed.select(
        *kept,
        "_json",
        F.startswith(F.ltrim(F.col("payload"), F.lit(" \t\r\n")), F.lit("{")).alias("_object"),
        F.when(F.col("_json").isNull(), large).alias("_text"),
    )

    def field(kind: str, name: str) -> Column:
        return F.from_json("_text", f"{name} {kind}")[name]

    inner = F.try_variant_get("_json", "$.states", "variant")
    parts = texts.select(
        *kept,
        "_object",
        (F.col("_json").isNotNull() | F.col("_text").isNotNull()).alias("_sound"),
        # A value that is there but too large for a variant is not empty.
        F.coalesce(F.array_contains(F.json_object_keys("_text"), "states"), F.lit(False)).alias("_there"),
        F.coalesce(F.try_variant_get("_json", "$.time", "variant"), field("variant", "time")).alias("_time"),
        F.coalesce(inner, field("variant", "states")).alias("_states"),
        F.coalesce(inner.try_cast("array<variant>"), field("array<variant>", "states")).alias("_list"),
    ).select(
        "*",
        kind_of(F.col("_time")).alias("_time_kind"),
        as_double(F.col("_time")).alias("_seconds"),
    )
    # Anything empty counts as "no rows": null, false, zero, "" and {}.
    kind = kind_of(F.col("_states"))
    empty = (
        F.col("_states").isNull()
        | (kind == "VOID")
        | F.coalesce(kind.isin("BOOLEAN") & ~F.try_variant_get("_states", "$", "boolean"), F.lit(False))
        | F.coalesce(is_number(kind) & (as_double(F.col("_states")) == 0), F.lit(False))
        | F.coalesce((kind == "STRING") & (F.try_variant_get("_states", "$", "string") == ""), F.lit(False))
        | (kind == "OBJECT<>")
    )
    empty = empty & ~(F.col("_states").isNull() & F.col("_there"))
    status = (
        F.when(~F.col("_sound"), "not_json")
        .when(~F.col("_object"), "not_object")
        .when(F.col("_time").isNull() | ~is_number(F.col("_time_kind")), "time_unusable")
        .when(~in_calendar(F.col("_seconds")), "time_out_of_range")
        .when(F.col("_list").isNull() & ~empty, "states_not_list")
        .otherwise("ok")
    )
    return parts.select(
        *kept,
        status.alias("payload_status"),
        epoch_to_timestamp(F.when(is_number(F.col("_time_kind")), F.col("_seconds"))).alias("_snapshot"),
        "_list",
    ).select(
        *kept,
        "payload_status",
        F.when(F.col("payload_status") == "ok", F.col("_snapshot")).alias("api_snapshot_time"),
        F.when(F.col("payload_status") == "ok", F.col("_list")).alias("states"),
    )
