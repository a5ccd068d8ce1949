"""Continuous landing: each micro-batch of payloads is one load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.operators.landing import land_snapshots
from skytally.plans.marts import LATE_ARRIVAL_LOOKBACK_HOURS, refresh_health, refresh_hourly
from skytally.schemas import PAYLOADS
from skytally.settings import Feed
from skytally.sources.tables import Lake, Marts


def stream_payload_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file")
    )


def stream_payload_archive(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAYLOADS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id by which a checkpoint knows its query; batch ids start anew with each."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def load_name(spark: SparkSession, name: str, checkpoint: str, batch_id: int) -> str:
    """Unique to a micro-batch."""
    return f"{name}-{query_id(spark, checkpoint)}-{batch_id:012d}"


def land_stream(
    payloads: DataFrame,
    lake: Lake,
    checkpoint: str,
    *,
    name: str = "snapshots",
    feed: Feed | None = None,
    as_of: dt.datetime | None = None,
    marts: Marts | None = None,
    lookback_hours: int = LATE_ARRIVAL_LOOKBACK_HOURS,
) -> StreamingQuery:
    """Land what has arrived and stop; with ``marts``, rebuild the affected hours too.

    The load is named after the query, as its checkpoint knows it, and the
    micro-batch. A batch replayed after a crash therefore replaces its first
    attempt, and rebuilding whole hours is repeatable, so nothing is counted
    twice. Without its checkpoint the stream is another query: what it reads
    again is counted as duplicates.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        now = as_of or dt.datetime.now(dt.timezone.utc)
        land_snapshots(batch, lake, load_name(lake.spark, name, checkpoint, batch_id), now, feed)
        if marts is not None:
            refresh_hourly(lake, marts, lookback_hours=lookback_hours)
            refresh_health(lake, marts)

    return (
        payloads.writeStream.queryName(name)
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
