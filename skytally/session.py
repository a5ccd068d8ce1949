"""Session settings the jobs rely on, and where they keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Buckets are UTC hours and UTC days everywhere.
    "spark.sql.session.timeZone": "UTC",
    # The default INT96 encoding carries no min/max statistics, so a range
    # filter on a timestamp could never skip a row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A repeated key in a payload object takes its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str, memory: str = "20g") -> SparkSession:
    """A session on one machine, for the benchmark and for trying things out."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skytally")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Recording the Python line of every expression takes longer than planning them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared folder, ``spark.checkpoint.dir``.

    Executors on other hosts must see what is written there, so a machine-local
    folder is made up only where the whole session runs on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="skytally-")
    return f"{base.rstrip('/')}/skytally-{purpose}-{uuid.uuid4().hex}"
