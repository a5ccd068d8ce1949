import datetime as dt
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from skytally.session import configure  # noqa: E402

EPOCH = 1757500000
AS_OF = dt.datetime.fromtimestamp(EPOCH + 60, tz=dt.timezone.utc)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("skytally-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def three_rows(epoch=EPOCH):
    """Two positioned aircraft and one that reports no position."""
    return [
        ["e5a001", "KITE7   ", "Ruritania", epoch - 7, epoch - 3, 1.25, 50.75, 9300.0, False,
         201.0, 64.0, 1.5, None, 9410.0, "3311", False, 0, 1],
        ["e5a002", "HERON42 ", "Freedonia", epoch - 13, epoch - 4, -4.5, 56.125, 1500.5, False,
         96.5, 310.0, -3.25, None, 1555.0, "3312", False, 0, 1],
        ["e5a003", None, "Sylvania", None, epoch - 40, None, None, None, True,
         None, None, None, None, None, None, False, 0, 0],
    ]


def airborne(icao24, epoch, lat, lon, track, velocity=150.0):
    return [icao24, "SWIFT9  ", "Freedonia", epoch - 6, epoch, lon, lat, 8000.0, False,
            velocity, track, 0.5, None, 8120.0, "3313", False, 0, 1]


def payload_text(states, time=EPOCH):
    return json.dumps({"time": time, "states": states})


@pytest.fixture
def payloads(spark):
    def make(*texts, prefix="snapshot"):
        rows = [(t, f"{prefix}-{i}") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "payload string, source_file string")

    return make


@pytest.fixture
def lake(spark, tmp_path):
    from skytally.sources.tables import Lake

    return Lake(spark, str(tmp_path / "raw"))


@pytest.fixture
def marts(spark, tmp_path):
    from skytally.sources.tables import Marts

    return Marts(spark, str(tmp_path / "marts"))


def normal(rows):
    return sorted((tuple(r) for r in rows), key=repr)
