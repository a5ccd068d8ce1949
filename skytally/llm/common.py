"""Small helpers that several operators share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import skytally
from skytally.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(column) == F.octet_length(column), F.lower(column)).otherwise(
        F.translate(column, UPPER, LOWER)
    )


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id's text, modulo ``by``: the folds of the queries. Null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % by


def kept_table(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, never the work above.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


#: Folders of the ``scratch`` blocks that are open, innermost last.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Deletes what ``kept_table`` wrote within the block, but for tables given to what it yields.

    Results that are still to be computed must not depend on the rest.
    """
    spared: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        spared.add(df.kept_at)
        return df

    _SCRATCH.append([])
    try:
        yield keep
    finally:
        folders = _SCRATCH.pop()
        for folder in folders:
            if folder in spared:
                if _SCRATCH:
                    _SCRATCH[-1].append(folder)
                continue
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Longer keys are computed each time they are asked for, so that a memory is bounded in bytes too.
MEMO_KEY = 256


class Memo(dict):
    """A dictionary that computes what it lacks.

    It holds two generations of at most ``most`` entries: when the younger one
    is full it becomes the older one, and what is asked for again moves up.
    """

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def __missing__(self, key):
        if isinstance(key, (str, bytes)) and len(key) > MEMO_KEY:
            return self.compute(key)
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def recalled(self, key):
        """An older entry, which moves up; null if there is none."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        """Enter a value that was computed elsewhere, unless its key is too long."""
        if len(key) > MEMO_KEY:
            return
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[key] = value


def sized_broadcast(small: DataFrame, rows: int) -> DataFrame:
    """``small`` with a broadcast hint if it was counted to have at most ``rows`` rows.

    Beyond that the join is left to Spark, which shuffles both sides.
    """
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def words_of(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8.

    ``bytes`` methods know ASCII only, which is what the definition asks for.
    """
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


_SHIPPED: set[str] = set()
#: In a worker: whose tasks it ran last, and what they left for the next of them.
_LASTING: dict[str, object] = {}


def lasting(made: Callable):
    """What ``made()`` gives, once for each worker and ``arrow_map``, so that a worker's tasks share it."""
    if "made" not in _LASTING:
        _LASTING["made"] = made()
    return _LASTING["made"]


def _turn_to(owner: str) -> None:
    if _LASTING.get("owner") != owner:
        left = _LASTING.pop("made", None) is not None
        _LASTING["owner"] = owner
        if left:  # memories refer to what fills them, so they go only when cycles are looked for
            gc.collect()


#: Of rows that go to a worker at a time. Spark's own bound is 64 MiB, and executor and worker hold a batch several
#: times over (vectors, the buffer they are sent from, the received copy).
BATCH_BYTES = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def arrow_map(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package sent along, so that executors need not have it installed.

    A worker that turns to another call of this forgets what ``lasting`` kept for the one before. Rows come in batches of
    ``BATCH_BYTES``, unless the session has a bound of its own.
    """
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:  # read when the rows are computed, so it stays
        df.sparkSession.conf.set(BATCH_SETTING, BATCH_BYTES)
    key = uuid.uuid4().hex

    def run(batches):
        _turn_to(key)
        return function(batches)

    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(skytally.__file__).parent
        folder = tempfile.mkdtemp()  # on the driver, which serves the file as long as it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    return df.mapInArrow(run, schema)


_ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}

#: Rows that a task turns into Python objects at a time.
TASK_ROWS = 256


def map_texts(docs: DataFrame, setup: Callable[[], Callable], columns: dict[str, str], column: str = "text") -> DataFrame:
    """``(doc_id, *columns)``: one row for each row of ``docs``.

    ``setup()`` runs once per task and returns the function that turns a text
    (or null) into the tuple of the columns. The id passes through untouched.
    """
    kinds = [_ARROW[kind] for kind in columns.values()]
    schema = pa.schema([("doc_id", pa.int64()), *zip(columns, kinds)])

    def mapped(batches):
        function = setup()
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                rows = [function(text) for text in part.column(1).to_pylist()]
                made = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], schema=schema)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col(column))
    return arrow_map(chosen, mapped, ", ".join(f"{n} {k}" for n, k in [("doc_id", "long"), *columns.items()]))
