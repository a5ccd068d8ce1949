"""How document filters interact: what each removes in every order, kept right by retractions.

The documents are streamed as available-now micro-batches. Four filters look at
a text alone; the fifth removes a text that a smaller doc_id has too, which a
stream cannot know at once. So the state keeps, for every text, the smallest
doc_id so far. When a smaller one arrives, the counters get a retraction for the
rows that held that place and the same rows again as copies. The sums of all
deltas are then what one look at the whole table would have counted.

State is keyed by a hash bucket of the text's SHA-256 with some hundred texts
each: a call of Python per text costs milliseconds. Before the shuffle every
task folds its rows, so a text that a third of all rows hold reaches its bucket
as a few rows.

Defined cases: a null text is empty, an empty text has no words and equals other
empty ones; a null lang is the part ''; rows that share a doc_id do not remove
each other; a row without a doc_id neither removes nor is removed as a copy and
has no labels; several labels of a document count as the highest; no documents
give no rows. Only the columns named here are read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from skytally.llm.common import TASK_ROWS, arrow_map
from skytally.session import shared_folder

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
UPPER_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")

#: Micro-batches that the present files are read in, and texts that share a state.
BATCHES = 4
TEXTS_PER_STATE = 256
#: Rows that a task folds in memory at a time.
FOLDED_ROWS = 100_000

#: State on disk, kept as change logs, and no room set aside ahead: a store of every partition would take megabytes.
STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.allowFAllocate": "false",
}

COUNTERS = "part string, mask int, good boolean, toxic boolean, delta long"
FOLDED = "bucket long, digest string, part string, mask int, good boolean, toxic boolean, n long, known boolean, least long, n_least long"


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # on the six ASCII blanks only
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * (len(raw) - len(raw.translate(None, UPPER_LETTERS))) > MOST_UPPER_PERCENT * len(text),
        len(raw.translate(None, MARKS)) < len(raw),
    )
    return sum(1 << i for i, fails in enumerate(failed) if fails)


def judged(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, mask, digest)`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.string())])

    def mapped(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                rows = batch.slice(start, TASK_ROWS)
                texts = rows.column(2).to_pylist()
                masks = pa.array([text_mask(t) for t in texts], pa.int32())
                digests = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts])
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), masks, digests], schema=schema)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    chosen = docs.select(F.col("doc_id").cast("long"), part.alias("part"), text.alias("text"))
    return arrow_map(chosen, mapped, "doc_id long, part string, mask int, digest string")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    joined = rows.join(marks, "doc_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})


def folded(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of a task summed by text, part and labels: how many, the smallest id, how many have it."""
    columns = ("doc_id", "digest", "part", "mask", "good", "toxic")

    def emptied(held: dict) -> pd.DataFrame:
        made = [
            (int(digest[:15], 16) % buckets, digest, part, mask, good, toxic, n, known, least, n_least)
            for (digest, part, mask, good, toxic, known), (n, least, n_least) in held.items()
        ]
        held.clear()
        return pd.DataFrame(made, columns=[c.split()[0] for c in FOLDED.split(", ")])

    def mapped(batches):
        held: dict = {}
        for batch in batches:
            for doc_id, *key in zip(*(batch.column(c).to_pylist() for c in columns)):
                known = doc_id is not None
                sums = held.setdefault((*key, known), [0, doc_id or 0, 0])
                sums[0] += 1
                if known and doc_id < sums[1]:
                    sums[1:] = doc_id, 0
                if known and doc_id == sums[1]:
                    sums[2] += 1
            if len(held) >= FOLDED_ROWS:
                yield pa.RecordBatch.from_pandas(emptied(held), schema=_FOLDED_ARROW, preserve_index=False)
        if held:
            yield pa.RecordBatch.from_pandas(emptied(held), schema=_FOLDED_ARROW, preserve_index=False)

    return arrow_map(rows.select(*columns), mapped, FOLDED)


_FOLDED_ARROW = pa.schema(
    [
        ("bucket", pa.int64()),
        ("digest", pa.string()),
        ("part", pa.string()),
        ("mask", pa.int32()),
        ("good", pa.bool_()),
        ("toxic", pa.bool_()),
        ("n", pa.int64()),
        ("known", pa.bool_()),
        ("least", pa.int64()),
        ("n_least", pa.int64()),
    ]
)


def _add(holders: list, key: tuple, n: int) -> None:
    for holder in holders:
        if tuple(holder[0]) == key:
            holder[1] += n
            return
    holders.append([key, n])


def updated(state: dict, rows) -> Counter:
    """Fold rows into the texts of one bucket; what the counters change by.

    ``state`` holds for each digest the smallest id and ``[(part, mask, good, toxic), count]``
    of the rows that have it. Whatever the order of the rows, the sum of all changes is the same.
    """
    deltas: Counter = Counter()
    for _, digest, part, mask, good, toxic, n, known, least, n_least in rows:
        key = (part, int(mask), bool(good), bool(toxic))
        copy = (key[0], key[1] | COPY, *key[2:])
        if not known:
            deltas[key] += int(n)
            continue
        least, n, n_least = int(least), int(n), int(n_least)
        held = state.get(digest)
        if held is not None and held[0] < least:
            deltas[copy] += n
            continue
        if held is None or held[0] > least:
            for (p, m, g, t), count in held[1] if held else ():
                deltas[p, m, g, t] -= count
                deltas[p, m | COPY, g, t] += count
            held = state[digest] = [least, []]
        _add(held[1], key, n_least)
        deltas[key] += n_least
        deltas[copy] += n - n_least
    return deltas


def _state_update(key, frames, state):
    texts = json.loads(state.get[0]) if state.exists else {}
    deltas: Counter = Counter()
    for frame in frames:
        deltas.update(updated(texts, frame.itertuples(index=False, name=None)))
    state.update((json.dumps(texts, ensure_ascii=False),))
    rows = [(*key, delta) for key, delta in deltas.items() if delta]
    yield pd.DataFrame(rows, columns=[c.split()[0] for c in COUNTERS.split(", ")])


def counted(
    spark: SparkSession, path: str, labels: DataFrame, folder: str, batches: int = BATCHES, buckets: int | None = None
) -> DataFrame:
    """``(part, mask, good, toxic, n)`` of the documents below ``path``; ``folder`` keeps state and counters.

    Called again with the same folder and ``buckets`` it reads only files that are new.
    """
    stored = spark.read.parquet(path)
    files = len(stored.inputFiles())
    buckets = buckets or max(1, stored.count() // TEXTS_PER_STATE)
    stream = (
        spark.readStream.schema(stored.schema)
        .option("maxFilesPerTrigger", max(1, -(-files // batches)))
        # A path of one file is no folder to the stream; as a pattern it may be either.
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )
    rows = folded(labelled(judged(stream), labels), buckets)
    deltas = rows.groupBy("bucket").applyInPandasWithState(
        _state_update, COUNTERS, "texts string", "append", GroupStateTimeout.NoTimeout
    )
    keys = ["part", "mask", "good", "toxic"]

    def add(batch: DataFrame, batch_id: int) -> None:
        # A batch that is replayed after a crash replaces its own folder.
        sums = batch.groupBy(*keys).agg(F.sum("delta").alias("delta"))
        sums.write.mode("overwrite").parquet(f"{folder}/counters/batch={batch_id}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            deltas.writeStream.foreachBatch(add)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    spark.createDataFrame([], COUNTERS).write.mode("overwrite").parquet(f"{folder}/counters/batch=-1")
    written = spark.read.schema(COUNTERS).option("recursiveFileLookup", True).parquet(f"{folder}/counters")
    return written.groupBy(*keys).agg(F.sum("delta").alias("n")).where("n <> 0")


def _steps() -> Column:
    """Every order and step: its filter's bit, and the bits of the filters before it."""
    steps = []
    for order in itertools.permutations(FILTERS):
        earlier = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "earlier": earlier})
            earlier |= bit
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,earlier:int>>")


def interactions(counters: DataFrame) -> DataFrame:
    """One row per part, order and step, from counts per part, mask and labels."""

    def when(condition: Column, count: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(0))

    per_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), when(F.col("good")).alias("good_n"), when(F.col("toxic")).alias("toxic_n")
    )
    every = per_mask.select("*", F.inline(_steps()))
    mask, bit, earlier = F.col("mask"), F.col("bit"), F.col("earlier")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(earlier) != 0
    removed = fails & ~gone
    # Of all orders of k failing filters, one in k has a given one first.
    orders = len(list(itertools.permutations(FILTERS)))
    first = F.when(fails, F.col("n") * F.expr(f"{orders} div bit_count(mask)")).otherwise(0)
    return every.groupBy("part", "filter_order", "step").agg(
        when(~fails & ~gone).alias("kept"),
        when(removed).alias("removed"),
        when(fails & gone).alias("redundant"),
        when(mask == bit).alias("unique_fails"),
        when(removed, "good_n").alias("good_lost"),
        when(removed, "toxic_n").alias("toxic_lost"),
        F.sum(first).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The interactions of all filters over the documents below ``path``, streamed from the start."""
    return interactions(counted(spark, path, labels, shared_folder(spark, "filter-audit"), batches))
