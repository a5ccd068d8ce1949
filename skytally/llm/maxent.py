"""Hashed maximum-entropy language model with a class-factored softmax.

    P(word | history) = P(class | history) * P(word | class)

The most frequent words are classes of their own, all others share classes by a
hash of their ending. The class is a log-linear model of hashed features of the
history: the class before (n-gram), the two before together (n-gram, hashed) and
the one two back (skip). Within its class a word has its smoothed share of the
corpus counts.

The gradient needs of the corpus only how often each class follows each pair of
classes, so these counts are gathered from all training texts once, and each
update sums the exact gradient over them in parallel tasks. What goes through
the driver is the weights, the gradients of ``GRADIENT_TASKS`` tasks and the
``HEAD`` most frequent words at most. All other words are looked up by a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import TASK_ROWS, Memo, arrow_map, kept_table, lasting, map_texts, words_of

#: Words whose counts every task holds; the least frequent are left out until there are this many.
HEAD = 1 << 17
OWN, SHARED = 128, 64
CLASSES = OWN + SHARED
PAIRS = 2048
ROWS = 2 * CLASSES + PAIRS
UPDATES, STEP = 24, 0.35
#: Precision of the Gaussian prior on the weights, in counts.
PRIOR = 4.0
GRADIENT_TASKS = 8
MEMO_WORDS = 250_000
FLUSH_WORDS = 200_000
FLUSH_CODES = 4_000_000
#: Stands for the end of a text among the words; no word is empty.
END = b""
SMOOTHING = 0.5


class Model(NamedTuple):
    head: dict[bytes, int]  # word -> place, the most frequent first
    head_counts: np.ndarray
    least_count: int  # every word above this count is in head
    weights: np.ndarray  # ROWS x CLASSES
    bias: np.ndarray
    mass: np.ndarray  # smoothed count of each class
    tokens: int  # N
    words: int  # V
    counts: DataFrame  # token, n

    @property
    def total(self) -> float:
        """The smoothed count of all words."""
        return self.tokens + SMOOTHING * (self.words + 1)


def ending_class(token: bytes) -> int:
    return OWN + zlib.crc32(token[-2:]) % SHARED


def word_counts(texts: DataFrame) -> DataFrame:
    """``(token, n)`` over the words and ends of texts(text); tasks add up before the shuffle."""

    def counted(batches):
        counts: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                for text in batch.column(0).slice(start, TASK_ROWS).to_pylist():
                    counts.update(words_of(text))
                    counts[END] += 1
                if len(counts) > FLUSH_WORDS:
                    yield _pairs(counts)
                    counts.clear()
        if counts:
            yield _pairs(counts)

    def _pairs(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["token", "n"]
        )

    parts = arrow_map(texts.select("text"), counted, "token binary, n long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame, most: int) -> tuple[list, int]:
    """The words above the lowest count that leaves at most ``most`` of them, and that count."""
    octave = F.floor(F.log2("n") * 8).cast("int")
    levels = counts.groupBy(octave.alias("level")).agg(F.count("*").alias("words"), F.max("n").alias("top")).collect()
    above, cutoff = 0, 0
    for level in sorted(levels, reverse=True):
        above += level.words
        if above > most:
            cutoff = level.top
            break
    return counts.where(F.col("n") > cutoff).collect(), cutoff


def _codes(model_head: dict[bytes, int]):
    """Function from the words of a text to their places in head, or ``len(head)`` plus the shared class."""
    size = len(model_head)
    place = Memo(lambda w: model_head[w] if w in model_head else size + ending_class(w) - OWN, MEMO_WORDS)

    def codes(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    return codes


def _classes(head: dict[bytes, int]) -> np.ndarray:
    """Class by code: the first ``OWN`` words of head are their own, all others share by their ending."""
    table = np.concatenate([np.zeros(len(head), np.int64), np.arange(OWN, CLASSES)])
    for token, place in head.items():
        table[place] = place if place < OWN else ending_class(token)
    return table


def _histories(classes: np.ndarray, start: int) -> np.ndarray:
    """Pair of classes before each position; two starts before the first."""
    padded = np.concatenate([[start, start], classes[:-1]])
    return padded[:-1] * CLASSES + padded[1:] if len(classes) else np.empty(0, np.int64)


def _pair_row(histories: np.ndarray) -> np.ndarray:
    mixed = (histories.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return 2 * CLASSES + (mixed >> np.uint64(40)).astype(np.int64) % PAIRS


def _rows_of(histories: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight rows of a history: the class before, the class two back, the hashed pair."""
    return histories % CLASSES, CLASSES + histories // CLASSES, _pair_row(histories)


def log_probabilities(weights: np.ndarray, bias: np.ndarray, histories: np.ndarray) -> np.ndarray:
    """Natural log of P(class | history), one row per history."""
    logits = bias + sum(weights[rows] for rows in _rows_of(histories))
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def transitions(texts: DataFrame, head: dict[bytes, int]) -> DataFrame:
    """``(history, class, n)``: how often each class follows each pair of classes in texts(text)."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def gathered(batches):
        codes, table = lasting(lambda: (_codes(shared.value), _classes(shared.value)))
        start = int(table[shared.value[END]])
        held, size = [], 0

        def flushed():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array((values // CLASSES).astype(np.int32)),
                    pa.array((values % CLASSES).astype(np.int32)),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["history", "class", "n"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TASK_ROWS):
                for text in batch.column(0).slice(at, TASK_ROWS).to_pylist():
                    classes = table[codes([*words_of(text), END])]
                    held.append(_histories(classes, start) * CLASSES + classes)
                    size += len(classes)
                if size > FLUSH_CODES:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    parts = arrow_map(texts.select("text"), gathered, "history int, class int, n long")
    return parts.groupBy("history", "class").agg(F.sum("n").alias("n"))


def _gradient(stats: DataFrame, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and value of the log-likelihood, summed over the tasks."""
    shared = stats.sparkSession.sparkContext.broadcast((weights, bias))

    def part(batches):
        held = list(batches)
        if not held:  # a task without histories
            return
        table = pa.Table.from_batches(held)
        gradient, value = np.zeros((ROWS, CLASSES)), 0.0
        histories, at = np.unique(table["history"].to_numpy().astype(np.int64), return_inverse=True)
        for low in range(0, len(histories), 4096):
            mine = (at >= low) & (at < low + 4096)
            some = histories[low : low + 4096]
            seen = np.zeros((len(some), CLASSES))
            np.add.at(seen, (at[mine] - low, table["class"].to_numpy()[mine]), table["n"].to_numpy()[mine])
            logs = log_probabilities(*shared.value, some)
            value += float((seen * logs).sum())
            error = seen - seen.sum(axis=1, keepdims=True) * np.exp(logs)
            for rows in _rows_of(some):
                np.add.at(gradient, rows, error)
        yield pa.RecordBatch.from_arrays(
            [pa.array([gradient.astype(np.float32).tobytes()], pa.binary()), pa.array([value])], names=["gradient", "value"]
        )

    rows = arrow_map(stats, part, "gradient binary, value double").collect()
    shared.destroy()
    total = np.zeros((ROWS, CLASSES))
    for row in rows:
        total += np.frombuffer(row.gradient, np.float32).reshape(ROWS, CLASSES)
    return total, sum(row.value for row in rows)


def train(texts: DataFrame, updates: int = UPDATES, head_size: int = HEAD) -> Model | None:
    """Fit on texts(text); every text counts, null ones as empty. None if there is no text."""
    counts = kept_table(word_counts(texts), "counts")
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    if not totals.words:
        return None
    rows, cutoff = _head(counts, head_size)
    rows = sorted(((-row.n, bytes(row.token)) for row in rows))
    if not any(token == END for _, token in rows):
        ends = counts.where(F.octet_length("token") == 0).first().n
        rows.append((-ends, END))
    head = {token: place for place, (_, token) in enumerate(rows)}

    # Shared classes have room for one unknown word each.
    ending = F.crc32(F.expr("substring(token, greatest(octet_length(token) - 1, 1), 2)")) % SHARED + OWN
    mass = np.zeros(CLASSES)
    mass[OWN:] += SMOOTHING
    own = {token: place for token, place in head.items() if place < OWN}
    summed = counts.where(~F.col("token").isin([F.lit(t) for t in own])).groupBy(ending.cast("int").alias("class"))
    for row in summed.agg((F.sum("n") + SMOOTHING * F.count("*")).alias("mass")).collect():
        mass[row["class"]] += row.mass
    for _token, place in own.items():
        mass[place] = SMOOTHING - rows[place][0]

    stats = transitions(texts, head).repartition(GRADIENT_TASKS, "history")
    stats = kept_table(stats, "transitions").coalesce(GRADIENT_TASKS)
    weights = np.zeros((ROWS, CLASSES), np.float32)
    bias = np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for n in range(1, updates + 1):
        gradient, _value = _gradient(stats, weights, bias)
        gradient = ((gradient - PRIOR * weights) / totals.tokens).astype(np.float32)
        mean = 0.8 * mean + 0.2 * gradient
        square = 0.95 * square + 0.05 * gradient**2
        rate = STEP * (1 - (n - 1) / updates)
        weights += rate * (mean / (1 - 0.8**n)) / (np.sqrt(square / (1 - 0.95**n)) + 1e-9)
    places = np.array([-n for n, _ in rows], float)
    return Model(head, places, cutoff, weights, bias, mass, totals.tokens, totals.words, counts)


def _scorer(model: Model):
    """Function from a text to ``(n_tokens, n_head, head_score, gain, rare)``; ``rare`` has the words beyond head."""
    codes, table, size = _codes(model.head), _classes(model.head), len(model.head)
    start, total = int(table[model.head[END]]), model.total
    base = np.concatenate([np.log10((model.head_counts + SMOOTHING) / total), np.zeros(SHARED)])
    prior = np.log10(np.maximum(model.mass, 1e-9) / total)
    # One row per history, 28 MB in all, of which those that were met take memory.
    logs = np.zeros((CLASSES * CLASSES, CLASSES), np.float32)
    met = np.zeros(CLASSES * CLASSES, bool)

    def gains(classes):
        histories = _histories(classes, start)
        new = np.unique(histories[~met[histories]])
        for low in range(0, len(new), 4096):
            some = new[low : low + 4096]
            logs[some] = log_probabilities(model.weights, model.bias, some) / math.log(10)
        met[new] = True
        return float((logs[histories, classes] - prior[classes]).sum())

    def scored(text):
        words = [*words_of(text), END]
        code = codes(words)
        rare = np.nonzero(code >= size)[0]
        unheld = [words[i].decode("utf-8", "surrogatepass") for i in rare]
        return len(words), len(words) - len(rare), float(base[code].sum()), gains(table[code]), unheld

    return scored


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for documents(doc_id, text), one row per row.

    Null and empty texts are a single end. Without a model no token is known and
    every one has probability 1, the share of the only, unknown word. Other
    columns are ignored, an empty table gives an empty result.
    """
    if model is None:
        tokens = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1
        return docs.select(
            "doc_id",
            tokens.cast("long").alias("n_tokens"),
            F.lit(0).cast("long").alias("n_known"),
            F.lit(0.0).alias("base_score"),
            F.lit(0.0).alias("score"),
        )
    total = model.total
    shared = docs.sparkSession.sparkContext.broadcast(model._replace(counts=None))

    def setup():
        return lasting(lambda: _scorer(shared.value))

    columns = {"n_tokens": "long", "n_head": "long", "head_score": "double", "gain": "double", "rare": "array<string>"}
    scored = kept_table(map_texts(docs, setup, columns).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("word")).select("row", F.encode("word", "UTF-8").alias("token"))
    lookup = model.counts.where(F.col("n") <= model.least_count)
    found = rare.join(lookup, "token", "left").select("row", F.coalesce("n", F.lit(0)).alias("n"))
    by_row = found.groupBy("row").agg(
        F.sum(F.log10((F.col("n") + SMOOTHING) / total)).alias("rare_score"), F.sum((F.col("n") > 0).cast("long")).alias("n_rare")
    )
    base_score = F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))
    return scored.drop("rare").join(by_row, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        base_score.alias("base_score"),
        (base_score + F.col("gain")).alias("score"),
    )
