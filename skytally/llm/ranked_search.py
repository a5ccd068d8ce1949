"""Ranked lexical search over posting lists that are cut into blocks of similar documents.

The score of a document for an item is the sum, over the item's terms, of the
term's weight times the document's impact for it; all parts are whole numbers
and none is negative. That allows a search that is exact without looking at
most documents:

- Only postings of terms that some item asks for are kept (``vectors``).
- Documents are put in the order of a geometric code, the signs of random
  projections of their weighted vectors, so that similar ones are neighbours.
- Each term's posting list, in that order, is cut into blocks. A block stores
  the largest impact that any of its documents has for each coordinate.
- The summary's product with an item bounds the score of every document in the
  block. A block is skipped only if that bound is below a score that ten
  documents are known to reach.

A document is looked for in the list of the rarest of the item's terms that it
has. So the bound of a term's block leaves out all rarer terms, and where even
the largest impacts of the whole list are not enough, the list gets no blocks.

The first threshold comes from a bounded sample of documents (``SEED_DOCS``), a
better one from the blocks with the highest bounds. Both only decide how much is
skipped, never what is found.

Defined cases: a null or empty text has no terms and is not counted; rows of
documents that share a doc_id are ranked each by itself; rows of items that
share an item_id are one item, whose terms add up; a term no document has, or of
weight 0, adds nothing; no items or no documents give no rows. Null ids come
last among equal scores. Only the id and the text of either table are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import TASK_ROWS, arrow_map, kept_table, map_texts

#: Characters of terms: ASCII letters (A-Z lower-cased) and digits, and all bytes of other characters.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

TOP = 10
#: Items searched at a time: at most so many, with so many terms all told (one larger item is a block of its own).
BLOCK_ITEMS, BLOCK_TERMS = 256, 20_000
#: Documents scored for the first threshold, and blocks per item for the second.
SEED_DOCS, FIRST_BLOCKS = 2_000, 4
#: Signs in a document's code, documents in a block, cells of the dense part of the index that a task holds.
PLANES, BLOCK_DOCS, CELLS = 16, 64, 1 << 23

IMPACT = "(1000000000L * tfs) div (1000L * tfs + 8 * m)"


def terms_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term, mult)``: how often each item has each of its terms."""

    def setup():
        return lambda text: ([t.decode("utf-8", "surrogatepass") for t in terms_of(text)],)

    chosen = items.select(F.col("item_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = map_texts(chosen, setup, {"terms": "array<string>"})
    return (
        listed.select(F.col("doc_id").alias("item_id"), F.explode("terms").alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count("*").alias("mult"))
    )


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, tids, tfs)`` of every row that has terms: all its terms counted, the vocabulary's listed."""

    def setup():
        def listed(text):
            words = terms_of(text)
            tfs: dict[int, int] = {}
            for tid in map(vocabulary.get, words):
                if tid is not None:
                    tfs[tid] = tfs.get(tid, 0) + 1
            return len(words), list(tfs), list(tfs.values())

        return listed

    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_texts(text, setup, {"n": "long", "tids": "array<int>", "tfs": "array<int>"}).where("n > 0")


class Searched:
    """What the tasks know of a block of items: terms by rarity, and the items' weights for them.

    Terms are numbered from the rarest on, so the terms that count for a block
    of term ``p`` are the numbers from ``p`` on.
    """

    def __init__(self, places: np.ndarray, weights: np.ndarray, largest: np.ndarray, means: np.ndarray):
        self.places, self.weights, self.largest, self.means = places, weights, largest, means
        self.floor = np.ones(weights.shape[1])

    def later(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        """``(items, columns)``: items that may find something new in list ``p``, and all they may find there."""
        asks = np.flatnonzero(self.weights[p])
        bounds = self.largest[p:] @ self.weights[p:, asks]
        asks = asks[bounds >= self.floor[asks]]
        if not len(asks):
            return asks, asks
        return asks, p + np.flatnonzero(self.weights[p:, asks].any(axis=1))


def _block_of_items(terms: DataFrame) -> list[DataFrame]:
    """The items' terms in blocks that the driver and the tasks can hold."""
    size = terms.agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items")).first()
    blocks = max(1, -(-size.n // BLOCK_TERMS), -(-size.items // BLOCK_ITEMS))
    if blocks == 1:
        return [terms]
    return [terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) for b in range(blocks)]


def _prepared(stored: DataFrame, rows: list, vocabulary: dict[bytes, int], items: list) -> Searched:
    """Weights and largest impacts, from one aggregate over all postings."""
    postings = stored.select("m", F.inline(F.arrays_zip("tids", "tfs")))
    impacts = postings.select(F.col("tids").alias("tid"), F.expr(IMPACT).alias("impact"))
    per_term = impacts.groupBy("tid").agg(
        F.count("*").alias("df"), F.max("impact").alias("largest"), F.sum("impact").alias("total")
    )
    documents = stored.count()
    df, largest, means = (np.zeros(len(vocabulary)) for _ in range(3))
    for row in per_term.collect():  # a row per term of the items
        df[row.tid], largest[row.tid], means[row.tid] = row.df, row.largest, row.total / documents
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df])
    weight[df == 0] = 0
    order = np.lexsort((np.arange(len(weight)), -weight))
    places = np.empty(len(order), dtype=np.int64)
    places[order] = np.arange(len(order))
    weights = np.zeros((len(vocabulary), len(items)))
    number = {item: i for i, item in enumerate(items)}
    for row in rows:
        tid = vocabulary[row.term.encode("utf-8", "surrogatepass")]
        weights[places[tid], number[row.item_id]] = row.mult * weight[tid]
    return Searched(places, weights, largest[order], means[order])


def _dense(batch: pa.RecordBatch, searched: Searched) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, impact)`` of all postings of a batch with m, tids and tfs; row counts within the batch."""
    tids, tfs = batch.column("tids"), batch.column("tfs")
    counts = np.diff(tids.offsets.to_numpy())
    rows = np.repeat(np.arange(batch.num_rows), counts)
    tf = tfs.flatten().to_numpy().astype(np.int64)
    m = batch.column("m").to_numpy(zero_copy_only=False).astype(np.int64)
    return rows, searched.places[tids.flatten().to_numpy()], (1_000_000_000 * tf) // (1000 * tf + 8 * m[rows])


def _slices(batches, searched: Searched):
    """Batches cut so that one row per document and one column per term fit the memory of a task."""
    rows = max(16, CELLS // max(1, len(searched.places)))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _matrix(batch: pa.RecordBatch, searched: Searched) -> np.ndarray:
    rows, places, impacts = _dense(batch, searched)
    matrix = np.zeros((batch.num_rows, len(searched.places)), dtype=np.float64)
    matrix[rows, places] = impacts
    return matrix


def _best(batches, searched: Searched, asked: str | None):
    """Per slice, the highest-scoring documents of each item.

    Sums of whole numbers below 2**53 are exact in doubles, which is what makes products fast.
    """
    for batch in _slices(batches, searched):
        matrix = _matrix(batch, searched)
        ids = batch.column("doc_id")
        sorted_ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        wanted = None if asked is None else batch.column(asked)
        item_of = np.arange(searched.weights.shape[1])
        if wanted is not None:
            pair_rows = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            pair_items = wanted.flatten().to_numpy()
            order = np.argsort(pair_items, kind="stable")
            pair_rows, pair_items = pair_rows[order], pair_items[order]
            item_of = np.unique(pair_items)
        out_items, out_rows, out_scores = [], [], []
        for item in item_of:
            rows = np.arange(batch.num_rows)
            if wanted is not None:
                rows = pair_rows[np.searchsorted(pair_items, item) : np.searchsorted(pair_items, item, "right")]
            columns = np.flatnonzero(searched.weights[:, item])
            scores = matrix[np.ix_(rows, columns)] @ searched.weights[columns, item]
            least = np.partition(scores, -TOP)[-TOP] if len(scores) > TOP else 1
            hit = np.flatnonzero(scores >= max(least, searched.floor[item]))
            hit = hit[np.lexsort((sorted_ids[rows[hit]], -scores[hit]))][:TOP]
            out_items.append(np.full(len(hit), item))
            out_rows.append(rows[hit])
            out_scores.append(scores[hit])
        rows = np.concatenate(out_rows) if out_rows else np.array([], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(out_items) if out_items else [], pa.int32()),
                ids.take(pa.array(rows, pa.int64())),
                pa.array((np.concatenate(out_scores) if out_scores else np.array([])).astype(np.int64), pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )


def _ranked(scored: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= TOP)


def _raise_floor(searched: Searched, ranked: DataFrame) -> None:
    """The score that TOP documents are known to reach, for each item that has so many."""
    for row in ranked.where(F.col("rank") == TOP).collect():  # a row per item of the block
        searched.floor[row.item] = max(searched.floor[row.item], row.score)


def coded(stored: DataFrame, searched: Searched) -> DataFrame:
    """Adds the geometric code: signs of random projections of the centred, weighted vector."""
    weight = searched.weights.max(axis=1, initial=0)

    def mapped(batches):
        signs = np.random.default_rng(11).choice((-1.0, 1.0), (len(searched.places), PLANES))
        signs *= weight[:, None]
        centre = searched.means @ signs
        powers = 1 << np.arange(PLANES)
        for batch in _slices(batches, searched):
            rows, places, impacts = _dense(batch, searched)
            sums = np.zeros((batch.num_rows, PLANES))
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            if len(starts):
                sums[rows[starts]] = np.add.reduceat(signs[places] * impacts[:, None], starts, axis=0)
            codes = (sums > centre) @ powers
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int32())], names=[*batch.schema.names, "code"])

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema)
    return arrow_map(stored, mapped, f"{names}, code int")


BLOCK = "place int, rows array<bigint>, columns array<int>, largest array<bigint>"


def blocks(stored: DataFrame, searched: Searched) -> DataFrame:
    """The posting lists worth searching, each in blocks of neighbours with their coordinatewise maxima."""

    def mapped(batches):
        lists: dict[int, tuple] = {}
        for batch in _slices(batches, searched):
            matrix = _matrix(batch, searched)
            ids = batch.column("row").to_numpy()
            made: tuple[list, ...] = ([], [], [], [])
            for p in np.flatnonzero((matrix > 0).any(axis=0)):
                if p not in lists:
                    lists[p] = searched.later(p)
                columns = lists[p][1]
                if not len(columns):
                    continue
                holders = np.flatnonzero(matrix[:, p])
                starts = np.arange(0, len(holders), BLOCK_DOCS)
                largest = np.maximum.reduceat(matrix[np.ix_(holders, columns)], starts, axis=0).astype(np.int64)
                for start, maxima in zip(starts, largest):
                    seen = np.flatnonzero(maxima)
                    made[0].append(p)
                    made[1].append(ids[holders[start : start + BLOCK_DOCS]])
                    made[2].append(columns[seen])
                    made[3].append(maxima[seen])
            kinds = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            arrays = [pa.array(values, kind) for values, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", "rows", "columns", "largest"])

    # Rows break ties, so a code that a third of all documents share is spread over tasks.
    near = coded(stored, searched).repartitionByRange("code", "row").sortWithinPartitions("code", "row")
    return arrow_map(near.select("row", "m", "tids", "tfs"), mapped, BLOCK)


def bounds(stored_blocks: DataFrame, searched: Searched) -> DataFrame:
    """``(item, bound, rows)`` for each block and item whose bound reaches the item's threshold."""

    def mapped(batches):
        lists: dict[int, tuple] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS)
                items, found, taken = [], [], []
                columns, largest = part.column("columns"), part.column("largest")
                coordinates, values = columns.flatten().to_numpy(), largest.flatten().to_numpy()
                offsets = columns.offsets.to_numpy() - columns.offsets[0].as_py()
                for i, p in enumerate(part.column("place").to_pylist()):
                    if p not in lists:
                        lists[p] = searched.later(p)
                    asks = lists[p][0]
                    if not len(asks):
                        continue
                    span = slice(offsets[i], offsets[i + 1])
                    bound = values[span] @ searched.weights[np.ix_(coordinates[span], asks)]
                    reach = np.flatnonzero(bound >= searched.floor[asks])
                    items.append(asks[reach])
                    found.append(bound[reach])
                    taken.append(np.full(len(reach), i))
                taken = np.concatenate(taken) if taken else np.array([], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(items) if items else [], pa.int32()),
                        pa.array((np.concatenate(found) if found else np.array([])).astype(np.int64), pa.int64()),
                        part.column("rows").take(pa.array(taken, pa.int64())),
                    ],
                    names=["item", "bound", "rows"],
                )

    return arrow_map(stored_blocks, mapped, "item int, bound long, rows array<bigint>")


def _scored(stored: DataFrame, candidates: DataFrame, searched: Searched) -> DataFrame:
    """The best of the candidate ``(item, rows)``, each document fetched once and scored in full."""
    asked = candidates.select("item", F.explode("rows").alias("row")).groupBy("row").agg(F.collect_set("item").alias("asked"))
    chosen = stored.join(asked, "row").select("doc_id", "m", "tids", "tfs", "asked")
    return arrow_map(chosen, lambda batches: _best(batches, searched, "asked"), "item int, doc_id long, score long")


def _search_block(docs: DataFrame, terms: DataFrame, seed_docs: int) -> DataFrame | None:
    rows = terms.collect()
    vocabulary = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(sorted({r.term for r in rows}))}
    items = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
    if not items:
        return None
    listed = kept_table(vectors(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = listed.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    if not size.documents:
        return None
    norm = F.expr(f"25 + (75 * n * {size.documents}L) div {size.terms}L")
    stored = listed.select("row", "doc_id", norm.alias("m"), "tids", "tfs")
    searched = _prepared(stored, rows, vocabulary, items)

    share = int(min(1.0, seed_docs / size.documents) * 2**40)
    seeds = stored.where(F.pmod(F.xxhash64("row"), F.lit(2**40)) < share)
    scored = arrow_map(seeds, lambda batches: _best(batches, searched, None), "item int, doc_id long, score long")
    _raise_floor(searched, _ranked(scored))

    kept = kept_table(blocks(stored, searched), "blocks")
    highest = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), F.col("rows")[0]))
    first = bounds(kept, searched).withColumn("place", highest).where(F.col("place") <= FIRST_BLOCKS)
    _raise_floor(searched, _ranked(_scored(stored, first, searched)))

    ranked = _ranked(_scored(stored, bounds(kept, searched), searched))
    names = F.array(*[F.lit(i).cast("long") for i in items])
    return ranked.select(F.get(names, F.col("item")).alias("item_id"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, seed_docs: int = SEED_DOCS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the TOP highest-scoring documents above 0 of every item."""
    terms = kept_table(item_terms(items), "item-terms")
    found = None
    for block in _block_of_items(terms):
        part = _search_block(docs, block, seed_docs)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
