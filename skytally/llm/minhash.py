"""Near-duplicate classes by MinHash.

1. Each text becomes a set of hashed word shingles and a signature: the minima
   of ``BANDS * ROWS`` universal hash functions over the set. Equal sets are one
   vertex from then on, however many copies there are.
2. Vertices that agree in all rows of a band share a bucket. A bucket is never
   paired off: its members are compared with its centre, the member that shares
   most buckets with others, which settles groups of near copies in one round.
3. Pairs whose signatures differ too much are dropped. Of the rest each vertex
   has its most alike centre confirmed on the full sets, then those centres
   whose class it is still not in. Confirmed pairs are links; classes are the
   connected components.
4. Buckets that still hold several classes are settled at once and exactly, by
   what their members have unlike their centre. Of two sets that are alike but
   not both linked with the centre, those differences overlap, by an amount that
   follows from the sizes; so they share one of their rarest few differences, and
   a join on these finds every such pair. Texts around one passage differ by what only they have, so
   they make no pairs however many they are.

Every step is a join or an aggregate; steps read tables in the shared folder,
which are deleted when they have been used.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import TASK_ROWS, Memo, arrow_map, kept_table, map_texts, scratch, sized_broadcast, words_of
from skytally.llm.graph import components

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**4)**20, 3 in 100,000.
BANDS, ROWS = 20, 4
#: Cells, as a power of two, of the table that tells common differences from rare ones.
COUNT_BITS = 22
#: Standard errors by which the signature may understate a pair that is then confirmed.
SLACK = 4.5
MEMO_WORDS = 200_000
#: Vertices whose ids may be broadcast to find their texts again; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000

_random = np.random.default_rng(20240501)
MULTIPLIERS = _random.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], width: int, word_hash) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``width`` are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
    count = len(words) - width + 1
    shingles = np.full(count, width, np.uint64)
    for k in range(width):
        shingles = _mixed(shingles ^ hashes[k : k + count]) + np.uint64(k + 1)
    return np.unique(shingles)


def signature_of(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash (multiply, add, keep the high half) over the set."""
    lowest = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512, None] * MULTIPLIERS + OFFSETS
        lowest = np.minimum(lowest, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return lowest


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key ^ rows[:, k]) + np.uint64(k + 1)
    return key.view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, signature, bands)`` of every text; no words: null digest."""

    def setup():
        hashes = Memo(xxhash.xxh3_64_intdigest, MEMO_WORDS)

        def sketch(text):
            found = shingle_set(words_of(text), width, hashes.__getitem__)
            if not len(found):
                return 0, None, None, None
            lowest = signature_of(found)
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            return len(found), digest, lowest.tobytes(), band_keys(lowest)

        return sketch

    return map_texts(
        docs, setup, {"n_shingles": "long", "digest": "binary", "signature": "binary", "bands": "array<long>"}
    )


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)``: the full set, as bytes, of each vertex."""

    def setup():
        hashes = Memo(xxhash.xxh3_64_intdigest, MEMO_WORDS)
        return lambda text: (shingle_set(words_of(text), width, hashes.__getitem__).tobytes(),)

    ids = sized_broadcast(nodes.select(F.col("node").alias("doc_id")), BROADCAST_IDS)
    wanted = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return map_texts(wanted, setup, {"shingles": "binary"}).withColumnRenamed("doc_id", "node")


def _joined(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``pairs(node, centre, ...)`` with the column of both ends. Of the centres, which are few, only theirs is moved."""
    centres = sized_broadcast(pairs.select(F.col("centre").alias("node")).distinct(), BROADCAST_IDS)
    theirs = values.join(centres, "node", "left_semi").select(F.col("node").alias("centre"), F.col(column).alias("b"))
    return pairs.join(values.select("node", F.col(column).alias("a")), "node").join(theirs, "centre")


def _slices(batches):
    """Batches of so few rows that what a task makes of one is small beside the batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, TASK_ROWS):
            yield batch.slice(start, TASK_ROWS)


def _alike(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose signatures agree nearly as often as the similarity asks for."""
    size = BANDS * ROWS
    least = size * (similarity - SLACK * (similarity * (1 - similarity) / size) ** 0.5)

    def kept(batches):
        for batch in _slices(batches):
            ends = [np.frombuffer(b"".join(batch.column(e).to_pylist()), np.uint32).reshape(-1, size) for e in "ab"]
            agree = (ends[0] == ends[1]).sum(axis=1)
            out = batch.select(["node", "centre"]).append_column("agree", pa.array(agree, pa.int32()))
            yield out.filter(pa.array(agree >= least))

    return arrow_map(pairs.select("node", "centre", "a", "b"), kept, "node long, centre long, agree int")


def _confirmed(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose full sets are similar enough, in whole per cents: ``100 i >= s u``."""
    percent = round(similarity * 100)

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= percent * (len(a) + len(b) - both)

    def kept(batches):
        for batch in _slices(batches):
            ends = zip(batch.column("a"), batch.column("b"))
            ok = [linked(*(np.frombuffer(end.as_py(), np.uint64) for end in pair)) for pair in ends]
            yield batch.select(["node", "centre"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(pairs.select("node", "centre", "a", "b"), kept, "node long, centre long")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes(node, component)`` after ``links(node, centre)``; only classes that a link touches are searched."""
    other = classes.select(F.col("node").alias("centre"), F.col("component").alias("v"))
    edges = links.join(classes.withColumnRenamed("component", "u"), "node").join(other, "centre").select("u", "v")
    found = components(edges).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    merged = classes.join(found, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return kept_table(merged, "classes")


def _across(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose ends are in different classes."""
    other = classes.select(F.col("node").alias("centre"), F.col("component").alias("centre_class"))
    return pairs.join(classes, "node").join(other, "centre").where("component <> centre_class").select(pairs.columns)


def classes_of(docs: DataFrame, nodes: DataFrame, width: int, similarity: float) -> DataFrame:
    """``(node, component)`` of every vertex that shares a bucket; component is the smallest vertex of its class."""
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = kept_table(buckets.join(shared, "key"), "members")
    weights = kept_table(members.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    members = kept_table(members.join(weights, "node").select("key", "node", "weight"), "weighted")
    signatures = nodes.select("node", "signature").join(weights.select("node"), "node", "left_semi")
    sets = kept_table(_sets(docs, weights.select("node"), width), "sets")

    def alike(pairs):
        return kept_table(_alike(_joined(pairs, signatures, "signature"), similarity), "alike")

    def linked(pairs):
        return kept_table(_confirmed(_joined(pairs, sets, "shingles"), similarity), "links")

    classes = weights.select("node", F.col("node").alias("component"))
    centres = members.groupBy("key").agg(F.max(F.struct("weight", "node")).getField("node").alias("centre"))
    tried = kept_table(members.join(centres, "key").where("node <> centre").select("node", "centre").distinct(), "pairs")
    near = alike(tried)
    most = Window.partitionBy("node").orderBy(F.desc("agree"), "centre")
    first = near.withColumn("n", F.row_number().over(most)).where("n = 1").select("node", "centre")
    classes = _merged(classes, linked(first))
    rest = near.join(first, ["node", "centre"], "left_anti").select("node", "centre")
    classes = _merged(classes, linked(kept_table(_across(rest, classes), "pairs")))

    classed = members.join(classes, "node").groupBy("key")
    ends = classed.agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    mixed = ends.where("low < high and size > 2").join(centres, "key").select("key", "centre")
    around = kept_table(members.join(mixed, "key").where("node <> centre").select("node", "centre").distinct(), "around")
    if around.isEmpty():
        return classes
    differences = kept_table(_differences(_joined(around, sets, "shingles"), similarity), "differences")
    firsts = _first_differences(differences, _commonness(differences), similarity).join(classes, "node")
    return _merged(classes, linked(kept_table(_overlapping(kept_table(firsts, "firsts"), similarity), "pairs")))


def _differences(pairs: DataFrame, similarity: float) -> DataFrame:
    """``(centre, node, size, linked, elements)``: the elements that only one end of each pair has, as bytes."""
    percent = round(100 * similarity)

    def kept(batches):
        for batch in _slices(batches):
            rows = []
            for node, centre, *sets in zip(*(batch.column(c).to_pylist() for c in ("node", "centre", "a", "b"))):
                own, its = (np.frombuffer(s, np.uint64) for s in sets)
                more = np.setdiff1d(own, its, assume_unique=True)
                less = np.setdiff1d(its, own, assume_unique=True)
                linked = 100 * (len(own) - len(more)) >= percent * (len(its) + len(more))
                rows.append((centre, node, len(own), linked, np.concatenate([more, less]).tobytes()))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DIFFERENCES)], schema=_DIFFERENCES)

    return arrow_map(
        pairs.select("node", "centre", "a", "b"), kept, "centre long, node long, size int, linked boolean, elements binary"
    )


_DIFFERENCES = pa.schema(
    [
        ("centre", pa.int64()),
        ("node", pa.int64()),
        ("size", pa.int32()),
        ("linked", pa.bool_()),
        ("elements", pa.binary()),
    ]
)


def _cells(centre: int, elements: np.ndarray) -> np.ndarray:
    """Where the count of an element among the differences to a centre is kept."""
    return (_mixed(elements ^ _mixed(np.array([centre], np.int64).view(np.uint64))) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _commonness(differences: DataFrame) -> np.ndarray:
    """How many differences hold an element, in a table of fixed size.

    Elements that share a cell seem more common than they are. That costs
    candidates, never links: any order that all members of a bucket share will do.
    """

    def counted(batches):
        counts = np.zeros(1 << COUNT_BITS, np.int32)
        for batch in batches:
            for centre, elements in zip(batch.column("centre").to_pylist(), batch.column("elements").to_pylist()):
                np.add.at(counts, _cells(centre, np.frombuffer(elements, np.uint64)), 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["cell", "n"])

    # A row per cell at most.
    parts = arrow_map(differences.select("centre", "elements"), counted, "cell long, n long")
    table = parts.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.int32)
    counts[table.column("cell").to_numpy()] = np.minimum(table.column("n").to_numpy(), np.iinfo(np.int32).max)
    return counts


def _first_differences(differences: DataFrame, commonness: np.ndarray, similarity: float) -> DataFrame:
    """``(centre, node, size, linked, differing, place, element)``: the rarest of the elements that only one end has.

    For sets s, x of similarity t or more, |s - x| + |x - s| <= (|s| + |x|) (1 - t) / (1 + t), and |x| <= |s| / t.
    With D_s, D_x their differences to a centre, the overlap of these is at least half of |D_s| + |D_x| less that,
    and no more than |D_x|; so it is at least |D_s| - |s| (1 - t) / t, which leaves this many places for the first.
    """
    shared = differences.sparkSession.sparkContext.broadcast(commonness)

    def kept(batches):
        for batch in _slices(batches):
            made: list[list] = [[] for _ in range(7)]
            rows = zip(*(batch.column(c).to_pylist() for c in ("centre", "node", "size", "linked", "elements")))
            for centre, node, size, linked, elements in rows:
                elements = np.frombuffer(elements, np.uint64)
                count = min(len(elements), int(size * (1 - similarity) / similarity + 1e-9) + 1)
                order = np.lexsort((elements, shared.value[_cells(centre, elements)]))[:count]
                for values, value in zip(made, (centre, node, size, linked, len(elements))):
                    values.append(np.full(count, value))
                made[5].append(np.arange(count))
                made[6].append(elements[order].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v) if v else [], f.type) for v, f in zip(made, _FIRSTS)], schema=_FIRSTS
            )

    return arrow_map(
        differences,
        kept,
        "centre long, node long, size int, linked boolean, differing int, place int, element long",
    )


_FIRSTS = pa.schema(
    [
        ("centre", pa.int64()),
        ("node", pa.int64()),
        ("size", pa.int32()),
        ("linked", pa.bool_()),
        ("differing", pa.int32()),
        ("place", pa.int32()),
        ("element", pa.int64()),
    ]
)


def _overlapping(firsts: DataFrame, similarity: float) -> DataFrame:
    """``(node, centre)``: pairs of two classes whose differences share an element early enough for their sizes."""
    a, b = firsts.alias("a"), firsts.alias("b")
    sizes = F.col("a.size") + F.col("b.size")
    apart = (1 - similarity) / (2 * (1 + similarity))
    overlap = F.greatest(F.lit(1.0), (F.col("a.differing") + F.col("b.differing")) / 2 - sizes * apart - 1e-6)
    met = a.join(
        b,
        (F.col("a.centre") == F.col("b.centre"))
        & (F.col("a.element") == F.col("b.element"))
        & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.component") != F.col("b.component"))
        & ~(F.col("a.linked") & F.col("b.linked"))
        & (F.least("a.size", "b.size") >= similarity * F.greatest("a.size", "b.size") - 1e-6)
        & (F.col("a.place") <= F.col("a.differing") - overlap)
        & (F.col("b.place") <= F.col("b.differing") - overlap),
    )
    return met.select(F.col("b.node").alias("node"), F.col("a.node").alias("centre")).distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of documents(doc_id, text).

    component_id is the smallest doc_id reachable over links; only its row is
    kept. A text that is null, empty or without words has no shingles, is linked
    with nothing and kept; so is a row without a doc_id, whose component is
    null. Rows that repeat a doc_id are one vertex, which has the links of all
    of their texts. Other columns are ignored, an empty table gives an empty result.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, width, similarity))


def _near_duplicates(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    table = kept_table(sketches(docs, width), "sketches")
    usable = table.where("digest is not null and doc_id is not null")
    nodes = kept_table(
        usable.groupBy("digest").agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    classes = classes_of(docs, nodes, width, similarity)
    # A doc_id on rows with several texts ties their vertices together.
    tied = usable.join(nodes.select("digest", "node"), "digest").groupBy("doc_id")
    tied = kept_table(tied.agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u <> v"), "tied")
    if not tied.isEmpty():
        stars = classes.select(F.col("node").alias("u"), F.col("component").alias("v"))
        classes = components(stars.unionByName(tied.select("u", "v")))
    by_digest = nodes.select("digest", "node").join(classes, "node", "left")
    by_digest = by_digest.select("digest", F.coalesce("component", "node").alias("found"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    found = (
        table.select("doc_id", "n_shingles", "digest")
        .join(by_digest, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    return kept_table(found, "near-duplicates")
