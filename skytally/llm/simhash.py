"""SimHash fingerprints and the search for fingerprints within a Hamming radius.

A text's terms are its pairs of neighbouring words, weighted by their length.
Each term's two 64-bit hashes vote with that weight on 128 bits; a bit is set
if more than half of the weight is for it. Two bits share one long while votes
are summed, 32 places apart, so that 64 sums do for 128 bits.

Near fingerprints are found through permuted block tables: the bits are cut
into ``radius + 2`` blocks; fingerprints within the radius agree on at least two
whole blocks, so a table for each pair of blocks has every match under one key.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import kept_table

BITS = 128
RADIUS = 3
#: Stands for a null document id; sorts before all others.
NO_ID = -(2**63)
_LANES = 0x1_0000_0001
_LOW = 0xFFFF_FFFF
_SEEDS = ("", "second")


def _votes() -> list[Column]:
    return [
        F.sum(F.col("weight") * F.shiftrightunsigned(f"hash{s}", i).bitwiseAND(F.lit(_LANES))).alias(f"v{s}_{i}")
        for s in range(len(_SEEDS))
        for i in range(32)
    ]


def _set_bits(seed: int) -> Column:
    """The long whose bits are set where more than half of the weight voted for them."""
    bits = F.lit(0).cast("long")
    for i in range(32):
        votes = F.col(f"v{seed}_{i}")
        for lane, count in ((0, votes.bitwiseAND(F.lit(_LOW))), (32, F.shiftrightunsigned(votes, 32))):
            bit = F.when(2 * count > F.col("total"), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
            bits = bits.bitwiseOR(F.shiftleft(bit, i + lane))
    return bits


def fingerprints(texts: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, f0, f1)`` of texts(*keys, text), one row per key.

    Equal texts have equal fingerprints. A null or empty text has no terms and
    all bits unset; a single word is a term with nothing after it. Rows that
    share their keys vote together. Needs no shuffle where the rows are already
    partitioned by some of the keys.
    """
    words = F.split(F.trim(F.lower(F.coalesce("text", F.lit("")))), r"\s+")
    pairs = texts.select(*keys, words.alias("words"))
    following = F.concat(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), F.array(F.lit("")))
    terms = pairs.select(*keys, F.explode(F.arrays_zip(F.col("words").alias("a"), following.alias("b"))).alias("t"))
    terms = terms.select(*keys, F.col("t.a").alias("a"), F.col("t.b").alias("b"))
    weight = (F.length("a") + F.length("b")).cast("long")
    hashed = terms.select(
        *keys,
        weight.alias("weight"),
        *[F.xxhash64(F.lit(seed), "a", "b").alias(f"hash{s}") for s, seed in enumerate(_SEEDS)],
    )
    summed = hashed.groupBy(*keys).agg(F.sum("weight").alias("total"), *_votes())
    return summed.select(*keys, _set_bits(0).alias("f0"), _set_bits(1).alias("f1"))


def likeness(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Share of equal bits."""
    return 1 - (F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))) / F.lit(float(BITS))


def _text_of(f0: Column, f1: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def _tables(prints: DataFrame, radius: int) -> DataFrame:
    """One row per print and pair of blocks, keyed by the table and the two blocks' bits."""
    blocks = radius + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    bits = F.concat(F.lpad(F.bin("f0"), 64, "0"), F.lpad(F.bin("f1"), 64, "0"))
    cut = [F.substring(bits, low + 1, high - low) for low, high in zip(edges, edges[1:])]
    keys = [F.xxhash64(F.lit(n), cut[i], cut[j]) for n, (i, j) in enumerate(combinations(range(blocks), 2))]
    return prints.withColumn("key", F.explode(F.array(*keys)))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(q0, q1, f0, f1)``: every fingerprint of ``prints`` within the radius of one of ``queries``.

    Both are tables of (f0, f1); equal fingerprints count once, however many
    documents have them. A fingerprint finds itself if it is in both.
    """
    asked = _tables(queries.select("f0", "f1").distinct(), radius)
    asked = asked.select("key", F.col("f0").alias("q0"), F.col("f1").alias("q1"))
    held = _tables(prints.select("f0", "f1").distinct(), radius)
    apart = F.bit_count(F.expr("f0 ^ q0")) + F.bit_count(F.expr("f1 ^ q1"))
    return asked.join(held, "key").where(apart <= radius).select("q0", "q1", "f0", "f1").distinct()


def following(rows: DataFrame) -> DataFrame:
    """Add next_doc and next_h to rows(doc, h), each the next in order and the first after the last.

    The rows are dealt into ranges; within a range a window finds the next row,
    and of a range only its first row is looked at by the range before.
    """
    ranged = kept_table(rows.repartitionByRange("doc", "h").withColumn("part", F.spark_partition_id()), "order")
    within = Window.partitionBy("part").orderBy("doc", "h")
    head = F.struct("doc", "h")
    heads = ranged.groupBy("part").agg(F.min(head).alias("head"))
    # One row per range, so one task has as many rows as there are ranges.
    in_turn = Window.orderBy("part")
    follower = F.coalesce(F.lead("head").over(in_turn), F.first("head").over(in_turn))
    after = heads.select("part", follower.alias("follower"))
    found = F.coalesce(F.lead(head).over(within), F.col("follower"))
    return (
        ranged.join(F.broadcast(after), "part")
        .withColumn("_next", found)
        .select(*rows.columns, F.col("_next.doc").alias("next_doc"), F.col("_next.h").alias("next_h"))
    )


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS, query_step: int = 100) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The edited text has the last half of the characters replaced by as many from
    the start of the next document. Documents are in ascending order of doc_id,
    rows without one first, rows that repeat one in the order of a hash of their
    text; equal rows count as one document and come out as often as they came
    in. A single document is its own next. Null texts are empty. Documents whose
    id is divisible by ``query_step`` also get ``n_near``, the number of other
    rows whose fingerprint is within ``radius``; it is null for the rest.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    rows = texts.select("doc", "h", F.length("text").cast("long").alias("n")).groupBy("doc", "h")
    order = kept_table(following(rows.agg(F.first("n").alias("n"), F.count("*").alias("copies"))), "following")

    asked = order.select(
        F.col("next_doc").alias("doc"),
        F.col("next_h").alias("h"),
        F.col("doc").alias("to_doc"),
        F.col("h").alias("to_h"),
        F.floor(F.col("n") / 2).cast("int").alias("take"),
    )
    starts = texts.join(asked, ["doc", "h"]).select(
        F.col("to_doc").alias("doc"), F.col("to_h").alias("h"), F.expr("substring(text, 1, take)").alias("start")
    )
    if not order.where("copies > 1").isEmpty():
        starts = starts.dropDuplicates(["doc", "h"])
    n = F.length("text")
    paired = texts.join(starts, ["doc", "h"]).select(
        "doc", "h", "text", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), "start").alias("edited")
    )
    versions = paired.select(
        "doc",
        "h",
        F.explode(
            F.array(
                F.struct(F.col("text"), F.lit(None).cast("binary").alias("sha")),
                F.struct(F.col("edited").alias("text"), F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha")),
            )
        ).alias("v"),
    ).select("doc", "h", "v.sha", "v.text")
    prints = fingerprints(versions, "doc", "h", "sha")
    own, edit = F.col("sha").isNull(), F.col("sha").isNotNull()
    pick = lambda which, column: F.max(F.when(which, F.col(column)))
    prints = kept_table(
        prints.groupBy("doc", "h").agg(
            *[pick(own, f).alias(f) for f in ("f0", "f1")],
            *[pick(edit, f).alias(f"e{f[1]}") for f in ("f0", "f1")],
            F.max("sha").alias("sha"),
        ),
        "prints",
    )

    rows = order.join(prints, ["doc", "h"])
    is_query = (F.col("doc") % query_step == 0) & (F.col("doc") != NO_ID)
    copies = rows.groupBy("f0", "f1").agg(F.sum("copies").alias("copies"))
    near = within_radius(rows.where(is_query), prints, radius).join(copies, ["f0", "f1"])
    near = near.groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1")).agg((F.sum("copies") - 1).alias("n_near"))
    following_prints = prints.select(
        F.col("doc").alias("next_doc"), F.col("h").alias("next_h"), F.col("f0").alias("n0"), F.col("f1").alias("n1")
    )
    f0, f1, e0, e1, n0, n1 = map(F.col, ("f0", "f1", "e0", "e1", "n0", "n1"))
    return (
        rows.join(following_prints, ["next_doc", "next_h"])
        .join(near, ["f0", "f1"], "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
            F.col("n").alias("n_chars"),
            F.lower(F.hex("sha")).alias("edited_sha256"),
            _text_of(f0, f1).alias("fingerprint"),
            _text_of(e0, e1).alias("edited_fingerprint"),
            likeness(f0, f1, e0, e1).alias("near_edited"),
            likeness(f0, f1, n0, n1).alias("near_next"),
            F.when(is_query, F.col("n_near")).alias("n_near"),
        )
    )
