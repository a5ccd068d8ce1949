"""Benchmark decontamination with a positional inverted index.

The index holds (term, document, position) for every training word that the
benchmark uses at all; it is written once, next to the documents' splits, so
that building it moves no text. A test window is looked up through its rarest
term: that term's list, less the term's place in the item, gives the diagonals
on which document and item may agree. The second rarest term's list is
intersected with them, then the lists of all other words of the windows left.
Runs of agreeing words as long as a window are exact phrase matches.

All steps are joins on (document, position, term) or narrower aggregates. A
common word is looked up only at positions that rarer words left over, and no
group is larger than an item.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import ascii_lower, kept_table, sized_broadcast

WINDOW = 10
#: What parts the words fixed by the query, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text; the same in any case.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms and diagonal starts of the benchmark that may be broadcast; beyond that joins shuffle.
BROADCAST_TERMS = 500_000
BROADCAST_DOCS = 1_000_000
#: Stands for a null document id.
NO_ID = -(2**63)


class Index(NamedTuple):
    items: DataFrame  # item, item_id, n_terms
    terms: DataFrame  # item, place, term_id, frequency (in the training texts)
    postings: DataFrame  # term_id, doc, pos


def _any_case_words(text: Column) -> Column:
    """Split, because an extraction of all matches copies the text for each of them."""
    return F.array_remove(F.split(text, BETWEEN), "")


def _words(text: str) -> Column:
    return _any_case_words(ascii_lower(F.col(text)))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _doc() -> Column:
    """What a row is known by: its id and its text. Rows that agree in both have the same hits."""
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_hash().alias("text_hash"))


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    """Index documents(doc_id, text) for the words of benchmark(item_id, text)."""
    items = kept_table(
        benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", _words("text").alias("words"))
        .where(F.size("words") > 0),
        "items",
    )
    places = items.select("item", F.posexplode("words").alias("place", "term"))
    vocabulary = kept_table(
        places.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id")), "vocabulary"
    )
    # Both are computed once a text, not once a word, and an outer explosion does not test the array ahead.
    split = docs.select(_doc().alias("doc"), _words("text").alias("words"))
    words = split.select("doc", F.posexplode_outer("words").alias("pos", "term"))
    postings = kept_table(
        words.join(sized_broadcast(vocabulary, BROADCAST_TERMS), "term").select("term_id", "doc", "pos"), "postings"
    )
    frequency = postings.groupBy("term_id").agg(F.count("*").alias("frequency"))
    terms = places.join(vocabulary, "term").join(frequency, "term_id").select("item", "place", "term_id", "frequency")
    return Index(
        items.select("item", "item_id", F.size("words").alias("n_terms")), kept_table(terms, "terms"), postings
    )


def _windows(index: Index, width: int) -> DataFrame:
    """``(item, first, place, term_id, rank)``: the terms of each window whose words all occur; rank 1 is the rarest."""
    sized = index.items.withColumn("width", F.least(F.lit(width), F.col("n_terms")))
    starts = sized.select(
        "item", "width", F.explode(F.sequence(F.lit(0), F.col("n_terms") - F.col("width"))).alias("first")
    )
    parts = starts.select("item", "first", "width", F.explode(F.expr("sequence(first, first + width - 1)")).alias("place"))
    of_window = Window.partitionBy("item", "first")
    return (
        parts.join(index.terms, ["item", "place"])
        .withColumn("found", F.count("*").over(of_window))
        .where("found = width")
        .withColumn("rank", F.row_number().over(of_window.orderBy("frequency", "place")))
        .select("item", "first", "place", "term_id", "rank", "width")
    )


def phrase_hits(index: Index, width: int = WINDOW) -> DataFrame:
    """``(doc, pos, item)``: every document word inside an occurrence of a window of ``width`` item words.

    An item of fewer words is one window.
    """
    windows = kept_table(_windows(index, width), "windows")
    rank = lambda n: windows.where(F.col("rank") == n)
    diagonal = (F.col("pos") - F.col("place")).alias("diagonal")

    rarest = sized_broadcast(rank(1).select("item", "first", "width", "place", "term_id"), BROADCAST_TERMS)
    met = index.postings.join(rarest, "term_id").select("item", "first", "width", "doc", diagonal)
    met = met.where(F.col("diagonal") + F.col("first") >= 0)

    second = rank(2).select("item", "first", F.col("place").alias("place2"), F.col("term_id").alias("term2"))
    asked = met.join(sized_broadcast(second, BROADCAST_TERMS), ["item", "first"], "left")
    asked = asked.withColumn("pos2", F.col("diagonal") + F.col("place2"))
    lists = index.postings.join(
        sized_broadcast(second.select(F.col("term2").alias("term_id")).distinct(), BROADCAST_TERMS), "term_id", "left_semi"
    ).select("doc", F.col("pos").alias("pos2"), F.col("term_id").alias("term2"), F.lit(True).alias("agrees"))
    left = asked.join(lists, ["doc", "pos2", "term2"], "left").where("term2 is null or agrees")
    left = kept_table(left.select("doc", "item", "diagonal", "first", "width"), "diagonals")

    # Windows on one diagonal overlap: each of their places is asked for once.
    places = left.select(
        "doc", "item", "diagonal", F.explode(F.expr("sequence(first, first + width - 1)")).alias("place")
    ).distinct()
    asked = places.join(
        sized_broadcast(index.terms.select("item", "place", "term_id"), BROADCAST_TERMS), ["item", "place"]
    ).withColumn("pos", F.col("diagonal") + F.col("place"))
    docs = sized_broadcast(left.select("doc").distinct(), BROADCAST_DOCS)
    lists = index.postings.join(docs, "doc", "left_semi")
    agreeing = asked.join(lists, ["doc", "pos", "term_id"], "left_semi")

    line = Window.partitionBy("doc", "item", "diagonal")
    runs = agreeing.withColumn("run", F.col("place") - F.row_number().over(line.orderBy("place")))
    runs = runs.withColumn("length", F.count("*").over(Window.partitionBy("doc", "item", "diagonal", "run")))
    whole = runs.join(
        sized_broadcast(index.items.select("item", F.least(F.lit(width), "n_terms").alias("width")), BROADCAST_TERMS), "item"
    )
    return whole.where("length >= width").select("doc", "pos", "item")


def proximity_hits(index: Index, width: int = WINDOW, span: int = 20, terms: int = 3) -> DataFrame:
    """``(doc, item, first, pos)``: places where the ``terms`` rarest terms of a window lie within ``span`` words.

    In any order; pos is that of the rarest. Windows of fewer terms need all of
    theirs. Lists meet by blocks of ``span`` positions, a term's own block and
    its neighbours, so no list is paired with a whole other.
    """
    windows = kept_table(_windows(index, width).where(F.col("rank") <= terms), "rare")
    lists = index.postings.join(sized_broadcast(windows.select("item", "first", "rank", "term_id"), BROADCAST_TERMS), "term_id")
    near = lists.where("rank = 1").select("doc", "item", "first", "pos")
    counted = windows.groupBy("item", "first").agg(F.count("*").alias("n"))
    for rank in range(2, terms + 1):
        other = lists.where(F.col("rank") == rank).select("doc", "item", "first", F.col("pos").alias("other"))
        blocks = near.withColumn("block", F.explode(F.array(*[F.floor(F.col("pos") / span) + d for d in (-1, 0, 1)])))
        found = (
            blocks.join(other.withColumn("block", F.floor(F.col("other") / span)), ["doc", "item", "first", "block"])
            .where(F.abs(F.col("pos") - F.col("other")) <= span)
            .select("doc", "item", "first", "pos")
            .distinct()
        )
        short = near.join(counted.where(F.col("n") < rank), ["item", "first"], "left_semi").select(*near.columns)
        near = found.unionByName(short)
    return near


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and are hit by nothing, as is every text
    when the benchmark has no words. Rows that repeat a doc_id, and rows without
    one, are each judged by their own text; ``text_hash`` tells them apart. An item without an item_id is
    written as an empty string; items that repeat an id count once. Other
    columns are ignored, an empty table gives an empty result.
    """
    index = build_index(docs, benchmark)
    hits = phrase_hits(index, width)
    named = hits.join(sized_broadcast(index.items.select("item", "item_id"), BROADCAST_TERMS), "item")
    item_id = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    summary = named.groupBy("doc").agg(
        F.countDistinct("pos").alias("n_hit"), F.array_sort(F.collect_set(item_id)).alias("item_ids")
    )
    counted = docs.select("doc_id", _doc().alias("doc"), F.size(_any_case_words(F.col("text"))).alias("n"))
    joined = counted.join(summary, "doc", "left")
    items = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.col("doc.text_hash").alias("text_hash"),
    )
