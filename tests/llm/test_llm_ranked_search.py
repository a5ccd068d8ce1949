"""Ranked search against brute force; blocks are skipped only where that loses nothing."""

import math
import random
import re
from collections import Counter

import pytest
from llm_tables import documents, prose
from pyspark.sql import functions as F

from skytally.llm import ranked_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(docs, items):
    listed = [(i, Counter(w), len(w)) for i, w in ((r[0], words(r[1])) for r in docs) if w]
    n, length, df = len(listed), sum(r[2] for r in listed), Counter()
    for _, counts, _ in listed:
        df.update(counts.keys())
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(words(text))
    found = set()
    for item, terms in asked.items():
        scores = []
        for doc, counts, size in listed:
            m = 100 - 75 + ((75 * size * n) // length)
            score = sum(
                mult * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, mult in terms.items()
                if t in counts
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found |= {(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:10], 1)}
    return found


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, doc_id long, term string")


def found(spark, docs, items, **options):
    rows = ranked_search.search(documents(spark, docs), items_of(spark, items), **options).collect()
    assert len({tuple(r) for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


ODD = [
    (900, None),
    (901, ""),
    (902, "!!! ?"),
    (903, "Ä ä É 9 a-b_c W001"),
    (None, "w001 w002 w003"),
    (None, None),
    (5, prose(5, 30)),
    (5, prose(5, 30)),
    (904, "w001 " * 3000),
]
ITEMS = [(1, prose(5, 12)), (2, "W001 w001 ä"), (3, None), (4, "nowhere"), (None, "w002 w003"), (2, "w004"), (6, prose(77, 40))]


def mixed(n, vocabulary=300):
    rng = random.Random(9)
    rows = [(i, prose(i, rng.choice([1, 5, 40, 150]), vocabulary)) for i in range(n)]
    return rows + [(100_000 + i, prose(5, 30, vocabulary)) for i in range(60)] + ODD


@pytest.mark.parametrize("seed_docs", [0, 20, 10_000])
def test_equals_brute_force(spark, seed_docs):
    docs = mixed(250)
    assert found(spark, docs, ITEMS, seed_docs=seed_docs) == brute(docs, ITEMS)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 3)
    docs = mixed(120)
    assert found(spark, docs, ITEMS) == brute(docs, ITEMS)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == found(spark, ODD[:3], ITEMS) == found(spark, mixed(5), []) == set()
    assert found(spark, mixed(5), [(1, ""), (2, None)]) == set()


def test_blocks_bound_their_documents_and_many_are_skipped(spark, monkeypatch):
    """Every document's score is below the bound of its block in the list of its rarest term."""
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 4)
    docs = mixed(880, 2000)
    items = [(i, prose(5000 + i, 20, 2000)) for i in range(6)]
    frame = documents(spark, docs)
    terms = ranked_search.item_terms(items_of(spark, items))
    rows = terms.collect()
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({r.term for r in rows}))}
    listed = ranked_search.vectors(frame, vocabulary).withColumn("row", F.monotonically_increasing_id())
    size = listed.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    norm = F.expr(f"25 + (75 * n * {size.documents}L) div {size.terms}L")
    stored = listed.select("row", "doc_id", norm.alias("m"), "tids", "tfs").persist()
    searched = ranked_search._prepared(stored, rows, vocabulary, [i for i, _ in items])
    made = ranked_search.blocks(stored, searched).persist()
    every = ranked_search.bounds(made, searched).collect()
    reached = {}
    for block in every:
        for row in block.rows:
            key = block.item, row
            reached[key] = max(block.bound, reached.get(key, 0))
    ids = {r.doc_id: r.row for r in stored.select("doc_id", "row").collect() if r.doc_id is not None}
    best = brute(docs, items)
    assert best and all(reached[item, ids[doc]] >= score for item, _, doc, score in best if doc not in (None, 5))
    for item, rank, _, score in best:
        if rank == 10:
            searched.floor[item] = score
    looked = ranked_search.bounds(made, searched).select("item", F.explode("rows")).distinct().count()
    assert looked < 0.5 * len(reached)


def test_copies_that_tie_are_ranked_by_id(spark):
    docs = [(i, "alpha beta gamma") for i in range(400, 0, -1)] + [(500, "delta"), (501, "delta beta")]
    items = [(1, "alpha beta"), (2, "beta delta")]
    result = found(spark, docs, items, seed_docs=5)
    assert result == brute(docs, items)
    assert {doc for item, _, doc, _ in result if item == 1} == set(range(1, 11))
