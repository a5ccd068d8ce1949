import random
from itertools import combinations

import pytest
from conftest import SF_DIR
from llm_tables import by_id, documents, prose

from skytally.llm import minhash
from skytally.llm.common import words_of


def brute_force(rows, width):
    """Components over every pair of texts that differ, on sets of word tuples."""
    sets = {}
    for doc_id, text in rows:
        words = words_of(text)
        size = min(width, len(words))
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force_on_the_tables(spark, width):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = brute_force([(r.doc_id, r.text) for r in docs.collect()], width)
    found = by_id(minhash.near_duplicates(docs, width=width))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected
    assert all(r.kept == (r.component_id == i) for i, r in found.items())


def test_group_of_near_copies_with_a_centre_none_of_them_is(spark):
    rng = random.Random(2)
    base = prose(1, 300, 5000).split()
    rows = [(1000, " ".join(base))]
    for n in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 22)):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(words)))
    rows += [(2000 + n, prose(50 + n, 200, 5000)) for n in range(40)]
    expected = brute_force(rows, 2)
    found = by_id(minhash.near_duplicates(documents(spark, rows), width=2))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected


def test_chain_of_copies_is_one_class(spark):
    words, rows = prose(9, 200, 5000).split(), []
    for n in range(12):
        rows.append((n, " ".join(words)))
        for k in range(8):
            words[(n * 8 + k) * 2 % 200] = f"n{n}k{k}"
    assert {r.component_id for r in minhash.near_duplicates(documents(spark, rows), width=2).collect()} == {0}


def test_odd_rows(spark):
    long = "a b c " * 50000
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, long), (8, long + " end"),
        (9, "É é"), (10, "é é"), (11, "x y z"), (11, "x y z"), (None, "x y z"), (12, "p q r s"), (13, "t u v w"), (12, "t u v w"),
    ]
    table = minhash.near_duplicates(documents(spark, rows), width=2).collect()
    assert len(table) == len(rows)
    found = {r.doc_id: r for r in table}
    assert [found[n].n_shingles for n in (1, 2, 3, 4, 6, 7)] == [0, 0, 0, 1, 1, 3]
    assert [found[n].component_id for n in (1, 2, 3, 4, 5, 6, 9, 10, 11)] == [1, 2, 3, 4, 4, 6, 9, 10, 11]
    assert found[8].component_id == 8 and found[7].component_id == 7
    assert found[None].component_id is None and found[None].kept
    assert found[13].component_id == 12
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    assert minhash.near_duplicates(documents(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_large_buckets_whose_first_members_link_with_nothing(spark):
    """Texts around one passage, 0.797 alike, hold every bucket's first ranks; only the pairs after them are 0.805 alike."""
    passage = prose(73, 200, 5000)
    rows = [(n, passage + " " + prose(73000 + n, 25, 10**6)) for n in range(30)]
    for n in range(6):
        both = prose(73200 + n, 2, 10**6)
        rows += [(100 + 10 * n + k, f"{passage} {both} {prose(73300 + 10 * n + k, 24, 10**6)}") for k in range(2)]
    expected = brute_force(rows, 5)
    assert [i for i, (_, c) in expected.items() if c != i] == [101 + 10 * n for n in range(6)]
    found = by_id(minhash.near_duplicates(documents(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected


def test_three_thousand_texts_around_one_passage_make_no_pairs(spark, monkeypatch):
    """All 0.78 alike and in the same buckets; of 3,000, only the planted pairs reach the full sets."""
    passage = prose(74, 100, 5000)
    rows = [(n, f"{passage} {prose(74000 + n, 14, 10**6)}") for n in range(3000)]
    rows += [(5000 + n, f"{passage} {prose(74000 + n, 14, 10**6)} end") for n in range(5)]
    counted = []
    original = minhash._overlapping

    def overlapping(firsts, similarity):
        pairs = original(firsts, similarity)
        counted.append((firsts.select("node").distinct().count(), pairs.count()))
        return pairs

    monkeypatch.setattr(minhash, "_overlapping", overlapping)
    found = by_id(minhash.near_duplicates(documents(spark, rows), width=5))
    assert {i: r.component_id for i, r in found.items() if r.component_id != i} == {5000 + n: n for n in range(5)}
    assert counted and counted[0][0] > 2000 and counted[0][1] < 1000


def test_differences_find_every_pair_that_is_not_linked_with_the_centre(spark):
    """Against all pairs, for random edits of one text at many distances from it."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    parents = [base]
    for n in range(1, 260):
        words = list(rng.choice(parents))
        for _ in range(rng.choice((1, 3, 6, 9, 14))):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(3)] = [f"e{rng.randrange(40)}"] * rng.randrange(1, 3)
        parents.append(words)
        rows.append((n, " ".join(words)))
    expected = brute_force(rows, 2)
    found = by_id(minhash.near_duplicates(documents(spark, rows), width=2))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected
