import hashlib
import random

import pytest
from conftest import SF_DIR
from llm_tables import by_id, documents, prose

from skytally.llm import simhash


def edited(texts):
    """texts: (doc_id, text) in order."""
    out = {}
    for n, (doc_id, text) in enumerate(texts):
        text, after = text or "", texts[(n + 1) % len(texts)][1] or ""
        half = len(text) // 2
        out[doc_id] = text[: len(text) - half] + after[:half]
    return out


def print_of(row, field="fingerprint"):
    return int(getattr(row, field), 16)


def check(rows, found):
    expected = edited(rows)
    assert set(found) == set(expected)
    for n, (doc_id, text) in enumerate(rows):
        row = found[doc_id]
        assert row.n_chars == len(text or "")
        assert row.edited_sha256 == hashlib.sha256(expected[doc_id].encode()).hexdigest()
        after = found[rows[(n + 1) % len(rows)][0]]
        assert row.near_edited == 1 - (print_of(row) ^ print_of(row, "edited_fingerprint")).bit_count() / 128
        assert row.near_next == 1 - (print_of(row) ^ print_of(after)).bit_count() / 128


def test_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    found = by_id(simhash.edited_fingerprints(docs))
    check(rows, found)
    prints = {}
    for doc_id, text in rows:
        assert prints.setdefault(text, found[doc_id].fingerprint) == found[doc_id].fingerprint
    nearer = [r.near_edited > r.near_next for r in found.values()]
    assert sum(nearer) / len(nearer) > 0.9
    for doc_id, row in found.items():
        near = sum((print_of(row) ^ print_of(o)).bit_count() <= simhash.RADIUS for o in found.values()) - 1
        assert row.n_near == (near if doc_id % 100 == 0 else None)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "é🙂漢"), (5, "one"), (7, prose(1, 30000)), (9, "  a  b "), (11, "a b"), (100, "a b")]
    check(rows, by_id(simhash.edited_fingerprints(documents(spark, rows))))
    one = simhash.edited_fingerprints(documents(spark, [(4, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert simhash.edited_fingerprints(documents(spark, [])).count() == 0


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "q r"), (2, "x y z"), (2, "u v w"), (3, "a b c")]
    table = simhash.edited_fingerprints(documents(spark, rows)).collect()
    assert sorted(repr(r.doc_id) for r in table) == sorted(repr(i) for i, _ in rows)
    ones = [r for r in table if r.doc_id == 1]
    assert ones[0] == ones[1]
    missing = next(r for r in table if r.doc_id is None)
    assert missing.edited_sha256 == hashlib.sha256(b"qra").hexdigest().replace("", "") or missing.n_chars == 3


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_search_finds_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(128) for _ in range(60)]
    for base in prints[:20]:
        for _ in range(12):
            near = base
            for bit in rng.sample(range(128), rng.randint(1, 8)):
                near ^= 1 << bit
            prints.append(near)

    def signed(n):
        return n - (1 << 64) if n >> 63 else n

    rows = [(signed(p >> 64), signed(p & (2**64 - 1))) for p in prints]
    table = spark.createDataFrame(rows + rows[:5], "f0 long, f1 long")
    queries = spark.createDataFrame(rows[:20], "f0 long, f1 long")
    found = {tuple(r) for r in simhash.within_radius(queries, table, radius).collect()}
    expected = {
        (*rows[q], *rows[p]) for q in range(20) for p in range(len(prints)) if (prints[q] ^ prints[p]).bit_count() <= radius
    }
    assert found == expected
