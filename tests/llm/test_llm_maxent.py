import math
import zlib
from collections import Counter

import numpy as np
from conftest import SF_DIR
from llm_tables import by_id, documents

from skytally.llm import maxent
from skytally.llm.common import words_of


def tokens(text):
    return [*words_of(text), None]


def base_scores(train, rows):
    counts = Counter(t for text in train for t in tokens(text))
    total = sum(counts.values()) + 0.5 * (len(counts) + 1)
    out = {}
    for doc_id, text in rows:
        found = tokens(text)
        score = sum(math.log10((counts.get(t, 0) + 0.5) / total) for t in found)
        out[doc_id] = (len(found), sum(t in counts for t in found), score)
    return out, sum(counts.values())


def check(found, expected):
    assert set(found) == set(expected)
    for doc_id, (n, known, base) in expected.items():
        row = found[doc_id]
        assert (row.n_tokens, row.n_known) == (n, known)
        assert math.isclose(row.base_score, base, rel_tol=1e-9, abs_tol=1e-9)


def test_query_equals_brute_force_and_beats_the_base_on_held_out_texts(spark):
    from skytally.llm.queries import QUERIES

    found = by_id(QUERIES["op7_hashed_maxent"](spark, SF_DIR))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    expected, total = base_scores([t for i, t in rows if not held_out[i]], rows)
    check(found, expected)
    assert {r.train_tokens for r in found.values()} == {total}
    assert all(r.held_out == held_out[i] for i, r in found.items())
    mine = [r for i, r in found.items() if held_out[i]]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


ROWS = [
    (1, "the cat sat on the mat"),
    (2, "The DOG sat\ton\x0bthe log"),
    (3, None),
    (4, ""),
    (5, "é É ñ o"),
    (6, "the cat " * 30000),
    (7, "the cat sat on the mat"),
    (7, "the cat sat on the mat"),
    (8, "unseen words only"),
]


def test_words_beyond_the_head_are_looked_up(spark):
    train = documents(spark, ROWS[:7])
    for size in (0, 3, 1 << 17):
        model = maxent.train(train, updates=3, head_size=size)
        assert len(model.head) <= size + 1
        expected, _ = base_scores([t for _, t in ROWS[:7]], ROWS)
        check(by_id(maxent.score(documents(spark, ROWS), model)), expected)


def test_probabilities_sum_to_one(spark):
    model = maxent.train(documents(spark, ROWS[:7]), updates=5)
    histories = np.arange(0, maxent.CLASSES**2, 977)
    assert np.allclose(np.exp(maxent.log_probabilities(model.weights, model.bias, histories)).sum(axis=1), 1, atol=1e-4)
    # Within a class: the counts of its words, and of one unknown word where the class is shared.
    table, shares = maxent._classes(model.head), np.zeros(maxent.CLASSES)
    np.add.at(shares, table[: len(model.head)], model.head_counts + maxent.SMOOTHING)
    shares[maxent.OWN :] += maxent.SMOOTHING
    assert np.allclose(shares, model.mass)


def test_histories_are_worked_out_once_for_all_texts_of_a_worker(spark, monkeypatch):
    model = maxent.train(documents(spark, ROWS[:7]), updates=3)
    plain, asked = maxent.log_probabilities, []
    monkeypatch.setattr(maxent, "log_probabilities", lambda w, b, h: (asked.extend(h.tolist()), plain(w, b, h))[1])
    scored = maxent._scorer(model)
    texts = ["the cat sat on the mat", "on the mat the cat sat", None, "the cat sat on the mat"]
    gains = [scored(text)[3] for text in texts]
    assert gains[0] == gains[3] and len(asked) == len(set(asked)) > 5
    table = maxent._classes(model.head)
    for text, gain in zip(texts, gains):
        classes = table[maxent._codes(model.head)(words_of(text) + [maxent.END])]
        histories = maxent._histories(classes, int(table[model.head[maxent.END]]))
        logs = plain(model.weights, model.bias, histories)[np.arange(len(classes)), classes] / math.log(10)
        assert math.isclose(gain, (logs - np.log10(model.mass[classes] / model.total)).sum(), rel_tol=1e-4, abs_tol=1e-5)


def test_order_matters_after_training(spark):
    train = documents(spark, [(n, "a b c d e f " * 40) for n in range(20)])
    model = maxent.train(train)
    found = by_id(maxent.score(documents(spark, [(1, "a b c d e f " * 5), (2, "f d b a c e " * 5)]), model))
    assert math.isclose(found[1].base_score, found[2].base_score)
    assert found[1].score > found[1].base_score > found[2].score


def test_empty_tables(spark):
    assert maxent.train(documents(spark, [])) is None
    row = maxent.score(documents(spark, [(1, "a b")]), None).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)
    model = maxent.train(documents(spark, [(1, None)]), updates=2)
    assert maxent.score(documents(spark, []), model).count() == 0
    assert maxent.score(documents(spark, [(1, None)]), model).first().n_known == 1
