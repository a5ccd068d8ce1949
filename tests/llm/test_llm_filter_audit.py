"""The audit against brute force, whatever the order in which the files arrive."""

import itertools
import random
from collections import Counter

import pytest
from llm_tables import prose

from skytally.llm import filter_audit

ORDERS = ["".join(p) for p in itertools.permutations("ABCDE")]
SCHEMA = "doc_id long, text string, lang string, mask string, part string, n long"


def brute(rows, labels):
    """Every count by applying every order to every row."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    counts = {(lang or "", o, s): Counter(dict.fromkeys(names, 0)) for _, _, lang in rows for o in ORDERS for s in range(1, 6)}
    shapley = Counter()
    for doc_id, text, lang in rows:
        text, part = text or "", lang or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and least[text] < doc_id,
        }
        for order in ORDERS:
            gone = False
            for step, letter in enumerate(order, 1):
                row = counts[part, order, step]
                removed = fails[letter] and not gone
                row["removed"] += removed
                row["redundant"] += fails[letter] and gone
                row["unique_fails"] += fails[letter] and sum(fails.values()) == 1
                row["good_lost"] += removed and doc_id in good
                row["toxic_lost"] += removed and doc_id in toxic
                shapley[part, letter] += removed
                gone = gone or fails[letter]
                row["kept"] += not gone
    for (part, order, step), row in counts.items():
        row["shapley"] = shapley[part, order[step - 1]]
    return {key: tuple(row[n] for n in names) for key, row in counts.items()}


def rows_of(frame):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in frame.collect()
    }


def written(spark, path, files):
    for rows in files:
        full = [(i, t, lang, "m", "p", 7) for i, t, lang in rows]
        spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def corpus():
    texts = [None, "", "a", "A B", "# x", prose(1, 130), prose(2, 130, 30), prose(3, 130).upper(), prose(4, 120) + " $", "é" * 3]
    rng = random.Random(5)
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None])) for i in range(120)]
    rows += [(None, "a", "en"), (None, "a", None), (7, "a", "de"), (7, "a", "en"), (-3, "a", "de"), (-3, "a", "de")]
    rng.shuffle(rows)
    return rows


LABELS = [(i, i % 2, i % 3 == 0) for i in range(0, 120, 2)] + [(3, None, 1), (3, 1, None), (None, 1, 1)]


def labels_of(spark):
    return spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in LABELS], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("order", [1, -1])
def test_equals_brute_force_in_any_order_of_files(spark, tmp_path, order):
    rows = sorted(corpus(), key=lambda r: order * (r[0] or 0))
    files = [rows[i : i + 30] for i in range(0, len(rows), 30)]
    written(spark, str(tmp_path / "documents"), files)
    found = rows_of(filter_audit.audit(spark, str(tmp_path / "documents"), labels_of(spark), batches=5))
    assert found == brute(rows, LABELS)
    assert len(found) == 3 * 600


def test_new_files_are_added_to_kept_counters(spark, tmp_path):
    rows = sorted(corpus(), key=lambda r: -(r[0] or 0))
    path, folder = str(tmp_path / "documents"), str(tmp_path / "kept")
    for part in (rows[:40], rows[40:]):
        written(spark, path, [part])
        counters = filter_audit.counted(spark, path, labels_of(spark), folder, buckets=3)
    assert rows_of(filter_audit.interactions(counters)) == brute(rows, LABELS)


def test_one_file_and_no_rows(spark, tmp_path):
    written(spark, str(tmp_path / "none"), [[]])
    assert filter_audit.audit(spark, str(tmp_path / "none"), labels_of(spark)).count() == 0
    written(spark, str(tmp_path / "one"), [[(1, "a", "en")]])
    part = next((tmp_path / "one").glob("part-*"))
    assert filter_audit.audit(spark, str(part), labels_of(spark).limit(0)).count() == 600


def test_a_smaller_id_retracts_its_predecessor():
    state = {}

    def change(doc_id):
        rows = [(0, "d", "en", 1, False, False, 1, True, doc_id, 1)]
        return {key: n for key, n in filter_audit.updated(state, rows).items() if n}

    assert change(9) == {("en", 1, False, False): 1}
    assert change(4) == {("en", 17, False, False): 1} and state["d"][0] == 4
    assert change(6) == {("en", 17, False, False): 1} and state["d"][0] == 4
    assert change(4) == {("en", 1, False, False): 1}


def test_a_common_text_reaches_its_state_as_few_rows(spark):
    rows = spark.range(30000).selectExpr(
        "id AS doc_id", "'en' AS part", "1 AS mask", "if(id % 3 = 0, 'ff' || repeat('0', 62), sha2(string(id), 256)) AS digest",
        "false AS good", "false AS toxic",
    )
    made = filter_audit.folded(rows, 8)
    hot = made.where("digest LIKE 'ff0000%'").collect()
    assert len(hot) <= rows.rdd.getNumPartitions() and sum(r.n for r in hot) == 10000 and min(r.least for r in hot) == 0
