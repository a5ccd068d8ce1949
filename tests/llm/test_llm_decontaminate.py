import hashlib
import re

from llm_tables import by_id, documents, prose

from skytally.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(text, items, width=10):
    doc, hit, met = words(text), set(), set()
    for item_id, item in items:
        test = words(item)
        size = min(width, len(test))
        for first in range(len(test) - size + 1 if test else 0):
            for start in range(len(doc) - size + 1):
                if doc[start : start + size] == test[first : first + size]:
                    hit.update(range(start, start + size))
                    met.add("" if item_id is None else str(item_id))
    return len(doc), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def benchmark(spark, items):
    return spark.createDataFrame([(*i, "w", 3) for i in items], "item_id long, text string, term string, pos long")


ITEMS = [
    (10, prose(1, 40, 60)),
    (9, prose(2, 10, 60)),
    (8, "Short item, here!"),
    (7, None),
    (6, "..."),
    (5, "the the the the the the the the the the the the"),
    (4, prose(1, 40, 60)),
    (3, "É été ñ 42"),
    (3, "other words of three"),
]


def rows():
    long, ten = ITEMS[0][1].split(), ITEMS[1][1]
    yield 1, prose(5, 300, 60) + " " + " ".join(long[5:18]).upper() + ". " + prose(6, 50, 60)
    yield 2, " ".join(long[5:14])
    yield 3, f"a {ten} b {ten} c"
    yield 4, "a short item here. SHORT-ITEM/here"
    yield 5, "the " * 30
    yield 6, "the " * 9
    yield 7, None
    yield 8, ""
    yield 9, "É été ñ 42 and é été ñ 42"
    yield 10, ("filler " * 5000) + " ".join(long) + (" filler" * 5000)
    yield 11, " ".join(long[3:20] + long[10:25] + long[:12])
    yield 12, ten + " " + ten


def as_tuples(table):
    return {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in by_id(table).items()}


def test_equals_brute_force(spark):
    found = decontaminate.contamination(documents(spark, list(rows())), benchmark(spark, ITEMS))
    assert as_tuples(found) == {i: brute_force(t, ITEMS) for i, t in rows()}


def test_wide_keys_take_the_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_DOCS", 0)
    found = decontaminate.contamination(documents(spark, list(rows())), benchmark(spark, ITEMS))
    assert as_tuples(found) == {i: brute_force(t, ITEMS) for i, t in rows()}


def test_null_and_repeated_ids_and_empty_tables(spark):
    docs = documents(spark, [(None, ITEMS[1][1]), (1, ITEMS[1][1]), (1, ITEMS[1][1]), (2, "clean")])
    found = decontaminate.contamination(docs, benchmark(spark, [*ITEMS, (None, "clean")])).collect()
    assert sorted((repr(r.doc_id), r.n_hit, r.n_items) for r in found) == [("1", 10, 1), ("1", 10, 1), ("2", 1, 1), ("None", 10, 1)]
    assert decontaminate.contamination(documents(spark, []), benchmark(spark, ITEMS)).count() == 0
    # Rows that share an id, or have none, are judged each by its own text.
    mixed = documents(spark, [(i, t) for i in (7, None) for t in (ITEMS[1][1], "clean", None)])
    found = decontaminate.contamination(mixed, benchmark(spark, ITEMS)).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_hit) for r in found) == sorted(
        (i, n, hit) for i in ("7", "None") for n, hit in ((len(ITEMS[1][1].split()), 10), (1, 0), (0, 0))
    )
    clean = decontaminate.contamination(docs, benchmark(spark, [])).collect()
    assert len(clean) == 4 and not any(r.contaminated for r in clean)


def test_proximity(spark):
    items = [(1, "alpha beta gamma common common common common common common common")]
    texts = [
        (1, "common alpha x x beta y gamma common"),
        (2, "alpha " + "common " * 60 + "beta gamma"),
        (3, "gamma beta x alpha"),
        (4, "alpha beta"),
    ]
    index = decontaminate.build_index(documents(spark, texts), benchmark(spark, items))
    assert {r.doc.id for r in decontaminate.proximity_hits(index, span=10).collect()} == {1, 3}
    assert {r.doc.id for r in decontaminate.proximity_hits(index, span=80).collect()} == {1, 2, 3}


def test_texts_are_split_in_one_pass(spark):
    texts = ["", " ", "a", " Éa-B  c.", "x\x00y\x7fz\u0085w", "\U0001f600a b", "[A]`{z}", None]
    docs = documents(spark, list(enumerate(texts)))
    split = docs.select("doc_id", decontaminate._words("text").alias("words"))
    assert {r.doc_id: r.words for r in split.collect()} == {n: t if t is None else words(t) for n, t in enumerate(texts)}
    # Extracting all matches copies the text for every word.
    plan = decontaminate.contamination(docs, benchmark(spark, ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan
