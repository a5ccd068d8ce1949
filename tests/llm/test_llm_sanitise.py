import hashlib
import random
import re

from conftest import SF_DIR
from llm_tables import by_id, documents

from skytally.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute_force(text):
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            valid = {
                "email": lambda: True,
                "ip": lambda m=match: all(int(part) <= 255 for part in m.group().split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]
            if valid():
                found.append((match.start(), number, kind, match.end()))
    return sorted(found)


def expected(text):
    spans = brute_force(text)
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
    return hashlib.sha256(listed.encode()).hexdigest(), *[sum(s[2] == kind for s in spans) for kind in PATTERNS]


def report(df):
    return {i: (r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for i, r in by_id(sanitise.report(df)).items()}


def test_equals_brute_force_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert report(docs) == {r.doc_id: expected(r.text) for r in docs.select("doc_id", "text").collect()}


def test_equals_brute_force_on_odd_texts(spark):
    rng = random.Random(5)
    letters = "ab.@-_ +1230459  ()é🙂\n"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))) for i in range(1500)]
    rows += [
        (3001, None), (3002, ""), (3003, "1 2 " * 5000), (3004, "a.b@" * 5000), (3005, "1." * 9000), (3006, "x" * 5000),
        (3007, "4111 1111 1111 1111 a@b.co" * 300), (3008, "+" * 9000), (3009, "+1-" * 5000), (3010, "a@b." + "c." * 5000 + "d"),
        (3011, "0256.1.1.1 00255.1.1.1 1.2.3.4.5"), (3012, "a@b.c_x@d.e"),
    ]
    assert report(documents(spark, rows)) == {i: expected(t) for i, t in rows}


def test_linear_in_a_long_run(spark):
    rows = [(1, "x" * 400_000), (2, "1" * 400_000), (3, "1 " * 200_000)]
    assert all(counts[1:] == (0, 0, 0, 0) for counts in report(documents(spark, rows)).values())


def told(spark):
    filler = [f"zz{n} yy{n} xx{n}" for n in range(400)]
    rows = [(n, f"{filler[n]} quill at a.b@c.de and the rest {filler[n + 100]}") for n in range(6)]
    rows += [(100 + n, f"the rest of it and at {filler[n]} and the rest at") for n in range(200)]
    return documents(spark, rows)


def test_terms_that_reveal_an_entity(spark):
    docs = told(spark)
    found = by_id(sanitise.report(docs))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for n in range(6):
        terms = [s.split(":") for s in found[n].spans.split(",") if s.startswith("term")]
        assert [texts[n][int(a) : int(b)] for _, a, b in terms] == ["quill"]
        assert found[n].n_email == 1
    assert all(found[100 + n].spans == "" for n in range(200))


def test_copies_are_no_evidence(spark):
    docs = documents(spark, [(n, "quill wrote to a.b@c.de today") for n in range(9)])
    assert {r.spans for r in sanitise.report(docs).collect()} == {"email:15:23"}


def test_sanitised_text_keeps_columns_and_rows(spark):
    rows = [
        (1, "mail me a.b@c.de now or 10.0.0.1 x"), (2, None), (3, "clean é"), (4, ""), (5, "+1 202 555 0199 or +12025550199"),
        (6, "é🙂 a@b.cd é"), (6, "é🙂 a@b.cd é"), (None, "a@b.cd"), (7, "4111 1111 1111 1111@x.yz"),
    ]
    docs = documents(spark, rows)
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    found = sorted(((repr(r.doc_id), r.text, r.n_chars) for r in out.collect()), key=repr)
    texts = {
        "1": "mail me [EMAIL] now or [IP] x", "3": "clean é", "4": "", "5": "[PHONE] or [PHONE]", "6": "é🙂 [EMAIL] é",
        "None": "[EMAIL]", "7": "[CARD]",
    }
    expect = [(i, t, len(t)) for i, t in texts.items()] + [("6", texts["6"], len(texts["6"])), ("2", None, 0)]
    assert found == sorted(expect, key=repr)
    revealing = {r.doc_id: r.text for r in sanitise.sanitised(told(spark)).collect()}
    assert all("quill" not in revealing[n] and "a.b@c.de" not in revealing[n] for n in range(6))
    assert sanitise.sanitised(documents(spark, [])).count() == sanitise.report(documents(spark, [])).count() == 0


def test_terms_far_from_the_entity_and_without_it(spark):
    """The name stands in the greeting, the address in the signature; one text has the name alone."""
    far = " and the rest of it" * 6
    rows = [(n, f"Quill zz{n},{far} {'it ' * n}a.b@c.de") for n in range(6)]
    rows += [(50, "and then quill said the rest, Quill")]
    rows += [(100 + n, f"the rest of it and at zz{n} and the rest at") for n in range(1000)]
    docs = documents(spark, rows)
    texts, found = dict(rows), by_id(sanitise.report(docs))
    terms = {
        i: [texts[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"]
        for i, r in found.items()
    }
    expect = {**{i: [] for i in texts}, **{n: ["Quill"] for n in range(6)}, 50: ["quill", "Quill"]}
    assert terms == expect
    assert all("quill" not in (r.text or "").lower() for r in sanitise.sanitised(docs).collect())
