import itertools
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR
from llm_tables import by_id, documents, prose

from skytally.llm import common, toxicity

PLAIN = "the quiet river ran past a green field while people walked home and talked about bread "
BAD = ("wretch", "scoundrel", "vermin", "blighter")


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for n in range(160):
        words = (PLAIN * 2).split() + prose(n, 10).split()
        if n % 4 == 0:
            words[5 + n % 9] = BAD[n // 4 % 4]
            words[25] = BAD[(n // 4 + 1) % 4]
        rows.append((n, " ".join(words)))
    return documents(spark, rows)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(n, 1, int(n % 4 == 0), "x") for n in range(160)]
    rows += [(4, 0, 0, "x"), (500, 1, 1, "x"), (None, 1, 1, "x"), (7, 1, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def model(table, labels):
    return toxicity.fit(table, labels)


@pytest.mark.parametrize(
    "disguise, word",
    [
        ("5c0undr3l", "scoundrel"), ("w r e t c h", "wretch"), ("wrrrretchhh", "wretch"), ("v.e.r.m.i.n", "vermin"),
        ("b-l-i-g-h-t-e-r", "blighter"), ("verm!n", "vermin"), ("$coundre1", "scoundrel"), ("w_r_e_t_c_h", "wretch"),
    ],
)
def test_disguised_words_are_restored(model, disguise, word):
    assert toxicity.Restorer(model.trigrams).decode(toxicity.stripped(disguise)) == word


def test_plain_words_stay(model):
    restorer = toxicity.Restorer(model.trigrams)
    for word in (PLAIN + "été über").split():
        assert restorer.words_of(word) == (word,)
    assert restorer.words_of('"Bread!!"') == ("bread",) and restorer.words_of("...") == ()


def test_scores(spark, model):
    rows = [
        (1, PLAIN), (2, PLAIN + "you wretch and vermin " + PLAIN), (3, PLAIN + "v3rm1n s c o u n d r e l " + PLAIN),
        (4, None), (5, ""), (6, PLAIN * 3000), (7, PLAIN * 2000 + " wretch scoundrel"), (8, "7" * 5000), (2, PLAIN),
    ]
    table = documents(spark, rows)
    found = {}
    for row in toxicity.score(table, model).collect():
        found.setdefault(row.doc_id, []).append(row.score)
    assert all(0 <= s <= 1 for scores in found.values() for s in scores)
    assert {i for i, s in found.items() if max(s) >= toxicity.THRESHOLD} == {2, 3, 7}
    assert found[4] == found[5] and len(found[2]) == 2
    kept = toxicity.accepted(table, model)
    assert kept.dtypes == table.dtypes
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6, 8]


def test_restored_text(spark, model):
    out = by_id(toxicity.restored(documents(spark, [(1, "Past the v3rm1n, w r e t c h home"), (2, None), (3, "")]), model.trigrams))
    assert (out[1].text, out[2].text, out[3].text) == ("Past the vermin wretch home", None, "")


def test_no_labels_and_empty_tables(spark, table, labels):
    unlearned = toxicity.fit(table, labels.limit(0))
    assert {r.score for r in toxicity.score(table, unlearned).collect()} == {0.5}
    nothing = toxicity.fit(documents(spark, []), labels)
    assert toxicity.score(documents(spark, []), nothing).count() == 0
    assert toxicity.score(documents(spark, [(1, "a")]), nothing).first().score == 0.5


def test_query_on_held_out_rows(spark):
    from skytally.llm.queries import QUERIES

    found = by_id(QUERIES["op1_disguised_toxicity"](spark, SF_DIR))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    clean = [found[r.doc_id].predicted for r in labels if r.toxic == 0 and r.doc_id in found and found[r.doc_id].held_out]
    assert sum(clean) <= 0.05 * len(clean)
    assert all(r.predicted == int(r.score >= 0.7) for r in found.values())


@pytest.mark.parametrize("token", ["!" * 10_000 + "a", "." * 40 + "12", "chapter" + "." * 24 + "12", "a" + "!?" * 5000, "$" * 9000])
def test_runs_of_signs_take_no_time(token):
    begin = time.perf_counter()
    toxicity.stripped(token)
    assert time.perf_counter() - begin < 0.2


@pytest.mark.parametrize(
    ("token", "word"),
    [("word", "word"), ('"Word!"', "word"), ("(word),", "word"), ("word...", "word"), ("--word--", "word"), ("a$$", "a"), ("...", "..."[:0])],
)
def test_ends_are_stripped(token, word):
    assert toxicity.stripped(token) == word


def test_disguises_at_the_ends_of_words():
    said = "idiot stupid piss ass cunt idiot the word letter is all but good and that was an idiot in a class of stupid".split()
    grams = Counter()
    for word in said * 50:
        shown = f"  {word} "
        grams.update(shown[i : i + 3] for i in range(len(shown) - 2))
    restorer = toxicity.Restorer(grams)
    for token, word in [("|diot", "idiot"), ("*diot", "idiot"), ("(unt", "cunt"), ("pi$$", "piss"), ("a$$", "ass"),
                        ("iddiot", "idiot"), ("stupiid!", "stupid"), ("(idiot)!!", "idiot"), ("letter!", "letter")]:
        assert word in restorer.words_of(token), (token, restorer.words_of(token))


def test_decoding_finds_the_cheapest_of_all_readings():
    """Against every combination of readings, for short tokens."""
    grams = Counter()
    for word in "bad cat tin lot bee see".split():
        shown = f"  {word} "
        grams.update({shown[i : i + 3]: 9 for i in range(len(shown) - 2)})
    restorer = toxicity.Restorer(grams)

    def price(characters, chosen):
        text, total = "  ", 0.0
        for letter, paid in chosen:
            total += paid
            if letter:
                total += restorer.cost[text[-2:] + letter]
                text += letter
        return total + restorer.cost[text[-2:] + " "], text.strip()

    for token in ("b4d", "(at", "t1n!", "l0t", "b33", "$ee", "s3e*"):
        inner = [i for i, c in enumerate(token) if c.isalnum()]
        ways = [list(restorer._readings(token, i, inner[0], inner[-1])) for i in range(len(token))]
        best = min(price(token, chosen) for chosen in itertools.product(*ways))
        assert restorer.decode(token) == best[1], token


def test_words_of_letters_are_read_without_the_lattice(model, monkeypatch):
    restorer = toxicity.Restorer(model.trigrams)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("eotß", repeat=n)] + ["gr" + "e" * n + "n" for n in range(9)]
    lattice = {word: restorer.decode(word) for word in words}
    monkeypatch.setattr(toxicity.Restorer, "decode", None)
    for word in words:
        assert restorer.words_of(word) == tuple(dict.fromkeys((word, lattice[word])))


def test_numbers_of_features_are_those_of_their_names(model):
    texts = ["you wretch, SCOUNDREL!! été éé a ab x.y w r e t c h", "", None, "gr€€n f1eld " * 9, "~abcd " + "z" * 400]
    names = [toxicity._Reader(model.trigrams).features(t) for t in texts]
    chosen = {name: n for n, name in enumerate(sorted(set().union(*names))) if n % 2}
    reader = toxicity._Reader(model.trigrams, chosen)
    for _ in range(2):
        assert [reader.features(t) for t in texts] == [{chosen[n] for n in found if n in chosen} for found in names]


def test_a_worker_forgets_what_another_stage_left():
    common._turn_to("first")
    assert common.lasting(lambda: 1) == 1 and common.lasting(lambda: 2) == 1
    common._turn_to("first")
    assert common.lasting(lambda: 2) == 1
    common._turn_to("second")
    assert common.lasting(lambda: 3) == 3


ODD_TEXTS = ["", None, "İ a b İ c", "ΑΣ Σ Σ ΟΔΟΣ Σ.", "x\x00y \x00 aa\x00", "~abcd ~~x~ w r e t c h", "a" * 600 + " b" * 400, "𝒜𝒷 d𝔢ff 漢字漢字 ééé.",
             "a. .a ... 1 aaa, bbb; aabb. gr€€n pi$$ le*** letter!!"]


def odd_texts(n):
    rng = random.Random(n)
    signs = "abelnoßéİΣσ.,;:?!$@*|(<+0134-_'~’ \t\nABE"
    return ODD_TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_endings_of_words_are_read_once(model, monkeypatch):
    """Words that end alike cost one walk through the lattice, however many there are."""
    asked = []
    readings = toxicity.Restorer._readings
    monkeypatch.setattr(toxicity.Restorer, "_readings", lambda self, *place: asked.append(place) or readings(self, *place))
    restorer = toxicity.Restorer(model.trigrams)
    for n in range(500):
        opening = "ba" * n + "bread"
        word, *read = restorer.words_of(opening + "$!!")
        assert word == opening + "$" and all(w.startswith(opening) for w in read)
    assert len(asked) <= 6


def test_words_with_an_opening_read_as_the_whole_lattice_does(model):
    restorer = toxicity.Restorer(model.trigrams)
    for token in {t.lower() for text in odd_texts(1500) for t in (text or "").split()} | {"x y z", "o l é"}:
        assert restorer.words_of(token) == restorer._words_of(token), token


def test_texts_read_together_have_the_features_that_each_has(model, monkeypatch):
    texts = odd_texts(300) + [PLAIN, PLAIN + "you wretch", "v3rm1n s c o u n d r e l"] * 2
    alone = [toxicity._Reader(model.trigrams, model.features).features(t) for t in texts]
    asked = []
    of = toxicity._Grams.of
    monkeypatch.setattr(toxicity._Grams, "of", lambda self, words: asked.append(words) or of(self, words))
    reader = toxicity._Reader(model.trigrams, model.features)
    assert reader.all_features(texts) == alone and len(asked) == 1
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    monkeypatch.setattr(toxicity, "MEMO_TOKENS", 20)
    assert reader.all_features(texts) == alone


def test_documents_with_a_feature_are_counted(model):
    texts = odd_texts(200) + [PLAIN, PLAIN, PLAIN + "w r e t c h"]
    toxic = np.arange(len(texts)) % 3 == 0
    reader = toxicity._Reader(model.trigrams)
    brute = Counter((name, bool(t)) for text, t in zip(texts, toxic) for name in reader.features(text))
    found = Counter()
    for names, *counts in toxicity._documents_with(reader, texts, toxic):
        for marked, count in zip((True, False), counts):
            found.update({(name, marked): n for name, n in zip(names, count) if n})
    assert found == brute
    assert not list(toxicity._documents_with(reader, ["", None, "..."], np.zeros(3, bool)))


def test_trigrams_are_those_of_plain_words(spark):
    """Rows of any length, also one of more tokens than are counted together."""
    texts = odd_texts(300) + [PLAIN, "letter, 'quoted' (word)! noooo 3x a", PLAIN * 5000]
    brute = Counter()
    for token in (token for text in texts for token in (text or "").split()):
        word = toxicity.stripped(token)
        if word.isalpha() and not any(len(list(run)) > 2 for _, run in itertools.groupby(word)):
            shown = f"  {word} "
            brute.update(shown[i : i + 3] for i in range(len(shown) - 2))
    assert toxicity.trigram_counts(documents(spark, list(enumerate(texts)))) == brute
