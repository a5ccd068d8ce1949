import zlib

from conftest import SF_DIR
from llm_tables import documents

from skytally.llm import language_id

SPOKEN = {
    "xx": "kolto merin saba dul pentra vosk ",
    "yy": "aquil thero nimba wex jorry plim ",
}


def test_separates_and_rejects(spark):
    train = [(n, SPOKEN[lang][n % 5 :] * 5, lang) for n, lang in enumerate(["xx", "yy"] * 30)]
    train += [(90, None, "xx"), (91, "saba dul", None), (92, "", "xx")]
    dictionaries = language_id.fit(documents(spark, train))
    assert set(dictionaries) == {"xx", "yy"}
    texts = {
        1: "merin saba dul pentra vosk",
        2: "THERO NIMBA WEX jorry plim",
        3: None,
        4: "",
        5: "1234 !!! 99",
        6: "é",
        7: "kolto merin saba " * 20000,
        8: "漢字",
    }
    found = {r.doc_id: r for r in language_id.predict(documents(spark, list(texts.items())), dictionaries).collect()}
    assert [found[n].lang_pred for n in (1, 2, 7)] == ["xx", "yy", "xx"]
    assert [found[n].lang_pred for n in (3, 4, 5)] == ["und"] * 3
    assert found[6].lang_pred in dictionaries and found[8].lang_pred in dictionaries
    assert found[1].accepted and not found[6].accepted
    assert all(0 <= r.score <= 1 for r in found.values())


def test_copies_do_not_fill_the_sample(spark):
    train = [(n, "saba dul " * 9, "xx") for n in range(300)] + [(500 + n, f"merin {'vosk' * n} pentra", "xx") for n in range(5)]
    assert b"merin" in language_id.fit(documents(spark, train), sample_docs=10)["xx"]


def test_nothing_learned_and_empty_table(spark):
    assert language_id.fit(documents(spark, [])) == {}
    assert language_id.predict(documents(spark, [(1, "text")]), {}).first().lang_pred == "und"
    assert language_id.predict(documents(spark, []), {"xx": b"saba"}).count() == 0


def test_held_out_accuracy(spark):
    from skytally.llm.queries import QUERIES

    found = QUERIES["op6_compression_language"](spark, SF_DIR)
    langs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(langs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held_out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held_out) / len(held_out) > 0.9
