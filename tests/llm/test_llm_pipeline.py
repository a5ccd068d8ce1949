import re

import pytest
from conftest import SF_DIR
from llm_tables import prose

import corpus_pipeline
from skytally.llm import bpe, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ("wretch", "scoundrel", "vermin")


@pytest.fixture
def planted(spark, tmp_path):
    """Tables with one known case per stage among clean documents."""
    passage = prose(900, 40)
    texts = {n: prose(n, 60, 5000) for n in range(200)}
    for n in range(0, 60, 3):
        texts[n] += f" you {BAD[n % 2]} and {BAD[2]}"
    texts[300] = prose(300, 60, 5000) + " y0u 5c0undr3l v.e.r.m.i.n"
    texts[301] = texts[302] = prose(301, 80, 5000)
    texts[303] = texts[301] + " w001"
    texts[304] = prose(304, 30, 5000) + " " + passage + " " + prose(305, 30, 5000)
    texts[305] = prose(306, 30, 5000) + " ann@mail.example from 10.1.2.3"
    texts[306] = None
    texts[307] = ""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(n, 1, int(n < 60 and n % 3 == 0)) for n in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), texts


def test_each_stage_takes_effect(spark, planted):
    sf_dir, texts = planted
    encoder = bpe.Encoder.from_file(queries.vocabulary_path())
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    gone = {*range(0, 60, 3), 300, 302, 303, 304}
    assert set(found) == set(texts) - gone
    for doc_id, row in found.items():
        text = re.sub(r"10\.1\.2\.3", "[IP]", (texts[doc_id] or "").replace("ann@mail.example", "[EMAIL]"))
        assert encoder.decode(row.ids) == text and row.n_tokens == len(row.ids)


def test_stages_chain_over_parquet_and_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "tokens",
    ]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]


def test_empty_documents(spark, planted):
    sf_dir, _ = planted
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_rows_without_an_id_are_judged_too(spark, planted):
    sf_dir, texts = planted
    plain, leaked, copied = prose(950, 60, 5000), texts[304], texts[301]
    rows = [(None, t, "en", "s", len(t or "")) for t in (plain, plain, leaked, copied, None, "", "")] + [(301, copied, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.reject_contaminated(spark, corpus_pipeline.keep_one_of_each(spark, docs, sf_dir), sf_dir)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, plain), (301, copied)] + [(0, "")] * 3)


def test_nothing_is_left_but_what_results_need(spark, planted):
    import os

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    corpus_pipeline.run(spark, planted[0]).count()
    left = {name.split("-")[1] for name in set(os.listdir(shared)) - before}
    assert left <= {"toxicity", "near", "near_duplicates", "decontamination", "personal", "personal_data"}, left
