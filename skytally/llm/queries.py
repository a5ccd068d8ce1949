"""One query per operator, with the parameters that the query fixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import (
    archive,
    bpe,
    chat_format,
    decontaminate,
    filter_audit,
    language_id,
    maxent,
    minhash,
    ranked_search,
    sanitise,
    simhash,
    toxicity,
    url_filter,
)
from skytally.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def vocabulary_path() -> str:
    """The public byte-level vocabulary of the queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op4_content_archive(spark, sf_dir):
    """Pages as records of a content-addressed archive, read back and verified."""
    return archive.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_redirect_filter(spark, sf_dir):
    """Every page's url judged by rules and by what its aliases are judged."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op5_minhash_classes(spark, sf_dir):
    """Near-duplicate classes on two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query
def op6_compression_language(spark, sf_dir):
    """The language under whose dictionary each text is smallest."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    dictionaries = language_id.fit(docs.where(~held_out))
    predicted = language_id.predict(docs, dictionaries)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@query
def op8_prefix_bpe(spark, sf_dir):
    """Every text encoded, and its ids decoded."""
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), bpe.Encoder.from_file(vocabulary_path()))


@query
def op2_positional_index(spark, sf_dir):
    """Benchmark phrases in every document, through the positional index."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query
def op9_simhash_edits(spark, sf_dir):
    """Fingerprints of every text, of its edited form and of the next document."""
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_disclosure_spans(spark, sf_dir):
    """Personal data in every document, and the terms that reveal it."""
    return sanitise.report(table(spark, sf_dir, "documents"))


@query
def op7_hashed_maxent(spark, sf_dir):
    """Every document scored by a model of the training documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False))
    model = maxent.train(docs.where(~held_out))
    return maxent.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens if model else 0).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op1_disguised_toxicity(spark, sf_dir):
    """Toxicity of every document, its disguised words restored."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    scored = toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out)))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op11_ranked_search(spark, sf_dir):
    """The ten highest-scoring documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_chat_windows(spark, sf_dir):
    """Every conversation in windows of turns, read back from the formatted text."""
    said = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', {said}), (-7L, 1L, 'assistant', {said})")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    with open(vocabulary_path(), encoding="utf-8") as file:
        tokenizer = file.read()
    return chat_format.digests(chat_format.formatted(rows, tokenizer))


@query
def op13_filter_audit(spark, sf_dir):
    """What each of five filters removes in every order, by language."""
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query
def pipeline(spark, sf_dir):
    """The corpus pipeline, from documents to token ids."""
    import corpus_pipeline  # it imports the operators, and this module

    return corpus_pipeline.run(spark, sf_dir)
