"""The corpus pipeline: toxicity, near-duplicates, benchmark phrases, personal data, tokens.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, written as Parquet and reread as the next one's docs.
All but the last keep the columns of documents. Stages are safe to run again:
what they keep in between goes to new folders below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import bpe, decontaminate, minhash, sanitise, toxicity
from skytally.llm.common import kept_table, remainder, scratch, sized_broadcast, table
from skytally.llm.decontaminate import NO_ID, text_hash
from skytally.llm.queries import vocabulary_path

#: SQL cannot express the learned and iterative stages; tests hold them against brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, rejected: DataFrame, *keys: str) -> DataFrame:
    """The rows of docs that agree with none of the rejected in all of ``doc_id`` and ``text_hash`` that are named."""
    prefix = max(docs.columns, key=len)  # names that no column of docs has
    values = {"doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "text_hash": text_hash()}
    with scratch(docs.sparkSession) as keep:
        named = [F.coalesce(F.col(k).cast("long"), F.lit(NO_ID)).alias(f"{prefix}_{k}") for k in keys]
        gone = keep(kept_table(rejected.select(*named).distinct(), "rejected"))
    keyed = docs.withColumns({f"{prefix}_{k}": values[k] for k in keys})
    return keyed.join(sized_broadcast(gone, minhash.BROADCAST_IDS), gone.columns, "left_anti").select(docs.columns)


def _one_of_each_text(docs: DataFrame) -> DataFrame:
    """Rows without a doc_id, which near-duplicate classes leave alone: one of each text, if no row with an id has it."""
    unnamed = docs.where("doc_id is null")
    if unnamed.isEmpty():
        return docs
    named = docs.where("doc_id is not null")
    h = f"{max(docs.columns, key=len)}_text_hash"
    # Texts without words are copies of nothing.
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    spoken = unnamed.where(~empty).withColumn(h, text_hash())
    texts = named.select(text_hash().alias(h)).distinct()
    one = spoken.dropDuplicates([h]).join(texts, h, "left_anti").select(docs.columns)
    return named.unionByName(unnamed.where(empty)).unionByName(one)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. The model learns from the folds of labels that the query does."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1))
    return toxicity.accepted(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate class.

    Rows that share a doc_id are one document and stay or go together. Of rows
    without one, exact copies go.
    """
    copies = minhash.near_duplicates(docs).where(~F.col("kept"))
    return _one_of_each_text(_without(docs, copies, "doc_id"))


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item; each row is judged by its own text."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"), "doc_id", "text_hash")


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    return sanitise.sanitised(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``: the token ids of each document, and the digest of their decoding.

    Each text is encoded and decoded in one pass; a decoding that is not the text ends the job.
    """
    return bpe.encoded_texts(docs, bpe.Encoder.from_file(vocabulary_path()))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", reject_contaminated),
    ("personal_data", remove_personal_data),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # what a stage has kept in between goes once its output is written
            docs = keep(kept_table(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
