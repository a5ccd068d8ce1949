"""Language identification by compression.

Each language has a zstandard dictionary of raw text. A text is compressed with
every dictionary in blocks, so that the dictionary counts for the whole of a
long text, and takes the language under which it becomes smallest. Where the
runner-up is within ``margin`` the result is marked as not accepted.

The dictionaries are fitted on a bounded sample of the labelled rows:
``sample_docs`` documents per language, chosen by a hash of their text, with
``sample_chars`` characters of each. The texts to classify are read whole.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import map_texts

SAMPLE_DOCS = 150
SAMPLE_CHARS = 800
MARGIN = 0.01
LEVEL = 5
BLOCK_BYTES = 8192
#: Compressed bytes by which a language must lead for odds of e to 1.
BYTES_PER_NAT = 6.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_ASCII_WORDS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def letters_of(text: str | None) -> bytes:
    """The lower-cased text in UTF-8, other ASCII than letters one space; empty without a letter."""
    if text is None or not _LETTER.search(text):
        return b""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_ASCII_WORDS).split())


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary content by language from labelled(text, lang).

    Rows with a null in either column are left out. Equal texts count once, so
    that a text with very many copies does not fill the sample. No rows: no language.
    """
    short = labelled.where("text is not null and lang is not null").select(
        "lang", F.xxhash64("text").alias("h"), F.substring("text", 1, sample_chars).alias("text")
    )
    first = Window.partitionBy("lang").orderBy("h")
    chosen = short.select("lang", "h").distinct().withColumn("n", F.row_number().over(first))
    chosen = chosen.where(F.col("n") <= sample_docs)
    # Copies meet in the aggregate before the shuffle; sample_docs rows per language are left.
    sample = short.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():  # sample_docs rows of at most sample_chars characters per language
        parts.setdefault(row.lang, []).append((row.n, row.text))
    # Dictionaries in the order of their rows, so that equal sizes go to the more frequent language.
    seen = {row.lang: row["count"] for row in short.groupBy("lang").count().collect()}
    parts = dict(sorted(parts.items(), key=lambda part: (-seen[part[0]], part[0])))
    content = {lang: b" ".join(letters_of(text) for _, text in sorted(rows)) for lang, rows in parts.items()}
    return {lang: letters for lang, letters in content.items() if letters}


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL):
    import zstandard as zstd

    out = []
    for lang, content in dictionaries.items():
        shared = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=level)
        out.append(
            (lang, zstd.ZstdCompressor(dict_data=shared, write_content_size=False, write_dict_id=False))
        )
    return out


def sizes_of(letters: bytes, coders) -> list[int]:
    """Compressed bytes of the text under each dictionary."""
    blocks = [letters[i : i + BLOCK_BYTES] for i in range(0, len(letters), BLOCK_BYTES)]
    return [sum(len(coder.compress(b)) for b in blocks) for _, coder in coders]


def decide(letters: bytes, coders, margin: float = MARGIN) -> tuple[str, float, bool]:
    """Language, share of the evidence it has (0 to 1), and whether its lead is wide enough.

    Equal sizes go to the language that comes first.
    """
    if not letters or not coders:
        return UNKNOWN, 0.0, False
    sizes = sizes_of(letters, coders)
    best = min(range(len(sizes)), key=sizes.__getitem__)
    score = 1 / sum(math.exp(max(-700.0, (sizes[best] - s) / BYTES_PER_NAT)) for s in sizes)
    rest = sizes[:best] + sizes[best + 1 :]
    return coders[best][0], score, not rest or min(rest) - sizes[best] >= margin * min(rest)


def predict(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)`` for documents(doc_id, text).

    A text that is null or has no letter is ``und`` with score 0, as is every
    text when no language was learned. One row per row; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def setup():
        coders = compressors(shared.value)
        return lambda text: decide(letters_of(text), coders, margin)

    return map_texts(docs, setup, {"lang_pred": "string", "score": "double", "accepted": "boolean"})
