"""Small tables with what real ones may hold: nulls, repeats, odd texts, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, h long, node string, __h string"


def documents(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang) with extra columns whose names operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), "w", 7, "n", "k") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):03d}" for _ in range(words))


def by_id(df):
    return {row.doc_id: row for row in df.collect()}
