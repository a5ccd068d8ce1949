"""Personal data and the terms that give it away.

Emails, ip addresses, card and phone numbers are found by fixed patterns. The
other words of the texts that hold them are then judged by information theory:
of entity ``e`` and term ``t``, with all probabilities counted over the words
outside the patterns of the whole corpus,

    disclosure(t, e) = PMI(t; e) / IC(e) = 1 + log2 p(e | t) / -log2 p(e)

is the share of the entity's information that the term reveals. p(e | t) is the
share of t's occurrences that lie in texts of e, p(e) the share of all words
that do. A pair must be seen in ``LEAST_TEXTS`` texts that differ, so that copies
are no evidence. Terms above ``REMOVE`` are removed wherever the corpus has them,
those above ``GENERALISE`` are replaced by a class.

Offsets are code points; matching runs on Spark's own regular expressions,
possessive where nothing could be given back, so that no text backtracks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import kept_table, scratch, sized_broadcast

#: Fixed values of the query, in the order of kinds. The look-behinds only skip
#: starts inside a run, which cannot match where the run's start did not.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
GENERAL = "[TERM]"

GENERALISE, REMOVE = 0.9, 0.97
LEAST_TEXTS = 2
WORD = r"\p{L}+"
#: Terms, or texts, that may be broadcast to find them in the corpus; more are joined by a shuffle.
BROADCAST_TERMS = 500_000
NO_ID = -(2**63)

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(_id().alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))


def _luhn(digits: Column) -> Column:
    """Whether up to 20 digits pass; zeros put in front change nothing."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for place in range(20):
        digit = F.substring(padded, 20 - place, 1).cast("int")
        if place % 2:
            digit = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        total = total + digit
    return total % 10 == 0


def _valid(kind: Column, match: Column, digits: Column) -> Column:
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", match.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"))
        .when(kind == "card", F.length(digits).between(14, 19) & _luhn(digits))
        .otherwise(F.length(digits).between(10, 15))
    )


def _entries(number: int, kind: str) -> Column:
    """The kind's matches, with the length of what lies before each."""
    matches, pieces = F.col(f"m_{kind}"), F.col(f"p_{kind}")

    def entry(i):
        return F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            F.length(F.get(pieces, i)).alias("gap"),
            F.get(matches, i).alias("match"),
        )

    return F.when(F.size(matches) > 0, F.transform(F.sequence(F.lit(0), F.size(matches) - 1), entry))


def entities(docs: DataFrame) -> DataFrame:
    """``(doc, h, kind, start, end, entity)`` of every valid match; kind is its number in KINDS.

    doc and h identify the text: its id (``NO_ID`` if null) and hash.
    """
    texts = _keyed(docs)
    matched = texts.select(
        "doc", "h", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in PATTERNS.items()]
    ).where(" or ".join(f"size(m_{k}) > 0" for k in PATTERNS))
    cut = matched.select(
        "doc",
        "h",
        *[f"m_{k}" for k in PATTERNS],
        *[F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).alias(f"p_{k}") for k, p in PATTERNS.items()],
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,match:string>>")
    listed = [F.coalesce(_entries(n, k), none) for n, k in enumerate(PATTERNS)]
    rows = cut.select("doc", "h", F.explode(F.concat(*listed)).alias("e")).select("doc", "h", "e.*")
    # Equal rows of the table give equal rows here; one of each is enough.
    rows = rows.repartition("doc", "h").dropDuplicates(["doc", "h", "kind", "i"])
    so_far = Window.partitionBy("doc", "h", "kind").orderBy("i")
    end = F.sum((F.col("gap") + F.length("match")).cast("long")).over(so_far)
    rows = rows.withColumn("end", end).withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    kind = F.element_at(F.array(*map(F.lit, PATTERNS)), F.col("kind") + 1)
    valid = rows.where(_valid(kind, F.col("match"), F.col("digits")))
    value = F.when(F.col("kind") < 2, F.lower("match")).otherwise(F.col("digits"))
    return valid.select(
        "doc",
        "h",
        "kind",
        (F.col("end") - F.length("match")).alias("start"),
        "end",
        F.concat_ws(":", kind, value).alias("entity"),
    )


def _islands(found: DataFrame) -> DataFrame:
    """``(doc, h, island, start, end, label)``: spans that overlap as one, by the label of the first."""
    in_order = Window.partitionBy("doc", "h").orderBy("start", "kind")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        found.withColumn("reached", before)
        .withColumn("fresh", (F.col("reached").isNull() | (F.col("start") >= F.col("reached"))).cast("int"))
        .withColumn("island", F.sum("fresh").over(in_order))
        .groupBy("doc", "h", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("label", F.struct("start", "kind")).alias("label"))
    )


def _cuts(islands: DataFrame) -> DataFrame:
    """``(doc, h, cuts)``: what ``_edited`` replaces in each text."""
    by_island = Window.partitionBy("doc", "h").orderBy("island")
    cuts = islands.withColumn("after", F.coalesce(F.lag("end").over(by_island), F.lit(0)))
    cuts = cuts.groupBy("doc", "h").agg(
        F.sort_array(F.collect_list(F.struct("start", "after", "label"))).alias("cuts"), F.max("end").alias("last")
    )
    return cuts.select("doc", "h", F.struct("cuts", "last").alias("cuts"))


def _edited(text: Column, cut: Column) -> Column:
    return F.concat(
        F.array_join(
            F.transform(
                cut["cuts"],
                lambda c: F.concat(
                    F.substring(text, (c["after"] + 1).cast("int"), (c["start"] - c["after"]).cast("int")), c["label"]
                ),
            ),
            "",
        ),
        F.substring(text, (cut["last"] + 1).cast("int"), F.length(text)),
    )


def _masked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(doc, h, text)`` of every row with blanks for its entities, so that all offsets stay.

    Texts are edited where they are read: of the few with entities the places
    are sent to them, and it is cheaper to do that each time than to store a
    second corpus.
    """
    blank = F.repeat(F.lit(" "), (F.col("end") - F.col("start")).cast("int"))
    islands = _islands(found.withColumn("label", F.lit(""))).withColumn("label", blank)
    cuts = sized_broadcast(kept_table(_cuts(islands), "blanks"), BROADCAST_TERMS)
    joined = _keyed(docs).join(cuts, ["doc", "h"], "left")
    text = F.when(F.col("cuts").isNotNull(), _edited(F.col("text"), F.col("cuts"))).otherwise(F.col("text"))
    return joined.select("doc", "h", text.alias("text"))


def _words(text: str = "text") -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def disclosures(texts: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """``(entity, term, disclosure)`` of every pair of at least that disclosure; texts are masked."""
    holders = found.select("entity", "h").distinct()
    # An entity in fewer texts has no pair with enough of them.
    often = holders.groupBy("entity").count().where(F.col("count") >= LEAST_TEXTS).select("entity")
    holders = kept_table(holders.join(often, "entity"), "holders")
    held = texts.join(sized_broadcast(holders.select("h").distinct(), BROADCAST_TERMS), "h", "left_semi")
    words = held.select("h", F.explode(_words()).alias("word")).groupBy("h", F.lower("word").alias("term"))
    words = kept_table(words.agg(F.count("*").alias("n")), "held")
    vocabulary = kept_table(words.groupBy("term").agg(F.countDistinct("h").alias("texts")), "terms")
    vocabulary = vocabulary.where(F.col("texts") >= LEAST_TEXTS).select("term")
    spoken = texts.select(F.explode(_words()).alias("word")).select(F.lower("word").alias("word"))
    # The null group holds all other words, so one pass gives the total as well.
    known = sized_broadcast(vocabulary, BROADCAST_TERMS)
    counts = kept_table(
        spoken.join(known, spoken.word == known.term, "left").groupBy("term").agg(F.count("*").alias("spoken")), "counts"
    )
    total = float(max(counts.agg(F.sum("spoken")).first()[0] or 0, 1))
    sizes = words.groupBy("h").agg(F.sum("n").alias("size"))
    around = holders.join(sizes, "h").groupBy("entity").agg(F.sum("size").alias("near_entity"))
    # A term reaches ``least`` only if p(e | t) is at least p(e) ** (1 - least), and it is not said with the
    # entity more often than all words are: pairs that fail this by more than rounding are never counted.
    share = F.pow(F.col("near_entity") / total, 1 - least)
    possible = F.col("spoken") * share * 0.999 <= F.col("near_entity")
    pairs = holders.join(around, "entity").join(words.join(counts, "term"), "h").where(possible)
    pairs = pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("together"),
        F.count("*").alias("texts"),
        F.first("spoken").alias("spoken"),
        F.first("near_entity").alias("near_entity"),
    )
    revealed = F.log2(F.col("together") / F.col("spoken"))
    information = -F.log2(F.col("near_entity") / total)
    value = F.when(information > 0, 1 + revealed / information).otherwise(0.0)
    supported = pairs.where(F.col("texts") >= LEAST_TEXTS).select("entity", "term", value.alias("disclosure"))
    return supported.where(F.col("disclosure") >= least)


def _occurrences(texts: DataFrame, telling: DataFrame) -> DataFrame:
    """``(doc, h, start, end, label)`` of every word of the corpus that is one of ``telling(term, label)``."""
    known = sized_broadcast(telling, BROADCAST_TERMS)
    said = texts.select("doc", "h", F.explode(F.array_distinct(_words())).alias("word"))
    said = said.withColumn("term", F.lower("word")).join(known, "term", "left_semi")
    ids = sized_broadcast(kept_table(said.select("doc", "h").distinct(), "telling_texts"), BROADCAST_TERMS)
    cut = texts.join(ids, ["doc", "h"], "left_semi").select(
        "doc", "h", _words().alias("words"), F.split("text", WORD, -1).alias("gaps")
    )
    place = lambda word, i: F.struct(
        i.alias("i"), word.alias("word"), F.length(F.get(F.col("gaps"), i)).alias("gap")
    )
    rows = cut.select("doc", "h", F.explode(F.transform("words", place)).alias("w")).select("doc", "h", "w.*")
    rows = rows.repartition("doc", "h").dropDuplicates(["doc", "h", "i"])
    so_far = Window.partitionBy("doc", "h").orderBy("i")
    rows = rows.withColumn("end", F.sum((F.col("gap") + F.length("word")).cast("long")).over(so_far))
    return rows.withColumn("term", F.lower("word")).join(known, "term").select(
        "doc", "h", (F.col("end") - F.length("word")).alias("start"), "end", "label"
    )


def spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``(doc, h, kind, start, end, label)`` of all personal data and disclosing terms, one row per span."""
    found = kept_table(entities(docs), "entities")
    texts = _masked(docs, found)
    most = disclosures(texts, found, generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    label = F.when(F.col("disclosure") >= remove, "").otherwise(GENERAL)
    telling = kept_table(most.select("term", label.alias("label")), "telling")
    terms = _occurrences(texts, telling).select(
        "doc", "h", F.lit(len(PATTERNS)).alias("kind"), "start", "end", "label"
    )
    labels = F.element_at(F.array(*map(F.lit, LABELS.values())), F.col("kind") + 1)
    return found.select("doc", "h", "kind", "start", "end", labels.alias("label")).unionByName(terms)


def _listed(entries: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", F.get(kinds, e["kind"]), e["start"], e["end"])), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans, number of terms.

    A null text counts as empty and has no spans; equal rows are reported
    alike. Rows without a doc_id are told apart by their text. Other columns
    are ignored, an empty table gives an empty result.
    """
    entry = F.struct("start", "kind", "end")
    count = lambda n: F.count(F.when(F.col("kind") == n, 1))
    with scratch(docs.sparkSession) as keep:
        found = keep(kept_table(spans(docs), "spans"))
    summary = found.groupBy("doc", "h").agg(
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)], F.sort_array(F.collect_list(entry)).alias("all")
    )
    rows = _keyed(docs).select("doc", "h").join(summary, ["doc", "h"], "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    rows = rows.withColumn("all", F.coalesce("all", none))
    base = _listed(F.filter("all", lambda e: e["kind"] < len(PATTERNS)))
    return rows.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        *[F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.coalesce("n_term", F.lit(0)).alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind and disclosing terms generalised or removed.

    All columns stay; n_chars, where there is one, is that of the new text.
    Spans that overlap are replaced as one, by the label of the first. Texts
    without a span, nulls among them, come out as they were.
    """
    # Names that no column of docs has.
    doc, h, cuts_of = (f"{max(docs.columns, key=len)}_{name}" for name in ("doc", "h", "cuts"))
    text, cut = F.col("text"), F.col(cuts_of)
    keys = {doc: _id(), h: F.xxhash64(F.coalesce("text", F.lit("")))}
    with scratch(docs.sparkSession) as keep:
        cuts = keep(kept_table(_cuts(_islands(spans(docs))), "cuts"))
    cuts = cuts.select(F.col("doc").alias(doc), F.col("h").alias(h), F.col("cuts").alias(cuts_of))
    # Only the texts that are edited need their places; the others go through unshuffled.
    joined = docs.withColumns(keys).join(sized_broadcast(cuts, BROADCAST_TERMS), [doc, h], "left")
    new = joined.withColumn("text", F.when(cut.isNotNull(), _edited(text, cut)).otherwise(text))
    if "n_chars" in docs.columns:
        size = F.when(cut.isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        new = new.withColumn("n_chars", size.otherwise(F.col("n_chars")))
    return new.select(docs.columns)
