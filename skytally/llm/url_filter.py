"""URL filter with redirect equivalence.

Rules judge a url by its host and path; pages that redirect to, or name as
canonical, another url are aliases of it. A blocked url blocks its aliases; a
url with a rule of its own, an explicit allow among them, keeps that verdict.

Aliases are the connected components of the links, found on Spark by
``graph.components``; only urls that take part in a link enter that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import LOWER, UPPER, kept_table
from skytally.llm.graph import components

ALLOW, BLOCK = "allow", "block"

# Fixed values of the query.
QUERY_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _scheme(url: Column) -> Column:
    return F.lower(F.substring_index(url, "://", 1))


def address_of(url: Column) -> Column:
    """The url as a vertex: scheme and host lower-cased, no fragment. Null without a ``://``."""
    tail = F.regexp_extract(_rest(url), r"\A[^/?#]*([^#]*)", 1)
    tail = F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.when(F.instr(url, "://") > 0, F.concat(_scheme(url), F.lit("://"), host_of(url), tail))


def _resolved() -> Column:
    """``href`` made absolute, on rows with the parts of the page's own url."""
    href, root = F.col("href"), F.concat("scheme", F.lit("://"), "host")
    return (
        F.when(href == "", None)
        .when(href.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat("scheme", F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, "path", href))
        .when(href.rlike(r"\A(#|[A-Za-z][A-Za-z0-9+.-]*:)"), None)
        .otherwise(F.concat(root, "folder", href))
    )


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(value, r"""\A["']|["']\z""", "")


def alias_links(pages: DataFrame) -> DataFrame:
    """``(u, v)``: a page's address and the address it redirects to or names as canonical.

    Read from ``<link rel=canonical href>`` and ``<meta http-equiv=refresh content>``
    anywhere in the html. Pages without a url or html give no link.
    """
    tags = pages.where(F.instr("url", "://") > 0).select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))).alias("tag")
    )
    tag, url = F.col("tag"), F.col("url")
    # One step per column: each is used several times in the next, and is then computed once.
    named = tags.select(
        "url",
        F.lower(_attribute(tag, "rel")).rlike(r"(\A|\s)canonical(\s|\z)").alias("canonical"),
        (F.lower(_attribute(tag, "http-equiv")) == "refresh").alias("refresh"),
        _attribute(tag, "href").alias("target"),
        F.regexp_extract(_attribute(tag, "content"), r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1).alias("moved"),
    )
    # Written out: a filter above would be pushed below and repeat the expressions.
    named = kept_table(named, "tags").where("canonical or refresh")
    parts = named.select(
        "url",
        F.replace(F.trim(F.when(F.col("refresh"), F.col("moved")).otherwise(F.col("target"))), F.lit("&amp;"), F.lit("&")).alias("href"),
        _scheme(url).alias("scheme"),
        host_of(url).alias("host"),
        F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url)).alias("path"),
    )
    parts = parts.withColumn("folder", F.regexp_extract("path", r"\A(.*/)?", 1))
    ends = parts.select("url", _resolved().alias("absolute"))
    return ends.select(address_of(url).alias("u"), address_of(F.col("absolute")).alias("v"))


def _rules_table(spark, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    if not isinstance(rules, DataFrame):
        # Literals, so that the rules are part of the plan and not rows that the driver hands over.
        listed = [F.struct(*[F.lit(x).alias(n) for x, n in zip(rule, ("verdict", "host", "path"))]) for rule in rules]
        none = F.array().cast("array<struct<verdict:string,host:string,path:string>>")
        rules = spark.range(1).select(F.inline(F.array(*listed) if listed else none))
    return rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            F.length("host").alias("host_size"),
            F.col("path"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict"),
        ).alias("entry"),
    )


def with_rule(urls: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Add ``rule`` and ``ruling`` of the longest rule that fits ``host`` and ``path`` (null: none).

    Rules are looked up once per distinct host, through all of its parent
    domains; the table of hosts is then joined to the urls. Among rules of one
    length the one with the longer host wins.
    """
    labels = F.split("host", r"\.")
    hosts = urls.select("host").distinct()
    above = hosts.select(
        "host",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
            )
        ).alias("rule_host"),
    )
    entries = (
        above.join(_rules_table(urls.sparkSession, rules), "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("entry"), asc=False).alias("entries"))
    )
    fits = F.filter("entries", lambda e: F.col("path").startswith(e["path"]))
    best = F.try_element_at(fits, F.lit(1))
    return (
        urls.join(entries, "host", "left")
        .withColumn("_best", best)
        .withColumns({"rule": F.col("_best.rule"), "ruling": F.col("_best.verdict")})
        .drop("entries", "_best")
    )


def blocked_aliases(links: DataFrame, rules) -> DataFrame:
    """``(address, blocked)`` for every address that takes part in a link."""
    groups = components(links)
    parts = F.col("node")
    judged = with_rule(groups.withColumns({"host": host_of(parts), "path": path_of(parts)}), rules)
    blocked = (
        judged.groupBy("component")
        .agg(F.max(F.coalesce(F.col("ruling") == BLOCK, F.lit(False))).alias("blocked"))
        .where("blocked")
    )
    return groups.join(blocked, "component").select(F.col("node").alias("address"), "blocked")


def judge(pages: DataFrame, rules=QUERY_RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and ``by`` (rule, alias or default).

    ``redirects(src, dst)`` adds links from a crawl log to those in the html. A
    null url, or one without ``://``, has an empty host and path, takes part in
    no link and is allowed. Repeated pages are judged alike, each on its row; an
    empty table gives an empty result. Columns beyond page_id, url and html are
    not looked at.
    """
    pages = pages.select("page_id", "url", "html")
    links = alias_links(pages)
    if redirects is not None:
        links = links.unionByName(
            redirects.select(address_of(F.col("src")).alias("u"), address_of(F.col("dst")).alias("v"))
        )
    links = kept_table(links, "links").where("u <> v")
    url = F.col("url")
    urls = pages.select("page_id", address_of(url).alias("address"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = with_rule(urls, rules)
    if not links.isEmpty():
        judged = judged.join(blocked_aliases(links, rules), "address", "left")
    else:
        judged = judged.withColumn("blocked", F.lit(None).cast("boolean"))
    alias = F.coalesce("blocked", F.lit(False))
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruling", F.when(alias, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.when(F.col("ruling").isNotNull(), "rule").when(alias, "alias").otherwise("default").alias("by"),
    )
