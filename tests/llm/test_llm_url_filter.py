import random

from conftest import SF_DIR

from skytally.llm import graph, url_filter

SCHEMA = "page_id long, url string, html string, host string, rule string, component long"


def judged(spark, rows, **more):
    pages = spark.createDataFrame([(*r, "h", "r", 1) for r in rows], SCHEMA)
    return {r.page_id: r for r in url_filter.judge(pages, **more).collect()}


def canonical(href):
    return f'<head><LINK href="{href}" rel="canonical"></head>'


def refresh(href):
    return f"<meta content='0; URL={href}' http-equiv=Refresh>"


def test_host_path_and_longest_rule(spark):
    rows = judged(
        spark,
        [
            (1, "https://WWW.Example.com/en/a?x#y", None),
            (2, "http://blog.example.com/en/b", None),
            (3, "http://example.net/fr/1", None),
            (4, "http://example.org/fr/", None),
            (5, "http://notexample.com/en/", None),
            (6, None, None),
            (7, "no scheme/en/", None),
            (8, "http://net?q=/es/", None),
            (9, "http://É.net/es/", ""),
            (10, "a://b://c.net/es/", None),
        ],
    )
    found = {p: (r.host, r.path, r.rule, r.verdict) for p, r in rows.items()}
    assert found == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("blog.example.com", "/en/b", "example.com/en/", "block"),
        3: ("example.net", "/fr/1", "net/fr/", "block"),
        4: ("example.org", "/fr/", None, "allow"),
        5: ("notexample.com", "/en/", "com/", "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("net", "", None, "allow"),
        9: ("É.net", "/es/", "net/es/", "block"),
        10: ("b:", "//c.net/es/", None, "allow"),
    }


def test_block_reaches_aliases_and_allow_stays(spark):
    rows = judged(
        spark,
        [
            (1, "http://a.org/1", canonical("http://x.net/es/")),
            (2, "http://b.org/dir/2", refresh("/2b")),
            (3, "http://b.org/2b#f", canonical("http://a.org/1")),
            (4, "http://good.com/", canonical("http://x.net/es/")),
            (5, "http://c.org/", canonical("http://d.org/&amp;x")),
            (6, "http://e.org/dir/6", canonical("sibling")),
            (7, "http://e.org/dir/sibling", refresh("//x.net/fr/")),
            (8, "http://f.org/", '<a rel="nofollow canonical-ish" href="http://x.net/es/">'),
            (9, "http://g.org/", canonical("mailto:x@x.net")),
        ],
    )
    assert {p: (r.verdict, r.by) for p, r in rows.items()} == {
        1: ("block", "alias"),
        2: ("block", "alias"),
        3: ("block", "alias"),
        4: ("allow", "rule"),
        5: ("allow", "default"),
        6: ("block", "alias"),
        7: ("block", "alias"),
        8: ("allow", "default"),
        9: ("allow", "default"),
    }


def test_redirect_log_repeats_and_empty_table(spark):
    log = spark.createDataFrame([("http://a.org/", "http://x.net/es/"), (None, "http://b.org/")], "src string, dst string")
    rows = judged(spark, [(1, "http://a.org/", None), (2, "http://b.org/", None)], redirects=log)
    assert (rows[1].verdict, rows[2].verdict) == ("block", "allow")
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.net/es/", None)] * 3, "page_id long, url string, html string")
    assert [r.verdict for r in url_filter.judge(pages).collect()] == ["block"] * 3


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)]
    edges += [(n, n + 1) for n in range(1000, 1080)] + [(2000, 2000 + n) for n in range(1, 300)] + [(5, 5), (5, 5)]
    parent = {n: n for edge in edges for n in edge}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        parent[max(find(u), find(v))] = min(find(u), find(v))
    linked = {n for u, v in edges if u != v for n in (u, v)}
    found = graph.components(spark.createDataFrame([*edges, (None, 3)], "u long, v long"))
    assert {r.node: r.component for r in found.collect()} == {n: find(n) for n in linked}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def parts(url):
    """Host, path and address of a url by hand."""
    if url is None or "://" not in url:
        return "", "", None
    scheme, rest = url.split("://", 1)
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:].split("#")[0]
    path = tail.split("?")[0]
    return host, path, f"{scheme.lower()}://{host}{tail if tail.startswith('/') else '/' + tail}"


def ruling(host, path):
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for verdict, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


def test_pages_with_planted_links_equal_brute_force(spark):
    """The given pages with random canonical links and refreshes between them, and to urls outside, some of them blocked."""
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()]
    rng = random.Random(12)
    pages += [(10_000 + n, f"http://site{n % 40}.org/p/{n}?q={n % 3}#f{n}") for n in range(150)]
    urls = [u for _, u in pages if u and "://" in u] + ["http://x.net/es/1", "https://WWW.X.NET/fr/", "http://y.net/de/"]
    rows, edges = [], []
    for page, url in pages:
        html = "<p>text</p>"
        if url and "://" in url and rng.random() < 0.5:
            target = rng.choice(urls)
            html += (canonical if rng.random() < 0.5 else refresh)(target.replace("&", "&amp;"))
            edges.append((parts(url)[2], parts(target)[2]))
        rows.append((page, url, html))
    parent = {a: a for edge in edges for a in edge}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        parent[find(a)] = find(b)
    blocked = {find(a) for a in parent if ruling(*parts(a)[:2])[1] == "block"}
    expected = {}
    for page, url in pages:
        host, path, address = parts(url)
        rule, verdict = ruling(host, path)
        alias = address in parent and find(address) in blocked
        expected[page] = (host, path, rule, verdict or ("block" if alias else "allow"))
    found = judged(spark, rows)
    assert {p: (r.host, r.path, r.rule, r.verdict) for p, r in found.items()} == expected
    assert sum(r.by == "alias" for r in found.values()) > 10
