"""URL rules against a plain matcher, edges out of pages, and decisions that spread over components."""

import random

import duckdb

from visitflow.llm import urls

from .data import cluttered, rows_of

SCHEMA = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return min(fits, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"), default=None)


def some_urls(n=400):
    rng = random.Random(8)
    hosts = ["org", "example.org", "a.Example.ORG", "xexample.org", "b.c.com", "com", "d.net", "net", "É.org", "user@e.com:80", ""]
    paths = ["", "/", "/es/", "/es", "/es/x", "/en/1", "/en/12", "/en/2", "/fr/", "/fr/q", "/de/", "/de", "/de/a?b=/fr/", "?/fr/", "#/de/"]
    return [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?x=1', '#top', '?utm_source=y', '#?'])}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_rules_equal_a_plain_matcher_listed_or_joined(spark):
    all_urls = [*some_urls(), None, "", "no url", "://", "a://", "http://example.org/es/://x", "HTTP://EXAMPLE.org/es/\n"]
    pages = frame(spark, [(i, u, None) for i, u in enumerate(all_urls)])
    want = {i: (*split(u), None if (r := plain_rule(u, urls.RULES)) is None else r[1] + r[2], None if r is None else r[0]) for i, u in enumerate(all_urls)}
    table = spark.createDataFrame([*urls.RULES, ("block", None, "/")], "verdict string, host string, path string")
    for rules in (urls.RULES, table):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict if r.rule else None) for r in urls.judge(cluttered(pages), rules).collect()}
        assert got == want


def test_equally_long_rules_allow(spark):
    rules = [("block", "a.b", "/c"), ("allow", "a.b", "/c"), ("block", "b", "/cdx")]
    got = urls.judge(frame(spark, [(1, "http://a.b/cd", None)]), rules).first()
    assert (got.rule, got.verdict) == ("a.b/c", "allow")


def test_edges_of_pages(spark):
    base = "https://h.net/d/e.html?q"
    html = {
        '<link rel="canonical" href="/x">': "https://h.net/x", "<LINK href='//o.net/y' REL=canonical >": "https://o.net/y",
        '<link rel=canonical href=z.html>': "https://h.net/d/z.html", '<link href="./w?a=1&amp;b=2" rel="nofollow canonical">': "https://h.net/d/w?a=1&b=2",
        '<meta http-equiv="Refresh" content="0; URL=\'http://r.net/\'">': "http://r.net/", "<meta content='5;url=?p' http-equiv=refresh>": "https://h.net/d/e.html?p",
        '<!-- <link rel="canonical" href="/x"> -->': None, '<script>var a = \'<link rel="canonical" href="/x">\'</script>': None,
        '<link rel="stylesheet" href="/canonical">': None, '<link rel="canonical" href="#a">': None, '<link rel="canonical" href="mailto:x">': None,
        '<meta name="refresh" content="0;url=/x">': None, '<meta http-equiv="refresh" content="30">': None, "": None, None: None,
        '<link data-x="a>b" rel="canonical" href="/gt">': "https://h.net/gt",
    }
    pages = frame(spark, [(i, base + str(i), h) for i, h in enumerate(html)])
    got = {r.url: r.target for r in urls.page_edges(pages).collect()}
    want = {base + str(i): t for i, t in enumerate(html.values()) if t is not None}
    # a query's own link keeps the page's path without its query
    assert got == want


def page(i, url, target=None):
    return (i, url, None if target is None else f'<head><link rel="canonical" href="{target}"></head>')


def test_blocks_spread_and_allows_come_first(spark):
    rows = [
        page(1, "http://a.net/1", "http://b.com/de/x"), page(2, "http://c.net/", "http://a.net/1/"), page(3, "http://alone.net/"),  # the block is no page
        page(4, "http://d.net/1", "http://e.com/de/1"), page(5, "http://e.com/fr/1", "http://d.net/1"), page(6, "http://f.net/", "http://d.net/1"),  # an allow among them
        page(7, "http://b.com/de/x"), page(8, "https://www.c.net?utm_source=q#z"), page(9, None), page(10, "c.net"), page(3, "http://alone.net/"),
        page(11, "http://g.net/1", "http://g.net/2"), page(12, "http://g.net/2", "http://g.net/3"), page(13, "http://g.net/4", "http://g.net/3"),
    ]
    known = spark.createDataFrame([("http://g.net/3", "http://x.com/de/"), (None, "http://alone.net/"), ("http://alone.net/", None)], "url string, target string")
    got = {r.page_id: (r.verdict, r.via) for r in urls.judge(frame(spark, rows), edges=known).collect()}
    assert got == {1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "default"), 4: ("allow", "default"), 5: ("allow", "rule"), 6: ("allow", "default"),
                   7: ("block", "rule"), 8: ("block", "alias"), 9: ("allow", "default"), 10: ("allow", "default"),
                   11: ("block", "alias"), 12: ("block", "alias"), 13: ("block", "alias")}


def test_one_url_with_most_rows_and_empty_table(spark):
    rows = [page(i, "http://hot.net/" + "?utm_source=x" * (i % 2), "http://b.com/de/") for i in range(1_500)] + [page(9_999, "http://cold.net/")]
    got = urls.judge(frame(spark, rows)).collect()
    assert len(got) == 1_501 and {r.verdict for r in got if r.page_id < 9_999} == {"block"}
    assert urls.judge(frame(spark, rows).limit(0)).count() == 0


def test_sql_agrees_where_pages_hold_links(spark):
    """The driver's pages hold no such elements; these do."""
    rng = random.Random(2)
    pool = some_urls(120)
    rows = [page(i, u, rng.choice(pool).replace("&", "&amp;") if i % 3 else None) for i, u in enumerate(pool)] + [page(500, None, "/x"), page(3, pool[3], "../up")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    df = urls.judge(frame(spark, rows))
    res = con.execute(urls.ORACLE)
    cols = [d[0] for d in res.description]
    want = sorted((dict(zip(cols, r, strict=True)) for r in res.fetchall()), key=str)
    assert sorted((r.asDict() for r in df.select(*cols).collect()), key=str) == want and len({r["via"] for r in want}) == 3
    assert rows_of(df)
