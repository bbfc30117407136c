from visitflow.llm import warc

from .data import cluttered

SCHEMA = "record_id long, warc_type string, target_uri string, date long, headers map<string,string>, payload_sha256 string, payload_bytes long"


def resolve(spark, rows):
    return {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_canonical_urls(spark):
    urls = {"http://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top": "example.com/a/b?a=1&b=2", "https://example.com": "example.com",
            "https://example.com/?ref=q": "example.com", "not a url": "not a url", "HTTPS://example.com:8080/x": "example.com:8080/x", "": ""}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.c for r in df.select("u", warc.canonical_url(df["u"]).alias("c")).collect()}
    assert got == urls


def test_latest_earlier_response_validators_and_headers(spark):
    full = {"ETag": '"1"', "Last-Modified": "m", "Content-Length": "9", "Date": "d1", "X": "y"}
    rows = [
        (1, "response", "http://a/x", 10, full, "s1", 9), (2, "response", "https://www.a/x/", 20, full | {"ETag": '"2"'}, "s2", 8),
        (3, "revisit", "http://a/x#f", 20, {"etag": 'W/"1"', "Date": "d3", "Content-Length": "0", "Expires": "e"}, None, None),
        (4, "revisit", "http://a/x", 21, {"ETAG": '"1"'}, None, None), (5, "revisit", "http://a/x", 21, {"Last-Modified": "m"}, None, None),
        (6, "revisit", "http://a/x", 10, {}, None, None), (7, "revisit", "http://a/x", 30, None, None, None),
        (8, "revisit", None, 30, {}, None, None), (9, "revisit", "http://a/x", None, {}, None, None), (10, "request", "http://a/x", 5, {}, None, None),
        (11, "revisit", "http://a/x", 30, {"ETag": '"2"', "etag": '"9"'}, None, None),
    ]
    got = resolve(spark, rows)
    assert {k: (r.status, r.refers_to) for k, r in got.items()} == {
        3: ("resolved", 1), 4: ("mismatch", None), 5: ("resolved", 2), 6: ("no_earlier", None), 7: ("unvalidated", 2),
        8: ("no_key", None), 9: ("no_key", None), 11: ("resolved", 2)}
    assert dict(map(tuple, got[3].headers)) == {"etag": 'W/"1"', "date": "d3", "expires": "e", "content-length": "9", "last-modified": "m", "x": "y"}
    assert (got[3].payload_sha256, got[3].payload_bytes) == ("s1", 9)


def test_ties_and_one_url_with_all_rows(spark):
    """The one URL is dealt over all partitions; times repeat across their borders."""
    rows = []
    for i in range(3_000):
        kind = "response" if i % 3 == 0 else "revisit"
        rows.append((i, kind, "http://a/x", (i * 7919) % 60, {}, f"s{i}" if i % 3 == 0 else None, i))
    got = resolve(spark, rows)
    for i, _, _, date, *_ in (r for r in rows if r[1] == "revisit"):
        best = max(((d, k) for k, t, _, d, *_ in rows if t == "response" and d < date), default=(None, None))
        assert (got[i].refers_date, got[i].refers_to) == best


def test_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/x", "<p>"), (2, None, None), (3, "", ""), (None, "http://a/x", "<p>"), (1, "http://a/x", "<p>")],
                                  "page_id long, url string, html string")
    out = warc.resolve_pages(cluttered(pages))
    assert out.count() == 5 and warc.resolve_pages(pages.limit(0)).count() == 0
