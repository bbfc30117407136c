"""URL filter with redirect equivalence (DataFrame functions only).

A rule (verdict, host, path) fits the URLs of its host and all its subdomains whose path starts with the rule's;
of several, the longest wins.  URLs that no rule fits are judged by their aliases: redirect and canonical-link edges
join URLs into components, found by distributed rounds of joins, and a block of one member holds for the others.

Explicit allows come first twice: a rule that fits a URL always beats what its aliases say, and a component with an
explicitly allowed member passes no block on.  What is left is allowed.

Vertices are canonical URLs (``warc.canonical_url``: no scheme, fragment, ``www.``, default port, closing slash or
tracking parameters), so that spellings a server redirects to each other are one vertex without an edge.  Edges come
from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` elements of the pages, outside comments and scripts,
and from any table of (url, target) that is passed.  Targets that are no page of the table carry decisions too.

One URL may hold any share of the rows: decisions meet rows by (URL, salt), and groups are added up before they shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and has no aliases; of
equally long rules an allow wins; repeated rows are judged alike; relative targets are resolved against the page's URL
(dot segments other than a leading ``./`` stay); an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, with_group
from .components import connected
from .warc import canonical_url

ALLOW, BLOCK = "allow", "block"
#: Rules (verdict, host, path) of the registered query (fixed values).
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: So many rules become one expression; more of them are joined.
INLINE = 256
SALTS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def _ranked(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != ALLOW, r))


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Add ``rule`` (host and path of the longest that fits) and ``own`` (its verdict) to rows with host and path.

    ``rules`` is a short list, or a table (verdict, host, path) of any length."""
    if isinstance(rules, DataFrame):
        return _joined(urls, rules)
    if len(rules) > INLINE:
        return _joined(urls, urls.sparkSession.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string"))
    none = F.lit(None).cast("string")
    rule, own = none, none
    for verdict, host, path in reversed(_ranked(rules)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, own = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(own)
    return urls.withColumns({"rule": rule, "own": own})


def _joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Equijoin on (host suffix, path prefix): one probe for each suffix and each length that a rule's path has."""
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").select("verdict", F.col("host").alias("_host"), F.col("path").alias("_path"))
    lengths = F.array([F.lit(r[0]) for r in rules.select(F.length("_path")).distinct().collect()] or [F.lit(0)])  # distinct lengths only
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = pairs.select("host", "path", F.explode(suffixes).alias("_host"), F.col("path").alias("p")).select(
        "host", "path", "_host", F.explode(F.filter(lengths, lambda n: n <= F.length("p"))).alias("n"))
    probes = probes.withColumn("_path", F.substr("path", F.lit(1), F.col("n")))
    rank = F.struct(F.length(F.concat("_host", "_path")).alias("n"), (F.col("verdict") == ALLOW).alias("allows"), "_host", "_path")
    best = probes.join(rules, ["_host", "_path"]).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("_host", "_path").alias("rule"), "verdict"), rank).alias("best"))
    # one host and path may hold a third of the rows
    salted = urls.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    spread = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return salted.join(spread, ["host", "path", "_salt"], "left").drop("_salt")


def absolute(base: Column, target: Column) -> Column:
    """The target of a link as a whole URL; null for none, for fragments and for other kinds of address."""
    return _let(F.trim(F.regexp_replace(target, "(?i)&amp;", "&")), lambda t: _resolved(base, t))


def _resolved(base: Column, t: Column) -> Column:
    scheme, host, path = (F.regexp_extract(base, p, 1) for p in ("^([^/?#:]*)://", "^[^/?#:]*://([^/?#]*)", "^[^/?#:]*://[^/?#]*([^?#]*)"))
    site = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    return (F.when((t == "") | t.startswith("#"), None).when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), t)
            .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t)).when(t.startswith("/"), F.concat(site, t))
            .when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None).when(t.startswith("?"), F.concat(site, path, t))
            .otherwise(F.concat(site, folder, F.regexp_replace(t, "^([.]/)+", ""))))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute: quoted either way, or bare."""
    found = [F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*{quoted}", 1) for quoted in ('"([^"]*)"', "'([^']*)'", r"([^\s\"'>]+)")]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found], F.lit(""))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def page_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of the canonical links and refresh redirects in the pages' heads and bodies."""
    html = F.col("html")
    may = (html.rlike(r"(?i)<link\b") & html.rlike("(?i)canonical")) | (html.rlike(r"(?i)<meta\b") & html.rlike("(?i)refresh"))
    some = pages.where(F.col("url").isNotNull() & may)
    # what a browser does not read as elements goes first
    bare = some.select("url", F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ").alias("html"))
    tags = bare.select("url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"), F.lit(0))).alias("tag"))
    link = F.col("tag").rlike("(?is)^<link") & _attribute(F.col("tag"), "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = F.col("tag").rlike("(?is)^<meta") & (F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))) == "refresh")
    goes = F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*['\"]?([^'\"]*)", 1)
    target = F.when(link, _attribute(F.col("tag"), "href")).when(refresh, goes)
    return tags.select("url", absolute(F.col("url"), target).alias("target")).where("target IS NOT NULL").distinct()


def vertex(url: Column) -> Column:
    """128 bits of a digest of the canonical URL; null without ``://``."""
    return F.when(url.contains("://"), F.substring(F.sha2(canonical_url(url).cast("binary"), 256), 1, 32))


def blocked_vertices(marks: DataFrame, edges: DataFrame) -> DataFrame:
    """``marks`` (vertex, blocked, allowed), ``edges`` (a, b) -> the vertices of components with a block and without an allow."""
    comps = connected(edges)
    named = marks.join(comps.select(F.col("id").alias("vertex"), "component_id"), "vertex", "left")
    named = staged(named.withColumn("component_id", F.coalesce("component_id", "vertex")), "url-components")
    flags = {c: F.max(c) for c in ("any_blocked", "any_allowed")}
    judged = with_group(named, ["component_id"], F.col("vertex"), {"any_blocked": F.max("blocked"), "any_allowed": F.max("allowed")}, flags)
    return judged.where("any_blocked AND NOT any_allowed").select("vertex")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, via) of each row of ``pages`` (page_id, url, html); ``via`` is ``rule``,
    ``alias`` or ``default``.  ``edges`` (url, target) are redirects known from elsewhere."""
    def ruled(df: DataFrame) -> DataFrame:
        host, path = host_and_path(F.col("url"))
        return with_rules(df.withColumns({"host": host, "path": path, "vertex": vertex(F.col("url"))}), rules)

    links = page_edges(pages)
    if edges is not None:
        links = links.unionByName(edges.select("url", "target").where("url IS NOT NULL AND target IS NOT NULL"))
    links = staged(links, "url-edges")
    rows = staged(ruled(pages.select("page_id", "url")).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), "url-rows")
    ends = ruled(links.select(F.explode(F.array("url", "target")).alias("url")).distinct())
    marks = rows.select("vertex", "own").unionByName(ends.select("vertex", "own")).where("vertex IS NOT NULL")
    marks = marks.groupBy("vertex").agg(F.max(F.coalesce(F.col("own") == BLOCK, F.lit(False))).alias("blocked"),
                                        F.max(F.coalesce(F.col("own") == ALLOW, F.lit(False))).alias("allowed"))
    pairs = links.select(vertex(F.col("url")).alias("a"), vertex(F.col("target")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    blocked = staged(blocked_vertices(marks, pairs), "url-blocked")
    open_rows = rows.where("rule IS NULL AND vertex IS NOT NULL")
    hit = open_rows.select("vertex", "_salt").distinct().join(blocked, "vertex").withColumn("alias", F.lit(True))
    out = open_rows.join(hit, ["vertex", "_salt"], "left").unionByName(
        rows.where("rule IS NOT NULL OR vertex IS NULL").withColumn("alias", F.lit(None).cast("boolean")))
    verdict = F.coalesce("own", F.when(F.col("alias"), F.lit(BLOCK)), F.lit(ALLOW))
    via = F.when(F.col("own").isNotNull(), "rule").when(F.col("alias"), "alias").otherwise("default")
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), via.alias("via"))


ORACLE = r"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
    '(?is)<(?:link|meta)\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM pages WHERE url IS NOT NULL),
att AS (SELECT url, tag, list_transform(['rel', 'href', 'http-equiv', 'content'], lambda n: coalesce(
    nullif(regexp_extract(tag, concat('(?is)[\s"''/]', n, '\s*=\s*"([^"]*)"'), 1), ''),
    nullif(regexp_extract(tag, concat('(?is)[\s"''/]', n, '\s*=\s*''([^'']*)'''), 1), ''),
    regexp_extract(tag, concat('(?is)[\s"''/]', n, '\s*=\s*([^\s"''>]+)'), 1))) AS v FROM tags),
goes AS (SELECT url, trim(regexp_replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(v[1], '(?i)(^|\s)canonical(\s|$)') THEN v[2]
    WHEN regexp_matches(tag, '(?is)^<meta') AND lower(trim(v[3])) = 'refresh'
      THEN regexp_extract(v[4], '(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*[''"]?([^''"]*)', 1) END, '(?i)&amp;', '&', 'g')) AS t,
    regexp_extract(url, '^([^/?#:]*)://', 1) AS scheme, regexp_extract(url, '^[^/?#:]*://([^/?#]*)', 1) AS authority,
    regexp_extract(url, '^[^/?#:]*://[^/?#]*([^?#]*)', 1) AS folder FROM att),
links AS (SELECT DISTINCT url, CASE WHEN t = '' OR t LIKE '#%' THEN NULL WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN t LIKE '//%' THEN scheme || ':' || t WHEN t LIKE '/%' THEN scheme || '://' || authority || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN t LIKE '?%' THEN scheme || '://' || authority || folder || t
    ELSE scheme || '://' || authority || regexp_replace(coalesce(nullif(folder, ''), '/'), '[^/]*$', '') || regexp_replace(t, '^([.]/)+', '') END AS target FROM goes),
urls AS (SELECT url FROM pages UNION SELECT url FROM links WHERE target IS NOT NULL UNION SELECT target FROM links WHERE target IS NOT NULL),
parts AS (SELECT url, translate(regexp_extract(regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1), '(?s)^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1), '(?s)^[^/?#]*([^?#]*)', 1) AS path, regexp_replace(trim(url), '#.*$', '') AS bare FROM urls),
canon AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 1)), '^www[.]|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 2), '/+$', '') AS site,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 3), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|ref|fbclid|gclid)='))), '&') AS query FROM parts),
named AS (SELECT url, host, path, CASE WHEN url LIKE '%://%' THEN CASE WHEN regexp_matches(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$')
    THEN site || CASE WHEN query = '' THEN '' ELSE '?' || query END ELSE bare END END AS vertex FROM canon),
ruled AS (SELECT DISTINCT ON (n.url) n.*, r.h || r.p AS rule, r.verdict AS own FROM named n
    LEFT JOIN rules r ON (n.host = r.h OR suffix(n.host, '.' || r.h)) AND starts_with(n.path, r.p)
    ORDER BY n.url, length(r.h || r.p) DESC NULLS LAST, r.verdict),
edges AS (SELECT a.vertex AS a, b.vertex AS b FROM links l JOIN named a ON a.url = l.url JOIN named b ON b.url = l.target),
reach(a, b) AS (SELECT DISTINCT vertex, vertex FROM ruled WHERE own IS NOT NULL AND vertex IS NOT NULL UNION
    SELECT r.a, e.y FROM reach r JOIN (SELECT a AS x, b AS y FROM edges UNION SELECT b, a FROM edges) e ON e.x = r.b),
told AS (SELECT r.b AS vertex, bool_or(u.own = 'block') AND NOT bool_or(u.own = 'allow') AS blocked FROM reach r JOIN ruled u ON u.vertex = r.a GROUP BY r.b)
SELECT p.page_id, u.host, u.path, u.rule, coalesce(u.own, CASE WHEN t.blocked THEN 'block' ELSE 'allow' END) AS verdict,
    CASE WHEN u.own IS NOT NULL THEN 'rule' WHEN t.blocked THEN 'alias' ELSE 'default' END AS via
FROM pages p JOIN ruled u ON u.url IS NOT DISTINCT FROM p.url LEFT JOIN told t ON t.vertex = u.vertex
"""
