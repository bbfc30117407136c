"""Web-archive revisits: resolve "not modified" records to the response they confirm.

A revisit record carries no body.  It stands for the latest full response of
the same canonical URL that was captured strictly before it (an as-of join).
Its validators must agree with that response: entity tags by weak comparison
where the revisit has one, else the modification date.  The resolved record has
the response's body and headers, with those headers of the revisit merged in
that a 304 answer may change.

The join orders all records by (URL, time, id) in range partitions, so a URL of
any size is dealt over many tasks; each (URL, partition) is then searched by a
window, and what precedes it comes from two summary rows of each earlier one.

Defined results: a record without URL or date gets status ``no_key``; of
responses at one time the largest record id counts; header names compare in
lower case and the first of a repeated name counts; a null header map is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

#: Headers of a 304 answer that replace those of the stored response (fixed values).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not name a resource (fixed values).
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)="


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slashes,
    sorted query without tracking parameters; scheme and fragment dropped."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = "^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, parts, 1)), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, parts, 2), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(bare, parts, 3), "&"), lambda q: (q != "") & ~q.rlike(TRACKING))
    query = F.array_join(F.array_sort(query), "&")
    full = F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(bare.rlike(parts), full).otherwise(bare)


def header_list(headers: Column) -> Column:
    """Map -> sorted (name, value) entries, names in lower case, one entry a name."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), e["value"].alias("value")))
    names = F.transform(entries, lambda e: e["name"])
    first = F.filter(entries, lambda e, i: F.array_position(names, e["name"]) == i + 1)
    return F.coalesce(F.array_sort(first), F.array().cast("array<struct<name:string,value:string>>"))


def header(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["name"] == name), F.lit(0))["value"]


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored entries, with the permitted ones of the 304 answer in their place or added."""
    allowed = F.filter(fresh, lambda e: e["name"].isin(*PERMITTED))
    names = F.transform(allowed, lambda e: e["name"])
    kept = F.filter(stored, lambda e: ~F.array_contains(names, e["name"]))
    return F.array_sort(F.concat(kept, allowed))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def as_of_response(records: DataFrame) -> DataFrame:
    """Rows (url, ts, is_response, row) -> all rows with ``found``: the ``row`` of
    the latest response of the URL with a smaller ``ts`` (null: none).  ``row``
    is an orderable struct that starts with ts; null urls and dates are absent."""
    spark = records.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(records.repartitionByRange(parts, "url", "ts", "row").withColumn("part", F.spark_partition_id()), "warc-ordered")
    response = F.when(F.col("is_response"), F.col("row"))
    here = Window.partitionBy("url", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.max(response).over(here))
    # of each (url, partition): its best response, and its best one before its last moment
    ends = rows.groupBy("url", "part").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    best = (rows.where("is_response").join(ends.select("url", "part", "hi"), ["url", "part"])
            .groupBy("url", "part").agg(F.max("row").alias("r1"), F.max(F.when(F.col("ts") < F.col("hi"), F.col("row"))).alias("r2")))
    summary = best.select("url", F.explode(F.array("r1", "r2")).alias("r")).where("r IS NOT NULL")
    none = F.lit(None).cast(records.schema["row"].dataType)
    marks = (summary.select("url", F.col("r.ts").alias("ts"), "r", F.lit(None).cast("int").alias("part"))
             .unionByName(ends.select("url", F.col("lo").alias("ts"), none.alias("r"), "part")))
    by_time = Window.partitionBy("url").orderBy("ts")
    marks = marks.withColumn("upto", F.max("r").over(by_time.rangeBetween(Window.unboundedPreceding, 0)))
    marks = marks.withColumn("before", F.max("r").over(by_time.rangeBetween(Window.unboundedPreceding, -1)))
    carry = marks.where("part IS NOT NULL").select("url", "part", F.col("ts").alias("lo"), "upto", "before")
    out = inside.join(carry, ["url", "part"])
    found = F.when(F.col("ts") > F.col("lo"), F.greatest("inside", "upto")).otherwise(F.col("before"))
    return out.withColumn("found", found).drop("inside", "part", "lo", "upto", "before")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve the revisits of ``records`` (record_id, warc_type, target_uri, date
    as epoch seconds, headers map, payload_sha256, payload_bytes).

    One row a revisit: record_id, canonical_url, status (``resolved``,
    ``unvalidated``, ``mismatch``, ``no_earlier``, ``no_key``), refers_to,
    refers_date, headers (name, value entries), payload_sha256, payload_bytes."""
    rec = records.where(F.col("warc_type").isin("response", "revisit")).select(
        F.col("record_id").cast("long"), (F.col("warc_type") == "response").alias("is_response"), canonical_url(F.col("target_uri")).alias("url"),
        F.col("date").cast("long").alias("ts"), header_list(F.col("headers")).alias("h"), "payload_sha256", F.col("payload_bytes").cast("long"))
    row = F.struct("ts", "record_id", "h", "payload_sha256", "payload_bytes")
    rec = rec.select("url", "ts", "is_response", row.alias("row"))
    keyed = as_of_response(rec.where("url IS NOT NULL AND ts IS NOT NULL")).where("NOT is_response")
    lost = rec.where("NOT is_response AND (url IS NULL OR ts IS NULL)").withColumn("found", F.lit(None).cast(rec.schema["row"].dataType))
    out = keyed.unionByName(lost)
    fresh, stored = F.col("row.h"), F.col("found.h")
    tag, changed = header(fresh, "etag"), header(fresh, "last-modified")
    agrees = (F.when(tag.isNotNull(), F.coalesce(_weak(tag) == _weak(header(stored, "etag")), F.lit(False)))
              .when(changed.isNotNull(), F.coalesce(changed == header(stored, "last-modified"), F.lit(False))))
    status = (F.when(F.col("url").isNull() | F.col("ts").isNull(), "no_key").when(F.col("found").isNull(), "no_earlier")
              .when(agrees.isNull(), "unvalidated").when(agrees, "resolved").otherwise("mismatch"))
    out = out.withColumn("status", status)
    ok = F.col("status").isin("resolved", "unvalidated")
    return out.select(F.col("row.record_id").alias("record_id"), F.col("url").alias("canonical_url"), "status",
                      F.when(ok, F.col("found.record_id")).alias("refers_to"), F.when(ok, F.col("found.ts")).alias("refers_date"),
                      F.when(ok, merged_headers(stored, fresh)).otherwise(fresh).alias("headers"),
                      F.when(ok, F.col("found.payload_sha256")).alias("payload_sha256"), F.when(ok, F.col("found.payload_bytes")).alias("payload_bytes"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two captures of each page: a full response, and a later "not modified"
    answer whose validators agree, are weak, differ, or are missing, by page id."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    k = F.col("page_id")
    p = p.select(k, "url", F.sha2(F.col("html").cast("binary"), 256).alias("sha"), F.octet_length("html").cast("long").alias("bytes"),
                 (F.lit(1_700_000_000) + F.pmod(k * 7919, F.lit(1_000_003)) * 60).alias("at"))
    tag = F.concat(F.lit('"'), F.substring("sha", 1, 16), F.lit('"'))
    changed = F.concat(F.lit("day "), F.pmod(k, F.lit(365)).cast("string"))
    full = F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("bytes").cast("string"), F.lit("ETag"), tag,
                        F.lit("Last-Modified"), changed, F.lit("Date"), F.col("at").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"))
    later = F.col("at") + 86400 * (1 + F.pmod(k, F.lit(30)))
    sent = (F.when(F.pmod(k, F.lit(7)) == 0, F.lit('"other"')).when(F.pmod(k, F.lit(5)) == 0, F.concat(F.lit("W/"), tag))
            .when(F.pmod(k, F.lit(3)) != 0, tag))
    same = F.when(F.pmod(k, F.lit(2)) == 0, changed)
    answer = F.map_filter(F.create_map(F.lit("ETag"), sent, F.lit("last-modified"), same, F.lit("Date"), later.cast("string"),
                                       F.lit("Cache-Control"), F.lit("max-age=120"), F.lit("Content-Length"), F.lit("0")), lambda _, v: v.isNotNull())
    empty = F.lit(None)
    response = F.struct((k * 2).alias("record_id"), F.lit("response").alias("warc_type"), F.col("url").alias("target_uri"), F.col("at").alias("date"),
                        full.alias("headers"), F.col("sha").alias("payload_sha256"), F.col("bytes").alias("payload_bytes"))
    revisit = F.struct((k * 2 + 1).alias("record_id"), F.lit("revisit").alias("warc_type"), F.col("url").alias("target_uri"), later.alias("date"),
                       answer.alias("headers"), empty.cast("string").alias("payload_sha256"), empty.cast("long").alias("payload_bytes"))
    return p.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def resolve_pages(pages: DataFrame) -> DataFrame:
    """``resolve_revisits`` over the captures of ``pages``; headers as ``name: value`` lines."""
    out = resolve_revisits(crawl_records(pages))
    lines = F.array_join(F.transform("headers", lambda e: F.concat(e["name"], F.lit(": "), e["value"])), "\n")
    return out.withColumn("headers", lines)


ORACLE = r"""
WITH p AS (SELECT page_id AS k, url, sha256(coalesce(html, '')) AS sha, strlen(coalesce(html, '')) AS bytes,
    1700000000 + (page_id * 7919) % 1000003 * 60 AS captured, regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
u AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 1)), '^www[.]|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 2), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$', 3), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|ref|fbclid|gclid)='))), '&') AS query FROM p),
c AS (SELECT *, CASE WHEN regexp_matches(bare, '^(?i:https?)://([^/?]*)([^?]*)[?]?(.*)$')
      THEN host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END ELSE bare END AS canon,
    '"' || substr(sha, 1, 16) || '"' AS tag, 'day ' || (k % 365) AS changed, captured + 86400 * (1 + k % 30) AS later FROM u),
r AS (SELECT *, CASE WHEN k % 7 = 0 THEN '"other"' WHEN k % 5 = 0 THEN 'W/' || tag WHEN k % 3 <> 0 THEN tag END AS sent,
    CASE WHEN k % 2 = 0 THEN changed END AS same FROM c),
f AS (SELECT r.k, r.canon, r.later, r.sent, r.same, s.k AS sk, s.captured, s.sha, s.bytes, s.tag, s.changed,
    row_number() OVER (PARTITION BY r.k ORDER BY s.captured DESC NULLS LAST, s.k DESC) AS n
  FROM r LEFT JOIN c s ON s.canon = r.canon AND s.captured < r.later),
t AS (SELECT *, CASE WHEN sk IS NULL THEN 'no_earlier' WHEN sent IS NULL AND same IS NULL THEN 'unvalidated'
    WHEN sent IS NOT NULL THEN CASE WHEN regexp_replace(sent, '^W/', '') = tag THEN 'resolved' ELSE 'mismatch' END
    WHEN same = changed THEN 'resolved' ELSE 'mismatch' END AS status FROM f WHERE n = 1)
SELECT 2 * k + 1 AS record_id, canon AS canonical_url, status,
  CASE WHEN status IN ('resolved', 'unvalidated') THEN 2 * sk END AS refers_to,
  CASE WHEN status IN ('resolved', 'unvalidated') THEN captured END AS refers_date,
  CASE WHEN status IN ('resolved', 'unvalidated')
    THEN 'cache-control: max-age=120' || chr(10) || 'content-length: ' || bytes || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || later
      || chr(10) || 'etag: ' || coalesce(sent, tag) || chr(10) || 'last-modified: ' || changed
    ELSE 'cache-control: max-age=120' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || later
      || CASE WHEN sent IS NULL THEN '' ELSE chr(10) || 'etag: ' || sent END || CASE WHEN same IS NULL THEN '' ELSE chr(10) || 'last-modified: ' || same END
    END AS headers,
  CASE WHEN status IN ('resolved', 'unvalidated') THEN sha END AS payload_sha256,
  CASE WHEN status IN ('resolved', 'unvalidated') THEN bytes END AS payload_bytes
FROM t
"""
