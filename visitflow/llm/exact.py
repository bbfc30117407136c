"""Exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass one sets the filter: every text hash marks ``HASHES`` positions of a bit
array; a position marked once belongs to one row, so a hash can only repeat
where all of its positions were marked at least twice.  Those positions form
the filter.  Pass two tests each row against it: rows that cannot repeat pass
straight through with their own id, only the rest shuffle to find their group.

Positions are counted as numbers (eight bytes a mark, combined before the
shuffle); texts and digests do not move.  The filter is at most ``max_bits``
bits, whatever the input, and that bound is what makes it safe to broadcast.  A
filter too small for the corpus lets more unrepeated rows shuffle; the result
stays the same.

Defined results: a null text is the empty text.  Rows repeated with id and text
share one id, and all of them carry ``kept``; ``dedup`` returns one of them.  A
null ``doc_id`` never beats an id; a group of null ids alone keeps null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, staged, with_group

HASHES = 2
#: Bits of a row of the filter table (4 kB).
ROW_BITS = 1 << 15


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ").cast("binary"), 256)


def _position(digest: Column, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(bits))


def repeat_filter(digests: DataFrame, column: str = "text_sha256", max_bits: int = 1 << 27,
                  bits_per_row: int = 16, times: int = 2) -> tuple[DataFrame, int]:
    """Table (bucket, bitmap) of the positions marked at least ``times`` times, and the number of bits."""
    rows, bits = digests.count(), ROW_BITS
    while bits < min(max_bits, rows * bits_per_row):
        bits *= 2
    marks = digests.select(F.explode(F.array(*[_position(F.col(column), i, bits) for i in range(HASHES)])).alias("position"))
    twice = marks.groupBy("position").count().where(F.col("count") >= times)
    table = (twice.groupBy(F.shiftright("position", 15).cast("int").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.col("position").bitwiseAND(ROW_BITS - 1)).alias("bitmap")))
    return staged(table, "exact-filter"), bits


def may_repeat(df: DataFrame, table: DataFrame, bits: int, column: str = "text_sha256", flag: str = "may_repeat") -> DataFrame:
    """Add ``flag``: false only for rows whose hash occurs once."""
    test = F.lit(True)
    for i in range(HASHES):
        at = f"__at{i}"
        df = df.withColumn(at, _position(F.col(column), i, bits))
        # at most max_bits / ROW_BITS rows of 4 kB
        df = df.join(F.broadcast(table.select(F.col("bucket").alias(f"__bucket{i}"), F.col("bitmap").alias(f"__bitmap{i}"))),
                     F.shiftright(F.col(at), 15).cast("int") == F.col(f"__bucket{i}"), "left")
        bit = F.col(at).bitwiseAND(ROW_BITS - 1).cast("int")
        byte = F.conv(F.hex(F.col(f"__bitmap{i}").substr(F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        test = test & F.coalesce(_bit(byte, bit), F.lit(False))
    df = df.withColumn(flag, test)
    return df.drop(*[f"{n}{i}" for i in range(HASHES) for n in ("__at", "__bucket", "__bitmap")])


def _bit(byte: Column, bit: Column) -> Column:
    return F.floor(byte / F.pow(F.lit(2), bit.bitwiseAND(7))).cast("int").bitwiseAND(1) == 1


def groups(docs: DataFrame, max_bits: int = 1 << 27) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    digests = staged(docs.select("doc_id", text_digest(F.col("text")).alias("text_sha256")), "exact-digests")
    table, bits = repeat_filter(digests, max_bits=max_bits)
    probed = may_repeat(digests, table, bits)
    alone = probed.where("not may_repeat").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    grouped = with_group(probed.where("may_repeat"), ["text_sha256"], F.col("doc_id"),
                         {"keep_id": F.min("doc_id"), "group_size": F.count(F.lit(1))},
                         {"keep_id": F.min("keep_id"), "group_size": F.sum("group_size")})
    out = alone.unionByName(grouped.select(*alone.columns))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def dedup(docs: DataFrame, max_bits: int = 1 << 27) -> DataFrame:
    """``docs`` without the repeated texts: of equal texts the row with the smallest id.

    Rows that pass the filter keep their place; texts shuffle only for the others.
    """
    sha, flag = "__text_sha256", "__may_repeat"
    digests = staged(docs.select("doc_id", text_digest(F.col("text")).alias("text_sha256")), "exact-digests")
    table, bits = repeat_filter(digests, max_bits=max_bits)
    probed = may_repeat(docs.withColumn(sha, text_digest(F.col("text"))), table, bits, sha, flag)
    keep = (may_repeat(digests, table, bits).where("may_repeat")
            .groupBy("text_sha256").agg(F.min("doc_id").alias("__keep_id")))
    again = probed.where(F.col(flag))
    # the kept id is part of the key: a group of copies does not meet in one partition
    stay = (again.join(keep, (again[sha] == keep["text_sha256"]) & again["doc_id"].eqNullSafe(keep["__keep_id"]), "left_semi")
            .dropDuplicates(["doc_id", sha]))
    return probed.where(~F.col(flag)).unionByName(stay).select(*docs.columns)


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM n
"""
