"""Typed table scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window


class SchemaMismatch(ValueError):
    pass


def scan_table(spark: SparkSession, path: str, expect: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet file/folder or catalog table (``db.name``) scan with an
    optional column-type check (S1).

    The check reads only the footer schema; column pruning and pushed
    filters still apply to whatever the caller selects afterwards.
    """
    is_path = "/" in path or path.endswith(".parquet")
    df = spark.read.parquet(path) if is_path else spark.table(path)
    if expect:
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        bad = {c: (t, have.get(c)) for c, t in expect.items() if have.get(c) != t}
        if bad:
            raise SchemaMismatch(f"{path}: expected/actual types differ: {bad}")
    return df


# --- fixed values: the quoting of exported files -----------------------------
QUOTING = {"quote": '"', "escape": '"'}
# -----------------------------------------------------------------------------


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files as (file, record, first), read in splits although quoted cells may hold line breaks.

    A line break ends a record when the number of quotes before it in the file is even (a doubled quote counts
    twice).  Quotes are summed for each split, then over the splits of a file, one row each; with what comes before
    it a split knows whether a line of its own begins inside a quoted cell.  Lines that are records stay where they are;
    only the lines of records with breaks meet.  ``first`` marks a file's first record."""
    split = ["file", "block"]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    own = lines.groupBy(*split).agg((F.sum(quotes) % 2).alias("odd"), F.min("at").alias("begin"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row a split
    own = own.select(*split, "begin", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("carried"), (F.min("block").over(
        Window.partitionBy("file")) == F.col("block")).alias("opens"))
    upto = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.join(own, split).withColumn("after", F.col("carried") + F.sum(quotes).over(upto))
    starts, ends = (F.col("after") - quotes) % 2 == 0, F.col("after") % 2 == 0
    lines = lines.withColumns({"starts": starts, "ends": ends, "first": F.col("opens") & (F.col("at") == F.col("begin"))})
    text = F.when(F.col("first"), F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    alone = lines.filter("starts AND ends").select("file", text.alias("record"), "first")
    # the split and line where a record with breaks began
    broken = lines.filter("NOT (starts AND ends)").withColumn("value", text)
    here = F.last(F.when(F.col("starts"), F.struct("block", "at")), ignorenulls=True)
    last = broken.groupBy(*split).agg(F.max(F.when(F.col("starts"), F.struct("block", "at"))).alias("begun"))
    last = last.withColumn("begun_before", F.last("begun", ignorenulls=True).over(earlier)).drop("begun")
    broken = broken.join(last, split).withColumn("begun", F.coalesce(here.over(upto), "begun_before"))
    whole = broken.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("l"), F.max("first").alias("first"))
    joined = whole.select("file", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("record"), "first")
    every = alone.unionByName(joined)
    return every.withColumn("record", F.regexp_replace("record", "\r$", "")).filter(F.trim("record") != "")


def scan_csv_typed(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """All-string CSV with a header per file, cast on read with ``try_cast``.

    Files of any size are read in splits (``csv_records``).  Unparsable text becomes null
    instead of failing the job; all files have the same header.  No row cap: the original's
    silent 10,000-row truncation is not reproduced."""
    names = spark.read.options(header=True, multiLine=True, **QUOTING).csv(path).columns
    records = csv_records(spark, path)
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    cells = records.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), dict(QUOTING)).alias("r"), "first")
    return cells.filter("NOT first").select(*[(F.col(f"r.c{i}").try_cast(types[c]) if c in types else F.col(f"r.c{i}")).alias(c) for i, c in enumerate(names)])
