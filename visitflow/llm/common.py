"""Shared helpers: staged tables in the shared folder and group lookups without a hot key."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java regex class; the words of a text lie between runs of it.
SPACE = "[\\x20\\x09-\\x0D]"


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Without the setting: the
    context's checkpoint folder, then a scratch folder for a ``local`` master
    (one machine); any other master raises."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file:" + tempfile.mkdtemp(prefix="visitflow-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and lets several consumers share it."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """In a task: hand memory that is no longer used back to the system, since the Python worker lives on."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def with_group(df: DataFrame, keys: list[str], spread: Column, first: dict[str, Column],
               last: dict[str, Column], salts: int = 64) -> DataFrame:
    """Attach aggregates of each row's group to the row.

    ``first`` aggregates the rows, ``last`` merges those partial results by
    name.  A key of any size is dealt over ``salts`` partitions (``spread``
    picks the one of a row); the merged result goes back only to the salts in
    which the key occurs, so it is never copied to more rows than the group has.
    Keys must not be null.  ``df`` is read twice: pass a staged or cheap frame.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in first.items()])
    whole = part.groupBy(*keys).agg(*[c.alias(n) for n, c in last.items()], F.collect_set("_salt").alias("_salts"))
    back = whole.select(*keys, *last, F.explode("_salts").alias("_salt"))
    return salted.join(back, [*keys, "_salt"]).drop("_salt")
