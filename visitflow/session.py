"""Session helpers: local sessions for tests/bench, shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column for error messages;
    # the stack inspection costs milliseconds per expression when plans are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "visitflow", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only set one when the cluster has none.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...) and
    is used as is.  Only a session without it (tests, local runs) gets a fresh
    scratch folder, registered on the SparkContext (the conf itself cannot be
    changed at run time); on any other master it raises, because executors
    would each write to a disk of their own.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="visitflow-ckpt-"))
    return sc.getCheckpointDir()


def checkpoint_path(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it is computed once, and lost executors cost no recomputation."""
    path = checkpoint_path(df.sparkSession, f"landed/{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
