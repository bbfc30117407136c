"""Sinks (S12-S14): append-only status log, JSON reports, message outbox."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import with_position

LOG_COLUMNS = ("nid", "fecha", "estado", "usuario")
LOG_SCHEMA = ", ".join(f"{c} string" for c in LOG_COLUMNS)


def _next_sequence(spark: SparkSession, path: str, fmt: str) -> int:
    try:
        last = spark.read.format(fmt).load(path).agg(F.max("seq")).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    return 0 if last is None else last + 1


def status_rows(df: DataFrame, order: Sequence[str], start: int = 0) -> DataFrame:
    """Rows as the log writer stores them (S12): null -> '', server timestamp,
    and ``seq``, which grows from ``start`` in the rows' ``order``."""
    ordered = df.orderBy(*order).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LOG_COLUMNS])
    return ordered.withColumn("timestamp", F.current_timestamp()).withColumn("seq", F.monotonically_increasing_id() + start)


def status_append(df: DataFrame, path: str, order: Sequence[str], fmt: str = "parquet") -> None:
    """Append-only write (S12); existing rows are never rewritten.

    ``order`` names the columns that order the rows of this append (the last of
    one key wins later).  Sequences continue after the log's largest one; a
    log has one writer at a time (``StatusLog`` takes any number)."""
    start = _next_sequence(df.sparkSession, path, fmt)
    status_rows(df, order, start).write.mode("append").format(fmt).save(path)


class StatusLog:
    """An append-only status log with any number of writers.

    Writers ``submit`` rows: each submission is one file below the inbox, which appears as a
    whole.  ``sequence`` is a checkpointed stream over the inbox: the micro-batch's number and the row's
    place in it, in order of submission, make ``seq``.  No largest number is read, a batch that
    runs again writes the same rows to the same folder, and a second run of it at the same
    time fails in the stream's checkpoint.  Rows get their numbers when they are sequenced; until then
    they are in the inbox, not in the log."""

    #: Rows that a micro-batch can number.
    BATCH = 1 << 36

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.inbox, self.log = f"{self.folder}/inbox", f"{self.folder}/log"

    def submit(self, df: DataFrame, order: Sequence[str]) -> None:
        """Hand in rows; ``order`` names the columns that order the rows of this submission."""
        # the edits of one request: one file, so that none is read in part, in a folder that no other job writes to
        rows = status_rows(df, order).withColumnRenamed("seq", "place").coalesce(1)
        rows.write.parquet(f"{self.inbox}/submission={uuid.uuid4().hex}")

    def sequence(self, max_files: int | None = None) -> None:
        """Number what has come in, in order of submission."""
        source = self.spark.readStream.schema(f"{LOG_SCHEMA}, timestamp timestamp, place bigint, submission string")
        if max_files is not None:
            source = source.option("maxFilesPerTrigger", max_files)

        def write(batch: DataFrame, number: int) -> None:
            rows = with_position(batch, ["timestamp", "submission", "place"])
            rows = rows.select(*LOG_COLUMNS, "timestamp", (F.lit(number * self.BATCH).cast("bigint") + F.col("pos")).alias("seq"))
            rows.write.mode("overwrite").parquet(f"{self.log}/batch={number}")

        try:
            submitted = source.parquet(self.inbox)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # nothing was ever submitted
        (submitted.writeStream.option("checkpointLocation", f"{self.folder}/checkpoint")
         .foreachBatch(write).trigger(availableNow=True).start().awaitTermination())

    def rows(self) -> DataFrame:
        """The sequenced log."""
        schema = f"{LOG_SCHEMA}, timestamp timestamp, seq bigint"
        try:
            return self.spark.read.schema(f"{schema}, batch bigint").parquet(self.log).drop("batch")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def json_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def outbox_rows(df: DataFrame, to: str = "email", fixed_to: str | None = None) -> DataFrame:
    """Messages as ``(to, subject, body, ...)`` rows (S14): the recipient is
    the ``to`` column, or ``fixed_to`` for messages with fixed recipients."""
    rcpt = F.lit(fixed_to) if fixed_to is not None else F.col(to)
    rest = [c for c in df.columns if c not in (to, "subject", "body")]
    return df.select(rcpt.alias("to"), "subject", "body", *rest)


def outbox_write(df: DataFrame, path: str, to: str = "email", fixed_to: str | None = None) -> None:
    """Message outbox table (S14); delivery is out of scope."""
    outbox_rows(df, to, fixed_to).write.mode("overwrite").parquet(path)
