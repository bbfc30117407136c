"""Structured Streaming twins of the batch folds (ST1-ST4).

The original re-reads whole inputs on every request; here the inputs that are
really streams (the status log, the visit log, report rows) are read
incrementally with ``trigger(availableNow=True)``, once per run.

Results live where the engine keeps them.  A fold's current values are the state
of its aggregate, read back with the state data source: the engine folds its change
files into snapshots and deletes old ones, so a read costs the same after ten
batches and after ten thousand.  Final rows go to a parquet file sink, whose log makes
each batch visible once and as a whole.  Work per micro-batch is that of its rows,
whatever came before.  Without ``root`` each call starts a fresh run folder under
``spark.checkpoint.dir``; with a stable ``root`` a restarted stream resumes.

* ST1 ``status_fold_stream``, read with ``current_values``.
* ST2 ``dedup_reports_stream``: duplicates within a horizon are dropped by the
  engine's watermark, which also forgets keys behind it.  Read with ``deduplicated``.
* ST3 ``latest_upsert_stream``: latest row per key, read with ``read_keyed``.
* ST4 ``daily_counts_stream``: tumbling days behind a watermark.  ``daily_counts`` adds
  up the closed days, the open ones and what came late; ``closed_counts`` are the
  closed days alone.

Late rows (ST2, ST4).  A run has a day, ``as_of``, which never goes back.  Rows that are
older than the horizon on that day, or without a time, are set aside in a stream of
their own; newer times count as ``as_of``.  The watermark can then never pass
a row that is not set aside, so no row is lost, in whatever order files come.

State is held by key in ``spark.sql.shuffle.partitions`` partitions, fixed by the first
run of a folder; for large state set ``spark.sql.streaming.stateStore.providerClass``
to the RocksDB provider.  A stream that has seen no row reads as an empty table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions.text import falsy_chain
from ..operators import joins
from ..operators.status import status_entries
from ..session import checkpoint_path


def stream_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet file or folder as a stream.  A single file is addressed
    through a glob (a streaming file source needs a directory or pattern);
    the schema is taken from the footer, not inferred from data."""
    schema = spark.read.parquet(path).schema
    src = path if not path.endswith(".parquet") else path[:-1] + "[t]"
    r = spark.readStream.schema(schema)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(src)


def _run_dir(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, f"streams/{name}/{uuid.uuid4().hex}")


def _checkpoint(run: str, part: str = "main") -> str:
    return f"{run}/checkpoints/{part}"


def _run(writer: DataStreamWriter, run: str, part: str = "main") -> None:
    """Process what is there and wait for it."""
    writer.option("checkpointLocation", _checkpoint(run, part)).trigger(availableNow=True).start().awaitTermination()


def _append(rows: DataFrame, run: str, part: str) -> None:
    _run(rows.writeStream.outputMode("append").format("parquet").option("path", f"{run}/{part}"), run, part)


def _appended(spark: SparkSession, run: str, part: str, schema: StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{run}/{part}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _state(spark: SparkSession, run: str, part: str = "main") -> DataFrame | None:
    """Keys and values of an aggregate's state as of the last batch; None before the first."""
    try:
        rows = spark.read.format("statestore").load(_checkpoint(run, part))
    except SparkRuntimeException as e:
        if not (e.getCondition() or "").startswith("STDS_COMMITTED_BATCH_UNAVAILABLE"):
            raise
        return None
    return rows.select("key", "value")


def _values(state: DataFrame, names: Sequence[str]) -> DataFrame:
    """The state with its values' fields, one for each aggregate, named ``names``."""
    return state.select("key", "value.*").toDF("key", *names)


# ---------------------------------------------------------------- ST1 -----
STATUS = "nid string, kind string, value string"


def status_fold_stream(spark: SparkSession, log: DataFrame, day: str, name: str = "status_fold",
                       root: str | None = None) -> str:
    """ST1: continuous status fold; returns the run folder."""
    run = root or _run_dir(spark, name)
    fold = status_entries(log, day).groupBy("nid", "kind").agg(F.max(F.struct("seq", "value")).alias("last"))
    _run(fold.writeStream.outputMode("update").format("noop"), run)
    return run


def current_values(spark: SparkSession, run: str) -> DataFrame:
    """(nid, kind, value): the last value of each key."""
    state = _state(spark, run)
    if state is None:
        return spark.createDataFrame([], STATUS)
    return _values(state, ["last"]).select("key.nid", "key.kind", "last.value")


# ---------------------------------------------------------------- ST2 -----
REPORT_KEYS = ["nid", "fecha_reporte"]


def _split_late(rows: DataFrame, at: Column, as_of: dt.date, horizon_days: int) -> tuple[DataFrame, DataFrame]:
    """(on time, late): the rows on time carry ``event_time``, ``at`` up to the end of ``as_of``."""
    end = F.lit(dt.datetime.combine(as_of + dt.timedelta(days=1), dt.time()).isoformat() + "Z").cast("timestamp")
    first = end - F.make_dt_interval(days=F.lit(horizon_days))
    timed = rows.withColumn("event_time", F.when(at.isNotNull(), F.least(at, end)))
    # a row at the watermark itself counts as behind it
    recent = F.coalesce(F.col("event_time") > first, F.lit(False))
    return timed.filter(recent), timed.filter(~recent).drop("event_time")


def dedup_reports_stream(spark: SparkSession, rows: DataFrame, as_of: dt.date, horizon_days: int = 30,
                         name: str = "dedup_reports", root: str | None = None) -> str:
    """ST2: duplicate-report suppression; returns the run folder (``kept`` and ``late``)."""
    run = root or _run_dir(spark, name)
    rows = rows.select(*REPORT_KEYS, F.col("received_at").cast("timestamp").alias("received_at"))
    recent, late = _split_late(rows, F.col("received_at"), as_of, horizon_days)
    recent = recent.withWatermark("event_time", f"{horizon_days} days").dropDuplicatesWithinWatermark(REPORT_KEYS)
    _append(recent.drop("event_time"), run, "kept")
    _append(late, run, "late")
    return run


def reports_of(spark: SparkSession, run: str, part: str) -> DataFrame:
    """Rows of ``kept`` or ``late``."""
    return _appended(spark, run, part, "nid string, fecha_reporte string, received_at timestamp")


def deduplicated(spark: SparkSession, run: str) -> DataFrame:
    """Distinct (nid, fecha_reporte) of the kept rows and the late ones."""
    return reports_of(spark, run, "kept").unionByName(reports_of(spark, run, "late")).select(*REPORT_KEYS).distinct()


# ---------------------------------------------------------------- ST3 -----
def latest_upsert_stream(spark: SparkSession, visits: DataFrame, keys=("nid",), by: str = "modified_date",
                         tiebreak: str = "record_id", name: str = "latest_upsert",
                         root: str | None = None) -> str:
    """ST3: latest row per key, kept up to date per micro-batch; returns the run folder."""
    run = root or _run_dir(spark, name)
    first = [by, tiebreak]
    rest = [c for c in visits.columns if c not in (*keys, *first)]
    latest = visits.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("row"))
    _run(latest.writeStream.outputMode("update").format("noop"), run)
    return run


def read_keyed(spark: SparkSession, run: str, schema: StructType) -> DataFrame:
    """The latest row of each key; ``schema`` is that of the visits."""
    state = _state(spark, run)
    if state is None:
        return spark.createDataFrame([], schema)
    return _values(state, ["row"]).select("key.*", "row.*").select(*schema.names)


# ---------------------------------------------------------------- ST4 -----
COUNTS = "dia string, agente string, canceladas bigint"


def cancellations(visits: DataFrame, master: DataFrame, cancel_statuses) -> DataFrame:
    """Cancelled visits with their agent and the day of their last change."""
    v = visits.filter(F.col("status").isin(list(cancel_statuses)))
    v = joins.left_cast(v, master, "nid", "nid", ["c_comercial_captacion"])
    return v.select(F.substring("modified_date", 1, 10).alias("dia"), falsy_chain("c_comercial_captacion", "email_agendador").alias("agente"), "modified_date")


def daily_counts_stream(spark: SparkSession, visits: DataFrame, master: DataFrame, cancel_statuses, as_of: dt.date,
                        horizon_days: int = 7, name: str = "daily_counts", root: str | None = None) -> str:
    """ST4: cancellations per agent and UTC day; returns the run folder.

    A day is closed, and its counts final but for late rows, once the newest event time is ``horizon_days`` past its end."""
    run = root or _run_dir(spark, name)
    md = F.col("modified_date")
    # ISO text with a zone designator is an instant, whatever the session's time zone
    at = F.coalesce(F.try_to_timestamp(md, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")), F.try_to_timestamp(md, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    rows, late = _split_late(cancellations(visits, master, cancel_statuses), at, as_of, horizon_days)
    # the day is part of the key: times capped at as_of keep their own
    days = (rows.withWatermark("event_time", f"{horizon_days} days").groupBy(F.window("event_time", "1 day").alias("w"), "dia", "agente")
            .agg(F.count(F.lit(1)).alias("canceladas")))
    _append(days.select("dia", "agente", "canceladas"), run, "closed")
    _append(late.select("dia", "agente"), run, "late")
    return run


def closed_counts(spark: SparkSession, run: str) -> DataFrame:
    """(dia, agente, canceladas) of the closed days."""
    return _appended(spark, run, "closed", COUNTS)


def daily_counts(spark: SparkSession, run: str) -> DataFrame:
    """(dia, agente, canceladas) over closed and open days, late rows included.  Read it between runs."""
    parts = closed_counts(spark, run)
    late = _appended(spark, run, "late", "dia string, agente string")
    parts = parts.unionByName(late.withColumn("canceladas", F.lit(1).cast("bigint")))
    state = _state(spark, run, "closed")
    if state is not None:
        parts = parts.unionByName(_values(state, ["canceladas"]).select("key.dia", "key.agente", "canceladas"))
    return parts.groupBy("dia", "agente").agg(F.sum("canceladas").alias("canceladas"))
