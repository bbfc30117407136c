"""Parsed report mails, landed once each by the day they came in.

Mails are filtered by day and sender before any body is read, and only mails that
no earlier run has parsed go to the parser.  Their rows are appended to a table
partitioned by (received_day, sender), so that a report's window reads its own
partitions.  Each mail also leaves a row without ``row_pos``: that is how a mail
without a table counts as parsed.

All rows of a mail are in one file, and a file appears as a whole: a run that
fails half way has landed some mails completely, and the next run parses the rest.
One run lands at a time.

Defined results: a mail without a date or a sender is in no window, but among all rows; one
without an id is not landed; an empty sender is none; an id is parsed once for a day and sender,
however often it is delivered later.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..operators.extract import report_rows
from ..session import landed
from .documents import scan_reports_window

MAIL = ("doc_id", "sender", "received_at")
KEY = ("doc_id", "received_day", "sender")
#: Files that one run writes for a day, at most.
FILES_A_DAY = 16


def _by_key(mails: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.select(*[F.col(c).alias(f"_{c}") for c in KEY])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    return mails.join(other, same[0] & same[1] & same[2], how)


class Mailbox:
    """The parsed mails below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, mails: DataFrame) -> DataFrame:
        """The landed table; empty with its columns before the first run."""
        schema = self._parsed(self._dated(mails)).schema
        try:
            return self.spark.read.schema(schema).parquet(self.folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    @staticmethod
    def _dated(mails: DataFrame) -> DataFrame:
        # a folder's name cannot tell an empty sender from none
        return mails.filter(F.col("doc_id").isNotNull()).select(
            "doc_id", F.nullif("sender", F.lit("")).alias("sender"), "received_at", "html", F.to_date("received_at").alias("received_day"))

    @staticmethod
    def _parsed(dated: DataFrame) -> DataFrame:
        return report_rows(dated, keep=(*MAIL, "received_day"), marked=True)

    def land(self, mails: DataFrame, since: dt.date | None = None) -> None:
        """Parse the mails that are not landed yet.  ``since`` bounds the days of ``mails``, and so the table parts
        that are searched for them."""
        mails, table = self._dated(mails), self._read(mails)
        if since is not None:
            mails, table = (df.filter(F.col("received_day") >= lit_date(since)) for df in (mails, table))
        # the bodies are not read for this
        new = _by_key(mails.select(*KEY), table.filter(F.col("row_pos").isNull()), "left_anti").distinct()
        new = landed(new, "new-mails")
        if new.isEmpty():
            return
        rows = self._parsed(_by_key(mails, new, "left_semi"))
        deal = F.pmod(F.xxhash64("doc_id"), F.lit(FILES_A_DAY))
        rows.repartition("received_day", deal).write.mode("append").partitionBy("received_day", "sender").parquet(self.folder)

    def window(self, mails: DataFrame, as_of: dt.date, days: int, sender: str) -> DataFrame:
        """Rows of the mails of ``sender`` received in the last ``days``, landing those that are new."""
        first = as_of - dt.timedelta(days=days)
        self.land(scan_reports_window(mails, as_of, days, sender), first)
        rows = self._read(mails).filter((F.col("received_day") >= lit_date(first)) & (F.col("sender") == F.lit(sender)))
        return rows.filter(F.col("row_pos").isNotNull()).drop("received_day")

    def every(self, mails: DataFrame) -> DataFrame:
        """Rows of all mails, landing those that are new."""
        self.land(mails)
        return self._read(mails).filter(F.col("row_pos").isNotNull()).drop("received_day")
