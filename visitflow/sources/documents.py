"""Landed mail documents (S8, S9): a mailbox re-aimed as a table
``(doc_id, sender, received_at, html | subject)`` with pushed predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date


def since(df: DataFrame, as_of: dt.date, days: int, ts_col: str = "received_at") -> DataFrame:
    """``SINCE <as_of - days>``: day granularity, inclusive (P10)."""
    return df.filter(F.to_date(ts_col) >= F.date_sub(lit_date(as_of), days))


def scan_reports_window(docs: DataFrame, as_of: dt.date, days: int, sender: str) -> DataFrame:
    """Report documents from ``sender`` received in the last ``days``."""
    return since(docs, as_of, days).filter(F.col("sender") == F.lit(sender))


def subject_filter(msgs: DataFrame, text: str, as_of: dt.date, days: int) -> DataFrame:
    """Header-only read: subject contains ``text`` (case-insensitive, like a
    mailbox SUBJECT search) within the lookback (S9).  Only ``subject`` and
    ``received_at`` are read."""
    m = msgs.select("msg_id", "subject", "received_at")
    m = since(m, as_of, days)
    return m.filter(F.lower(F.col("subject")).contains(text.lower()))
