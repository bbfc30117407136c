"""Filters and projections (P1-P18) as Column predicates.

Everything here is a plain Catalyst expression, so equality, IN, IS NULL and
``startswith`` predicates reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..functions.keys import col_, is_real_key  # noqa: F401  (re-exported)
from ..functions.text import not_contains_ci  # noqa: F401


def project(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """``SELECT expr AS name, ...`` (P1); values are column names or Columns."""
    return df.select(*[col_(v).alias(k) for k, v in mapping.items()])


def in_list(c, values: Sequence) -> Column:
    """``x IN (...)`` (P5)."""
    return col_(c).isin(list(values))


def not_in_list(c, values: Sequence) -> Column:
    """``x NOT IN (...)``: null stays null (unknown) and drops the row (P5)."""
    return ~col_(c).isin(list(values))


def starts_with(c, prefix: str) -> Column:
    """``x LIKE 'prefix%'`` (P6) -> ``StringStartsWith`` pushdown."""
    return col_(c).startswith(prefix)


def on_or_after_months_back(c, as_of: dt.date, months: int) -> Column:
    """``DATE(x) >= DATE_SUB(as_of, INTERVAL n MONTH)``."""
    return F.to_date(col_(c)) >= F.add_months(lit_date(as_of), -months)


def on_or_after_days_back(c, as_of: dt.date, days: int) -> Column:
    """``x >= as_of - n days`` (P10)."""
    return F.to_date(col_(c)) >= F.date_sub(lit_date(as_of), days)


def iso_on_or_after(c, day_iso: str) -> Column:
    """Lexicographic ``x >= 'YYYY-MM-DD'`` on ISO text (P11, month-to-date)."""
    return col_(c) >= F.lit(day_iso)


def date_on_or_after(c, cutoff: dt.date) -> Column:
    """``DATE(x) >= DATE 'cutoff'``."""
    return F.to_date(col_(c)) >= lit_date(cutoff)


def coalesce_ne(c, default, value) -> Column:
    """``COALESCE(x, d) != v``."""
    return F.coalesce(col_(c), F.lit(default)) != F.lit(value)
