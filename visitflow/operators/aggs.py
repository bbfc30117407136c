"""Aggregations (A1-A16).  All are hash/sort aggregates with a partial
(map-side) phase, so a hot key is pre-reduced on every map task before the
shuffle; nothing collects a group on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import col_


def count_by(df: DataFrame, keys: Sequence, name: str = "total") -> DataFrame:
    """``COUNT(*) GROUP BY keys`` (A1, A6, A7: keys may be expressions)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_if(pred: Column) -> Column:
    """``COUNTIF(pred)`` (A2): null predicate counts as false."""
    return F.count_if(F.coalesce(pred, F.lit(False))).cast("bigint")


def any_value(c) -> Column:
    """``ANY_VALUE(x)`` made replayable: smallest non-null value (A3)."""
    return F.min(col_(c))


def last_nonblank(value, seq) -> Column:
    """Value of the row with the highest ``seq`` among non-blank values."""
    v = col_(value)
    keep = v.isNotNull() & (v != F.lit(""))
    return F.max_by(F.when(keep, v), F.when(keep, col_(seq)))


def having(df: DataFrame, pred: Column) -> DataFrame:
    """``HAVING`` on an aggregate alias."""
    return df.filter(pred)


def ranked_items(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Per-key lists as rows (A10): each item of a key, sorted over the keys and
    items.  A range sort deals one key of any size over many tasks; no list is
    gathered."""
    return df.select(*keys, item).orderBy(*keys, item)


def global_flag(df: DataFrame, pred: Column) -> Column:
    """One scalar ``bool_or(pred)`` over a whole DataFrame, as an uncorrelated
    scalar subquery (A12): evaluated once, no driver action, no cross join."""
    return df.agg(F.coalesce(F.bool_or(pred), F.lit(False))).scalar()


def row_total(*cols) -> Column:
    """Sum across metric columns."""
    out = F.lit(0).cast("bigint")
    for c in cols:
        out = out + F.coalesce(col_(c), F.lit(0)).cast("bigint")
    return out
