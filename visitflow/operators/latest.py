"""Latest / first record per key.

``row_number() == 1`` directly after the window lets Catalyst insert a
partial ``WindowGroupLimit`` before the shuffle, so a hot key ships at most
one row per map partition.  Every ordering ends in a tiebreak column so the
pick is reproducible (the original relies on warehouse order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import col_

RN = "_rn"


def _order(cols: Sequence) -> list[Column]:
    return [col_(c) for c in cols]


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """Rows ranked ``1..n`` within each key under ``order`` (total order expected)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) <= n).drop(RN)


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, by, tiebreak=None,
                   descending: bool = True) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY by DESC, tiebreak DESC) = 1``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = [by] if isinstance(by, (str, Column)) else list(by)
    if tiebreak is not None:
        by = by + ([tiebreak] if isinstance(tiebreak, (str, Column)) else list(tiebreak))
    order = [col_(c).desc_nulls_last() if descending else col_(c).asc_nulls_first() for c in by]
    return top_n_per_key(df, keys, order, 1)


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence) -> DataFrame:
    """First-row-wins dedup after a sort (O5, J15): ``order`` is the sort the
    original iterated in; it must end in a unique column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return top_n_per_key(df, keys, order, 1)


def filter_then_latest(df: DataFrame, pred: Column, keys, by, tiebreak=None) -> DataFrame:
    """Predicate applied before ranking."""
    return latest_per_key(df.filter(pred), keys, by, tiebreak)


def latest_then_filter(df: DataFrame, pred: Column, keys, by, tiebreak=None) -> DataFrame:
    """Rank first, then filter (the order that keeps a rescheduled visit
    from showing its stale row)."""
    return latest_per_key(df, keys, by, tiebreak).filter(pred)


def dedup_composite(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per composite key, the first under ``order``."""
    return top_n_per_key(df, list(keys), order, 1)
