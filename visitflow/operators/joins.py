"""Join operators.

No operator forces a broadcast of data that grows with the input: AQE turns
a shuffle join into a broadcast only after it has measured the built side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import canonical_long, safe_cast
from ..functions.text import strip


def spread_key(left: DataFrame, key) -> Column:
    """Numeric join key of a text key: the number it spells, else a negative
    number that differs from row to row, so rows without a number are dealt
    over all partitions and not to the one of null."""
    k = F.col(key) if isinstance(key, str) else key
    apart = -1 - F.pmod(F.xxhash64(*left.columns), F.lit(1 << 62))
    return F.coalesce(safe_cast(k), apart)


def _with_right(left: DataFrame, right: DataFrame, left_key: str, right_key: str, match: Column,
                right_cols: Sequence[str] | None, prefix: str) -> DataFrame:
    r = right.withColumn("_jk", F.col(right_key))
    if right_cols is not None:
        r = r.select("_jk", *[F.col(c).alias(prefix + c) for c in right_cols])
    keyed = left.withColumn("_lk", spread_key(left, left_key)).withColumn("_ok", match)
    return keyed.join(r, (F.col("_lk") == F.col("_jk")) & F.col("_ok"), "left").drop("_lk", "_ok", "_jk")


def left_cast(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              right_cols: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """``LEFT JOIN r ON l.k = CAST(r.k AS STRING)`` for an integral ``r.k``.

    The join runs on the number, so the right side keeps the partitioning and
    bucketing of its key; only a text that is exactly the number's decimal
    form matches, as with the cast."""
    return _with_right(left, right, left_key, right_key, canonical_long(left_key).isNotNull(), right_cols, prefix)


def left_safecast_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     right_pred: Column | None = None,
                     right_cols: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """``LEFT JOIN r ON SAFE_CAST(l.k AS INT64) = r.k AND <pred on r>``.

    The ON-clause constant only restricts which right rows can match, so it
    is applied to the right side before the join, where it reaches the scan.
    """
    r = right if right_pred is None else right.filter(right_pred)
    return _with_right(left, r, left_key, right_key, safe_cast(left_key).isNotNull(), right_cols, prefix)


def semi(left: DataFrame, keys: DataFrame, left_key, key_col: str) -> DataFrame:
    """Inner join to a DISTINCT key set == left semi join."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return left.join(keys.select(F.col(key_col).alias("_sk")), lk == F.col("_sk"), "left_semi")


def anti(left: DataFrame, keys: DataFrame, left_key, key_col: str) -> DataFrame:
    """``LEFT JOIN k ... WHERE k.key IS NULL`` written as a left anti join.

    Catalyst keeps the outer-join-plus-filter form as is; the anti join ships
    only keys and can shuffle on either side.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return left.join(keys.select(F.col(key_col).alias("_ak")), lk == F.col("_ak"), "left_anti")


def not_in(left: DataFrame, keys: DataFrame, left_key, key_col: str) -> DataFrame:
    """``k NOT IN (SELECT key ...)`` with null keys dropped from the subquery.

    With a null in the subquery SQL returns no row at all; the original never
    meant that, so nulls are removed and the anti join can be a shuffle join
    (Spark's null-aware anti join exists only as a broadcast join).
    A null probe key is not "in" a null-free set, but SQL still drops it.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    k = keys.filter(F.col(key_col).isNotNull())
    return anti(left.filter(lk.isNotNull()), k, lk, key_col)


def exists_flag(left: DataFrame, keys: DataFrame, left_key, key_col: str, flag: str) -> DataFrame:
    """``CASE WHEN k.key IS NOT NULL THEN true ELSE false END`` after a left
    join to the distinct key set (J9)."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    k = keys.select(F.col(key_col).alias("_ek")).distinct().withColumn("_ef", F.lit(True))
    out = left.join(k, lk == F.col("_ek"), "left")
    return out.withColumn(flag, F.coalesce(F.col("_ef"), F.lit(False))).drop("_ek", "_ef")


def lookup_default(left: DataFrame, lookup: DataFrame, left_key: str, key_col: str,
                   value_col: str, out_col: str, default: str = "", required: bool = False) -> DataFrame:
    """Dict lookup with default (J11); ``required`` keeps only keys found (inner)."""
    lk = lookup.select(F.col(key_col).alias("_lk"), F.col(value_col).alias("_lv"))
    out = left.join(lk, F.col(left_key) == F.col("_lk"), "inner" if required else "left")
    return out.withColumn(out_col, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def lookup_fallback(left: DataFrame, lookup: DataFrame, left_key: str, key_col: str,
                    value_col: str, out_col: str, default: str) -> DataFrame:
    """``(d.get(k) or '').strip() or default``."""
    lk = lookup.select(F.col(key_col).alias("_lk"), F.col(value_col).alias("_lv"))
    out = left.join(lk, F.col(left_key) == F.col("_lk"), "left")
    val = F.nullif(strip(F.col("_lv")), F.lit(""))
    return out.withColumn(out_col, F.coalesce(val, F.lit(default))).drop("_lk", "_lv")


def merge_metrics(parts: Sequence[DataFrame], key, metrics: Sequence[str],
                  carry: Sequence[str] = ()) -> DataFrame:
    """Full-outer merge of keyed aggregates, zero-filled.

    Each part holds ``key`` (one column or several) and some of ``metrics``;
    instead of chaining full outer joins (one shuffle each) the parts are
    unioned with zeros for the missing metrics and summed in one
    aggregation.  ``carry`` columns (text) take the first non-blank value.
    """
    keys = [key] if isinstance(key, str) else list(key)
    aligned = []
    for p in parts:
        cols = [F.col(k) for k in keys]
        for m in metrics:
            cols.append((F.col(m) if m in p.columns else F.lit(0)).cast("bigint").alias(m))
        for c in carry:
            cols.append((F.col(c) if c in p.columns else F.lit(None)).cast("string").alias(c))
        aligned.append(p.select(*cols))
    u = aligned[0]
    for p in aligned[1:]:
        u = u.unionByName(p)
    aggs = [F.sum(m).cast("bigint").alias(m) for m in metrics]
    aggs += [F.max(F.nullif(F.col(c), F.lit(""))).alias(c) for c in carry]
    out = u.groupBy(*keys).agg(*aggs)
    for c in carry:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    return out
