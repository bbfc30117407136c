"""Rows as they were: validity intervals and as-of lookups (W1 for a past day).

A log holds every state of a key; a row is valid from its own time until that of the
key's next row.  Rows without a time come first and are valid from the beginning.  Both
operators sort the log into ranges of (key, time), so that a key with any share of the
rows is spread over many tasks; what a range needs of its neighbours is one row for each
key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .positions import AT, RANGE, placed

FROM, TO = "valid_from", "valid_to"


def _matched(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys (null is a key) and range; the key columns of ``other`` go."""
    right = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(RANGE).alias("_r"),
                         *[c for c in other.columns if c not in (*keys, RANGE)])
    same = F.col(RANGE) == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(right, same, "left").drop("_r", *[f"_k{i}" for i in range(len(keys))])


def validity(log: DataFrame, keys: Sequence[str], by: str, tiebreak: str) -> DataFrame:
    """The log's rows that were ever valid, with ``valid_from`` (null: always) and ``valid_to`` (null: still)."""
    columns = log.columns
    rows, _ = placed(log, [F.col(by).asc_nulls_first(), tiebreak], keys, "history")
    following = F.lead(F.struct(F.col(by).alias("t"))).over(Window.partitionBy(*keys, RANGE).orderBy(AT))
    heads = rows.groupBy(*keys, RANGE).agg(F.min_by(F.struct(F.col(by).alias("t")), AT).alias("_head"))
    # at most one row per range
    heads = heads.withColumn("_next", F.lead("_head").over(Window.partitionBy(*keys).orderBy(RANGE))).drop("_head")
    out = _matched(rows.withColumn("_following", following), heads, keys)
    after = F.coalesce("_following", "_next")
    out = out.withColumns({FROM: F.col(by), TO: after["t"], "_last": after.isNull()})
    # replaced at the moment it came
    gone = ~F.col("_last") & (F.col(TO).isNull() | F.coalesce(F.col(FROM) == F.col(TO), F.lit(False)))
    return out.filter(~gone).select(*columns, FROM, TO)


def valid_at(history: DataFrame, at: Column) -> DataFrame:
    """The rows of ``validity`` that were valid at a moment: comparisons that reach the scan, no ranking."""
    begun = F.col(FROM).isNull() | (F.col(FROM) <= at)
    return history.filter(begun & (F.col(TO).isNull() | (F.col(TO) > at))).drop(FROM, TO)


def as_of(log: DataFrame, probes: DataFrame, keys: Sequence[str], by: str, tiebreak: str, at: str) -> DataFrame:
    """Each row of ``probes`` (the keys, ``at``, ...) with ``found``: the log row (a struct) of its key that was valid
    at that time, null if there was none; a probe without a time finds what had no time."""
    row = F.struct(*[c for c in log.columns])
    probe = F.struct(*probes.columns)
    sides = (log.select(*keys, F.col(by).alias("_t"), F.lit(0).alias("_kind"), F.struct(F.col(tiebreak)).alias("_tie"), row.alias("_row"),
                        F.lit(None).cast(probes.schema).alias("_probe")),
             probes.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(f"struct<{tiebreak}:{dict(log.dtypes)[tiebreak]}>").alias("_tie"),
                           F.lit(None).cast(log.schema).alias("_row"), probe.alias("_probe")))
    rows, _ = placed(sides[0].unionByName(sides[1]), [F.col("_t").asc_nulls_first(), "_kind", "_tie"], keys, "as-of")
    inside = F.last("_row", ignorenulls=True).over(Window.partitionBy(*keys, RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0))
    newest = rows.filter("_kind = 0").groupBy(*keys, RANGE).agg(F.max_by("_row", AT).alias("_newest"))
    # every range of a key, also those without a log row; at most one row per range
    newest = _matched(rows.select(*keys, RANGE).distinct(), newest, keys)
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.withColumn("_carried", F.last("_newest", ignorenulls=True).over(earlier)).drop("_newest")
    out = _matched(rows.withColumn("_inside", inside).filter("_kind = 1"), carried, keys)
    return out.select("_probe.*", F.coalesce("_inside", "_carried").alias("found"))
