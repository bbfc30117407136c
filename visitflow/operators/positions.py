"""Global positions of a sorted table without one sorting task (O1-O3).

The rows are dealt into ranges of the order, sorted inside each range and
numbered there; a small table with one row per (group, range) then says how many
rows of the group lie in earlier ranges.  No group meets in one task, whatever
its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import landed

AT, RANGE = "_at", "_range"


def placed(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "placed") -> tuple[DataFrame, DataFrame]:
    """Rows in ranges of (group, order), written once, and the ranges' offsets.

    The rows gain ``_at`` and ``_range``; the offsets are (group, _range, _first,
    _before): the smallest ``_at`` of the group in the range and the number of the
    group's rows in earlier ranges.  ``order`` decides between all rows that differ."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*group, *order]
    rows = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    # the id holds the range's number above 33 bits of the place in it
    rows = landed(rows.withColumn(AT, F.monotonically_increasing_id()).withColumn(RANGE, F.shiftright(AT, 33)), name)
    ranges = rows.groupBy(*group, RANGE).agg(F.min(AT).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # at most one row per range and group
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return rows, ranges.select(*group, RANGE, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def attach_offsets(rows: DataFrame, offsets: DataFrame, group: Sequence[str] = (), pos: str = "pos") -> DataFrame:
    """Rows with ``pos``, counted from 0 in each group, and what else ``offsets`` carries."""
    right = offsets.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col(RANGE).alias("_of"),
                           *[c for c in offsets.columns if c not in (*group, RANGE)])
    match = F.col(RANGE) == F.col("_of")
    for i, c in enumerate(group):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = rows.join(right, match).withColumn(pos, F.col("_before") + F.col(AT) - F.col("_first"))
    return out.drop(AT, RANGE, "_of", "_first", "_before", *[f"_g{i}" for i in range(len(group))])


def with_position(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), pos: str = "pos") -> DataFrame:
    """Add the 0-based place of each row in ``order``, within its ``group``.

    Null is a group of its own.  Rows that ``order`` does not tell apart share no
    place, but which of them comes first is not defined: end it in a tiebreak."""
    rows, offsets = placed(df, order, group)
    return attach_offsets(rows, offsets, group, pos)
