"""Set operations and ordering helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def except_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``other``."""
    return df.join(other.select(F.col(key).alias("_xk")), F.col(key) == F.col("_xk"), "left_anti")


def split_by(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """One labelled frame, two filtered views."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))
