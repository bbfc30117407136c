"""Connected components by alternating large and small stars, in rounds of joins.

Links never leave the executors: every round is written to the shared folder
and read back; the driver only learns whether a round was the last one.  In a star, all
neighbours of a vertex are pointed at the smallest one.  The neighbours of a
vertex of any degree are dealt over salts, so no vertex meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, with_group


def _star(directed: DataFrame, large: bool) -> DataFrame:
    """(u, v) pairs -> each v of interest pointed at the smallest of u's circle."""
    best = with_group(directed, ["u"], F.col("v"), {"m": F.min("v")}, {"m": F.min("m")}).withColumn("m", F.least("u", "m"))
    if large:
        out = best.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = best.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(best.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected(links: DataFrame, rounds: int = 40) -> DataFrame:
    """``links`` (a, b) -> (id, component_id) of every linked id; component_id is the smallest id."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-links")
    if edges.isEmpty():
        return _labels(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = staged(_star(both, True), "cc-large")
        # every pair now points down: u > v
        edges = staged(_star(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False), "cc-small")
        # finished when all are stars: one target per vertex, and no target points on
        if edges.groupBy("u").count().where("count > 1").isEmpty() and edges.join(
                edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return _labels(edges)
    raise RuntimeError("components did not settle; raise rounds")


def _labels(edges: DataFrame) -> DataFrame:
    own = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return own.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
