"""Nested JSON state ``{fecha: {nid: estado}}`` as a long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_TYPE = "map<string,map<string,string>>"


def json_state_explode(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Long ``(fecha, nid, estado)`` rows; invalid JSON parses to null and so
    yields no rows (the original treats a corrupt file as empty) (S10)."""
    m = df.select(F.from_json(F.col(json_col), STATE_TYPE, {"mode": "PERMISSIVE"}).alias("m"))
    days = m.select(F.explode("m").alias("fecha", "by_nid"))
    return days.select("fecha", F.explode("by_nid").alias("nid", "estado"))


def state_to_json(long: DataFrame) -> DataFrame:
    """Long table back to JSON, one ``{fecha: {nid: estado}}`` document per
    day: a group is one day of visits, never the whole history."""
    per_day = long.groupBy("fecha").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("nid", "estado")))).alias("m"))
    return per_day.select("fecha", F.to_json(F.create_map(F.col("fecha"), F.col("m"))).alias("json"))
