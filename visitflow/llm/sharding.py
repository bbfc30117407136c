"""Sharding by fixed virtual slots (DataFrame functions only).

Every record hashes by its id into one of ``slots`` virtual slots, for good.
The bytes of each slot are added up, and a small versioned table maps slots to
shards.  Loading uses a stored version of that map; growing or rebalancing
stores a new version in which only the moved slots differ, so records of the
other slots stay where they are.

Tables here that reach one task hold at most ``slots`` rows (the map) or
``slots * PARTS`` rows (offsets); both bounds are parameters, not data.

Defined results: a null text has size 1 (no bytes, plus one); a null id hashes
like any value; repeated rows lie side by side.  An empty table gives an empty
result and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import run_folder, staged

SLOTS = 8192
#: Parts of a slot that are numbered apart, so that one id or no id does not meet in one task.
PARTS = 16


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def record_sizes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), slot_of(F.col("doc_id"), slots).alias("virtual_slot"))
    return out.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)).cast("int"))


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, slot_bytes, slot_rows) for every slot, empty ones included."""
    got = records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(got, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("b", F.lit(0)).cast("long").alias("slot_bytes"),
        F.coalesce("n", F.lit(0)).cast("long").alias("slot_rows"))


def _to_lightest(acc: Column, x: Column) -> Column:
    """Fold step: slot ``x`` (``w``: minus its bytes) goes to the lightest shard."""
    at = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
    load = F.transform(acc["load"], lambda v, i: F.when(i == at, v - x["w"]).otherwise(v))
    return F.struct(load.alias("load"), F.concat(acc["to"], F.array(at)).alias("to"))


def balanced_map(sizes: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """Largest slot first, each to the lightest shard so far; at most ``slots`` rows in one fold."""
    ranked = sizes.groupBy().agg(F.array_sort(F.collect_list(F.struct((-F.col("slot_bytes")).alias("w"), "virtual_slot", "slot_rows"))).alias("s"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), F.array().cast("array<int>").alias("to"))

    placed = ranked.select("s", F.aggregate("s", start, _to_lightest)["to"].alias("to"))
    one = placed.select(F.explode(F.arrays_zip("s", "to")).alias("z"))
    return one.select(F.lit(version).alias("version"), F.col("z.s.virtual_slot").alias("virtual_slot"),
                      F.col("z.to").alias("shard"), (-F.col("z.s.w")).alias("slot_bytes"), F.col("z.s.slot_rows").alias("slot_rows"))


def grown_map(current: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard (number ``shards``): each old shard
    gives up slots, in hash order, until about 1 / (shards + 1) of all bytes
    have moved; no other slot changes."""
    w = Window.partitionBy("shard").orderBy(F.xxhash64("virtual_slot"), "virtual_slot")
    total = F.sum("slot_bytes").over(Window.partitionBy("shard"))
    moved = (F.sum("slot_bytes").over(w.rowsBetween(Window.unboundedPreceding, 0)) * (shards + 1) <= total) & (F.col("slot_bytes") > 0)
    return current.select((F.col("version") + 1).alias("version"), "virtual_slot",
                          F.when(moved, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"), "slot_bytes", "slot_rows")


def rebalanced_map(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version after the slots' bytes changed: shards above the mean
    give up their smallest slots that cover the excess; those go, largest first,
    into the room of the shards below the mean.  All other slots stay."""
    now = current.select("version", "virtual_slot", "shard").join(sizes, "virtual_slot")
    w = Window.partitionBy("shard").orderBy("slot_bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum("slot_bytes").over(Window.partitionBy("version")) / shards
    over = F.sum("slot_bytes").over(Window.partitionBy("shard")) - mean
    now = now.withColumn("over", over).withColumn("leaves", (F.sum("slot_bytes").over(w) <= F.col("over")) & (F.col("slot_bytes") > 0))
    # one row: at most ``slots`` entries
    state = now.groupBy().agg(F.array_sort(F.collect_list(F.struct((-F.col("slot_bytes")).alias("w"), "virtual_slot", "shard", "leaves"))).alias("s"))

    def stays(k: int) -> Column:
        return F.aggregate(F.filter("s", lambda x: (x["shard"] == k) & ~x["leaves"]), F.lit(0).cast("long"), lambda a, x: a - x["w"])

    load = F.array(*[stays(k) for k in range(shards)])
    placed = state.select(F.filter("s", lambda x: x["leaves"]).alias("s"), load.alias("load"))
    placed = placed.select("s", F.aggregate("s", F.struct("load", F.array().cast("array<int>").alias("to")), _to_lightest)["to"].alias("to"))
    moves = (placed.select(F.explode(F.arrays_zip("s", "to")).alias("z"))
             .select(F.col("z.s.virtual_slot").alias("virtual_slot"), F.col("z.to").alias("goes")))
    return now.join(moves, "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.coalesce("goes", "shard").cast("int").alias("shard"), "slot_bytes", "slot_rows")


def store_map(slot_map: DataFrame, path: str) -> None:
    """Append the map as a version of its own; older versions stay readable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, slot_bytes long, slot_rows long, version int").parquet(path).where(F.col("version") == version)


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add each record's shard and its gapless place in the shard (``slot``)."""
    counts = records.groupBy("virtual_slot", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(F.broadcast(slot_map.select("virtual_slot", "shard", "version")), "virtual_slot").select(
        "virtual_slot", "part", "shard", "version", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32")) - 1
    # at most slots * PARTS rows
    return records.withColumn("inside", inside).join(F.broadcast(offsets), ["virtual_slot", "part"]).withColumn("slot", (F.col("offset") + F.col("inside")).cast("long"))


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Shards of near equal bytes: build and store version 1 of the map, then place by it."""
    spark = docs.sparkSession
    path = map_path or run_folder(spark, "slot-map")
    records = staged(record_sizes(docs, slots), "shard-records")
    store_map(balanced_map(slot_bytes(records, slots), shards), path)
    return place(records, load_map(spark, path, 1)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"))
