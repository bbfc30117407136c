import zlib

import pytest
from pyspark.sql import functions as F

from visitflow.llm import sharding
from visitflow.llm.common import run_folder

from .data import awkward, cluttered, docs


def test_near_equal_bytes_and_gapless_slots(spark):
    rows = [(i, "x" * (i * 37 % 900), "en", "a", 1) for i in range(5_000)]
    out = sharding.shard_documents(docs(spark, rows)).toPandas()
    load = out.groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() - load.min() <= 0.01 * load.mean()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    one = out[out.doc_id == 11].iloc[0]
    assert one["size"] == 11 * 37 % 900 + 1 and one.text_crc32 == zlib.crc32(b"x" * (11 * 37 % 900))
    assert set(out.law) == {"bytes"} and out.grown_shard.isna().all()


def test_awkward_rows(spark):
    out = sharding.shard_documents(cluttered(docs(spark)))
    got = out.collect()
    assert len(got) == len(awkward())
    assert {r["size"] for r in got if r.doc_id in (2, 3)} == {1} and {r.text_crc32 for r in got if r.doc_id == 2} == {0}
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_one_id_with_a_third_of_all_rows(spark):
    rows = [(7 if i % 3 == 0 else i, f"t{i}", "en", "a", 1) for i in range(3_000)]
    out = sharding.shard_documents(docs(spark, rows)).toPandas()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard")) and len(out) == 3_000


@pytest.fixture()
def stored(spark):
    rows = docs(spark, [(i, "x" * (i * 37 % 900), "en", "a", 1) for i in range(5_000)])
    sizes = sharding.slot_bytes(sharding.record_sizes(rows, 512), 512)
    path = run_folder(spark, "map")
    sharding.store_map(sharding.balanced_map(sizes, 8), path)
    return path, sizes


def test_growing_moves_slots_only_to_the_new_shard(spark, stored):
    path, _ = stored
    one = sharding.load_map(spark, path, 1)
    sharding.store_map(sharding.grown_map(one, 8), path)
    both = one.alias("a").join(sharding.load_map(spark, path, 2).alias("b"), "virtual_slot")
    moved = both.where("a.shard <> b.shard")
    assert moved.where("b.shard <> 8").isEmpty() and both.count() == 512
    share = moved.agg(F.sum("b.slot_bytes")).first()[0] / one.agg(F.sum("slot_bytes")).first()[0]
    assert 0.07 < share <= 1 / 9


def test_rebalancing_moves_few_slots(spark, stored):
    path, sizes = stored
    one = sharding.load_map(spark, path, 1)
    # shard 0 grows by half
    grown = sizes.join(one.select("virtual_slot", "shard"), "virtual_slot").withColumn(
        "slot_bytes", F.when(F.col("shard") == 0, (F.col("slot_bytes") * 1.5).cast("long")).otherwise(F.col("slot_bytes"))).drop("shard")
    sharding.store_map(sharding.rebalanced_map(one, grown, 8), path)
    two = sharding.load_map(spark, path, 2)
    load = [r.b for r in two.groupBy("shard").agg(F.sum("slot_bytes").alias("b")).collect()]
    assert len(load) == 8 and max(load) / (sum(load) / 8) < 1.02
    moved = one.alias("a").join(two.alias("b"), "virtual_slot").where("a.shard <> b.shard")
    assert moved.where("a.shard <> 0").isEmpty() and moved.count() < 64
    assert sharding.load_map(spark, path, 1).count() == 512
