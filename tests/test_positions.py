"""Global positions: equal to a sort of everything, for any group size, nulls and repeated rows."""

import random

from pyspark.sql import functions as F

from visitflow.operators.positions import with_position


def test_positions_equal_a_full_sort(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]), rng.randrange(1_000), i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "g string, k long, i long")
    got = with_position(df, [F.col("k").desc(), "i"]).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert [(r.g, r.k, r.i) for r in sorted(got, key=lambda r: r.pos)] == want
    assert sorted(r.pos for r in got) == list(range(3_000))


def test_positions_in_groups(spark):
    rows = [("hot", i % 7, i) for i in range(2_000)] + [(None, 1, 5), (None, 1, 4), ("one", 0, 0)]
    df = spark.createDataFrame(rows, "g string, k long, i long")
    got = {(r.g, r.k, r.i): r.pos for r in with_position(df, ["k", "i"], ["g"]).collect()}
    for g in ("hot", None, "one"):
        mine = sorted(r for r in rows if r[0] == g)
        assert [got[r] for r in mine] == list(range(len(mine)))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([("x", 1)] * 50, "g string, k long")
    assert sorted(r.pos for r in with_position(df, ["k"]).collect()) == list(range(50))
    assert with_position(df.limit(0), ["k"], ["g"]).count() == 0
