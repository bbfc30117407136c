"""CSV in splits equals the whole-file reader, whatever cells hold and wherever splits fall."""

import csv
import io
import os
import random

import pytest

from visitflow.sources.tables import csv_records, scan_csv_typed


def cell(rng):
    return "".join(rng.choice(["a", "b", ",", '"', "\n", "\r\n", " ", "é", "12", "", "﻿"]) for _ in range(rng.randint(0, 9)))


def write(path, rows, end):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
    w.writerow(["id", "n", "text"])
    w.writerows(rows)
    with open(path, "wb") as f:
        f.write(("﻿" + out.getvalue()).encode())


@pytest.mark.parametrize("split", ["64", "1000", "134217728"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, scratch, split, end):
    rng = random.Random(split + end)
    rows = {f"f{k}": [(f"{k}-{i}", rng.choice(["7", "x", "12.5", ""]), cell(rng)) for i in range(150)] for k in range(3)}
    rows["f2"][40] = ("2-40", "1", "long\n" * 300)  # over many splits
    for name, part in rows.items():
        write(os.path.join(scratch, name + ".csv"), part, end)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = scan_csv_typed(spark, scratch, {"n": "bigint"})
        assert df.columns == ["id", "n", "text"]
        got = {r.id: (r.n, r.text or "") for r in df.collect()}
        assert csv_records(spark, scratch).filter("first").count() == 3
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    want = {i: ({"7": 7, "1": 1, "12.5": None}.get(n), t) for part in rows.values() for i, n, t in part}
    assert got == want


def test_plain_lines_are_read_where_they_lie(spark, scratch):
    with open(os.path.join(scratch, "a.csv"), "w") as f:
        f.write("a,b\n" + "".join(f"{i},x\n\n" for i in range(50)) + "9,")
    got = scan_csv_typed(spark, scratch, {"a": "int"}).collect()
    assert sorted(r.a for r in got) == sorted([*range(50), 9]) and sum(r.b is None for r in got) == 1


def test_header_only(spark, scratch):
    with open(os.path.join(scratch, "a.csv"), "w") as f:
        f.write('"a","b\nc"\n')
    df = scan_csv_typed(spark, scratch, {"a": "int"})
    assert df.columns == ["a", "b\nc"] and df.count() == 0
