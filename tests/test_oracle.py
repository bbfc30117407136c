"""queries() against oracle_sql() on the smallest driver scale (the driver runs sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from visitflow.plans import registry

SF = "/root/testdata/sf0.001"
KEYS = [k for k in registry.ORACLES if not k.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
