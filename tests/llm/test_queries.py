"""The registered queries: names, whole tables, and their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from visitflow.llm import registry

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("key", registry.ORACLES)
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.ORACLES[key])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


#: Columns that each contract names.
COLUMNS = {
    "op2_chosen_path": "doc_id n_shingles component_id kept", "op3_bradley_terry": "doc_id held_out score predicted",
    "op5_sorted_projections": "vec_id n_links component_id kept", "op6_deep_shallow": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op9_virtual_slots": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_tokenizer_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_redirect_filter": "page_id host path rule verdict", "op10_vector_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


@pytest.mark.parametrize("key", COLUMNS)
def test_contract_columns(spark, key):
    df = registry.QUERIES[key](spark, SF)
    assert set(COLUMNS[key].split()) <= set(df.columns)


@pytest.mark.parametrize("key", ["op4_source_mixing", "op7_exact_dedup", "op9_virtual_slots", "op13_redirect_filter"])
def test_native_queries_run_no_python(spark, key):
    text = registry.QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
