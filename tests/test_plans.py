"""Physical-plan checks over every registered query (planned, not executed)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from visitflow.plans import registry

SF = "/root/testdata/sf0.001"
BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for k, fn in registry.QUERIES.items():
        if k.startswith("stream_"):
            continue
        out[k] = plan_text(fn(spark, SF))
    return out


def test_no_python_udfs_or_cross_joins(plans):
    bad = {k: [b for b in BANNED if b in p] for k, p in plans.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_latest_per_key_uses_partial_group_limit(plans):
    assert "WindowGroupLimit" in plans["report_visits_tomorrow"]
    assert "WindowGroupLimit" in plans["win_latest_per_key"]


def test_anti_and_semi_joins_are_real_joins(plans):
    assert "LeftAnti" in plans["report_to_publish_nophotos"]
    assert "LeftSemi" in plans["report_to_publish_clientphotos"] or "LeftSemi" in plans["join_in_keyset"]


def test_filters_reach_the_scan(spark):
    p = E.queries()["filter_in_list"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), In(o_orderstatus, [O,P])" in p or "In(o_orderstatus" in p
    p2 = E.queries()["report_visits_tomorrow"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "In(o_orderpriority" in p2


def test_projection_is_pruned(spark):
    p = E.queries()["fn_lower"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "nid" in df.columns


def test_bucketed_roles_remove_shuffles(spark):
    import datetime as dt
    import uuid

    from visitflow.plans import reports as R
    from visitflow.plans.bindings import driver_params, driver_tables
    from visitflow.plans.materialize import materialize_roles

    t = driver_tables(spark, SF)
    p = driver_params(dt.date(2026, 4, 23))
    bt = materialize_roles(spark, t, "vf_" + uuid.uuid4().hex[:8], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plain, bucketed = R.to_publish_no_photos(t, p), R.to_publish_no_photos(bt, p)
        assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0
        n = [plan_text(d).count("Exchange hashpartitioning") for d in (plain, bucketed)]
        assert n[1] < n[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_month_filter_lies_below_the_ranking(spark):
    """Only this month's rows are ranked, and the filter reaches the scan."""
    from visitflow.plans import outbox as O
    from visitflow.plans import registry as r
    text = plan_text(O.cancelled_rows(r.tables(spark, SF), r.P_MTD))
    window, scan = text.index("Window"), text.index("orders.parquet")
    assert window < text.rindex("Filter", 0, scan) and "2001-07-01" in text[window:]


def test_a_day_ranks_only_its_keys(spark):
    from visitflow.plans import reports as R
    from visitflow.plans import registry as r
    text = plan_text(R.latest_visits(r.tables(spark, SF), r.P_ORD, only=F.col("fecha_fin").startswith("2001-07-02")))
    assert text.index("Window") < text.index("LeftSemi")


def test_one_pass_over_the_visits_for_status_and_finished(spark):
    from visitflow.plans import reports as R
    from visitflow.plans import registry as r
    text = plan_text(R.visit_state(r.tables(spark, SF), r.P_REP))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_no_list_of_a_group_is_gathered(plans):
    # the lines of a CSV record with line breaks are one value
    bad = [k for k, p in plans.items() if k != "scan_csv_typed" and ("collect_list" in p or "collect_set" in p)]
    assert bad == []


def test_no_folder_of_one_machine_on_a_cluster():
    from visitflow.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
