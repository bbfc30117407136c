"""Validity intervals and as-of lookups against plain loops; past reports; the log by month; many writers."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from visitflow.operators import history
from visitflow.plans import outbox as O
from visitflow.plans import registry
from visitflow.plans import reports as R
from visitflow.plans.bindings import Tables, driver_params, driver_tables
from visitflow.plans.materialize import visit_log_by_month
from visitflow.sources.sinks import StatusLog

SF = "/root/testdata/sf0.001"
LOG = "k string, t long, id long, v string"


def log_rows(n=800):
    rng = random.Random(5)
    # one key holds most rows; times tie, some are missing
    return [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *range(60)]), i, f"v{i}") for i in range(n)]


def best(rows, key, at):
    mine = [r for r in rows if r[0] == key and (r[1] is None or (at is not None and r[1] <= at))]
    return max(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[2]), default=None)


@pytest.mark.parametrize("at", [-1, 0, 7, 31, 99])
def test_valid_rows(spark, at):
    rows = log_rows()
    hist = history.validity(spark.createDataFrame(rows, LOG), ["k"], "t", "id")
    got = {tuple(r) for r in history.valid_at(hist, F.lit(at)).collect()}
    assert got == {best(rows, k, at) for k in ("hot", "a", "b", None)} - {None}


def test_as_of_lookup(spark):
    rows, rng = log_rows(), random.Random(9)
    probes = [(rng.choice(["hot", "hot", "a", None, "none"]), rng.choice([None, *range(-3, 70)]), i) for i in range(400)] + [("a", 5, 7)] * 3
    df = history.as_of(spark.createDataFrame(rows, LOG), spark.createDataFrame(probes, "k string, at long, n long"), ["k"], "t", "id", "at")
    got = df.collect()
    assert len(got) == len(probes) and sorted((r.k or "", r.at or -9, r.n) for r in got) == sorted((p[0] or "", p[1] or -9, p[2]) for p in probes)
    for r in got:
        assert (None if r.found is None else tuple(r.found)) == best(rows, r.k, r.at), r
    empty = spark.createDataFrame([], LOG)
    assert all(r.found is None for r in history.as_of(empty, spark.createDataFrame(probes[:5], "k string, at long, n long"), ["k"], "t", "id", "at").collect())
    assert history.validity(empty, ["k"], "t", "id").count() == 0


def test_past_reports_see_the_rows_valid_then(spark):
    t = driver_tables(spark, SF)
    with_history = Tables(t)
    with_history["visit_history"] = R.visit_history(t.visit_log)
    p = driver_params(dt.date(2001, 7, 1))
    seen = {}
    for moment in (None, "1997-12-31T23:59:59.999Z", "2000-06-15T12:00:00.000Z"):
        past = p.with_(known_at=moment)
        a, b = (sorted(tuple(r) for r in R.latest_visits(x, past).select("nid", "record_id").collect()) for x in (t, with_history))
        assert a == b
        seen[moment] = a
        one, two = R.visits_tomorrow(t, past), R.visits_tomorrow(with_history, past)
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert len({tuple(x) for x in seen.values()}) == 3


def test_log_by_month_is_pruned(spark, scratch):
    t = driver_tables(spark, SF)
    by_month = visit_log_by_month(t, f"{scratch}/visits")
    p = driver_params(dt.date(2001, 7, 20))
    for report in (O.backlog_team, O.backlog_agent, O.cancelled_digest):
        a, b = report(t, p), report(by_month, p)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert any(f"{R.MONTH}" in x and ">= 2001-07" in x.split("PartitionFilters")[1].split("PushedFilters")[0]
                   for x in plan.splitlines() if "PartitionFilters" in x)
    past = p.with_(known_at="1998-03-01T00:00:00.000Z")
    a, b = R.latest_visits(t, past).select("nid", "record_id"), R.latest_visits(by_month, past).select("nid", "record_id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and by_month.visit_log.count() == t.visit_log.count()


ROWS = "nid string, fecha string, estado string, usuario string, n int"


def test_appends_at_once_keep_distinct_ordered_sequences(spark, scratch):
    log = StatusLog(spark, f"{scratch}/log")
    log.sequence()
    assert log.rows().count() == 0

    def writer(name):
        log.submit(spark.createDataFrame([(f"{i % 3}", "perm", f"ps:{name}{i:03}", name, i) for i in range(50)], ROWS).repartition(4), ["n"])

    threads = [threading.Thread(target=writer, args=(x,)) for x in "abc"]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    log.sequence()
    first = log.rows().collect()
    assert len({r.seq for r in first}) == len(first) == 150
    for name in "abc":
        mine = [r.estado for r in sorted(first, key=lambda r: r.seq) if r.usuario == name]
        assert mine == [f"ps:{name}{i:03}" for i in range(50)]
    # running again adds nothing, later rows come after all earlier ones
    log.sequence()
    assert log.rows().count() == 150
    log.submit(spark.createDataFrame([("9", None, "x", "d", 1)], ROWS), ["n"])
    log.sequence()
    last = max(log.rows().collect(), key=lambda r: r.seq)
    assert (last.nid, last.fecha, last.usuario) == ("9", "", "d") and log.rows().count() == 151


def test_a_batch_that_runs_again_writes_the_same(spark, scratch):
    log = StatusLog(spark, f"{scratch}/log")
    for name in "ab":
        log.submit(spark.createDataFrame([("1", "perm", f"ps:{name}{i}", name, i) for i in range(5)], ROWS), ["n"])
    log.sequence(max_files=1)
    before = sorted(map(tuple, log.rows().collect()))
    import os
    os.remove(f"{log.folder}/checkpoint/commits/1")
    crc = f"{log.folder}/checkpoint/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    log.sequence()
    assert sorted(map(tuple, log.rows().collect())) == before and len(before) == 10


def test_registered_past_reports_differ():
    keys = [k for k in registry.QUERIES if k.startswith("report_visits_tomorrow")]
    assert len(keys) == 3 and set(keys) <= set(registry.ORACLES)
