"""Stream twins equal their batch twins, over many batches, restarts, late rows and streams without rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from visitflow.operators.latest import latest_per_key
from visitflow.plans.bindings import bind_visit_log, driver_tables
from visitflow.streaming import streams as S

SF = "/root/testdata/sf0.001"


def files(spark, df, scratch, conditions, name="in"):
    """One parquet file for each condition, read by the stream in this order."""
    flat = os.path.join(scratch, name)
    os.makedirs(flat)
    for i, cond in enumerate(conditions):
        part = os.path.join(scratch, f"{name}-{i}")
        df.filter(cond).coalesce(1).write.parquet(part)
        f = next(x for x in os.listdir(part) if x.endswith(".parquet"))
        os.link(os.path.join(part, f), os.path.join(flat, f"f{i}.parquet"))
        os.utime(os.path.join(flat, f"f{i}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(flat)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def batches(spark, run, part="main"):
    """Committed micro-batches of a query."""
    return len([x for x in os.listdir(os.path.join(run, "checkpoints", part, "commits")) if x.isdigit()])


def test_latest_upsert_over_many_batches(spark, scratch):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    # three files with overlapping keys: later files may hold older rows
    visits = bind_visit_log(files(spark, orders, scratch, ["o_orderstatus = 'O'", "o_orderstatus = 'P'", "o_orderstatus = 'F'"]))
    run = S.latest_upsert_stream(spark, visits, root=os.path.join(scratch, "run"))
    assert batches(spark, run) == 3
    exp = latest_per_key(bind_visit_log(orders), "nid", "modified_date", "record_id")
    assert same(S.read_keyed(spark, run, visits.schema), exp)


def test_latest_rows_with_nulls_and_ties(spark, scratch):
    schema = "nid string, modified_date string, record_id bigint, status string"
    rows = [("1", "b", 1, "x"), ("1", "b", 2, "y"), ("1", "a", 9, "z"), ("2", None, 5, "n"), ("2", None, 4, "m"), (None, "c", 1, None), ("3", "a", 1, None)]
    df = spark.createDataFrame(rows, schema)
    stream = files(spark, df, scratch, ["record_id = 2 OR nid = '2'", "record_id <> 2 AND (nid IS NULL OR nid <> '2')"])
    run = S.latest_upsert_stream(spark, stream, root=os.path.join(scratch, "run"))
    assert same(S.read_keyed(spark, run, df.schema), latest_per_key(df, "nid", "modified_date", "record_id"))


def test_status_fold_over_files_in_any_order(spark, scratch):
    from visitflow.operators.status import status_fold
    from visitflow.plans.bindings import bind_status_log
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = files(spark, events, scratch, ["event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 1"])
    run = S.status_fold_stream(spark, bind_status_log(stream), "2001-07-02", root=os.path.join(scratch, "run"))
    got = S.current_values(spark, run)
    assert batches(spark, run) == 3 and same(got, status_fold(bind_status_log(events), "2001-07-02")) and got.count() > 0


def test_many_batches_leave_bounded_state(spark, scratch):
    """A read opens the newest snapshot and the few changes after it, not one file per batch."""
    schema = "nid string, fecha string, estado string, seq bigint"
    log = spark.createDataFrame([(str(i % 5), "perm", f"ps:{i}", i) for i in range(40)], schema)
    stream = files(spark, log, scratch, [f"seq = {i}" for i in range(40)])
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.minBatchesToRetain", "spark.sql.shuffle.partitions",
                                                   "spark.sql.streaming.stateStore.maintenanceInterval")}
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "4")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        run = S.status_fold_stream(spark, log_stream := stream, "2026-04-01", root=os.path.join(scratch, "run"))
        assert log_stream.isStreaming and batches(spark, run) <= 40
        got = {r.nid: r.value for r in S.current_values(spark, run).collect()}
        assert got == {str(i): f"ps:{35 + i}"[3:] for i in range(5)}
        offsets = [x for x in os.listdir(os.path.join(run, "checkpoints/main/offsets")) if x.isdigit()]
        assert len(offsets) <= 6  # the engine forgets the batches before
    finally:
        for k, v in held.items():
            if v is not None:
                spark.conf.set(k, v)
            else:
                spark.conf.unset(k)


def counts(spark, orders, master):
    out = S.cancellations(bind_visit_log(orders), master, ["P", "O"])
    return out.groupBy("dia", "agente").agg(F.count(F.lit(1)).alias("canceladas"))


def test_daily_counts_as_the_log_grows(spark, scratch):
    """One run a part: days close behind the watermark, the rest stays open, and late files still count."""
    master, orders = driver_tables(spark, SF).property_master, spark.read.parquet(f"{SF}/orders.parquet")
    src, run = os.path.join(scratch, "in"), os.path.join(scratch, "run")
    parts = [("year(o_orderdate) <= 1995", 1995), ("year(o_orderdate) between 1996 and 1997", 1997), ("year(o_orderdate) > 1997", 2005)]
    seen = []
    for cond, year in parts:
        orders.filter(cond).write.mode("append").parquet(src)
        S.daily_counts_stream(spark, bind_visit_log(S.stream_source(spark, src)), master, ["P", "O"], dt.date(year, 12, 31), 3_000, root=run)
        seen.append(cond)
        assert same(S.daily_counts(spark, run), counts(spark, orders.filter(" OR ".join(f"({c})" for c in seen)), master))
    closed = S.closed_counts(spark, run)
    whole = S.daily_counts(spark, run)
    # closed days are final, and the newest ones are open
    assert closed.count() < whole.count() and closed.exceptAll(whole).isEmpty()


def test_closed_days_are_the_batch_twin_of_them(spark, scratch):
    master = driver_tables(spark, SF).property_master
    day = dt.datetime(2026, 4, 1, 10)
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    base = spark.read.parquet(f"{SF}/orders.parquet").first().asDict() | {"o_orderstatus": "P"}
    rows = [base | {"o_orderkey": i, "o_custkey": i % 4, "o_orderdate": type(base["o_orderdate"])(2026, 4, 1) + dt.timedelta(days=i % 20)
                    if not isinstance(base["o_orderdate"], dt.datetime) else day + dt.timedelta(days=i % 20)} for i in range(100)]
    df = spark.createDataFrame(rows, schema)
    stream = files(spark, df, scratch, ["o_orderkey % 20 < 12", "o_orderkey % 20 >= 12"])
    run = S.daily_counts_stream(spark, bind_visit_log(stream), master, ["P"], dt.date(2026, 4, 20), 25, root=os.path.join(scratch, "a"))
    whole = S.cancellations(bind_visit_log(df), master, ["P"]).groupBy("dia", "agente").agg(F.count(F.lit(1)).alias("canceladas"))
    assert S.closed_counts(spark, run).isEmpty() and same(S.daily_counts(spark, run), whole)
    # four days later: 25 days before the newest row lies the first day's end
    late = spark.createDataFrame([base | {"o_orderkey": 900, "o_custkey": 1, "o_orderdate": rows[19]["o_orderdate"] + dt.timedelta(days=15)},
                                  base | {"o_orderkey": 901, "o_custkey": 1, "o_orderdate": rows[0]["o_orderdate"] - dt.timedelta(days=9)}], schema)
    late.coalesce(1).write.parquet(os.path.join(scratch, "more"))
    f = next(x for x in os.listdir(os.path.join(scratch, "more")) if x.endswith(".parquet"))
    os.link(os.path.join(scratch, "more", f), os.path.join(scratch, "in", "f9.parquet"))
    again = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(scratch, "in"))
    S.daily_counts_stream(spark, bind_visit_log(again), master, ["P"], dt.date(2026, 5, 5), 25, root=run)
    every = S.cancellations(bind_visit_log(df.unionByName(late)), master, ["P"]).groupBy("dia", "agente").agg(F.count(F.lit(1)).alias("canceladas"))
    closed = S.closed_counts(spark, run)
    assert same(S.daily_counts(spark, run), every) and not closed.isEmpty()
    assert same(closed, whole.filter(whole.dia <= closed.agg({"dia": "max"}).first()[0]))
    assert S._appended(spark, run, "late", "dia string, agente string").count() == 1


def reports(spark, n=300):
    day = dt.datetime(2026, 4, 1)
    rows = [(f"{i % 40}", f"{i % 7} de abril", None if i == 7 else day + dt.timedelta(days=i % 90), i) for i in range(n)]
    return spark.createDataFrame(rows, "nid string, fecha_reporte string, received_at timestamp_ntz, i int")


def test_late_reports_are_set_aside(spark, scratch):
    df = reports(spark)
    # newest first: the rows of the last file lie behind the horizon
    stream = files(spark, df, scratch, ["i % 90 >= 60", "i % 90 between 30 and 59", "i % 90 < 30"])
    run = S.dedup_reports_stream(spark, stream, dt.date(2026, 6, 20), root=os.path.join(scratch, "run"))
    assert same(S.deduplicated(spark, run), df.select("nid", "fecha_reporte").distinct())
    kept, late = S.reports_of(spark, run, "kept"), S.reports_of(spark, run, "late")
    recent = df.filter("received_at > timestamp_ntz'2026-05-22'")
    assert df.filter("received_at = timestamp_ntz'2026-05-22'").count() > 0
    # a row without a time is late; times after the run's day (2026-06-20) count as that day
    assert late.count() == df.count() - recent.count() and same(kept.select("nid", "fecha_reporte"), recent.select("nid", "fecha_reporte").distinct())


def test_dedup_forgets_what_lies_behind_the_horizon(spark, scratch):
    """The state holds the keys of the horizon, not of the whole past."""
    df, src, run = reports(spark, 4_000).filter("received_at IS NOT NULL"), os.path.join(scratch, "in"), os.path.join(scratch, "run")
    df = df.withColumn("nid", F.col("i").cast("string"))
    for k in range(9):
        df.filter(f"i % 90 between {10 * k} and {10 * k + 9}").write.mode("append").parquet(src)
        S.dedup_reports_stream(spark, S.stream_source(spark, src), dt.date(2026, 4, 1) + dt.timedelta(days=10 * k + 9), 11, root=run)
    held = spark.read.format("statestore").load(f"{run}/checkpoints/kept").count()
    assert 0 < held < 0.4 * df.count() and S.reports_of(spark, run, "late").count() == 0
    assert same(S.deduplicated(spark, run), df.select("nid", "fecha_reporte").distinct())


def test_dedup_stream_resumes_from_its_checkpoint(spark, scratch):
    from visitflow.plans.bindings import driver_report_rows
    src = os.path.join(scratch, "pages")
    spark.read.parquet(f"{SF}/pages.parquet").write.parquet(src)
    pages = spark.read.parquet(src)
    root = os.path.join(scratch, "run")

    def run():
        stream = spark.readStream.schema(pages.schema).parquet(src)
        return S.deduplicated(spark, S.dedup_reports_stream(spark, driver_report_rows(stream), dt.date(2026, 4, 23), root=root))

    first = run().count()
    kept = S.reports_of(spark, root, "kept").count()
    assert first > 0
    # restart with no new input: nothing is processed twice
    assert run().count() == first and S.reports_of(spark, root, "kept").count() == kept


def test_streams_without_rows_read_as_empty(spark, scratch):
    master, empty = driver_tables(spark, SF).property_master, os.path.join(scratch, "empty")
    os.makedirs(empty)
    orders = spark.read.parquet(f"{SF}/orders.parquet").schema
    visits = bind_visit_log(spark.readStream.schema(orders).parquet(empty))
    log = spark.readStream.schema("nid string, fecha string, estado string, seq bigint").parquet(empty)
    rows = spark.readStream.schema("nid string, fecha_reporte string, received_at timestamp_ntz").parquet(empty)
    at = dt.date(2026, 4, 1)
    assert S.read_keyed(spark, S.latest_upsert_stream(spark, visits), visits.schema).count() == 0
    assert S.current_values(spark, S.status_fold_stream(spark, log, "2026-04-01")).count() == 0
    assert S.deduplicated(spark, S.dedup_reports_stream(spark, rows, at)).count() == 0
    assert S.daily_counts(spark, S.daily_counts_stream(spark, visits, master, ["P"], at)).count() == 0


def test_larger_tables_become_more_files_a_trigger(spark, scratch):
    """The files of a driver table are of bounded size, and the number of triggers stays."""
    from visitflow.plans import registry_ops
    for n, files in ((50, 1), (100, 1), (1_000, 9), (0, 1)):
        spark.range(n).withColumnRenamed("id", "k").write.parquet(os.path.join(scratch, f"n{n}", "orders.parquet"))
        stream = registry_ops._files(spark, os.path.join(scratch, f"n{n}"), "orders", rows=40)
        run = os.path.join(scratch, f"run{n}")
        S._append(stream.withColumn("file", F.input_file_name()), run, "rows")
        got = spark.createDataFrame([], "k long, file string") if not n else spark.read.parquet(f"{run}/rows")
        assert same(got.select("k"), spark.range(n).withColumnRenamed("id", "k"))
        if n:
            sizes = [r["count"] for r in got.groupBy("file").count().collect()]
            assert len(sizes) == 3 * files and max(sizes) <= 50 and batches(spark, run, "rows") == 3
