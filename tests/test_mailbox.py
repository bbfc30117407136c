"""Incremental landing of parsed mails: window first, each mail parsed once, reports read their partitions."""

import datetime as dt
import glob

import pytest

from visitflow.plans import reports as R
from visitflow.plans.bindings import driver_params, driver_tables
from visitflow.sources.mailbox import Mailbox

SCHEMA = "doc_id long, sender string, received_at timestamp_ntz, html string"
SENDER = "r@example.com"
DAY = dt.datetime(2026, 4, 1, 12)


def mail(i, day, sender=SENDER, rows=1):
    at = None if day is None else DAY + dt.timedelta(days=day)
    body = "".join(f"<tr><td>{1000 + i}{k}</td><td>b</td><td>c</td><td>si</td></tr>" for k in range(rows))
    return (i, sender, at, f"<table>{body}</table>")


def frame(spark, mails):
    return spark.createDataFrame(mails, SCHEMA)


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def files(folder):
    return sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_each_mail_is_parsed_once(spark, scratch):
    box = Mailbox(spark, f"{scratch}/mails")
    mails = [mail(1, 0), mail(2, 1, rows=0), mail(3, 1, "other@example.com"), mail(4, -40), mail(5, None), mail(6, 0, None), mail(7, 1, rows=3), (None, SENDER, DAY, "")]
    first = box.window(frame(spark, mails), dt.date(2026, 4, 2), 30, SENDER)
    assert ids(first) == [1, 7, 7, 7] and set(first.columns) >= {"nid", "fecha_reporte", "completado", "motivo", "row_pos"}
    # the window's mails only, those without rows too
    landed = files(box.folder)
    marks = spark.read.parquet(box.folder).filter("row_pos IS NULL")
    assert ids(marks) == [1, 2, 7]
    assert ids(box.window(frame(spark, mails), dt.date(2026, 4, 2), 30, SENDER)) == [1, 7, 7, 7] and files(box.folder) == landed
    # a second run parses the new mail, not the changed bodies of old ones
    again = [m[:3] + ("<p>",) for m in mails[:4]] + [mail(8, 1)]
    assert ids(box.window(frame(spark, again), dt.date(2026, 4, 2), 30, SENDER)) == [1, 7, 7, 7, 8]
    assert len(files(box.folder)) == len(landed) + 1
    # a wider window and another sender land what they lack
    assert ids(box.window(frame(spark, mails), dt.date(2026, 4, 2), 60, SENDER)) == [1, 4, 7, 7, 7, 8]
    assert ids(box.window(frame(spark, mails), dt.date(2026, 4, 2), 30, "other@example.com")) == [3]
    for _ in range(2):
        assert ids(box.every(frame(spark, [*mails, mail(9, None, "")]))) == [1, 3, 4, 5, 6, 7, 7, 7, 8, 9]


def test_no_mails(spark, scratch):
    box = Mailbox(spark, f"{scratch}/none")
    assert box.every(frame(spark, [])).count() == 0 and files(box.folder) == []


@pytest.mark.parametrize("report", ["cancelled", "to_publish", "report_dates"])
def test_reports_read_their_partitions(spark, report):
    t = driver_tables(spark, "/root/testdata/sf0.001")
    p = driver_params(dt.date(2026, 4, 23))
    df = getattr(R, report)(t, p)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "PartitionFilters" in x and "received_day" in x.split("PartitionFilters")[1].split("PushedFilters")[0]]
    assert scans and all("sender" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in scans)
    assert "MapInArrow" not in plan and "MapInPandas" not in plan
    df.collect()


def test_bodies_are_filtered_before_the_parser(spark):
    t = driver_tables(spark, "/root/testdata/sf0.001")
    from visitflow.sources.documents import scan_reports_window
    box = t.mailbox
    plan = box._parsed(box._dated(scan_reports_window(t.photo_report, dt.date(2026, 4, 23), 30, "reports@example.com")))
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parser = next(i for i, x in enumerate(lines) if "MapInArrow" in x)
    below = [x for x in lines[parser:] if "Filter" in x]
    assert any("page_id" in x and "url" in x for x in below), lines


def test_changed_source_files_are_seen(spark, scratch):
    import shutil

    from visitflow.plans import registry
    folder = f"{scratch}/sf"
    shutil.copytree("/root/testdata/sf0.001", folder)
    before = registry.tables(spark, folder)
    assert registry.tables(spark, folder) is before
    pages = spark.read.parquet(f"{folder}/pages.parquet").limit(5).toPandas()
    import os
    os.chmod(f"{folder}", 0o755)
    os.remove(f"{folder}/pages.parquet")
    pages.to_parquet(f"{folder}/pages.parquet")
    assert registry.tables(spark, folder) is not before
