"""Role loading from storage and the daily runner, end to end on fixture rows."""

import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F

from tests.fixtures import KIND, domain_tables
from tests.test_operators import HTML
from visitflow.operators.extract import report_rows
from visitflow.params import Params
from visitflow.plans import daily
from visitflow.plans import reports as R
from visitflow.sources.roles import conform


def test_conform_adds_a_content_hash_tiebreak(spark):
    t = domain_tables(spark)
    v = conform(t.visit_log.drop("record_id"), "visit_log")
    assert "record_id" in v.columns and v.filter(F.col("record_id").isNull()).count() == 0
    again = conform(t.visit_log.drop("record_id").repartition(3), "visit_log")
    assert sorted(v.select("record_id").collect()) == sorted(again.select("record_id").collect())


def test_daily_cli(spark, scratch):
    t = domain_tables(spark)
    docs = spark.createDataFrame([(1, "r@example.com", dt.datetime(2026, 4, 23, 8), HTML)],
                                 "doc_id bigint, sender string, received_at timestamp_ntz, html string")
    t["report_rows"] = report_rows(docs, keep=("doc_id", "sender", "received_at"))
    t["photo_report"] = docs
    t["photo_subject"] = spark.createDataFrame([(1, dt.datetime(2026, 4, 20), "Fotos cliente (10000013)")],
                                               "msg_id bigint, received_at timestamp_ntz, subject string")
    locations = {}
    for role in ("visit_log", "property_master", "crm_deal", "crm_deal_raw", "listing_card", "listing_image",
                 "listing_state", "process_history", "clearance_tower", "intake_detail", "seller_intake",
                 "seller_form", "status_log", "photo_report", "photo_subject", "team_lead"):
        path = os.path.join(scratch, "in", role)
        t[role].write.parquet(path)
        locations[role] = path
    links = os.path.join(scratch, "links.csv")
    with open(links, "w", encoding="utf-8") as f:
        f.write("﻿NID,Link Publicación\n10000001,https://x/1\n")
    follow = os.path.join(scratch, "follow.csv")
    with open(follow, "w", encoding="utf-8") as f:
        f.write("nid,Estado Publicación,Motivo\n10000004,Publicado,m\n")
    roles = os.path.join(scratch, "roles.json")
    with open(roles, "w", encoding="utf-8") as f:
        json.dump(locations, f)
    out = os.path.join(scratch, "out")
    daily.main(["--roles", roles, "--as-of", "2026-04-23", "--out", out, "--links", f"{links}:Bogotá",
                "--followup", f"{follow}:Ciudades", "--visit-type", "Inmobiliaria", "--visit-category", "Inmobiliaria",
                "--sender", "r@example.com"])
    assert sorted(os.listdir(out)) == sorted([*daily.REPORTS, "backlog_levels", "report_rows"])
    from visitflow.plans import outbox as O
    p = Params(as_of=dt.date(2026, 4, 23), **KIND)
    for name, fn in (("backlog_team", O.backlog_team), ("backlog_agent", O.backlog_agent)):
        got = spark.read.parquet(os.path.join(out, name))
        assert got.exceptAll(fn(t, p)).count() == 0 and fn(t, p).exceptAll(got).count() == 0
    got = {r["nid"] for r in spark.read.parquet(os.path.join(out, "visits_tomorrow")).collect()}
    assert got == {r["nid"] for r in R.visits_tomorrow(t, Params(as_of=dt.date(2026, 4, 23), **KIND)).collect()}
    assert spark.read.parquet(os.path.join(out, "links")).count() == 1
    cancelled = {r["nid"] for r in spark.read.parquet(os.path.join(out, "cancelled")).collect()}
    assert cancelled == {r["nid"] for r in R.cancelled(t, Params(as_of=dt.date(2026, 4, 23), **KIND)).collect()} == {"10000002"}


def test_status_log_needs_its_sequence(spark):
    df = spark.createDataFrame([("1", "perm", "ps:a", None, dt.datetime(2026, 4, 1, 10))],
                               "nid string, fecha string, estado string, usuario string, timestamp timestamp_ntz")
    with pytest.raises(ValueError, match="no seq"):
        conform(df, "status_log")
