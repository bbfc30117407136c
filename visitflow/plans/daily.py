"""Daily run: every report and outbox for one ``as_of``, written as tables.

    python -m visitflow.plans.daily --roles roles.json --as-of 2026-04-23 --out <folder> \
        --visit-type KIND --visit-category KIND --sender reports@... \
        [--links a.csv:Bogotá --links b.csv:Ciudades] [--followup ...] [--only report ...] \
        [--lookback-days 30] [--force-weekend] [--first-messages N] [--bucketed-db name --buckets 512] \
        [--known-at 2026-04-23T23:59:59] [--visits-by-month <folder>] \
        [--mails <folder of parsed mails, kept from day to day; default: <out>/report_rows>]

``roles.json`` maps role names (FIXTURES.md) to parquet paths or catalog
tables.  Each report is written to ``<out>/<report>`` (parquet, overwrite):
one job per report, nothing collected to the driver.  With
``--bucketed-db`` the property-keyed roles are first written bucketed by
``nid`` so every report joins them without a shuffle.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from ..params import Params
from ..sources.sinks import outbox_rows
from ..sources.roles import read_roles
from . import outbox as O
from . import reports as R
from .bindings import Tables
from .materialize import materialize_roles, visit_log_by_month

REPORTS = {
    "visits_tomorrow": R.visits_tomorrow,
    "cancelled": R.cancelled,
    "report_dates": R.report_dates,
    "court_candidates": R.court_candidates,
    "to_schedule": R.to_schedule,
    "to_publish": R.to_publish,
    "to_publish_client_photos": R.to_publish_client_photos,
    "to_publish_no_photos": R.to_publish_no_photos,
    "published_links": R.published_links,
    "links": R.links_lookup,
    "reasons": R.reasons_lookup,
    "sheet_published": R.sheet_published,
    "status_current": R.status_current,
    "status_wide": R.status_wide,
    "visit_reminder": O.visit_reminder,
    "cancelled_digest": O.cancelled_digest,
    "cancelled_digest_lines": O.cancelled_digest_lines,
    "backlog_team": O.backlog_team,
    "backlog_agent": O.backlog_agent,
    "team_lead_digest": O.team_lead_digest,
    "agent_digest": O.agent_digest,
    "confirmation_buckets": O.confirmation_buckets,
    "confirmation_summary": O.confirmation_summary,
    "confirmation_summary_lines": O.confirmation_summary_lines,
    "cancellation_notices": O.cancellation_notices,
}


# Messages written as outbox rows (to, subject, ...): name -> recipient column.
OUTBOX = {"visit_reminder": "email", "team_lead_digest": "email", "agent_digest": "email"}
BACKLOG = ("backlog_team", "backlog_agent", "team_lead_digest", "agent_digest")


def run_daily(t: Tables, p: Params, out_dir: str, only=None) -> dict[str, str]:
    """Write each report to ``out_dir/<name>``; returns name -> folder.

    The four backlog outputs share one job: both backlog levels are
    computed once (``outbox.backlog_levels``), written, and the team/agent
    tables and their messages are derived from the written table.
    """
    out_dir = out_dir.rstrip("/")
    spark, written = t.spark or SparkSession.getActiveSession(), {}

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        written[name] = f"{out_dir}/{name}"

    wanted = [n for n in REPORTS if not only or n in only]
    if "report_rows" in t and t.mailbox is None:
        # several reports read the parsed mails; they are parsed once
        write("report_rows", t["report_rows"])
        t = Tables(t)
        t["report_rows"] = spark.read.parquet(written["report_rows"])
    if any(n in BACKLOG for n in wanted):
        write("backlog_levels", O.backlog_levels(t, p))
        levels = spark.read.parquet(written["backlog_levels"])
        team, agent = O.team_from_levels(levels), O.agent_from_levels(levels)
        derived = {"backlog_team": team, "backlog_agent": agent,
                   "team_lead_digest": O.team_lead_digest(t, p, backlog=team),
                   "agent_digest": O.agent_digest(t, p, backlog=agent)}
    for name in wanted:
        df = derived[name] if name in BACKLOG else REPORTS[name](t, p)
        write(name, outbox_rows(df, OUTBOX[name]) if name in OUTBOX else df)
    return written


def _tabs(values):
    out = []
    for v in values or ():
        path, _, label = v.rpartition(":")
        out.append((path, label))
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--roles", required=True)
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--out", required=True)
    ap.add_argument("--visit-type", action="append", required=True)
    ap.add_argument("--visit-category", action="append", required=True)
    ap.add_argument("--sender", required=True)
    ap.add_argument("--lookback-days", type=int, help="of completed and cancelled reports")
    ap.add_argument("--force-weekend", action="store_true")
    ap.add_argument("--first-messages", type=int)
    ap.add_argument("--links", action="append")
    ap.add_argument("--followup", action="append")
    ap.add_argument("--only", nargs="*")
    ap.add_argument("--mails")
    ap.add_argument("--known-at", help="reports see the visit log as it was then")
    ap.add_argument("--visits-by-month", help="folder for the visit log laid out by month")
    ap.add_argument("--bucketed-db")
    ap.add_argument("--buckets", type=int, default=512)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("visitflow-daily").getOrCreate()
    with open(a.roles, encoding="utf-8") as f:
        locations = json.load(f)
    t = read_roles(spark, locations, _tabs(a.links), _tabs(a.followup), a.mails or f"{a.out.rstrip('/')}/report_rows")
    if a.bucketed_db:
        t = materialize_roles(spark, t, a.bucketed_db, a.buckets)
    if a.visits_by_month:
        t = visit_log_by_month(t, a.visits_by_month)
    p = Params(as_of=a.as_of, known_at=a.known_at, visit_types=tuple(a.visit_type), visit_categories=tuple(a.visit_category), report_sender=a.sender,
               force_weekend=a.force_weekend, max_messages=a.first_messages)
    if a.lookback_days is not None:
        p = p.with_(completed_lookback_days=a.lookback_days, cancelled_lookback_days=a.lookback_days)
    run_daily(t, p, a.out, a.only)


if __name__ == "__main__":
    main()
