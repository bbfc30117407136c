"""Composite reports on hand-made rows (fixed clock as_of = 2026-04-23, a Thursday)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitflow.operators.extract import report_rows
from visitflow.params import Params
from visitflow.plans import outbox as O
from visitflow.plans import reports as R
from tests.fixtures import KIND, domain_tables
from tests.test_operators import HTML

AS_OF = dt.date(2026, 4, 23)


@pytest.fixture(scope="module")
def t(spark):
    tables = domain_tables(spark)
    docs = spark.createDataFrame([(1, "r@example.com", dt.datetime(2026, 4, 23, 8), HTML),
                                  (2, "r@example.com", dt.datetime(2026, 4, 23, 9), HTML)],
                                 "doc_id bigint, sender string, received_at timestamp_ntz, html string")
    tables["report_rows"] = report_rows(docs, keep=("doc_id", "sender", "received_at"))
    return tables


P = Params(as_of=AS_OF, **KIND)


def test_r1_visits_tomorrow(t):
    out = {r["nid"]: r for r in R.visits_tomorrow(t, P).collect()}
    assert set(out) == {"10000002", "10000008"}                 # trap 1 and trap 15 rows are out
    r2 = out["10000002"]
    assert r2["hora"] == "08:05 AM" and r2["equipo"] == "Equipo CRM"
    assert r2["c_comercial_captacion"] == "sched1@example.com"  # empty CRM owner falls to the scheduler
    assert r2["ciudad"] == "Bogotá D.C."
    assert out["10000008"]["ciudad"] == "" and out["10000008"]["c_comercial_captacion"] == "sched2@example.com"


def test_r2_cancelled(t):
    rows = [r.asDict() for r in R.cancelled(t, P).collect()]
    assert len(rows) == 1                                        # duplicate report deduplicated
    r = rows[0]
    assert r["nid"] == "10000002" and r["motivo_cancelacion"] == "Cliente no estaba"
    assert r["ciudad"] == "Bogotá D.C." and r["c_comercial_captacion"] == "" and r["equipo"] == "Equipo CRM"
    assert r["fecha_agendada"] == "2026-04-24 08:05 AM" and r["ultima_actualizacion"] == "2026-04-22"
    assert r["tiene_fotos_profesionales"] is False


def test_r5_to_publish(t, spark):
    empty = spark.createDataFrame([], "nid string, link string")
    out = [r.asDict() for r in R.to_publish(t, P, links=empty, published=empty.select("nid")).collect()]
    assert [r["nid"] for r in out] == ["10000001"]              # 10000004 has a lost CRM stage
    assert out[0]["estado_actual"] == "Sin patrimonio, Sin CMS, Sin publicar"
    assert out[0]["fecha_recorrido"] == "23 de abril" and out[0]["link_publicacion"] == ""


def test_r13_reminder_keeps_stale_rows(t):
    out = {r["email"]: r["count"] for r in O.visit_reminder(t, P).collect()}
    assert out == {"agent1@example.com": 1, " Agent2@Example.com\xa0": 1, "sched2@example.com": 1}


def test_r14_digest_gates(t):
    out = O.cancelled_digest(t, P).collect()
    assert [(r["email"], r["n_nuevas"], r["n_pendientes"]) for r in out] == [("agent1@example.com", 1, 0)]
    lines = [r["line"] for r in O.cancelled_digest_lines(t, P).collect()]
    assert lines == ["  - NID 10000004 (estaba agendado para 2026-04-22)"] and out[0]["pending_head"] == ""
    assert out[0]["head"].startswith("Hola Sched One,") and out[0]["tail"].endswith(P.signature)
    assert O.cancelled_digest(t, P.with_(as_of=dt.date(2026, 4, 25))).count() == 0        # Saturday
    assert O.cancelled_digest(t, P.with_(as_of=dt.date(2026, 5, 1))).count() == 0         # first of month


def test_r15_r16_backlog(t):
    team = [tuple(r) for r in O.backlog_team(t, P).collect()]
    assert team == [("Equipo A", 2, 2, 2, 1)]
    agent = {r["comercial"]: tuple(r)[1:] for r in O.backlog_agent(t, P).collect()}
    assert agent == {"agent1@example.com": (2, 2, 0, 0, "Equipo A"),
                     "owner4@example.com": (0, 0, 1, 1, ""),
                     "agent2@example.com": (0, 0, 1, 0, "")}


def test_r17_r18_outbox(t, spark):
    t2 = dict(t)
    from visitflow.plans.bindings import Tables
    t2 = Tables(t2)
    leads = {r["equipo"]: r["email"] for r in O.team_lead_digest(t2, P).collect()}
    assert leads == {"Equipo A": "lead-a@example.com"}
    msgs = O.agent_digest(t, P).collect()
    assert [m["email"] for m in msgs] == ["agent1@example.com", "agent2@example.com", "owner4@example.com"]
    assert "De los cuales 2 son del 2025" in msgs[0]["body"] and msgs[0]["total"] == 2
    assert O.agent_digest(t, P.with_(max_messages=1)).count() == 1


def test_r19_summary(t):
    b = O.confirmation_buckets(t, P).first().asDict()
    assert b == {"confirmadas": 0, "sin_confirmar": 1, "canceladas": 1, "total": 2}
    s = O.confirmation_summary(t, P).first()
    assert s["subject"].endswith("0 confirmadas, 1 canceladas") and s["head_confirmadas"] == "--- CONFIRMADAS (0) ---\n"
    lines = [(r["bucket"], r["line"]) for r in O.confirmation_summary_lines(t, P).collect()]
    assert [x for x, _ in lines] == ["confirmadas", "sin_confirmar", "canceladas"] and lines[0][1] == "  Ninguna"


def test_r20_notices(t):
    out = O.cancellation_notices(t, P).collect()
    assert [r["nid"] for r in out] == ["10000008"] and out[0]["subject"] == "CANCELADA 360"
    assert out[0]["to"] == ", ".join(P.notice_emails)


def test_r3_court_candidates(t):
    out = [r.asDict() for r in R.court_candidates(t, P.with_(pipeline_id="803674753")).collect()]
    # 10000001 has an active court phase, 10000002's opinion is older than 6 months
    assert [r["nid"] for r in out] == ["10000004"] and out[0]["fecha_desfavorable"] == "2026-03-01"


def test_r4_r7(t):
    r4 = {r["nid"]: r for r in R.to_schedule(t, P).collect()}
    # rule v2: 10000013 has the patrimony contract and no "done" flag, 10000005 has neither
    assert set(r4) == {"10000005", "10000012"}
    assert r4["10000012"]["tipo_fotos"] == "Publicado sin fotos profesionales"
    assert r4["10000012"]["ultimo_status"] == "Sin visita"
    r7 = {r["nid"] for r in R.to_publish_no_photos(t, P).collect()}
    assert "10000011" not in r7 and "10000012" not in r7 and "10000001" in r7


def test_results_do_not_depend_on_row_order_or_partitioning(t):
    """Metamorphic: every pick has a total order, so shuffled inputs give the same rows."""
    from pyspark.sql import DataFrame

    from visitflow.plans.bindings import Tables
    shuffled = Tables({k: (v.orderBy(F.rand(7)).repartition(5) if isinstance(v, DataFrame) else v)
                       for k, v in t.items()})
    for fn in (R.visits_tomorrow, R.cancelled, R.to_schedule, O.cancelled_digest, O.backlog_agent):
        a, b = fn(t, P), fn(shuffled, P)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, fn.__name__


def test_digest_lines_go_to_the_agents_of_the_digest(t):
    agents = {r["email"]: r["n_nuevas"] + r["n_pendientes"] for r in O.cancelled_digest(t, P).collect()}
    lines = O.cancelled_digest_lines(t, P).collect()
    assert lines and {e: sum(r["email"] == e for r in lines) for e in agents} == agents
    assert O.cancelled_digest_lines(t, P.with_(as_of=dt.date(2026, 4, 25))).count() == 0   # weekend


def test_r3_drops_opinions_without_a_master_row(t):
    from visitflow.plans.bindings import Tables
    t2 = Tables(t)
    t2["property_master"] = t.property_master.filter("nid <> 10000004")
    assert R.court_candidates(t2, P).count() == 0
    # the backlog counts keep such opinions
    assert sum(r["juzgado"] for r in O.backlog_team(t2, P).collect()) == sum(r["juzgado"] for r in O.backlog_team(t, P).collect())


def test_order_of_the_listings(t, spark):
    from visitflow.plans.bindings import driver_params, driver_tables
    d = driver_tables(spark, "/root/testdata/sf0.001")

    def newest_first(df, column):
        got = [(r[column], r["nid"]) for r in df.collect()]
        assert len(got) > 1 and [x for x, _ in got] == sorted((x for x, _ in got), reverse=True)

    newest_first(R.court_candidates(d, driver_params(dt.date(2024, 7, 15))), "fecha_desfavorable")
    p = driver_params(dt.date(2026, 4, 23))
    newest_first(R.to_schedule(d, p), "fecha_captacion")
    newest_first(R.to_publish_no_photos(d, p), "fecha_captacion")
    newest_first(R.published_links(d, p), "fecha_publicacion")
    teams = [r["equipo"] for r in O.team_lead_digest(d, driver_params(dt.date(2001, 7, 20))).collect()]
    assert len(teams) > 1 and teams == sorted(teams)
    dates = R.report_dates(d, p).collect()
    seen = {r["fecha_reporte"]: r["m"] for r in R.report_window(d, p, 30).groupBy("fecha_reporte").agg(
        F.min(F.struct("received_at", "doc_id")).alias("m")).collect()}
    assert [r[0] for r in dates] == sorted(seen, key=lambda k: tuple(seen[k]))


@pytest.mark.parametrize("key,order", [("sort_nulls", lambda r: (r["fecha"] is not None, r["fecha"] or "", r["nid"])),
                                       ("sort_group_key", lambda r: r["equipo"])])
def test_sorted_keys(spark, key, order):
    from visitflow.plans import registry
    got = registry.QUERIES[key](spark, "/root/testdata/sf0.001").collect()
    assert len(got) > 1 and got == sorted(got, key=order)


def test_sort_default_blank(spark):
    from visitflow.plans import registry
    got = [((r["equipo_sellers"] or ""), r["nid"]) for r in registry.QUERIES["sort_default_blank"](spark, "/root/testdata/sf0.001").collect()]
    assert [x for x, _ in got] == sorted((x for x, _ in got), reverse=True) and len({x for x, _ in got}) > 1
