"""Operator-level registry entries, each over whole role
tables, each with an independent DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.keys import is_real_key, key_string, safe_cast
from ..operators import aggs, filters, history, joins, latest, rules, sets
from ..operators.extract import html_rows, report_rows
from ..operators.positions import with_position
from ..operators.status import clean_log, state_upsert
from ..session import checkpoint_path
from ..sources import documents, sheets, sinks, state
from ..sources.tables import scan_csv_typed, scan_table
from ..streaming import streams as S
from . import outbox as O
from . import reports as R
from .bindings import bind_status_log, bind_visit_log, driver_report_rows
from .registry import (NEWEST_FLAG, P_COURT, P_MTD, P_ORD, P_REP, P_SUBJ, ROLES_BACKLOG, _fold_sql, _links_sql, _published_sql,
                       _r14_rows, _r15_sql, _r16_sql, _subject_keys_sql, bad_opinions, has_photo, in_court, newest_visit,
                       patrimony_allows, properties, register, running, sql_text, tables, window_of)
from .sqlfrag import clean, dlit, falsy, hora, in_list, nonblank, not_contains, q, spanish_date, strip, title

VL = ("visit_log",)
PM = ("property_master",)


def op(key: str, fn, sql: str | None, roles: tuple = ()):
    register(key, sql, roles)(lambda spark, sf: fn(tables(spark, sf), sf))


# ------------------------------------------------------------ 2.1 sources
op("scan_table",
   lambda t, sf: scan_table(t.spark, f"{sf}/orders.parquet",
                            {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"})
   .select("o_orderkey", "o_custkey", "o_orderstatus"),
   "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
op("resolve_header",
   lambda t, sf: sheets.resolve_header(t.link_tabs[1][0], sheets.LINK_ALIASES, ("nid", "link")),
   "SELECT nid, link FROM link_rows WHERE tab_order = 1", ("link_rows",))
op("union_tabs_lww",
   lambda t, sf: sheets.last_wins(sheets.union_tabs(t.followup_tabs, sheets.REASON_ALIASES, ("nid",)))
   .select("nid", "motivo", "fuente"),
   """SELECT nid, motivo, fuente FROM (SELECT *, row_number() OVER (PARTITION BY nid ORDER BY tab_order DESC, row_order DESC)
      AS _rn FROM followup_rows) WHERE _rn = 1""", ("followup_rows",))


def _scan_status(t, sf):
    """The status sheet exported as CSV with drifting headers, read by name."""
    path = _io_dir(t.spark, "status_log")
    log = t.status_log.select(F.concat(F.lit(" "), F.col("nid")).alias(sheets.BOM + "NID"), F.col("usuario").alias("Usuario"),
                              F.concat(F.col("estado"), F.lit("\n")).alias("estado "), F.col("fecha").alias("Fecha"))
    log.write.options(header=True, escape='"').csv(path)
    return clean_log(sheets.read_status_log(t.spark, path)).drop("seq")


op("scan_status_log", _scan_status,
   f"""SELECT COALESCE({strip('nid')}, '') AS nid, COALESCE({strip('fecha')}, '') AS fecha,
       COALESCE({strip('estado')}, '') AS estado FROM status_log""", ("status_log",))
op("scan_reports_window",
   lambda t, sf: documents.scan_reports_window(t.photo_report, P_REP.as_of, 30, P_REP.report_sender).select("doc_id", "sender"),
   f"""SELECT page_id AS doc_id, 'reports@example.com' AS sender FROM pages WHERE starts_with(url, 'https')
       AND DATE '2026-03-01' + CAST(page_id % 60 AS INTEGER) >= {dlit(P_REP.as_of)} - INTERVAL 30 DAY""")
op("subject_filter",
   lambda t, sf: documents.subject_filter(t.photo_subject, P_SUBJ.subject_text, P_SUBJ.as_of, 60).select("msg_id", "subject"),
   f"""SELECT msg_id, subject FROM photo_subject WHERE CAST(received_at AS DATE) >= {dlit(P_SUBJ.as_of)} - INTERVAL 60 DAY
       AND contains(lower(subject), 'fotos cliente')""", ("photo_subject",))


def _json_docs(t):
    doc = F.to_json(F.create_map(F.col("fecha"), F.create_map(F.col("nid"), F.col("estado"))))
    broken = F.concat(F.lit('{"'), F.col("fecha"), F.lit('": {'))
    return t.status_log.select(F.when(F.col("estado").startswith("wa:"), broken).otherwise(doc).alias("json"))


op("json_state_explode", lambda t, sf: state.json_state_explode(_json_docs(t)),
   "SELECT fecha, nid, estado FROM status_log WHERE NOT starts_with(estado, 'wa:')", ("status_log",))


def _upsert(t, sf):
    """Every log row is part of the state or an update: 'ps:' rows update what the others left."""
    update = F.substring("estado", 1, 3) == "ps:"
    cur = latest.latest_per_key(t.status_log.filter(~update), ["fecha", "nid"], "seq")
    upd = t.status_log.filter(update).select(
        "fecha", "nid", F.when(F.col("estado") == "ps:", F.lit("")).otherwise(F.col("estado")).alias("estado"), "seq")
    return state_upsert(cur.select("fecha", "nid", "estado"), upd)


op("state_upsert_tombstone", _upsert, """
WITH ranked AS (SELECT fecha, nid, starts_with(estado, 'ps:') AS newer, CASE WHEN estado = 'ps:' THEN '' ELSE estado END AS estado, seq FROM status_log)
SELECT fecha, nid, arg_max(estado, (newer, seq)) AS estado FROM ranked GROUP BY fecha, nid HAVING arg_max(estado, (newer, seq)) <> ''""",
   ("status_log",))


def _json_sink(t, sf):
    """Written as JSON lines and read back as text."""
    path = _io_dir(t.spark, "json_sink")
    sinks.json_sink(R.links_lookup(t, P_REP), path)
    return t.spark.read.text(path).select(F.col("value").alias("json"))


op("json_sink", _json_sink,
   """SELECT '{"nid":"' || nid || '","link":"' || link || '"}' AS json FROM """ + _links_sql(), ("link_rows",))

# --------------------------------------------------- 2.2 projections, filters
op("proj_rename",
   lambda t, sf: filters.project(t.visit_log, {"nid": "nid", "estado": "status", "ultima": "modified_date"}),
   "SELECT nid, status AS estado, modified_date AS ultima FROM visit_log", VL)
op("proj_star", lambda t, sf: t.crm_deal.select("*").withColumn("fecha_desistio_inmobiliaria",
                                                                  F.col("fecha_desistio_inmobiliaria").cast("string")),
   "SELECT * REPLACE (CAST(fecha_desistio_inmobiliaria AS VARCHAR) AS fecha_desistio_inmobiliaria) FROM crm_deal",
   ("crm_deal",))
op("filter_eq",
   lambda t, sf: t.visit_log.filter((F.col("status") == "F") & (F.col("visit_type") != "5-LOW")).select("nid", "record_id"),
   "SELECT nid, record_id FROM visit_log WHERE status = 'F' AND visit_type <> '5-LOW'", VL)
op("filter_sentinel", lambda t, sf: t.status_log.filter(is_real_key("nid")).select("nid", "seq"),
   "SELECT nid, seq FROM status_log WHERE nid <> 'nan' AND nid IS NOT NULL", ("status_log",))
op("filter_in_list",
   lambda t, sf: t.visit_log.filter(filters.in_list("status", ["O", "P"]) & filters.not_in_list("visit_type", ["5-LOW"]))
   .select("nid", "record_id"),
   "SELECT nid, record_id FROM visit_log WHERE status IN ('O', 'P') AND visit_type NOT IN ('5-LOW')", VL)
op("filter_prefix", lambda t, sf: t.visit_log.filter(filters.starts_with("fecha_fin", "2001-07-02")).select("nid", "fecha_fin"),
   "SELECT nid, fecha_fin FROM visit_log WHERE starts_with(fecha_fin, '2001-07-02')", VL)
op("filter_not_contains",
   lambda t, sf: t.property_master.filter(T.not_contains_ci("ciudad", P_REP.excluded_city_substrings)).select("nid", "ciudad"),
   f"SELECT nid, ciudad FROM property_master WHERE {not_contains('ciudad', P_REP.excluded_city_substrings)}", PM)
op("filter_nulls",
   lambda t, sf: t.property_master.filter(F.col("c_fecha_captacion").isNotNull() & F.col("v_fecha_venta").isNull()
                                          & F.col("fecha_desistio_inmobiliaria").isNull()).select("nid"),
   """SELECT nid FROM property_master WHERE c_fecha_captacion IS NOT NULL AND v_fecha_venta IS NULL
      AND fecha_desistio_inmobiliaria IS NULL""", PM)
op("filter_lookback_months",
   lambda t, sf: t.clearance_tower.filter(filters.on_or_after_months_back(
       "v_fecha_concepto_del_defensor_de_familia", P_COURT.as_of, 6)).select("nid", "record_id"),
   f"""SELECT nid, record_id FROM clearance_tower WHERE CAST(v_fecha_concepto_del_defensor_de_familia AS DATE)
       >= CAST({dlit(P_COURT.as_of)} - INTERVAL 6 MONTH AS DATE)""", ("clearance_tower",))
op("filter_lookback_days",
   lambda t, sf: t.photo_subject.filter(filters.on_or_after_days_back("received_at", P_SUBJ.as_of, 7)).select("msg_id"),
   f"SELECT msg_id FROM photo_subject WHERE CAST(received_at AS DATE) >= {dlit(P_SUBJ.as_of)} - INTERVAL 7 DAY",
   ("photo_subject",))
op("filter_mtd", lambda t, sf: t.visit_log.filter(filters.iso_on_or_after("modified_date", P_MTD.month_start))
   .select("nid", "record_id"),
   f"SELECT nid, record_id FROM visit_log WHERE modified_date >= {q(P_MTD.month_start)}", VL)
op("filter_cutoff",
   lambda t, sf: t.property_master.filter(filters.date_on_or_after("date_publication", P_REP.publication_cutoff)).select("nid"),
   f"SELECT nid FROM property_master WHERE CAST(date_publication AS DATE) >= {dlit(P_REP.publication_cutoff)}", PM)


def _coalesce_default(t, sf):
    c = t.listing_card.join(t.listing_state, F.col("id") == F.col("property_card_id"), "left")
    keep = filters.coalesce_ne("active", 1, 0) & ~(
        (F.coalesce(F.col("active"), F.lit(0)) == 1) & (F.coalesce(F.col("current_state_id"), F.lit(0)) == 2))
    return c.filter(keep).select("id", F.col("current_state_id").cast("bigint").alias("state"))


op("filter_coalesce_default", _coalesce_default, """
SELECT id, CAST(current_state_id AS BIGINT) AS state FROM listing_card LEFT JOIN listing_state ON id = property_card_id
WHERE COALESCE(active, 1) <> 0 AND NOT (COALESCE(active, 0) = 1 AND COALESCE(current_state_id, 0) = 2)""",
   ("listing_card", "listing_state"))
op("filter_text_shape",
   lambda t, sf: t.link_tabs[0][0].select(F.col("NID").alias("nid"), F.col("Link Publicación").alias("link"))
   .filter(T.starts_http("link") & T.all_digits("nid") & ~T.has_at("link")),
   """SELECT nid, link FROM link_rows WHERE tab_order = 0 AND starts_with(lower(link), 'http')
      AND regexp_matches(nid, '^[0-9]+$') AND NOT contains(link, '@')""", ("link_rows",))
op("case_when",
   lambda t, sf: t.visit_log.select("nid", "record_id", F.when(F.col("status") == "F", "cerrada")
                                    .when(F.col("status") == "P", "cancelada").otherwise("abierta").alias("estado")),
   """SELECT nid, record_id, CASE WHEN status = 'F' THEN 'cerrada' WHEN status = 'P' THEN 'cancelada' ELSE 'abierta' END AS estado
      FROM visit_log""", VL)
op("if_null",
   lambda t, sf: t.intake_detail.select("nid", D.to_date_(F.when(F.col("estado_patrimonio") == "MACHINERY",
                                                                F.col("date_publication"))).cast("string").alias("fecha")),
   "SELECT nid, CAST(CAST(IF(estado_patrimonio = 'MACHINERY', date_publication, NULL) AS DATE) AS VARCHAR) AS fecha "
   "FROM intake_detail", ("intake_detail",))



def _states(t):
    """Per agent: how many properties are sold and how many withdrawn."""
    return t.property_master.groupBy(T.lower_trim("c_comercial_captacion").alias("comercial")).agg(
        aggs.count_if(F.col("v_fecha_venta").isNotNull()).alias("vendidos"),
        aggs.count_if(F.col("fecha_desistio_inmobiliaria").isNotNull()).alias("retirados"))


_STATES = f"""SELECT lower({strip('c_comercial_captacion')}) AS comercial, count(v_fecha_venta) AS vendidos,
  count(fecha_desistio_inmobiliaria) AS retirados FROM property_master GROUP BY 1"""
op("drop_zero_groups", lambda t, sf: _states(t).filter(aggs.row_total("vendidos", "retirados") > 0),
   _STATES + " HAVING vendidos + retirados > 0", PM)

# ------------------------------------------------------------------ 2.3 joins
op("join_left_cast",
   lambda t, sf: joins.left_cast(t.visit_log.select("nid", "record_id"), t.property_master, "nid", "nid", ["ciudad"]),
   "SELECT v.nid, v.record_id, c.ciudad FROM visit_log v LEFT JOIN property_master c ON v.nid = CAST(c.nid AS VARCHAR)",
   ("visit_log", "property_master"))
op("join_left_safecast_on_const",
   lambda t, sf: joins.left_safecast_on(t.visit_log.select("nid", "record_id"), t.crm_deal, "nid", "nid",
                                        F.col("pipeline") == "P1", ["hubspot_owner_id"]),
   """SELECT v.nid, v.record_id, h.hubspot_owner_id FROM visit_log v
      LEFT JOIN crm_deal h ON TRY_CAST(v.nid AS BIGINT) = h.nid AND h.pipeline = 'P1'""", ("visit_log", "crm_deal"))
op("join_left",
   lambda t, sf: t.property_master.select("nid").join(t.intake_detail.select("nid", "estado_patrimonio"), "nid", "left"),
   "SELECT cd.nid, d.estado_patrimonio FROM property_master cd LEFT JOIN intake_detail d ON cd.nid = d.nid",
   ("property_master", "intake_detail"))
op("join_inner",
   lambda t, sf: t.listing_card.join(t.listing_image, F.col("id") == F.col("property_card_id"), "inner")
   .select("nid", "id", F.col("source_image_id").cast("bigint").alias("source")),
   """SELECT pc.nid, pc.id, CAST(pi.source_image_id AS BIGINT) AS source FROM listing_card pc
      JOIN listing_image pi ON pc.id = pi.property_card_id""", ("listing_card", "listing_image"))
op("join_semi",
   lambda t, sf: joins.semi(t.property_master.select(F.col("nid").cast("string").alias("nid")),
                            R.pipeline_keys(t, P_REP), "nid", "nid"),
   """SELECT CAST(nid AS VARCHAR) AS nid FROM property_master WHERE CAST(nid AS VARCHAR) IN
      (SELECT CAST(nid AS VARCHAR) FROM crm_deal WHERE pipeline = 'P1' AND nid IS NOT NULL)""", ("property_master", "crm_deal"))
op("join_anti",
   lambda t, sf: joins.anti(t.property_master.select("nid"),
                            rules.photo_keyset(t.listing_card, t.listing_image, P_REP.photo_professional), "nid", "nid"),
   f"""SELECT cd.nid FROM property_master cd WHERE NOT {has_photo('cd.nid', P_REP.photo_professional)}""", ("property_master", "listing_card", "listing_image"))


def _done(t):
    return (t.visit_log.filter(F.col("visit_category").isin(list(P_REP.visit_categories)) & (F.col("status") == "F"))
            .select("nid").distinct())


op("join_not_in",
   lambda t, sf: joins.not_in(t.property_master.select(F.col("nid").cast("string").alias("nid")), _done(t), "nid", "nid"),
   """SELECT CAST(nid AS VARCHAR) AS nid FROM property_master WHERE CAST(nid AS VARCHAR) NOT IN
      (SELECT nid FROM visit_log WHERE visit_category = '1-URGENT' AND status = 'F' AND nid IS NOT NULL)""",
   ("property_master", "visit_log"))
op("join_in_keyset",
   lambda t, sf: joins.semi(t.property_master.select(F.col("nid").cast("string").alias("nid"), "ciudad"),
                            R.subject_keys(t, P_SUBJ), "nid", "nid"),
   f"""SELECT CAST(nid AS VARCHAR) AS nid, ciudad FROM property_master WHERE CAST(nid AS VARCHAR) IN
       {_subject_keys_sql(P_SUBJ)}""", ("property_master", "photo_subject"))
op("join_exists_flag",
   lambda t, sf: joins.exists_flag(t.property_master.select("nid"),
                                   rules.photo_keyset(t.listing_card, t.listing_image, P_REP.photo_client), "nid", "nid",
                                   "tiene_fotos"),
   f"""SELECT cd.nid, {has_photo('cd.nid', P_REP.photo_client)} AS tiene_fotos FROM property_master cd""", ("property_master", "listing_card", "listing_image"))
op("join_anti_set",
   lambda t, sf: joins.anti(t.report_rows.select("doc_id", "row_pos", "nid"), sheets.sheet_published(t.followup_tabs),
                            "nid", "nid"),
   f"SELECT doc_id, row_pos, nid FROM report_rows WHERE nid NOT IN {_published_sql()}", ("report_rows", "followup_rows"))
op("join_lookup_default",
   lambda t, sf: joins.lookup_default(t.report_rows.select("doc_id", "row_pos", "nid"), sheets.lookup_links(t.link_tabs),
                                      "nid", "nid", "link", "link_publicacion"),
   f"""SELECT r.doc_id, r.row_pos, r.nid, COALESCE(l.link, '') AS link_publicacion FROM report_rows r
       LEFT JOIN {_links_sql()} l ON r.nid = l.nid""", ("report_rows", "link_rows"))
op("join_lookup_fallback",
   lambda t, sf: joins.lookup_fallback(R._base_active(t, P_MTD).select(R.team().alias("equipo")).distinct(),
                                       t.team_lead, "equipo", "equipo", "email", "email", P_MTD.lead_default_email),
   f"""SELECT e.equipo, COALESCE(NULLIF({strip('tl.email')}, ''), {q(P_MTD.lead_default_email)}) AS email
       FROM (SELECT DISTINCT crew AS equipo FROM {properties(P_MTD)}) e LEFT JOIN team_lead tl ON e.equipo = tl.equipo""",
   ("property_master", "crm_deal", "team_lead"))


def _fanout_first(t, sf):
    pc = t.listing_card.filter(F.col("active") == 1).select("id", "nid")
    ps = t.listing_state.filter(F.col("current_state_id") == 2).select("property_card_id", "date_publication")
    j = pc.join(ps, F.col("id") == F.col("property_card_id"))
    first = latest.first_per_key(j, ["nid"], [F.col("date_publication").desc(), F.col("id").desc()])
    return first.select("nid", "id", F.col("date_publication").cast("string").alias("fecha"))


op("join_fanout_first", _fanout_first, """
SELECT nid, id, CAST(date_publication AS VARCHAR) AS fecha FROM (SELECT pc.nid, pc.id, ps.date_publication,
  row_number() OVER (PARTITION BY pc.nid ORDER BY ps.date_publication DESC, pc.id DESC) AS _rn
  FROM listing_card pc JOIN listing_state ps ON pc.id = ps.property_card_id WHERE pc.active = 1 AND ps.current_state_id = 2)
WHERE _rn = 1""", ("listing_card", "listing_state"))


def _star(t, sf):
    """The master with four side tables, all on the numeric key."""
    out = R._base_active(t, P_REP).select("nid", F.col("h_dealstage").alias("etapa"), F.col("cd_ciudad").alias("ciudad"))
    out = out.join(t.intake_detail.select("nid", "estado_patrimonio"), "nid", "left")
    out = out.join(t.seller_intake.groupBy("nid").agg(aggs.any_value("gravamenes_del_apartamento").alias("gravamen")), "nid", "left")
    out = out.join(rules.latest_flag(t.clearance_tower, as_string=False), "nid", "left")
    return out.join(t.listing_card.groupBy("nid").agg(F.count(F.lit(1)).alias("fichas")), "nid", "left")


op("join_star_chain", _star, f"""
SELECT m.nid, dealstage AS etapa, ciudad, estado_patrimonio, (SELECT min(gravamenes_del_apartamento) FROM seller_intake s WHERE s.nid = m.nid) AS gravamen,
  flag, NULLIF((SELECT count(*) FROM listing_card c WHERE c.nid = m.nid), 0) AS fichas
FROM {properties(P_REP)} m LEFT JOIN intake_detail d ON d.nid = m.nid LEFT JOIN {NEWEST_FLAG} ON flag_key = m.nid""",
   ("property_master", "crm_deal", "intake_detail", "seller_intake", "clearance_tower", "listing_card"))


def _merge(t, sf):
    """Visits per key by status, merged from one count per status."""
    names = {"O": "abiertas", "P": "canceladas", "F": "cerradas"}
    parts = [t.visit_log.filter(F.col("status") == k).groupBy("nid").agg(F.count(F.lit(1)).alias(n)) for k, n in names.items()]
    return joins.merge_metrics(parts, "nid", list(names.values()))


op("merge_metrics_full_outer", _merge, """
SELECT nid, count(*) FILTER (WHERE status = 'O') AS abiertas, count(*) FILTER (WHERE status = 'P') AS canceladas,
  count(*) FILTER (WHERE status = 'F') AS cerradas FROM visit_log GROUP BY nid""", VL)


def _reconcile(t, sf):
    p = P_REP
    rows = R.report_window(t, p, 30).filter(~F.col("completado"))
    newest = rows.groupBy("nid").agg(F.max(D.spanish_day_month("fecha_reporte", p.as_of)).alias("last_report"))
    v = joins.semi(t.visit_log.filter(F.col("visit_type").isin(list(p.visit_types))), rows.select("nid"), "nid", "nid")
    last = latest.latest_per_key(v, "nid", "modified_date", tiebreak="record_id")
    last = last.select("nid", "status", F.try_to_date(T.iso_date_part("modified_date"), "yyyy-MM-dd").alias("mod_date"))
    real = R.cancelled_keys(last, newest, p)
    return real.select("nid", "status", F.col("last_report").cast("string").alias("last_report"))


op("rule_reconcile_recency", _reconcile, f"""
WITH told AS (SELECT nid, max({spanish_date('fecha_reporte', P_REP.as_of)}) AS newest FROM report_rows
              WHERE {window_of(P_REP, 30)} AND NOT completado GROUP BY nid)
SELECT v.nid, v.status, CAST(newest AS VARCHAR) AS last_report FROM told JOIN {newest_visit(P_REP)} v ON v.nid = told.nid
WHERE v.status = 'P' OR (v.status IS DISTINCT FROM 'F'
  AND newest > CAST(try_strptime(split_part(v.modified_date, 'T', 1), '%Y-%m-%d') AS DATE))""", ("report_rows", "visit_log"))

# ------------------------------------------------------------ 2.4 aggregates
op("agg_count", lambda t, sf: aggs.count_by(t.visit_log, ["status"]),
   "SELECT status, count(*) AS total FROM visit_log GROUP BY status", VL)
op("agg_countif",
   lambda t, sf: t.property_master.groupBy(F.col("c_equipo_seller").alias("equipo")).agg(
       aggs.count_if(F.year("c_fecha_captacion") <= 2025).alias("antiguos")),
   """SELECT c_equipo_seller AS equipo, count(*) FILTER (WHERE year(c_fecha_captacion) <= 2025) AS antiguos
      FROM property_master GROUP BY 1""", PM)
op("agg_any_value",
   lambda t, sf: t.visit_log.groupBy("nid").agg(aggs.any_value("email_agendador").alias("email")),
   "SELECT nid, min(email_agendador) AS email FROM visit_log GROUP BY nid", VL)
op("agg_min",
   lambda t, sf: t.visit_log.filter(F.col("status") == "O").groupBy("nid").agg(
       F.min("fecha_inicio").alias("fecha_inicio"), F.min("nombre_agendador").alias("nombre"),
       F.min("email_agendador").alias("email")),
   """SELECT nid, min(fecha_inicio) AS fecha_inicio, min(nombre_agendador) AS nombre, min(email_agendador) AS email
      FROM visit_log WHERE status = 'O' GROUP BY nid""", VL)
op("agg_max_per_key",
   lambda t, sf: t.report_rows.groupBy("nid").agg(
       F.max(D.spanish_day_month("fecha_reporte", P_REP.as_of)).cast("string").alias("ultimo_reporte")),
   f"""SELECT nid, CAST(max({spanish_date('fecha_reporte', P_REP.as_of)}) AS VARCHAR) AS ultimo_reporte
       FROM report_rows GROUP BY nid""", ("report_rows",))
op("agg_multi_key",
   lambda t, sf: t.property_master.groupBy(T.lower_trim("c_comercial_captacion").alias("comercial"),
                                           F.col("c_equipo_seller").alias("equipo")).agg(F.count(F.lit(1)).alias("total")),
   f"""SELECT lower({strip('c_comercial_captacion')}) AS comercial, c_equipo_seller AS equipo, count(*) AS total
       FROM property_master GROUP BY 1, 2""", PM)
op("agg_group_expr",
   lambda t, sf: t.visit_log.groupBy(F.substring("visit_type", 1, 1).alias("visit_type")).agg(
       F.count(F.lit(1)).alias("total")),
   "SELECT substring(visit_type, 1, 1) AS visit_type, count(*) AS total FROM visit_log GROUP BY substring(visit_type, 1, 1)",
   VL)
op("agg_having",
   lambda t, sf: aggs.having(t.visit_log.groupBy("nid").agg(F.count(F.lit(1)).alias("total")), F.col("total") >= 15),
   "SELECT nid, count(*) AS total FROM visit_log GROUP BY nid HAVING count(*) >= 15", VL)
op("agg_distinct", lambda t, sf: t.visit_log.select("visit_type", "status").distinct(),
   "SELECT DISTINCT visit_type, status FROM visit_log", VL)
op("agg_collect_by_type", lambda t, sf: aggs.ranked_items(O.cancelled_rows(t, P_MTD), ["email", "tipo"], "nid"),
   f"SELECT email, CASE WHEN fresh THEN 'nueva' ELSE 'pendiente' END AS tipo, nid FROM {_r14_rows(P_MTD)} ORDER BY email, tipo, nid",
   ("visit_log", "property_master"))
op("agg_count_py",
   lambda t, sf: O.visit_reminder(t, P_ORD).select("email", "count"),
   f"""SELECT email, count(*) AS count FROM (SELECT {falsy('c.c_comercial_captacion', 'vd.email_agendador')} AS email FROM
       (SELECT nid, min(email_agendador) AS email_agendador FROM visit_log WHERE starts_with(fecha_fin, '2001-07-02')
        AND nid <> 'nan' AND nid IS NOT NULL AND status = 'O' AND visit_type IN {in_list(P_ORD.visit_types)} GROUP BY nid) vd
       LEFT JOIN property_master c ON vd.nid = CAST(c.nid AS VARCHAR)) WHERE email <> '' AND email <> 'nan' GROUP BY email""",
   ("visit_log", "property_master"))


def _gate(t, sf):
    rows = O.cancelled_rows(t, P_MTD)
    return rows.filter(aggs.global_flag(rows, F.col("tipo") == "nueva")).select("nid", "email", "tipo")


op("agg_global_gate", _gate, f"""
WITH r AS {_r14_rows(P_MTD)}
SELECT nid, email, CASE WHEN fresh THEN 'nueva' ELSE 'pendiente' END AS tipo FROM r WHERE (SELECT bool_or(fresh) FROM r)""",
   ("visit_log", "property_master"))
op("agg_row_total", lambda t, sf: _states(t).select("comercial", aggs.row_total("vendidos", "retirados").alias("total")),
   f"SELECT comercial, vendidos + retirados AS total FROM ({_STATES})", PM)
op("agg_last_nonblank",
   lambda t, sf: t.report_rows.groupBy("nid").agg(
       aggs.last_nonblank("ciudad_correo", F.struct("received_at", "doc_id", "row_pos")).alias("ciudad")),
   """SELECT nid, arg_max(ciudad_correo, (received_at, doc_id, row_pos)) FILTER (WHERE COALESCE(ciudad_correo, '') <> '')
      AS ciudad FROM report_rows GROUP BY nid""", ("report_rows",))

# --------------------------------------------------------------- 2.5 windows
op("win_latest_per_key",
   lambda t, sf: R.latest_visits(t, P_ORD).select("nid", "status", "modified_date", "record_id"),
   f"SELECT nid, status, modified_date, record_id FROM {newest_visit(P_ORD)}", VL)
op("win_latest_phase",
   lambda t, sf: latest.latest_per_key(t.process_history.filter(F.col("pipe_id").isin(list(P_COURT.court_pipes))), "nid",
                                       "first_time_in_phase", "record_id").select("nid", "phase_name"),
   """SELECT nid, phase_name FROM (SELECT *, row_number() OVER (PARTITION BY nid ORDER BY first_time_in_phase DESC, record_id DESC)
      AS _rn FROM process_history WHERE pipe_id IN ('pipeA', 'pipeB')) WHERE _rn = 1""", ("process_history",))
op("win_filter_then_latest",
   lambda t, sf: rules.unfavourable_opinions(t.clearance_tower, P_COURT.as_of, P_COURT.unfavourable, 6).select(
       "nid", F.col("fecha_desfavorable").cast("string").alias("fecha"), "telefono_plano"),
   f"SELECT CAST(k AS VARCHAR) AS nid, CAST(on_day AS VARCHAR) AS fecha, phone AS telefono_plano FROM {bad_opinions(P_COURT)}",
   ("clearance_tower",))
op("win_latest_flag", lambda t, sf: rules.latest_flag(t.clearance_tower),
   "SELECT CAST(flag_key AS VARCHAR) AS nid, flag FROM " + NEWEST_FLAG, ("clearance_tower",))
op("win_dedup_then_filter",
   lambda t, sf: latest.latest_then_filter(t.visit_log.filter(is_real_key("nid")), F.col("status") == "O", "nid",
                                           "modified_date", "record_id").select("nid", "record_id"),
   """SELECT nid, record_id FROM (SELECT *, row_number() OVER (PARTITION BY nid ORDER BY modified_date DESC, record_id DESC)
      AS _rn FROM visit_log WHERE nid <> 'nan' AND nid IS NOT NULL) WHERE _rn = 1 AND status = 'O'""", VL)

_MOMENTS = ("1996-07-01T00:00:00.000Z", "2000-02-29T12:00:00.000Z")


def _as_of(t, sf):
    """The visit of each property that was the latest at two moments."""
    probes = t.property_master.select(F.col("nid").cast("string").alias("nid"), F.explode(F.array(*[F.lit(x) for x in _MOMENTS])).alias("at"))
    found = history.as_of(t.visit_log.select("nid", "modified_date", "record_id", "status"), probes, ["nid"], "modified_date", "record_id", "at")
    return found.select("nid", "at", "found.record_id", "found.status")


op("win_as_of", _as_of, f"""
SELECT DISTINCT ON (p.nid, m.moment) CAST(p.nid AS VARCHAR) AS nid, m.moment AS at, v.record_id, v.status
FROM property_master p CROSS JOIN (VALUES ({q(_MOMENTS[0])}), ({q(_MOMENTS[1])})) m(moment)
LEFT JOIN visit_log v ON v.nid = CAST(p.nid AS VARCHAR) AND v.modified_date <= m.moment
ORDER BY p.nid, m.moment, v.modified_date DESC NULLS LAST, v.record_id DESC NULLS LAST""", ("visit_log", "property_master"))
op("win_valid_at",
   lambda t, sf: history.valid_at(history.validity(t.visit_log, ["nid"], "modified_date", "record_id"), F.lit(_MOMENTS[1])).select(
       "nid", "record_id", "status"),
   f"""SELECT DISTINCT ON (nid) nid, record_id, status FROM visit_log WHERE modified_date <= {q(_MOMENTS[1])}
       ORDER BY nid, modified_date DESC, record_id DESC""", VL)

# ------------------------------------------------ 2.6 sorts, limits, set ops
op("sort_nulls",
   lambda t, sf: with_position(t.property_master.select("nid", "date_publication"), [F.col("date_publication").asc_nulls_first(), "nid"])
   .select("pos", "nid", F.col("date_publication").cast("string").alias("fecha")).orderBy("pos"),
   """SELECT row_number() OVER (ORDER BY date_publication ASC NULLS FIRST, nid) - 1 AS pos, nid, CAST(date_publication AS VARCHAR) AS fecha
      FROM property_master ORDER BY pos""", PM)
op("sort_default_blank",
   lambda t, sf: with_position(t.crm_deal.select("nid", "equipo_sellers"), [F.coalesce("equipo_sellers", F.lit("")).desc(), "nid"])
   .select("pos", "nid", "equipo_sellers").orderBy("pos"),
   """SELECT row_number() OVER (ORDER BY COALESCE(equipo_sellers, '') DESC, nid) - 1 AS pos, nid, equipo_sellers FROM crm_deal ORDER BY pos""",
   ("crm_deal",))
op("sort_group_key",
   lambda t, sf: with_position(aggs.count_by(t.property_master, [F.col("c_equipo_seller").alias("equipo")]), ["equipo"])
   .select("pos", "equipo", "total").orderBy("pos"),
   """SELECT row_number() OVER (ORDER BY c_equipo_seller NULLS FIRST) - 1 AS pos, c_equipo_seller AS equipo, count(*) AS total
      FROM property_master GROUP BY c_equipo_seller ORDER BY pos""", PM)
op("topn", lambda t, sf: aggs.count_by(t.visit_log, ["nid"]).orderBy(F.col("total").desc(), "nid").limit(10),
   "SELECT nid, count(*) AS total FROM visit_log GROUP BY nid ORDER BY total DESC, nid LIMIT 10", VL)
op("dedup_first",
   lambda t, sf: latest.first_per_key(t.visit_log, ["nid"], [F.col("record_id").asc()]).select("nid", "record_id"),
   "SELECT nid, min(record_id) AS record_id FROM visit_log GROUP BY nid", VL)
op("dedup_composite",
   lambda t, sf: latest.dedup_composite(t.report_rows, ["nid", "fecha_reporte"],
                                        [F.col("received_at").asc(), "doc_id", "row_pos"]).select(
       "nid", "fecha_reporte", "fotografo"),
   """SELECT nid, fecha_reporte, fotografo FROM (SELECT *, row_number() OVER (PARTITION BY nid, fecha_reporte
      ORDER BY received_at, doc_id, row_pos) AS _rn FROM report_rows) WHERE _rn = 1""", ("report_rows",))
op("set_distinct", lambda t, sf: R.subject_keys(t, P_SUBJ), "SELECT * FROM " + _subject_keys_sql(P_SUBJ),
   ("photo_subject",))
op("set_union_all",
   lambda t, sf: sets.union_all([sheets.resolve_header(df, sheets.LINK_ALIASES, ("nid", "link")) for df, _ in t.link_tabs]),
   "SELECT nid, link FROM link_rows", ("link_rows",))
op("set_except",
   lambda t, sf: sets.except_keys(t.report_rows.select("nid").distinct(), sheets.sheet_published(t.followup_tabs), "nid"),
   f"SELECT DISTINCT nid FROM report_rows WHERE nid NOT IN {_published_sql()}", ("report_rows", "followup_rows"))
op("split_outcome",
   lambda t, sf: sets.union_all([v.select("doc_id", "row_pos", F.lit(lbl).alias("outcome")) for v, lbl in
                                 zip(sets.split_by(t.report_rows, "completado"), ("completado", "cancelado"))]),
   """SELECT doc_id, row_pos, CASE WHEN completado THEN 'completado' ELSE 'cancelado' END AS outcome FROM report_rows""",
   ("report_rows",))

# -------------------------------------------------------------- 2.7 scalars
op("fn_cast_string", lambda t, sf: t.listing_card.select("id", key_string("nid").alias("nid")),
   "SELECT id, CAST(nid AS VARCHAR) AS nid FROM listing_card", ("listing_card",))
op("fn_safe_cast",
   lambda t, sf: t.visit_log.select("record_id", safe_cast("nid").alias("nid"), safe_cast("ciudad_muni").alias("bad")),
   "SELECT record_id, TRY_CAST(nid AS BIGINT) AS nid, TRY_CAST(ciudad_muni AS BIGINT) AS bad FROM visit_log", VL)
op("fn_coalesce",
   lambda t, sf: t.property_master.select("nid", D.to_date_(F.coalesce("date_publication", "c_fecha_captacion"))
                                          .cast("string").alias("fecha")),
   "SELECT nid, CAST(CAST(COALESCE(date_publication, c_fecha_captacion) AS DATE) AS VARCHAR) AS fecha FROM property_master",
   PM)
op("fn_coalesce_nullif",
   lambda t, sf: R._base_active(t, P_REP).select(
       "nid", T.coalesce_nonblank(F.col("h_equipo_sellers"), F.col("cd_c_equipo_seller"), default="Sin equipo").alias("equipo")),
   f"""SELECT cd.nid, {nonblank('h.equipo_sellers', 'cd.c_equipo_seller', default='Sin equipo')} AS equipo
       FROM property_master cd LEFT JOIN crm_deal h ON cd.nid = h.nid AND h.pipeline = 'P1'""", ("property_master", "crm_deal"))
op("fn_lower_trim", lambda t, sf: t.property_master.select("nid", T.lower_trim("c_comercial_captacion").alias("agente")),
   f"SELECT nid, lower({strip('c_comercial_captacion')}) AS agente FROM property_master", PM)
op("fn_lower", lambda t, sf: t.property_master.select("nid", F.lower("ciudad").alias("ciudad")),
   "SELECT nid, lower(ciudad) AS ciudad FROM property_master", PM)
op("fn_to_date", lambda t, sf: t.visit_log.select("record_id", D.to_date_("modified_date").cast("string").alias("dia")),
   "SELECT record_id, CAST(CAST(substring(modified_date, 1, 10) AS DATE) AS VARCHAR) AS dia FROM visit_log", VL)
op("fn_year", lambda t, sf: t.property_master.select("nid", D.year_("c_fecha_captacion").cast("bigint").alias("anio")),
   "SELECT nid, CAST(year(c_fecha_captacion) AS BIGINT) AS anio FROM property_master", PM)
op("fn_add_months",
   lambda t, sf: t.property_master.select("nid", F.add_months(D.to_date_("c_fecha_captacion"), -6).cast("string").alias("d")),
   "SELECT nid, CAST(CAST(CAST(c_fecha_captacion AS DATE) - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS d FROM property_master",
   PM)


def _days(t):
    return t.status_log.select(F.to_date("timestamp").alias("d")).distinct()


op("fn_calendar",
   lambda t, sf: _days(t).select(D.iso("d").alias("dia"), D.tomorrow("d").alias("manana"), D.yesterday("d").alias("ayer"),
                                 D.month_start("d").alias("mes")),
   """SELECT CAST(d AS VARCHAR) AS dia, CAST(d + 1 AS VARCHAR) AS manana, CAST(d - 1 AS VARCHAR) AS ayer,
      CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS mes FROM (SELECT DISTINCT CAST("timestamp" AS DATE) AS d FROM status_log)""",
   ("status_log",))
op("fn_business_lookback",
   lambda t, sf: _days(t).select(F.col("d").cast("string").alias("dia"),
                                 D.business_lookback_days("d").cast("bigint").alias("dias_atras"),
                                 D.is_weekend("d").alias("fin_de_semana")),
   """SELECT CAST(d AS VARCHAR) AS dia, CAST(CASE WHEN isodow(d) = 1 THEN 3 ELSE 1 END AS BIGINT) AS dias_atras,
      isodow(d) >= 6 AS fin_de_semana FROM (SELECT DISTINCT CAST("timestamp" AS DATE) AS d FROM status_log)""",
   ("status_log",))
op("fn_utc_minus5", lambda t, sf: t.visit_log.select("record_id", D.utc_to_local_hhmm("fecha_inicio").alias("hora")),
   f"SELECT record_id, {hora('fecha_inicio')} AS hora FROM visit_log", VL)
op("fn_iso_date_part", lambda t, sf: t.visit_log.select("record_id", T.iso_date_part("modified_date").alias("dia")),
   "SELECT record_id, split_part(modified_date, 'T', 1) AS dia FROM visit_log", VL)
op("fn_clean", lambda t, sf: t.crm_deal.select("nid", T.clean("equipo_sellers").alias("equipo")),
   f"SELECT nid, {clean('equipo_sellers')} AS equipo FROM crm_deal", ("crm_deal",))
op("fn_falsy_chain",
   lambda t, sf: R._base_active(t, P_REP).select("nid", T.falsy_chain("h_hubspot_owner_id", "cd_c_comercial_captacion")
                                                 .alias("agente")),
   f"""SELECT cd.nid, {falsy('h.hubspot_owner_id', 'cd.c_comercial_captacion')} AS agente FROM property_master cd
       LEFT JOIN crm_deal h ON cd.nid = h.nid AND h.pipeline = 'P1'""", ("property_master", "crm_deal"))
_TITLE_RE = r"(?is)<title>(.*?)</title>"
op("fn_title",
   lambda t, sf: t.raw("pages").select(
       "page_id", T.py_title(F.regexp_extract("html", _TITLE_RE, 1)).alias("titulo")),
   f"SELECT page_id, {title(f'regexp_extract(html, {q(_TITLE_RE)}, 1)')} AS titulo FROM pages")
op("fn_regex_report_date", lambda t, sf: t.photo_report.select("doc_id", T.report_date_text("html").alias("fecha")),
   "SELECT page_id AS doc_id, CAST(page_id % 31 + 1 AS VARCHAR) || ' de ' || ['enero','febrero','marzo','abril','mayo','junio','julio',"
   "'agosto','septiembre','octubre','noviembre','diciembre'][CAST(page_id % 12 + 1 AS INTEGER)] AS fecha FROM pages")
op("fn_regex_subject_key", lambda t, sf: t.photo_subject.select("msg_id", T.subject_key("subject").alias("nid")),
   r"""SELECT msg_id, COALESCE(NULLIF(regexp_extract(subject, '\((\d{8,})\)', 1), ''),
       NULLIF(regexp_extract(subject, '(\d{8,})', 1), '')) AS nid FROM photo_subject""", ("photo_subject",))
op("fn_spanish_date",
   lambda t, sf: t.report_rows.select("fecha_reporte").distinct().select(
       "fecha_reporte", D.spanish_day_month("fecha_reporte", P_REP.as_of).cast("string").alias("fecha")),
   f"""SELECT fecha_reporte, CAST({spanish_date('fecha_reporte', P_REP.as_of)} AS VARCHAR) AS fecha
       FROM (SELECT DISTINCT fecha_reporte FROM report_rows)""", ("report_rows",))
op("fn_format_body",
   lambda t, sf: t.visit_log.select("record_id", O._fmt(O.NOTICE_BODY, nid=F.col("nid"), day=F.col("fecha_fin"), city=F.col("ciudad_muni"),
                                                       agent=F.col("email_agendador")).alias("body")),
   f"""SELECT record_id, {sql_text(O.NOTICE_BODY, nid='nid', day='fecha_fin', city='ciudad_muni', agent='email_agendador')} AS body
       FROM visit_log""", VL)
op("fn_prefix_split",
   lambda t, sf: t.status_log.select("seq", T.prefix_kind("estado").alias("tipo"), T.prefix_value("estado").alias("valor")),
   "SELECT seq, substring(estado, 1, 3) AS tipo, substring(estado, 4) AS valor FROM status_log", ("status_log",))


def _zero_default(t, sf):
    counts = t.listing_card.groupBy("nid").agg(F.count(F.lit(1)).alias("n"))
    return t.property_master.select("nid").join(counts, "nid", "left").select("nid", T.zero_default("n").alias("fichas"))


op("fn_zero_default", _zero_default, """
SELECT cd.nid, CAST(COALESCE(c.n, 0) AS BIGINT) AS fichas FROM property_master cd
LEFT JOIN (SELECT nid, count(*) AS n FROM listing_card GROUP BY nid) c ON cd.nid = c.nid""", ("property_master", "listing_card"))
op("fn_outcome_si", lambda t, sf: t.report_rows.select("doc_id", "row_pos", T.is_si("resultado").alias("si")),
   f"SELECT doc_id, row_pos, COALESCE(upper({strip('resultado')}) = 'SI', FALSE) AS si FROM report_rows", ("report_rows",))

# ---------------------------------------------- 2.8 extraction, rules, folds
op("html_rows",
   lambda t, sf: html_rows(t.raw("pages"), "html", "ul", "li", "a", 1,
                           keep=["page_id"]).select("page_id", F.col("row_pos").cast("bigint").alias("row_pos"),
                                                    F.array_join("cells", "|").alias("cells")),
   "SELECT page_id, CAST(row_pos AS BIGINT) AS row_pos, array_to_string(cells, '|') AS cells FROM page_items WHERE len(cells) >= 1",
   ("page_items",))
op("report_outcome", lambda t, sf: report_rows(t.photo_report, keep=("doc_id",)).select("doc_id", "row_pos", "nid", "completado", "motivo"),
   "SELECT doc_id, row_pos, nid, completado, motivo FROM report_rows", ("report_rows",))
op("report_dated_rows", lambda t, sf: report_rows(t.photo_report, keep=("doc_id",)).select("doc_id", "row_pos", "nid", "fecha_reporte"),
   "SELECT doc_id, row_pos, nid, fecha_reporte FROM report_rows", ("report_rows",))
op("photo_keyset",
   lambda t, sf: rules.photo_keyset(t.listing_card, t.listing_image, P_REP.photo_professional, exclude_deleted=True,
                                    as_string=True),
   f"SELECT DISTINCT CAST(c.nid AS VARCHAR) AS nid FROM listing_card c WHERE c.nid IS NOT NULL AND {has_photo('c.nid', P_REP.photo_professional, True)}",
   ("listing_card", "listing_image"))


def _v1(t, sf):
    p = P_MTD
    d = t.intake_detail.select(F.col("nid").alias("d_nid"), "estado_patrimonio")
    gs = t.seller_intake.groupBy(F.col("nid").alias("gs_nid")).agg(aggs.any_value("gravamenes_del_apartamento").alias("g"))
    j = t.property_master.select("nid").join(d, F.col("nid") == F.col("d_nid"), "left").join(
        gs, F.col("nid") == F.col("gs_nid"), "left")
    return j.filter(rules.patrimony_v1("estado_patrimonio", "g", p.patrimony_ok, p.encumbrance_deny)).select("nid")


op("rule_patrimony_v1", _v1, f"""
SELECT cd.nid FROM property_master cd LEFT JOIN intake_detail d ON cd.nid = d.nid
LEFT JOIN (SELECT nid, min(gravamenes_del_apartamento) AS g FROM seller_intake GROUP BY nid) gs ON cd.nid = gs.nid
WHERE d.estado_patrimonio IN {in_list(P_MTD.patrimony_ok)} OR (d.estado_patrimonio IS NULL
  AND (gs.g IS NULL OR gs.g NOT IN {in_list(P_MTD.encumbrance_deny)}))""",
   ("property_master", "intake_detail", "seller_intake"))


def _v2(t, sf):
    p = P_REP
    epa = rules.latest_flag(t.clearance_tower).withColumnRenamed("nid", "epa_nid")
    j = t.property_master.join(epa, F.col("nid").cast("string") == F.col("epa_nid"), "left")
    return j.filter(rules.patrimony_v2("flag", "c_tipo_contrato_firmado", p.flag_done, p.flag_in_process,
                                       p.patrimony_contract)).select("nid")


op("rule_patrimony_v2", _v2, f"""
SELECT nid FROM property_master LEFT JOIN {NEWEST_FLAG} ON flag_key = nid WHERE {patrimony_allows(P_REP)}""", ("property_master", "clearance_tower"))


def _publication(t, sf):
    fc = rules.photo_keyset(t.listing_card, t.listing_image, P_REP.photo_client)
    j = joins.exists_flag(t.property_master.select("nid", "date_publication"), fc, "nid", "nid", "fc")
    return j.filter(rules.publication_ok("date_publication", "fc", P_REP.publication_cutoff)).select("nid")


op("rule_publication", _publication, f"""
SELECT cd.nid FROM property_master cd
WHERE cd.date_publication IS NULL OR ({has_photo('cd.nid', P_REP.photo_client)} AND CAST(cd.date_publication AS DATE) >= {dlit(P_REP.publication_cutoff)})""",
   ("property_master", "listing_card", "listing_image"))
op("rule_active_pipeline",
   lambda t, sf: R._base_active(t, P_REP).filter(rules.active_pipeline(
       "cd_c_fecha_captacion", "cd_fecha_desistio_inmobiliaria", "h_fecha_desistio_inmobiliaria", "cd_v_fecha_venta",
       "h_dealstage", P_REP.lost_stage)).select("nid"),
   f"SELECT nid FROM {properties(P_REP, running(P_REP))} WHERE c_fecha_captacion IS NOT NULL", ("property_master", "crm_deal"))
op("rule_listing_live",
   lambda t, sf: t.listing_card.join(t.listing_state, F.col("id") == F.col("property_card_id"))
   .filter(rules.listing_live("active", "current_state_id", 2)).select("nid").distinct(),
   """SELECT DISTINCT pc.nid FROM listing_card pc JOIN listing_state ps ON pc.id = ps.property_card_id
      WHERE pc.active = 1 AND ps.current_state_id = 2""", ("listing_card", "listing_state"))
op("rule_phase_active",
   lambda t, sf: rules.active_phase_keys(t.process_history, P_COURT.court_pipes, P_COURT.closed_phases),
   f"SELECT CAST(k AS VARCHAR) AS nid FROM {in_court(P_COURT)}", ("process_history",))
op("first_final_phase",
   lambda t, sf: rules.first_final_phase(t.process_history, P_REP.patrimony_pipes, P_REP.final_phases).select(
       "nid", F.col("fecha_levant").cast("string").alias("fecha_levant")),
   f"""SELECT CAST(nid AS VARCHAR) AS nid, CAST(min(CAST(first_time_in_phase AS DATE)) AS VARCHAR) AS fecha_levant
       FROM process_history WHERE pipe_id IN {in_list(P_REP.patrimony_pipes)} AND phase_name IN {in_list(P_REP.final_phases)}
       AND nid IS NOT NULL GROUP BY 1""", ("process_history",))

# ------------------------------------------------------------ 2.10 streams


def _files(spark, sf, name, parts=3, rows=100_000):
    """A driver table as a folder that a stream reads in several triggers, in no order of time.

    A file is one task's at least, whatever its size (a row group is not split): files hold about ``rows`` rows, so a
    trigger's work spreads over the cores and a task's memory does not grow with the table."""
    path = _io_dir(spark, f"stream/{name}")
    table = spark.read.parquet(f"{sf}/{name}.parquet")
    files = max(1, -(-table.count() // (parts * rows)))
    table.repartition(parts * files).write.parquet(path)
    return S.stream_source(spark, path, max_files=files)


def _st1(spark, sf):
    return S.current_values(spark, S.status_fold_stream(spark, bind_status_log(_files(spark, sf, "events")), P_ORD.status_day_str))


def _st2(spark, sf):
    return S.deduplicated(spark, S.dedup_reports_stream(spark, driver_report_rows(_files(spark, sf, "pages", rows=500)), P_REP.as_of))


def _st3(spark, sf):
    visits = bind_visit_log(_files(spark, sf, "orders"))
    return S.read_keyed(spark, S.latest_upsert_stream(spark, visits), visits.schema).select("nid", "status", "modified_date", "record_id")


def _st4(spark, sf):
    """The log as it grows: three parts in order of time, a run after each, and at each run the part before is closed."""
    orders, path = spark.read.parquet(f"{sf}/orders.parquet"), _io_dir(spark, "stream/orders")
    run, day = f"{path}/run", F.to_date("o_orderdate")
    first, last = orders.agg(F.min(day), F.max(day)).first()
    part = (last - first) // 3 + dt.timedelta(days=1)
    for k in range(3):
        begin, end = first + k * part, first + (k + 1) * part
        orders.filter((day >= F.lit(begin)) & (day < F.lit(end))).write.mode("append").parquet(f"{path}/in")
        S.daily_counts_stream(spark, bind_visit_log(S.stream_source(spark, f"{path}/in")), tables(spark, sf).property_master, P_MTD.cancel_statuses_digest,
                              end - dt.timedelta(days=1), part.days, root=run)
    return S.daily_counts(spark, run)


register("stream_status_fold", _fold_sql(P_ORD.status_day_str), ("status_log",))(_st1)
register("stream_dedup_reports", "SELECT DISTINCT nid, fecha_reporte FROM report_rows", ("report_rows",))(_st2)
register("stream_latest_upsert", """SELECT DISTINCT ON (nid) nid, status, modified_date, record_id FROM visit_log
  ORDER BY nid, modified_date DESC, record_id DESC""", VL)(_st3)
register("stream_daily_counts", f"""
SELECT substring(v.modified_date, 1, 10) AS dia, {falsy('m.c_comercial_captacion', 'v.email_agendador')} AS agente, count(*) AS canceladas
FROM visit_log v LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = v.nid
WHERE v.status IN {in_list(P_MTD.cancel_statuses_digest)} GROUP BY 1, 2""", ("visit_log", "property_master"))(_st4)

# ------------------------------------------------- 2.1 file sources / sinks


def _io_dir(spark, name):
    return checkpoint_path(spark, f"io/{name}/{uuid.uuid4().hex}")


_ODD_TEXT = ("concat(p_brand, ', \"', p_name, '\"\n', p_type)", "p_brand || ', \"' || p_name || '\"' || chr(10) || p_type")


def _csv_typed(spark, sf):
    """Parts as an all-string CSV with quoted commas, quotes and line breaks, read back with typed, error-tolerant casts."""
    path = _io_dir(spark, "csv_typed")
    part = spark.read.parquet(f"{sf}/part.parquet")
    part.select(F.col("p_partkey").cast("string").alias("clave"), F.col("p_size").cast("string").alias("medida"),
                F.col("p_type").alias("malo"), F.expr(_ODD_TEXT[0]).alias("nota")).write.options(header=True, escape='"').csv(path)
    return scan_csv_typed(spark, path, {"clave": "bigint", "medida": "bigint", "malo": "bigint"})


def _sheet_bom(spark, sf):
    """S3: a sheet tab with a byte-order mark in its header and free text in its cells."""
    path = _io_dir(spark, "sheet_bom")
    tab = tables(spark, sf).raw("part").select(F.col("p_partkey").cast("string").alias(sheets.BOM + "NID"), F.expr(_ODD_TEXT[0]).alias("Observaciones"))
    tab.write.options(header=True, escape='"').csv(path)
    return sheets.resolve_header(sheets.read_sheet(spark, path), sheets.REASON_ALIASES, ("nid",)).select("nid", "observaciones")


def _append(spark, sf):
    """Status rows appended twice to the log folder; the last row of each key by the log's own sequence."""
    path = _io_dir(spark, "status_append")
    log = tables(spark, sf).status_log
    sinks.status_append(log.filter(F.col("fecha") != "perm"), path, ["seq"])
    sinks.status_append(log.filter(F.col("fecha") == "perm"), path, ["seq"])
    return latest.latest_per_key(spark.read.parquet(path), ["nid", "fecha"], "seq").select(*sinks.LOG_COLUMNS)


def _many_writers(spark, sf):
    """S12 with several writers: three submissions, sequenced in two runs; the last row of each key."""
    log = sinks.StatusLog(spark, _io_dir(spark, "status_log_writers"))
    rows = tables(spark, sf).status_log
    for k in range(3):
        log.submit(rows.filter((F.col("seq") >= k * 1000) & (F.col("seq") < (k + 1) * 1000) if k < 2 else F.col("seq") >= 2000), ["seq"])
        if k:
            log.sequence()
    return latest.latest_per_key(log.rows(), ["nid", "fecha"], "seq").select(*sinks.LOG_COLUMNS)


register("status_append_writers", """SELECT nid, fecha, arg_max(estado, seq) AS estado, '' AS usuario FROM status_log GROUP BY nid, fecha""",
         ("status_log",))(_many_writers)


register("scan_csv_typed", f"""SELECT CAST(p_partkey AS BIGINT) AS clave, CAST(p_size AS BIGINT) AS medida, CAST(NULL AS BIGINT) AS malo,
  {_ODD_TEXT[1]} AS nota FROM part""")(_csv_typed)
register("scan_sheet_bom", f"SELECT CAST(p_partkey AS VARCHAR) AS nid, {_ODD_TEXT[1]} AS observaciones FROM part")(_sheet_bom)
register("status_append", """SELECT nid, fecha, arg_max(estado, seq) AS estado, '' AS usuario FROM status_log GROUP BY nid, fecha""",
         ("status_log",))(_append)


def _positional(spark, sf):
    """The status sheet exported as CSV, read back by column position."""
    path = _io_dir(spark, "status_positional")
    log = tables(spark, sf).status_log
    log.select(F.col("nid").alias("NID "), F.col("fecha").alias("Fecha"), F.concat("estado", F.lit(", \"x\"\ny")).alias("estado"),
               "usuario").write.options(header=True, escape='"').csv(path)
    return sheets.read_status_log_positional(spark, path).select("nid", "fecha", "estado")


register("scan_status_positional", """SELECT nid, fecha, estado || ', "x"' || chr(10) || 'y' AS estado FROM status_log""", ("status_log",))(_positional)


register("report_backlog_levels", f"""
SELECT 'equipo' AS nivel, equipo AS clave, por_agendar, por_agendar_2025, canceladas, juzgado, '' AS equipo FROM ({_r15_sql(P_MTD)})
UNION ALL
SELECT 'comercial', comercial, por_agendar, por_agendar_2025, canceladas, juzgado, equipo FROM ({_r16_sql(P_MTD)})""", ROLES_BACKLOG)(
    lambda spark, sf: O.backlog_levels(tables(spark, sf), P_MTD))
