"""Query registry: ``key -> (spark callable, oracle SQL)``.

Every callable takes ``(spark, sf_dir)``, binds the driver tables to roles
and runs one library operator or report over whole tables.  Every oracle is
independent DuckDB SQL over the same parquet files (role CTEs from
``oracle_roles``), written from the rule: one CTE per rule, key sets as
``EXISTS``, the latest row of a key as ``DISTINCT ON``.  Outputs use text dates
and bigint counts so both engines agree on types.
"""

from __future__ import annotations

import datetime as dt
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..params import NO_INFO_LABEL, NO_VISIT_LABEL
from . import outbox as O
from . import reports as R
from .bindings import Tables, driver_params, driver_tables
from .oracle_roles import with_roles
from .sqlfrag import clean, date_text, dlit, falsy, hora, in_list, nonblank, not_contains, q, spanish_date, strip, title_or_blank

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a folder's entries."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Roles of a folder, bound once a session and again when the folder's files change; they are kept on the session
    object and end with it."""
    held, now = spark.__dict__.setdefault("_visitflow_tables", {}), _listing(spark, sf_dir)
    if held.get(sf_dir, (None,))[0] != now:
        held[sf_dir] = now, driver_tables(spark, sf_dir)
    return held[sf_dir][1]


def register(key: str, sql: str | None = None, roles: tuple = ()):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_roles(sql, *roles) if roles else sql
        return fn
    return deco


def report(key: str, fn, params, sql: str | None = None, roles: tuple = ()):
    register(key, sql, roles)(lambda spark, sf: fn(tables(spark, sf), params))


# ------------------------------------------------------------------ params
P_ORD = driver_params(dt.date(2001, 7, 1))
P_MTD = driver_params(dt.date(2001, 7, 20))
P_COURT = driver_params(dt.date(2024, 7, 15))
P_REP = driver_params(dt.date(2026, 4, 23))
P_SUBJ = driver_params(dt.date(2026, 3, 15))

# ------------------------------------------------------------- shared rules


def sql_text(template: str, **parts) -> str:
    """A message template of ``outbox`` as a DuckDB expression; parts are SQL."""
    out = []
    for lit, name, _, _ in string.Formatter().parse(template):
        if lit:
            out.append(q(lit))
        if name is not None:
            out.append(f"CAST({parts[name]} AS VARCHAR)")
    return "(" + " || ".join(out) + ")"


def newest_visit(p, where: str = "TRUE") -> str:
    """The latest row of each real key among the tracked visits, as known then."""
    if p.known_at is not None:
        where += f" AND (modified_date IS NULL OR modified_date <= {q(p.known_at)})"
    return (f"(SELECT DISTINCT ON (nid) * FROM visit_log WHERE visit_type IN {in_list(p.visit_types)} AND nid <> 'nan' "
            f"AND nid IS NOT NULL AND {where} ORDER BY nid, modified_date DESC NULLS LAST, record_id DESC)")


def deals(p) -> str:
    return (f"(SELECT nid AS deal_key, hubspot_owner_id AS deal_owner, equipo_sellers AS deal_team, dealstage, "
            f"fecha_desistio_inmobiliaria AS deal_lost_on FROM crm_deal WHERE pipeline = {q(p.pipeline_id)})")


def properties(p, only: str = "TRUE") -> str:
    """Every property with its deal: ``agent`` and ``crew`` prefer the deal's."""
    return (f"(SELECT m.*, CAST(m.nid AS VARCHAR) AS txt, deal_key, deal_owner, deal_team, dealstage, deal_lost_on, "
            f"COALESCE(deal_owner, m.c_comercial_captacion) AS agent, COALESCE(deal_team, m.c_equipo_seller) AS crew "
            f"FROM property_master m LEFT JOIN {deals(p)} ON deal_key = m.nid WHERE {only})")


def running(p) -> str:
    """Neither withdrawn, sold nor lost."""
    return (f"fecha_desistio_inmobiliaria IS NULL AND v_fecha_venta IS NULL AND deal_lost_on IS NULL "
            f"AND dealstage IS DISTINCT FROM {q(p.lost_stage)}")


def has_photo(key: str, source: int, live: bool = False) -> str:
    kept = " AND img.deleted_at IS NULL" if live else ""
    return (f"EXISTS (SELECT 1 FROM listing_card crd, listing_image img WHERE crd.nid = {key} AND img.property_card_id = crd.id "
            f"AND img.source_image_id = {source}{kept})")


NEWEST_FLAG = ("(SELECT DISTINCT ON (nid) nid AS flag_key, v_flag_desistidos_patrimonio AS flag FROM clearance_tower "
               "ORDER BY nid, v_fecha_inicio_fase_actual_patrimonio_de_familia DESC NULLS LAST, record_id DESC)")


def patrimony_allows(p) -> str:
    return (f"(flag IS NOT DISTINCT FROM {q(p.flag_done)} OR (c_tipo_contrato_firmado IS DISTINCT FROM {q(p.patrimony_contract)} "
            f"AND flag IS DISTINCT FROM {q(p.flag_in_process)}))")


def bad_opinions(p) -> str:
    """The latest unfavourable opinion of each key within the lookback."""
    return (f"(SELECT DISTINCT ON (nid) nid AS k, CAST(v_fecha_concepto_del_defensor_de_familia AS DATE) AS on_day, "
            f"v_nombre_cliente_1 AS client, v_numero_telefonico_cliente_1 AS phone FROM clearance_tower "
            f"WHERE lower(v_concepto_del_defensor_de_familia) = {q(p.unfavourable)} "
            f"AND CAST(v_fecha_concepto_del_defensor_de_familia AS DATE) >= CAST({dlit(p.as_of)} - INTERVAL {p.opinion_lookback_months} MONTH AS DATE) "
            f"ORDER BY nid, v_fecha_concepto_del_defensor_de_familia DESC, record_id DESC)")


def in_court(p) -> str:
    """Keys whose latest phase in a court pipe is still open."""
    return (f"(SELECT nid AS k FROM (SELECT DISTINCT ON (nid) nid, phase_name FROM process_history WHERE pipe_id IN {in_list(p.court_pipes)} "
            f"ORDER BY nid, first_time_in_phase DESC NULLS LAST, record_id DESC) WHERE phase_name NOT IN {in_list(p.closed_phases)})")


def window_of(p, days: int) -> str:
    return f"CAST(received_at AS DATE) >= {dlit(p.as_of)} - INTERVAL {days} DAY AND sender = {q(p.report_sender)}"


# ----------------------------------------------------------------- R1
def _r1_sql(p) -> str:
    return f"""
SELECT {clean('v.nid')} AS nid, {clean('v.fecha_fin')} AS fecha_fin, {hora('v.fecha_inicio')} AS hora,
  {falsy(clean('COALESCE(deal_owner, m.c_comercial_captacion)'), clean('v.email_agendador'))} AS c_comercial_captacion,
  {clean('v.nombre_agendador')} AS nombre_agendador, {title_or_blank(clean('v.ciudad_muni'))} AS ciudad,
  {clean('v.zona')} AS zona, {clean('v.direccion')} AS direccion, {clean('v.torre_apto')} AS torre_apto,
  {clean('v.conjunto')} AS conjunto, {clean('v.visit_type')} AS visit_type, {clean('v.visit_category')} AS visit_category,
  {clean('m.tel_fono_del_cliente_1')} AS telefono_cliente, {clean('COALESCE(deal_team, m.c_equipo_seller)')} AS equipo
FROM {newest_visit(p)} v LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = v.nid
LEFT JOIN {deals(p)} ON deal_key = TRY_CAST(v.nid AS BIGINT)
WHERE v.status IN {in_list(p.scheduled_statuses)} AND starts_with(v.fecha_fin, {q(p.day_prefix)})
ORDER BY v.fecha_inicio NULLS FIRST, v.nid"""


ROLES_R1 = ("visit_log", "property_master", "crm_deal")
report("report_visits_tomorrow", R.visits_tomorrow, P_ORD, _r1_sql(P_ORD), ROLES_R1)


def _r1_past(known_at: str):
    """R1 over the log as it was, from the rows' validity intervals."""
    p = P_ORD.with_(known_at=known_at)

    def run(t, _):
        past = Tables(t)
        past["visit_history"] = R.visit_history(t.visit_log)
        return R.visits_tomorrow(past, p)

    report(f"report_visits_tomorrow_{known_at[:4]}", run, p, _r1_sql(p), ROLES_R1)


for _moment in ("1997-12-31T23:59:59.999Z", "2000-06-15T12:00:00.000Z"):
    _r1_past(_moment)


# ----------------------------------------------------------------- R2
def _r2_sql(p) -> str:
    iso = "contains(modified_date, 'T')"
    return f"""
WITH told AS (SELECT *, {spanish_date('fecha_reporte', p.as_of)} AS report_day FROM report_rows
              WHERE {window_of(p, p.cancelled_lookback_days)} AND NOT completado),
state AS (SELECT nid, status, fecha_inicio,
            CASE WHEN {iso} THEN CAST(try_strptime(split_part(modified_date, 'T', 1), '%Y-%m-%d') AS DATE) END AS changed_on,
            CASE WHEN {iso} THEN split_part(modified_date, 'T', 1) ELSE COALESCE(modified_date, '') END AS changed_text
          FROM (SELECT DISTINCT ON (nid) * FROM visit_log WHERE visit_type IN {in_list(p.visit_types)}
                ORDER BY nid, modified_date DESC NULLS LAST, record_id DESC)),
off AS (SELECT s.* FROM state s JOIN (SELECT nid, max(report_day) AS newest FROM told GROUP BY nid) t USING (nid)
        WHERE s.status IN {in_list(p.cancel_statuses_report)}
           OR (s.status IS DISTINCT FROM {q(p.done_status)} AND t.newest > s.changed_on)),
one AS (SELECT DISTINCT ON (nid, fecha_reporte) * FROM told ORDER BY nid, fecha_reporte, received_at, doc_id, row_pos),
who AS (SELECT DISTINCT ON (txt) txt, agent, tel_fono_del_cliente_1 AS phone, direccion AS street, ciudad AS town, crew FROM {properties(p)}
        ORDER BY txt, agent NULLS FIRST, phone NULLS FIRST, street NULLS FIRST, town NULLS FIRST, crew NULLS FIRST)
SELECT one.nid, {title_or_blank("COALESCE(NULLIF(town, ''), NULLIF(one.ciudad_correo, ''))")} AS ciudad,
  one.fotografo, one.motivo AS motivo_cancelacion, COALESCE(agent, '') AS c_comercial_captacion,
  COALESCE(phone, '') AS telefono_cliente, COALESCE(street, '') AS direccion, one.fecha_reporte,
  CASE WHEN contains(off.fecha_inicio, 'T') THEN split_part(off.fecha_inicio, 'T', 1) || ' ' || {hora('off.fecha_inicio')} ELSE '' END AS fecha_agendada,
  COALESCE(crew, '') AS equipo, COALESCE(changed_text, '') AS ultima_actualizacion,
  {has_photo('TRY_CAST(one.nid AS BIGINT)', p.photo_professional, True)} AS tiene_fotos_profesionales
FROM one JOIN off USING (nid) LEFT JOIN who ON who.txt = one.nid
WHERE NOT {has_photo('TRY_CAST(one.nid AS BIGINT)', p.photo_professional)}"""


report("report_cancelled", R.cancelled, P_REP, _r2_sql(P_REP),
       ("report_rows", "visit_log", "listing_card", "listing_image", "property_master", "crm_deal"))
report("agg_distinct_ordered", R.report_dates, P_REP, f"""
SELECT fecha_reporte FROM report_rows WHERE {window_of(P_REP, P_REP.cancelled_lookback_days)} AND fecha_reporte <> ''
GROUP BY fecha_reporte ORDER BY min((received_at, doc_id))""", ("report_rows",))


# ----------------------------------------------------------------- R3
def _r3_sql(p) -> str:
    return f"""
SELECT DISTINCT ON (o.k) m.txt AS nid, {date_text('o.on_day')} AS fecha_desfavorable, {date_text('m.c_fecha_captacion')} AS fecha_captacion,
  {clean('m.agent')} AS comercial, {clean('m.crew')} AS equipo, {title_or_blank('m.ciudad')} AS ciudad,
  {clean('COALESCE(o.phone, m.tel_fono_del_cliente_1)')} AS telefono_cliente, {clean('o.client')} AS nombre_cliente,
  {date_text('m.v_fecha_venta')} AS fecha_venta, {date_text('m.fecha_desistio_inmobiliaria')} AS fecha_desistio
FROM {bad_opinions(p)} o JOIN {properties(p, 'deal_key IS NOT NULL')} m ON m.nid = o.k
WHERE o.k NOT IN (SELECT k FROM {in_court(p)} WHERE k IS NOT NULL)
ORDER BY o.k, fecha_captacion, comercial, equipo, ciudad"""


report("report_court_candidates", R.court_candidates, P_COURT, _r3_sql(P_COURT),
       ("clearance_tower", "crm_deal", "process_history", "property_master"))


# ----------------------------------------------------------------- R4
def _visits_of_category(p) -> str:
    return (f"(SELECT nid AS visit_key, arg_max(status, (modified_date, record_id)) AS last_status, bool_or(status = {q(p.done_status)}) AS finished "
            f"FROM visit_log WHERE visit_category IN {in_list(p.visit_categories)} AND nid IS NOT NULL GROUP BY nid)")


def _open_for_visit(p) -> str:
    return f"(visit_key IS NULL OR (NOT finished AND last_status NOT IN {in_list(p.scheduled_statuses)}))"


def _published_late(p, key: str = "m.nid") -> str:
    return (f"(m.date_publication IS NULL OR ({has_photo(key, p.photo_client)} "
            f"AND CAST(m.date_publication AS DATE) >= {dlit(p.publication_cutoff)}))")


def _r4_sql(p) -> str:
    return f"""
WITH building AS (SELECT nid_1 AS k, min(nombre_de_edificio_conjunto) AS name FROM seller_form
                  WHERE nombre_de_edificio_conjunto <> '' GROUP BY nid_1),
lifted AS (SELECT nid AS k, min(CAST(first_time_in_phase AS DATE)) AS on_day FROM process_history
           WHERE pipe_id IN {in_list(p.patrimony_pipes)} AND phase_name IN {in_list(p.final_phases)} GROUP BY nid),
due AS (
SELECT m.txt AS nid, COALESCE(m.agent, '') AS comercial, {title_or_blank('m.ciudad')} AS ciudad, COALESCE(building.name, '') AS conjunto,
  COALESCE(m.crew, '') AS equipo, {date_text('m.c_fecha_captacion')} AS fecha_captacion,
  {date_text(f"CASE WHEN d.estado_patrimonio = {q(p.patrimony_lifted)} THEN lifted.on_day END")} AS fecha_levantamiento,
  COALESCE(m.tel_fono_del_cliente_1, '') AS telefono_cliente, COALESCE(NULLIF(last_status, ''), {q(NO_VISIT_LABEL)}) AS ultimo_status,
  CASE WHEN {has_photo('m.nid', p.photo_client)} THEN {q(R.CLIENT_PHOTOS_LABEL)} ELSE {q(R.UNPUBLISHED_LABEL)} END AS tipo_fotos,
  m.c_fecha_captacion AS captured
FROM {properties(p, running(p))} m LEFT JOIN {_visits_of_category(p)} ON visit_key = m.txt LEFT JOIN {NEWEST_FLAG} ON flag_key = m.nid
LEFT JOIN intake_detail d ON d.nid = m.nid LEFT JOIN building ON building.k = m.nid LEFT JOIN lifted ON lifted.k = m.nid
WHERE m.c_fecha_captacion IS NOT NULL AND {not_contains('m.ciudad', p.excluded_city_substrings)} AND {_published_late(p)}
  AND {_open_for_visit(p)} AND {patrimony_allows(p)})
SELECT DISTINCT ON (nid) * EXCLUDE (captured) FROM due ORDER BY nid, captured DESC NULLS LAST, comercial, ciudad, conjunto, equipo"""


ROLES_R4 = ("visit_log", "listing_card", "listing_image", "seller_form", "process_history", "property_master",
            "intake_detail", "crm_deal", "clearance_tower")
report("report_to_schedule", R.to_schedule, P_REP, _r4_sql(P_REP), ROLES_R4)


# ----------------------------------------------------------------- R5
def _links_sql() -> str:
    return (f"(SELECT DISTINCT ON (nid) nid, link FROM (SELECT {strip('nid')} AS nid, {strip('link')} AS link, tab_order, row_order FROM link_rows) "
            "WHERE nid <> '' AND starts_with(lower(link), 'http') ORDER BY nid, tab_order DESC, row_order DESC)")


def _published_sql() -> str:
    return (f"(SELECT DISTINCT nid FROM (SELECT {strip('nid')} AS nid, lower({strip('estado')}) AS estado FROM followup_rows) "
            "WHERE nid <> '' AND starts_with(estado, 'publicad'))")


def _r5_sql(p) -> str:
    day = spanish_date("fecha_reporte", p.as_of)
    town = "COALESCE(NULLIF(m.ciudad, ''), told.town, '')"
    photos = f"CASE WHEN pictured THEN {q(R.CLIENT_PHOTOS_LABEL)} ELSE {q(R.UNPUBLISHED_LABEL)} END"
    card = f"CASE WHEN u.id IS NULL THEN {q(R.WITHOUT_CMS)} ELSE {q(R.WITH_CMS)} END"
    return f"""
WITH told AS (SELECT nid, COALESCE(arg_max(fecha_reporte, ({day}, fecha_reporte)) FILTER (WHERE fecha_reporte <> ''), '') AS seen_on,
                arg_max(ciudad_correo, (received_at, doc_id, row_pos)) FILTER (WHERE ciudad_correo <> '') AS town
              FROM report_rows WHERE {window_of(p, p.completed_lookback_days)} AND completado AND nid <> '' GROUP BY nid),
shown AS (SELECT c.nid AS k, c.id, st.current_state_id AS state, c.active = 1 AND st.current_state_id = {p.live_state} AS live
          FROM listing_card c LEFT JOIN listing_state st ON st.property_card_id = c.id
          WHERE c.nid IS NOT NULL),
usable AS (SELECT k, id, state, COALESCE(live, FALSE) AS live FROM shown JOIN listing_card c USING (id)
           WHERE c.active IS DISTINCT FROM 0 AND COALESCE(state, 0) NOT IN {in_list(p.dead_states)})
SELECT DISTINCT ON (m.txt) m.txt AS nid, COALESCE(m.agent, '') AS comercial,
  CASE WHEN {town} = '' THEN '' ELSE {title_or_blank(town)} END AS ciudad, COALESCE(m.crew, '') AS equipo, told.seen_on AS fecha_recorrido,
  {q(R.BUBBLE_DONE_LABEL)} AS status_bubble, {card} AS ficha_cms,
  COALESCE(d.estado_patrimonio, '') AS patrimonio, {q(R.WITH_360_LABEL)} AS visita_360, {photos} AS tipo_fotos,
  concat_ws(', ', NULLIF(d.estado_patrimonio, ''), {card}, {photos}) AS estado_actual, COALESCE(l.link, '') AS link_publicacion
FROM told JOIN (SELECT r.*, {has_photo('r.nid', p.photo_client, True)} AS pictured, {has_photo('r.nid', p.photo_professional, True)} AS toured
  FROM {properties(p, running(p))} r) m ON m.txt = told.nid LEFT JOIN {NEWEST_FLAG} ON flag_key = m.nid
LEFT JOIN intake_detail d ON d.nid = m.nid LEFT JOIN {_links_sql()} l ON l.nid = m.txt
LEFT JOIN usable u ON u.k = m.nid AND NOT (u.live AND m.toured)
WHERE {patrimony_allows(p)} AND m.txt NOT IN {_published_sql()}
  AND (u.id IS NOT NULL OR NOT EXISTS (SELECT 1 FROM shown s WHERE s.k = m.nid))
ORDER BY m.txt, u.id, u.state NULLS FIRST"""


ROLES_R5 = ("report_rows", "property_master", "listing_card", "listing_state", "intake_detail", "crm_deal",
            "listing_image", "clearance_tower", "followup_rows", "link_rows")
report("report_to_publish", R.to_publish, P_REP, _r5_sql(P_REP), ROLES_R5)


# ----------------------------------------------------------------- R6
def _subject_keys_sql(p) -> str:
    return f"""(SELECT DISTINCT k AS nid FROM (SELECT COALESCE(NULLIF(regexp_extract(subject, '\\((\\d{{8,}})\\)', 1), ''),
      NULLIF(regexp_extract(subject, '(\\d{{8,}})', 1), '')) AS k FROM photo_subject
    WHERE CAST(received_at AS DATE) >= {dlit(p.as_of)} - INTERVAL {p.subject_lookback_days} DAY
      AND contains(lower(subject), {q(p.subject_text.lower())})) WHERE k IS NOT NULL)"""


def _r6_sql(p) -> str:
    return f"""
WITH told AS (SELECT m.*, {has_photo('m.nid', p.photo_client)} AS pictured FROM {properties(p)} m
              WHERE m.txt IN {_subject_keys_sql(p)} AND m.fecha_desistio_inmobiliaria IS NULL AND NOT {has_photo('m.nid', p.photo_professional)})
SELECT txt AS nid, COALESCE(agent, '') AS comercial, {title_or_blank('ciudad')} AS ciudad, COALESCE(crew, '') AS equipo,
  {date_text('c_fecha_captacion')} AS fecha_captacion, COALESCE(tel_fono_del_cliente_1, '') AS telefono_cliente,
  COALESCE(NULLIF(d.estado_patrimonio, ''), {q(NO_INFO_LABEL)}) AS patrimonio
FROM told LEFT JOIN intake_detail d ON d.nid = told.nid LEFT JOIN {NEWEST_FLAG} ON flag_key = told.nid
WHERE (pictured OR (told.date_publication IS NULL AND d.date_publication IS NULL)) AND {patrimony_allows(p)}"""


report("report_to_publish_clientphotos", R.to_publish_client_photos, P_SUBJ, _r6_sql(P_SUBJ),
       ("photo_subject", "property_master", "intake_detail", "crm_deal", "listing_card", "listing_image", "clearance_tower"))


# ----------------------------------------------------------------- R7
def _r7_sql(p) -> str:
    return f"""
SELECT DISTINCT ON (m.nid) m.txt AS nid, COALESCE(m.agent, '') AS comercial, {title_or_blank('m.ciudad')} AS ciudad, COALESCE(m.crew, '') AS equipo,
  {date_text('m.c_fecha_captacion')} AS fecha_captacion, COALESCE(m.tel_fono_del_cliente_1, '') AS telefono_cliente
FROM {properties(p, running(p))} m LEFT JOIN {NEWEST_FLAG} ON flag_key = m.nid
WHERE m.c_fecha_captacion IS NOT NULL AND m.date_publication IS NULL AND {patrimony_allows(p)}
  AND NOT {has_photo('m.nid', p.photo_professional)}
  AND NOT EXISTS (SELECT 1 FROM crm_deal_raw special WHERE special.nid = m.nid AND special.flag_inmueble_nph <> '')
ORDER BY m.nid, m.c_fecha_captacion DESC, comercial, ciudad, equipo"""


report("report_to_publish_nophotos", R.to_publish_no_photos, P_REP, _r7_sql(P_REP),
       ("property_master", "crm_deal", "listing_card", "listing_image", "crm_deal_raw", "clearance_tower"))


# ----------------------------------------------------------------- R8
def _r8_sql(p) -> str:
    return f"""
WITH shown AS (SELECT c.nid AS k, max(CAST(st.date_publication AS DATE)) AS newest FROM listing_card c, listing_state st
               WHERE st.property_card_id = c.id AND c.active = 1 AND st.current_state_id = {p.live_state} GROUP BY c.nid)
SELECT DISTINCT ON (k) CAST(k AS VARCHAR) AS nid, {date_text('newest')} AS fecha_publicacion,
  {clean('COALESCE(deal_owner, m.c_comercial_captacion)')} AS comercial, {clean('COALESCE(deal_team, m.c_equipo_seller)')} AS equipo,
  {title_or_blank('m.ciudad')} AS ciudad, l.link AS link_publicacion
FROM shown JOIN {deals(p)} ON deal_key = k JOIN {_links_sql()} l ON l.nid = CAST(k AS VARCHAR) LEFT JOIN property_master m ON m.nid = k
ORDER BY k, comercial, equipo, ciudad"""


report("report_published_links", R.published_links, P_REP, _r8_sql(P_REP),
       ("listing_card", "listing_state", "property_master", "crm_deal", "link_rows"))

# ------------------------------------------------------------- R9-R11
report("lookup_links", R.links_lookup, P_REP, "SELECT * FROM " + _links_sql(), ("link_rows",))
report("lookup_reasons", R.reasons_lookup, P_REP, f"""
SELECT DISTINCT ON (nid) nid, motivo, observaciones, fuente FROM (SELECT COALESCE({strip('nid')}, '') AS nid,
  COALESCE({strip('motivo')}, '') AS motivo, COALESCE({strip('observaciones')}, '') AS observaciones, fuente, tab_order, row_order
  FROM followup_rows) WHERE nid <> '' ORDER BY nid, tab_order DESC, row_order DESC""", ("followup_rows",))
report("lookup_sheet_published", R.sheet_published, P_REP, "SELECT * FROM " + _published_sql(), ("followup_rows",))


# ----------------------------------------------------------------- R12
def _fold_sql(day: str) -> str:
    perm = "('ps:', 'pc:', 'sf:', 'sc:', 'jz:', 'fc:', 'fd:', 'cd:')"
    return f"""
WITH r AS (SELECT {strip("COALESCE(nid, '')")} AS nid, {strip("COALESCE(fecha, '')")} AS fecha,
                  {strip("COALESCE(estado, '')")} AS estado, seq FROM status_log),
e AS (
  SELECT nid, seq, CASE WHEN substring(estado, 1, 3) = 'wa:' THEN 'whatsapp'
                        WHEN substring(estado, 1, 3) = 'cc:' THEN 'cancelContacto'
                        WHEN substring(estado, 1, 3) NOT IN {perm} THEN 'visita' END AS kind,
         CASE WHEN substring(estado, 1, 3) = 'wa:' THEN 'true'
              WHEN substring(estado, 1, 3) = 'cc:' THEN substring(estado, 4) ELSE estado END AS value
  FROM r WHERE nid <> '' AND estado <> '' AND fecha = {q(day)}
  UNION ALL
  SELECT nid, seq, 'cancelDesistido', 'true' FROM r
  WHERE nid <> '' AND fecha = {q(day)} AND substring(estado, 1, 3) = 'cc:' AND substring(estado, 4) = 'desistido'
  UNION ALL
  SELECT nid, seq, CASE substring(estado, 1, 3) WHEN 'ps:' THEN 'pubEstado' WHEN 'pc:' THEN 'pubComentario'
                        WHEN 'sf:' THEN 'sfEstado' WHEN 'sc:' THEN 'sfComentario' WHEN 'fc:' THEN 'fcEstado'
                        WHEN 'fd:' THEN 'fcComentario' WHEN 'jz:' THEN 'juzgado' WHEN 'cd:' THEN 'cancelDesistido' END,
         CASE WHEN substring(estado, 1, 3) = 'cd:' THEN 'true' ELSE substring(estado, 4) END
  FROM r WHERE nid <> '' AND estado <> '' AND fecha = 'perm'
    AND (substring(estado, 1, 3) IN ('pc:', 'sc:', 'fd:')
         OR (substring(estado, 1, 3) IN ('ps:', 'sf:', 'fc:', 'jz:', 'cd:') AND substring(estado, 4) <> '')))
SELECT nid, kind, arg_max(value, seq) AS value FROM e WHERE kind IS NOT NULL GROUP BY nid, kind"""


report("report_status_current", R.status_current, P_ORD, _fold_sql(P_ORD.status_day_str), ("status_log",))
report("status_fold", R.status_current, P_MTD, _fold_sql(P_MTD.status_day_str), ("status_log",))


def _wide_sql(day: str) -> str:
    texts = ("visita", "cancelContacto", "pubEstado", "pubComentario", "sfEstado", "sfComentario", "fcEstado", "fcComentario", "juzgado")
    columns = [f"""any_value(value) FILTER (kind = '{k}') AS "{k}\"""" for k in texts]
    columns += [f"""bool_or(value = 'true') FILTER (kind = '{k}') AS "{k}\"""" for k in ("whatsapp", "cancelDesistido")]
    return f"SELECT nid, {', '.join(columns)} FROM ({_fold_sql(day)}) GROUP BY nid"


report("report_status_wide", R.status_wide, P_ORD, _wide_sql(P_ORD.status_day_str), ("status_log",))
report("status_wide", R.status_wide, P_MTD, _wide_sql(P_MTD.status_day_str), ("status_log",))


# ------------------------------------------------------------ R15/R16
def _backlog_ctes(p) -> str:
    """todo: properties to schedule; off: cancelled this month; court: opinions
    to take to court.  Each with the raw team and agent columns."""
    gone = "m.fecha_desistio_inmobiliaria IS NULL AND m.v_fecha_venta IS NULL"
    return f"""
todo AS (SELECT m.*, year(m.c_fecha_captacion) <= {p.old_year} AS old
  FROM {properties(p, running(p))} m LEFT JOIN {_visits_of_category(p)} ON visit_key = m.txt LEFT JOIN intake_detail d ON d.nid = m.nid
  LEFT JOIN (SELECT nid AS k, min(gravamenes_del_apartamento) AS lien FROM seller_intake GROUP BY nid) s ON s.k = m.nid
  WHERE m.c_fecha_captacion IS NOT NULL AND {not_contains('m.ciudad', p.excluded_city_substrings)} AND {_published_late(p)} AND {_open_for_visit(p)}
    AND (d.estado_patrimonio IN {in_list(p.patrimony_ok)}
         OR (d.estado_patrimonio IS NULL AND (lien IS NULL OR lien NOT IN {in_list(p.encumbrance_deny)})))),
off AS (SELECT m.c_equipo_seller, m.c_comercial_captacion, deal_team, deal_owner
  FROM {newest_visit(p, f'modified_date >= {q(p.month_start)}')} v LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = v.nid
  LEFT JOIN {deals(p)} ON deal_key = TRY_CAST(v.nid AS BIGINT) WHERE v.status IN {in_list(p.cancel_statuses_digest)} AND {gone}),
court AS (SELECT m.c_equipo_seller, m.c_comercial_captacion, deal_team, deal_owner
  FROM {bad_opinions(p)} o LEFT JOIN property_master m ON m.nid = o.k LEFT JOIN {deals(p)} ON deal_key = o.k
  WHERE NOT EXISTS (SELECT 1 FROM {in_court(p)} c WHERE c.k = o.k))"""


def _backlog_sql(p, key: str, name: str, extra: str, having: str) -> str:
    return f"""
WITH {_backlog_ctes(p)},
counted AS (
  SELECT {key} AS {name}, 1 AS por_agendar, CAST(COALESCE(old, FALSE) AS INTEGER) AS por_agendar_2025, 0 AS canceladas, 0 AS juzgado, {extra} AS extra FROM todo
  UNION ALL SELECT {key}, 0, 0, 1, 0, NULL FROM off
  UNION ALL SELECT {key}, 0, 0, 0, 1, NULL FROM court)
SELECT {name}, CAST(sum(por_agendar) AS BIGINT) AS por_agendar, CAST(sum(por_agendar_2025) AS BIGINT) AS por_agendar_2025,
  CAST(sum(canceladas) AS BIGINT) AS canceladas, CAST(sum(juzgado) AS BIGINT) AS juzgado, COALESCE(min(extra), '') AS extra
FROM counted GROUP BY {name} HAVING {having}"""


def _r15_sql(p) -> str:
    team = nonblank("deal_team", "c_equipo_seller", default=p.no_team_label)
    return f"SELECT * EXCLUDE (extra) FROM ({_backlog_sql(p, team, 'equipo', 'NULL', 'TRUE')})"


def _r16_sql(p) -> str:
    agent = f"lower({strip(nonblank('deal_owner', 'c_comercial_captacion'))})"
    team = nonblank("deal_team", "c_equipo_seller", default="")
    return f"SELECT * RENAME (extra AS equipo) FROM ({_backlog_sql(p, agent, 'comercial', team, 'contains(comercial, chr(64))')})"


ROLES_BACKLOG = ("visit_log", "property_master", "intake_detail", "crm_deal", "listing_card", "listing_image",
                 "seller_intake", "clearance_tower", "process_history")
report("report_backlog_team", O.backlog_team, P_MTD, _r15_sql(P_MTD), ROLES_BACKLOG)
report("report_backlog_agent", O.backlog_agent, P_MTD, _r16_sql(P_MTD), ROLES_BACKLOG)


# ----------------------------------------------------------------- R13
def _r13_sql(p) -> str:
    day = q(p.day_prefix)
    return f"""
WITH booked AS (SELECT nid, min(nombre_agendador) AS name, min(email_agendador) AS mail FROM visit_log
                WHERE starts_with(fecha_fin, {day}) AND nid <> 'nan' AND status IN {in_list(p.reminder_statuses)}
                  AND visit_type IN {in_list(p.visit_types)} GROUP BY nid),
per AS (SELECT {falsy('m.c_comercial_captacion', 'mail')} AS email, count(*) AS n, min(NULLIF(name, '')) AS name
        FROM booked LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = booked.nid GROUP BY 1)
SELECT email, COALESCE(name, email) AS nombre, CAST(n AS BIGINT) AS count, {sql_text(O.REMINDER_SUBJECT, n='n', day=day)} AS subject,
  {sql_text(O.REMINDER_BODY, name='COALESCE(name, email)', n='n', day=day, url=q(p.portal_url), sign=q(p.signature))} AS body
FROM per WHERE email NOT IN ('', 'nan')"""


report("outbox_visit_reminder", O.visit_reminder, P_ORD, _r13_sql(P_ORD), ("visit_log", "property_master"))


# ----------------------------------------------------------------- R14
def _r14_rows(p) -> str:
    return f"""(SELECT * FROM (SELECT v.nid, {falsy('m.c_comercial_captacion', 'v.email_agendador')} AS email, v.nombre_agendador,
    v.modified_date >= {q(p.new_since)} AS fresh, CASE WHEN v.fecha_inicio <> '' THEN split_part(v.fecha_inicio, 'T', 1) ELSE '' END AS day
  FROM {newest_visit(p, f'modified_date >= {q(p.month_start)}')} v LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = v.nid
  WHERE v.status IN {in_list(p.cancel_statuses_digest)}) WHERE email NOT IN ('', 'nan'))"""


def _r14_sql(p) -> str:
    sends = "TRUE" if not p.is_weekend or p.force_weekend else "FALSE"
    return f"""
WITH per AS (SELECT email, min(NULLIF(nombre_agendador, '')) AS name, count(*) FILTER (WHERE fresh) AS a, count(*) FILTER (WHERE NOT fresh) AS b
             FROM {_r14_rows(p)} GROUP BY email)
SELECT email, COALESCE(name, email) AS nombre, CAST(a AS BIGINT) AS n_nuevas, CAST(b AS BIGINT) AS n_pendientes,
  {sql_text(O.DIGEST_SUBJECT, n='a')} AS subject, {sql_text(O.DIGEST_HEAD, name='COALESCE(name, email)')} AS head,
  CASE WHEN b > 0 THEN {q(O.DIGEST_PENDING_HEAD)} ELSE '' END AS pending_head,
  {sql_text(O.DIGEST_TAIL, url=q(p.portal_url), sign=q(p.signature))} AS tail
FROM per WHERE a > 0 AND {sends}"""


def _r14_lines_sql(p) -> str:
    return f"""
WITH r AS {_r14_rows(p)}
SELECT email, CASE WHEN fresh THEN 'nuevas' ELSE 'pendientes' END AS seccion, day AS fecha, nid,
  CASE WHEN fresh THEN {sql_text(O.DIGEST_NEW_LINE, nid='nid', day='day')} ELSE {sql_text(O.DIGEST_PENDING_LINE, nid='nid', day='day')} END AS line
FROM r WHERE email IN (SELECT email FROM r WHERE fresh) ORDER BY email, seccion, fecha, nid"""


report("outbox_cancelled_digest", O.cancelled_digest, P_MTD, _r14_sql(P_MTD), ("visit_log", "property_master"))
report("outbox_cancelled_digest_lines", O.cancelled_digest_lines, P_MTD, _r14_lines_sql(P_MTD), ("visit_log", "property_master"))


# ----------------------------------------------------------------- R17
def _r17_sql(p) -> str:
    return f"""
SELECT b.equipo, COALESCE(NULLIF({strip('lead.email')}, ''), {q(p.lead_default_email)}) AS email,
  b.por_agendar, b.por_agendar_2025, b.canceladas, b.juzgado, {sql_text(O.LEAD_SUBJECT, team='b.equipo')} AS subject,
  {sql_text(O.LEAD_BODY, team='b.equipo', a='b.por_agendar', b='b.por_agendar_2025', c='b.canceladas', d='b.juzgado',
            url=q(p.portal_url), sign=q(p.signature))} AS body
FROM ({_r15_sql(p)}) b LEFT JOIN team_lead lead ON lead.equipo = b.equipo
WHERE b.por_agendar + b.canceladas + b.juzgado > 0 ORDER BY b.equipo"""


report("outbox_team_lead", O.team_lead_digest, P_MTD, _r17_sql(P_MTD), ROLES_BACKLOG + ("team_lead",))


# ----------------------------------------------------------------- R18
def _r18_sql(p) -> str:
    def some(n: str, text: str) -> str:
        return f"CASE WHEN {n} > 0 THEN {text} ELSE '' END"

    todo = f"{sql_text(O.AGENT_TO_SCHEDULE, n='por_agendar')} || {some('por_agendar_2025', sql_text(O.AGENT_OLD, n='por_agendar_2025'))}"
    return f"""
WITH t AS (SELECT *, por_agendar + canceladas + juzgado AS total FROM ({_r16_sql(p)}))
SELECT comercial AS email, {sql_text(O.AGENT_SUBJECT, n='total')} AS subject,
  {q(O.AGENT_HEAD)} || {some('por_agendar', todo)} || {some('canceladas', sql_text(O.AGENT_CANCELLED, n='canceladas'))}
  || {some('juzgado', sql_text(O.AGENT_COURT, n='juzgado'))} || {sql_text(O.AGENT_TAIL, url=q(p.portal_url), sign=q(p.signature))} AS body,
  CAST(total AS BIGINT) AS total
FROM t WHERE total > 0 ORDER BY email"""


report("outbox_agent_digest", O.agent_digest, P_MTD, _r18_sql(P_MTD), ROLES_BACKLOG)


# ----------------------------------------------------------------- R19
def _r19_rows(p) -> str:
    nid, fecha, estado = (strip(f"COALESCE({c}, '')") for c in ("nid", "fecha", "estado"))
    said = (f"(SELECT {nid} AS k, arg_max({estado}, seq) AS word FROM status_log WHERE {fecha} = {q(p.status_day_str)} GROUP BY 1)")
    line = "'NID ' || v.nid || ' - ' || COALESCE(v.ciudad_muni, '') || ' - ' || " + falsy('m.c_comercial_captacion', 'v.nombre_agendador')
    return f"""(SELECT CASE word WHEN {q(p.confirmed_label)} THEN 'confirmadas' WHEN {q(p.cancelled_label)} THEN 'canceladas' ELSE 'sin_confirmar' END AS bucket,
    {line} AS line FROM {newest_visit(p)} v LEFT JOIN property_master m ON CAST(m.nid AS VARCHAR) = v.nid LEFT JOIN {said} ON k = v.nid
  WHERE v.status IN {in_list(p.reminder_statuses)} AND starts_with(v.fecha_fin, {q(p.day_prefix)}))"""


def _r19_buckets_sql(p) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE bucket = {q(b)}) AS {b}" for b, _ in O.SUMMARY_SECTIONS)
    return f"SELECT {counts}, count(*) AS total FROM {_r19_rows(p)}"


def _r19_sql(p) -> str:
    heads = ", ".join(f"{sql_text(O.SUMMARY_SECTION, t=q(t), n=b)} AS head_{b}" for b, t in O.SUMMARY_SECTIONS)
    day = q(p.day_prefix)
    return f"""
SELECT {q(p.coordinator_email)} AS "to", {sql_text(O.SUMMARY_SUBJECT, day=day, c='confirmadas', x='canceladas')} AS subject,
  {sql_text(O.SUMMARY_HEAD, day=day, n='total')} AS head, {heads}, {sql_text(O.SUMMARY_TAIL, s=q(p.signature))} AS tail,
  confirmadas, sin_confirmar, canceladas FROM ({_r19_buckets_sql(p)})"""


def _r19_lines_sql(p) -> str:
    names = ", ".join(f"({i}, {q(b)})" for i, (b, _) in enumerate(O.SUMMARY_SECTIONS, 1))
    return f"""
SELECT CAST(pos AS INTEGER) AS pos, s.bucket, COALESCE('  ' || line, {q(O.SUMMARY_NONE)}) AS line
FROM (VALUES {names}) s(pos, bucket) LEFT JOIN {_r19_rows(p)} r ON r.bucket = s.bucket ORDER BY pos, line"""


ROLES_R19 = ("visit_log", "property_master", "status_log")
report("agg_status_buckets", O.confirmation_buckets, P_MTD, _r19_buckets_sql(P_MTD), ROLES_R19)
report("outbox_confirmation_summary", O.confirmation_summary, P_ORD, _r19_sql(P_ORD), ROLES_R19)
report("outbox_confirmation_lines", O.confirmation_summary_lines, P_ORD, _r19_lines_sql(P_ORD), ROLES_R19)


# ----------------------------------------------------------------- R20
def _r20_sql(p) -> str:
    return f"""
WITH f AS ({_fold_sql(p.status_day_str)}), r1 AS ({_r1_sql(p)})
SELECT {q(', '.join(p.notice_emails))} AS "to", {q(O.NOTICE_SUBJECT)} AS subject,
  {sql_text(O.NOTICE_BODY, nid='nid', day='fecha_fin', city='ciudad', agent='c_comercial_captacion')} AS body, nid
FROM r1 WHERE nid IN (SELECT nid FROM f WHERE kind = 'visita' AND value = {q(p.cancelled_label)})"""


report("outbox_cancellation_notice", O.cancellation_notices, P_ORD, _r20_sql(P_ORD),
       ("status_log", "visit_log", "property_master", "crm_deal"))


from . import registry_ops  # noqa: E402,F401  (registers the operator-level keys)
