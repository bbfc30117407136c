"""Backlog aggregates (R15, R16) and message outbox tables.

A message is a row ``(to, subject, body, ...)``; delivery is out of scope.
Message bodies are built with ``concat`` on the executors.  A message that
lists rows is a table of its lines in order (``section``, ``line``): a range
sort deals a message of any size over many tasks, and a mailer streams it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import is_real_key
from ..functions.text import coalesce_nonblank, falsy_chain, has_at, iso_date_part, lower_trim, not_contains_ci
from ..operators import joins, rules
from ..operators.aggs import any_value, count_if, global_flag, row_total
from ..operators.status import day_status, status_fold
from ..params import Params
from ..sources.sinks import outbox_rows
from . import reports as R
from .bindings import Tables

# --- fixed values: message texts of the original notifications -------------
REMINDER_SUBJECT = "Tienes {n} visita(s) 360 agendada(s) para manana {day}"
REMINDER_BODY = ("Hola {name},\n\nTienes {n} visita(s) 360 agendada(s) para manana {day}.\n\n"
                 "Ingresa en el siguiente link y escribeles para confirmar la visita:\n{url}\n\n"
                 "Utiliza los botones de WhatsApp para escribirles y usa los botones "
                 "de Confirmar y Cancelar para informar al coordinador.\n\nSaludos,\n{sign}")
DIGEST_SUBJECT = "Visita(s) cancelada(s) ayer - Reagendar ({n} nueva(s))"
DIGEST_HEAD = ("Hola {name},\n\nLas siguientes visitas que tenias agendadas para ayer fueron "
               "canceladas, reagendalas:\n\n")
DIGEST_NEW_LINE = "  - NID {nid} (estaba agendado para {day})"
DIGEST_PENDING_HEAD = "Ademas, tienes estas canceladas de la semana pendientes por reagendar:\n\n"
DIGEST_PENDING_LINE = "  - NID {nid} (agendado para {day})"
DIGEST_TAIL = "Ingresa aqui para gestionarlas:\n{url}\n\nSaludos,\n{sign}"
AGENT_SUBJECT = "Resumen Inmobiliaria — tienes {n} pendiente(s) por gestionar"
AGENT_HEAD = "Hola,\n\nTe compartimos tu resumen de pendientes:\n\n"
AGENT_TO_SCHEDULE = "  • Negocios POR AGENDAR: {n}\n"
AGENT_OLD = ("      ↳ De los cuales {n} son del 2025 o antes — URGENTE confirmar si "
             "desistir o agendar.\n")
AGENT_CANCELLED = "  • Canceladas POR REAGENDAR (este mes): {n}\n"
AGENT_COURT = "  • Candidatos para JUZGADO: {n}\n"
AGENT_TAIL = ("\nIngresa al portal para verlos en detalle por NID y gestionarlos:\n{url}\n\n"
              "Saludos,\n{sign}")
LEAD_SUBJECT = "Resumen Inmobiliaria — equipo {team}"
LEAD_BODY = ("Hola lider de {team},\n\n  • Negocios POR AGENDAR: {a}\n"
             "      ↳ De 2025 o antes (urgente): {b}\n"
             "  • Canceladas POR REAGENDAR (este mes): {c}\n  • Candidatos JUZGADO: {d}\n\n"
             "Portal: {url}\n\nSaludos,\n{sign}")
SUMMARY_SUBJECT = "Resumen visitas 360 para manana {day} - {c} confirmadas, {x} canceladas"
SUMMARY_HEAD = "Hola,\n\nResumen de visitas 360 agendadas para manana {day}:\n\nTotal: {n} visitas\n\n"
SUMMARY_SECTIONS = (("confirmadas", "CONFIRMADAS"), ("sin_confirmar", "SIN CONFIRMAR"),
                    ("canceladas", "CANCELADAS"))
SUMMARY_SECTION = "--- {t} ({n}) ---\n"
SUMMARY_NONE = "  Ninguna"
SUMMARY_TAIL = "Saludos,\n{s}"
NOTICE_SUBJECT = "CANCELADA 360"
NOTICE_BODY = ("La visita 360 del NID {nid} agendada para el {day} fue cancelada por el cliente.\n\n"
               "Ciudad: {city}\nComercial: {agent}\n")
# ---------------------------------------------------------------------------

METRICS = ("por_agendar", "por_agendar_2025", "canceladas", "juzgado")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _fmt(template: str, **parts) -> Column:
    """``template.format(**parts)`` with Column parts, as one ``concat``."""
    import string
    out = []
    for lit, field, _, _ in string.Formatter().parse(template):
        if lit:
            out.append(F.lit(lit))
        if field is not None:
            v = parts[field]
            out.append(_s(v) if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*out) if out else F.lit("")


# ------------------------------------------------------------ R15/R16 -----
def _to_schedule_base(t: Tables, p: Params) -> DataFrame:
    """Rows counted as "to schedule" (patrimony rule v1).  Every side input
    is keyed on the numeric property key, so the master is shuffled once."""
    fc = rules.photo_keyset(t.listing_card, t.listing_image, p.photo_client)
    gs = t.seller_intake.groupBy(F.col("nid").alias("gs_nid")).agg(
        any_value("gravamenes_del_apartamento").alias("gravamen"))
    d = t.intake_detail.select(F.col("nid").alias("d_nid"), F.col("estado_patrimonio").alias("d_estado"))
    base = R._base_active(t, p)
    base = base.filter(rules.active_pipeline("cd_c_fecha_captacion", "cd_fecha_desistio_inmobiliaria",
                                             "h_fecha_desistio_inmobiliaria", "cd_v_fecha_venta",
                                             "h_dealstage", p.lost_stage))
    base = base.filter(not_contains_ci("cd_ciudad", p.excluded_city_substrings))
    base = joins.exists_flag(base, fc, "nid", "nid", "has_fc")
    base = base.filter(rules.publication_ok("cd_date_publication", "has_fc", p.publication_cutoff))
    base = R.without_open_visit(base, t, p)
    base = base.join(d, F.col("nid") == F.col("d_nid"), "left")
    base = base.join(gs, F.col("nid") == F.col("gs_nid"), "left")
    return base.filter(rules.patrimony_v1("d_estado", "gravamen", p.patrimony_ok, p.encumbrance_deny))


def _cancelled_base(t: Tables, p: Params) -> DataFrame:
    """Latest visit per key cancelled this month, property not withdrawn or sold."""
    v = R.latest_visits(t, p, since=p.month_start).filter(F.col("status").isin(list(p.cancel_statuses_digest)))
    j = R.with_master_crm(v.select("nid"), t, p)
    return j.filter(F.col("cd_fecha_desistio_inmobiliaria").isNull() & F.col("cd_v_fecha_venta").isNull())


def _court_base(t: Tables, p: Params) -> DataFrame:
    """Unfavourable opinions without an active court phase (no pipeline check)."""
    d = rules.unfavourable_opinions(t.clearance_tower, p.as_of, p.unfavourable, p.opinion_lookback_months,
                                    as_string=False)
    d = joins.anti(d.select("nid"), rules.active_phase_keys(t.process_history, p.court_pipes, p.closed_phases,
                                                            as_string=False), "nid", "nid")
    return R.with_master_crm(d, t, p, key_is_string=False)


def _team_expr(default: str, hp: str = "h_", cp: str = "cd_") -> Column:
    return coalesce_nonblank(F.col(hp + "equipo_sellers"), F.col(cp + "c_equipo_seller"), default=default)


def _agent_expr(hp: str = "h_", cp: str = "cd_") -> Column:
    return lower_trim(coalesce_nonblank(F.col(hp + "hubspot_owner_id"), F.col(cp + "c_comercial_captacion")))


def backlog_team(t: Tables, p: Params) -> DataFrame:
    """Per team: to schedule (and how many captured in or before ``old_year``),
    cancelled this month, court candidates; zero-filled (R15)."""
    old = F.year("cd_c_fecha_captacion") <= F.lit(p.old_year)
    a = _to_schedule_base(t, p).groupBy(_team_expr(p.no_team_label).alias("equipo")).agg(
        F.count(F.lit(1)).alias("por_agendar"), count_if(old).alias("por_agendar_2025"))
    b = _cancelled_base(t, p).groupBy(_team_expr(p.no_team_label).alias("equipo")).agg(
        F.count(F.lit(1)).alias("canceladas"))
    c = _court_base(t, p).groupBy(_team_expr(p.no_team_label).alias("equipo")).agg(
        F.count(F.lit(1)).alias("juzgado"))
    return joins.merge_metrics([a, b, c], "equipo", METRICS)


def backlog_agent(t: Tables, p: Params) -> DataFrame:
    """Per agent (lower-cased, trimmed mail): the same three metrics plus
    the agent's team; grouped by agent only (R16)."""
    old = F.year("cd_c_fecha_captacion") <= F.lit(p.old_year)
    agent = _agent_expr().alias("comercial")
    ok = F.col("comercial").isNotNull() & (F.col("comercial") != "")
    a = _to_schedule_base(t, p).groupBy(agent).agg(
        any_value(_team_expr("")).alias("equipo"),
        F.count(F.lit(1)).alias("por_agendar"), count_if(old).alias("por_agendar_2025")).filter(ok)
    b = _cancelled_base(t, p).groupBy(agent).agg(F.count(F.lit(1)).alias("canceladas")).filter(ok)
    c = _court_base(t, p).groupBy(agent).agg(F.count(F.lit(1)).alias("juzgado")).filter(ok)
    parts = [x.filter(has_at("comercial")) for x in (a, b, c)]
    out = joins.merge_metrics(parts, "comercial", METRICS, carry=("equipo",))
    return out.select("comercial", *METRICS, "equipo")


TEAM_LEVEL, AGENT_LEVEL = "equipo", "comercial"


def backlog_levels(t: Tables, p: Params) -> DataFrame:
    """R15 and R16 in one plan, long form ``(nivel, clave, metrics..., equipo)``.

    Each of the three bases is built once and aggregated once over the
    grouping sets (team) and (agent), instead of once per report: the
    daily run writes this table and derives both backlogs (and their
    outboxes) from it.
    """
    old = F.year("cd_c_fecha_captacion") <= F.lit(p.old_year)
    lvl = F.when(F.grouping("team") == 0, F.lit(TEAM_LEVEL)).otherwise(F.lit(AGENT_LEVEL))
    key = F.when(F.grouping("team") == 0, F.col("team")).otherwise(F.col("agent"))

    def keyed(df: DataFrame, *extra) -> DataFrame:
        return df.select(_team_expr(p.no_team_label).alias("team"), _agent_expr().alias("agent"), *extra)

    def by_level(df: DataFrame, *aggs) -> DataFrame:
        g = df.groupingSets([["team"], ["agent"]], "team", "agent").agg(*aggs, lvl.alias("nivel"), key.alias("clave"))
        ok = (F.col("nivel") == TEAM_LEVEL) | (F.col("clave").isNotNull() & (F.col("clave") != "") & has_at("clave"))
        return g.filter(ok).drop("team", "agent")

    a = by_level(keyed(_to_schedule_base(t, p), old.alias("old"), _team_expr("").alias("team_blank")),
                 F.count(F.lit(1)).alias("por_agendar"), count_if(F.col("old")).alias("por_agendar_2025"),
                 any_value("team_blank").alias("equipo"))
    a = a.withColumn("equipo", F.when(F.col("nivel") == AGENT_LEVEL, F.col("equipo")))
    b = by_level(keyed(_cancelled_base(t, p)), F.count(F.lit(1)).alias("canceladas"))
    c = by_level(keyed(_court_base(t, p)), F.count(F.lit(1)).alias("juzgado"))
    return joins.merge_metrics([a, b, c], ["nivel", "clave"], METRICS, carry=("equipo",))


def team_from_levels(levels: DataFrame) -> DataFrame:
    """R15 rows out of ``backlog_levels``."""
    return levels.filter(F.col("nivel") == TEAM_LEVEL).select(F.col("clave").alias("equipo"), *METRICS)


def agent_from_levels(levels: DataFrame) -> DataFrame:
    """R16 rows out of ``backlog_levels``."""
    return levels.filter(F.col("nivel") == AGENT_LEVEL).select(F.col("clave").alias("comercial"), *METRICS, "equipo")


# ---------------------------------------------------------------- R13 -----
def visit_reminder(t: Tables, p: Params) -> DataFrame:
    """Per agent: how many visits tomorrow (R13).  Per key the earliest
    start / scheduler are taken independently, as in the original (no
    latest-record dedup here)."""
    v = t.visit_log.filter(F.col("fecha_fin").startswith(p.day_prefix) & is_real_key("nid")
                           & F.col("status").isin(list(p.reminder_statuses))
                           & F.col("visit_type").isin(list(p.visit_types)))
    vd = v.groupBy("nid").agg(F.min("fecha_inicio").alias("fecha_inicio"),
                              F.min("nombre_agendador").alias("nombre_agendador"),
                              F.min("email_agendador").alias("email_agendador"))
    j = joins.left_cast(vd, t.property_master, "nid", "nid", ["c_comercial_captacion"])
    j = j.withColumn("email", falsy_chain("c_comercial_captacion", "email_agendador"))
    j = j.filter((F.col("email") != "") & (F.col("email") != "nan"))
    per = j.groupBy("email").agg(F.count(F.lit(1)).alias("count"),
                                 F.min(F.nullif(F.col("nombre_agendador"), F.lit(""))).alias("_n"))
    per = per.withColumn("nombre", F.coalesce("_n", "email")).drop("_n")
    day = p.day_prefix
    return per.select(
        "email", "nombre", F.col("count").cast("bigint").alias("count"),
        _fmt(REMINDER_SUBJECT, n=F.col("count"), day=day).alias("subject"),
        _fmt(REMINDER_BODY, name=F.col("nombre"), n=F.col("count"), day=day,
             url=p.portal_url, sign=p.signature).alias("body"))


# ---------------------------------------------------------------- R14 -----
def cancelled_rows(t: Tables, p: Params) -> DataFrame:
    """Cancelled this month per key with agent mail and new/pending type."""
    v = R.latest_visits(t, p, since=p.month_start).filter(F.col("status").isin(list(p.cancel_statuses_digest)))
    j = joins.left_cast(v, t.property_master, "nid", "nid", ["c_comercial_captacion"])
    j = j.withColumn("tipo", F.when(F.col("modified_date") >= F.lit(p.new_since), F.lit("nueva"))
                     .otherwise(F.lit("pendiente")))
    j = j.withColumn("email", falsy_chain("c_comercial_captacion", "email_agendador"))
    j = j.filter((F.col("email") != "") & (F.col("email") != "nan"))
    fi = F.col("fecha_inicio")
    return j.select("nid", "email", "nombre_agendador", "tipo",
                    F.when(fi.isNotNull() & (fi != ""), iso_date_part(fi)).otherwise(F.lit("")).alias("fecha"))


def cancelled_digest(t: Tables, p: Params) -> DataFrame:
    """Head of one message per agent with at least one new cancellation (R14):
    recipient, counts, subject, and the texts around the lines of
    ``cancelled_digest_lines``.

    Nothing is sent on weekends unless forced, nor when there is no new
    cancellation at all; the gate is a scalar subquery, not a driver count.
    """
    rows = cancelled_rows(t, p)
    new = F.col("tipo") == "nueva"
    per = rows.groupBy("email").agg(
        F.min(F.nullif(F.col("nombre_agendador"), F.lit(""))).alias("_n"),
        count_if(new).alias("n_nuevas"), count_if(~new).alias("n_pendientes"))
    per = per.withColumn("nombre", F.coalesce("_n", "email")).drop("_n").filter(F.col("n_nuevas") > 0)
    if p.is_weekend and not p.force_weekend:
        per = per.filter(F.lit(False))
    per = per.filter(global_flag(rows, new))
    return per.select(
        "email", "nombre", "n_nuevas", "n_pendientes",
        _fmt(DIGEST_SUBJECT, n=F.col("n_nuevas")).alias("subject"),
        _fmt(DIGEST_HEAD, name=F.col("nombre")).alias("head"),
        F.when(F.col("n_pendientes") > 0, F.lit(DIGEST_PENDING_HEAD)).otherwise(F.lit("")).alias("pending_head"),
        _fmt(DIGEST_TAIL, url=p.portal_url, sign=p.signature).alias("tail"))


def cancelled_digest_lines(t: Tables, p: Params) -> DataFrame:
    """The lines of the R14 messages, in order: one row per cancellation,
    ``(email, seccion, fecha, nid, line)``, for agents that get a digest.  The
    result is range-sorted by (email, section, date, key), so even an agent
    with a third of all cancellations is split over many tasks.  Same gates as
    the digest."""
    rows = cancelled_rows(t, p)
    new = F.col("tipo") == "nueva"
    agents = rows.filter(new).select(F.col("email").alias("_agent")).distinct()
    out = rows.join(agents, F.col("email") == F.col("_agent"), "left_semi")
    if p.is_weekend and not p.force_weekend:
        out = out.filter(F.lit(False))
    line = F.when(new, _fmt(DIGEST_NEW_LINE, nid=F.col("nid"), day=F.col("fecha"))) \
        .otherwise(_fmt(DIGEST_PENDING_LINE, nid=F.col("nid"), day=F.col("fecha")))
    out = out.select("email", F.when(new, F.lit("nuevas")).otherwise(F.lit("pendientes")).alias("seccion"),
                     "fecha", "nid", line.alias("line"))
    return out.orderBy("email", "seccion", "fecha", "nid")


# ---------------------------------------------------------------- R17 -----
def team_lead_digest(t: Tables, p: Params, backlog: DataFrame | None = None) -> DataFrame:
    """Per team with any action: lead mail (fallback default) and message.
    ``backlog`` is an already computed R15 result (e.g. from backlog_levels)."""
    b = backlog if backlog is not None else backlog_team(t, p)
    b = b.filter(row_total("por_agendar", "canceladas", "juzgado") > 0)
    b = joins.lookup_fallback(b, t.team_lead, "equipo", "equipo", "email", "email", p.lead_default_email)
    return b.orderBy("equipo").select(
        "equipo", "email", *METRICS,
        _fmt(LEAD_SUBJECT, team=F.col("equipo")).alias("subject"),
        _fmt(LEAD_BODY, team=F.col("equipo"), a=F.col("por_agendar"), b=F.col("por_agendar_2025"),
             c=F.col("canceladas"), d=F.col("juzgado"), url=p.portal_url, sign=p.signature).alias("body"))


# ---------------------------------------------------------------- R18 -----
def agent_digest(t: Tables, p: Params, backlog: DataFrame | None = None) -> DataFrame:
    """Per agent with a non-zero total: message, sorted by mail; with
    ``max_messages`` only the first N (R18).  ``backlog`` is an already
    computed R16 result."""
    b = backlog if backlog is not None else backlog_agent(t, p)
    b = b.withColumn("total", row_total("por_agendar", "canceladas", "juzgado")).filter(F.col("total") > 0)
    body = F.concat(
        F.lit(AGENT_HEAD),
        F.when(F.col("por_agendar") > 0, F.concat(
            _fmt(AGENT_TO_SCHEDULE, n=F.col("por_agendar")),
            F.when(F.col("por_agendar_2025") > 0, _fmt(AGENT_OLD, n=F.col("por_agendar_2025")))
            .otherwise(F.lit("")))).otherwise(F.lit("")),
        F.when(F.col("canceladas") > 0, _fmt(AGENT_CANCELLED, n=F.col("canceladas"))).otherwise(F.lit("")),
        F.when(F.col("juzgado") > 0, _fmt(AGENT_COURT, n=F.col("juzgado"))).otherwise(F.lit("")),
        _fmt(AGENT_TAIL, url=p.portal_url, sign=p.signature))
    out = b.select(F.col("comercial").alias("email"),
                   _fmt(AGENT_SUBJECT, n=F.col("total")).alias("subject"), body.alias("body"),
                   F.col("total").cast("bigint").alias("total"))
    out = out.orderBy("email")
    if p.max_messages is not None:
        out = out.limit(p.max_messages)
    return out


# ---------------------------------------------------------------- R19 -----
def confirmation_rows(t: Tables, p: Params) -> DataFrame:
    """Tomorrow's scheduled visits with their confirmation bucket."""
    v = R.latest_visits(t, p, only=F.col("status").isin(list(p.reminder_statuses)) & F.col("fecha_fin").startswith(p.day_prefix))
    j = joins.left_cast(v, t.property_master, "nid", "nid", ["c_comercial_captacion"])
    st = day_status(t.status_log, p.status_day_str).withColumnRenamed("nid", "st_nid")
    j = j.join(st, F.col("nid") == F.col("st_nid"), "left")
    est = F.coalesce(F.col("estado"), F.lit(""))
    bucket = (F.when(est == F.lit(p.confirmed_label), F.lit("confirmadas"))
              .when(est == F.lit(p.cancelled_label), F.lit("canceladas"))
              .otherwise(F.lit("sin_confirmar")))
    line = _fmt("NID {nid} - {city} - {agent}", nid=F.col("nid"),
                city=F.coalesce(F.col("ciudad_muni"), F.lit("")),
                agent=falsy_chain("c_comercial_captacion", "nombre_agendador"))
    return j.select("nid", bucket.alias("bucket"), line.alias("line"))


def confirmation_buckets(t: Tables, p: Params) -> DataFrame:
    """Counts per bucket in one row, every bucket present, and the total."""
    rows = confirmation_rows(t, p)
    names = [b for b, _ in SUMMARY_SECTIONS]
    counts = rows.agg(*[count_if(F.col("bucket") == b).alias(b) for b in names])
    return counts.withColumn("total", row_total(*names))


def confirmation_summary(t: Tables, p: Params) -> DataFrame:
    """Head of the coordinator's one message for tomorrow (R19): recipient,
    counts, subject, and the texts around ``confirmation_summary_lines``."""
    counts = confirmation_buckets(t, p)
    day = p.day_prefix
    return counts.select(
        F.lit(p.coordinator_email).alias("to"),
        _fmt(SUMMARY_SUBJECT, day=day, c=F.col("confirmadas"), x=F.col("canceladas")).alias("subject"),
        _fmt(SUMMARY_HEAD, day=day, n=F.col("total")).alias("head"),
        *[_fmt(SUMMARY_SECTION, t=title, n=F.col(b)).alias("head_" + b) for b, title in SUMMARY_SECTIONS],
        _fmt(SUMMARY_TAIL, s=p.signature).alias("tail"),
        *[F.col(b).cast("bigint").alias(b) for b, _ in SUMMARY_SECTIONS])


def confirmation_summary_lines(t: Tables, p: Params) -> DataFrame:
    """The lines of the R19 message in order, ``(pos, bucket, line)``; an empty
    section has one line that says so."""
    rows = confirmation_rows(t, p)
    names = [b for b, _ in SUMMARY_SECTIONS]
    counts = confirmation_buckets(t, p)
    none = counts.select(F.explode(F.array(*[F.when(F.col(b) == 0, F.lit(b)) for b in names])).alias("bucket"))
    none = none.filter(F.col("bucket").isNotNull()).select("bucket", F.lit(SUMMARY_NONE).alias("line"))
    lines = rows.select("bucket", F.concat(F.lit("  "), "line").alias("line")).unionByName(none)
    pos = F.array_position(F.array(*[F.lit(b) for b in names]), F.col("bucket")).cast("int")
    return lines.select(pos.alias("pos"), "bucket", "line").orderBy("pos", "line")


# ---------------------------------------------------------------- R20 -----
def cancellation_notices(t: Tables, p: Params) -> DataFrame:
    """One notice per visit of tomorrow whose shared status is cancelled, to a
    fixed pair of recipients (R20): ``(to, subject, body, nid)``."""
    st = status_fold(t.status_log, p.status_day_str)
    cancelled = st.filter((F.col("kind") == "visita") & (F.col("value") == F.lit(p.cancelled_label))).select("nid")
    visits = R.visits_tomorrow(t, p)
    j = visits.join(cancelled, "nid", "left_semi")
    notice = j.select(
        "nid",
        F.lit(NOTICE_SUBJECT).alias("subject"),
        _fmt(NOTICE_BODY, nid=F.col("nid"), day=F.col("fecha_fin"), city=F.col("ciudad"),
             agent=F.col("c_comercial_captacion")).alias("body"))
    return outbox_rows(notice, fixed_to=", ".join(p.notice_emails))
