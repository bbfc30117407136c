"""Composite reports R1-R12: pure functions ``report(tables, params) -> DataFrame``.

Each report is one lazy plan.  The original ran up to five warehouse round
trips plus Python-side merges per report; here every key set is a semi/anti
join and every dictionary lookup a left join, so the only boundaries are
shuffles on the property key.  Dates come from ``params.as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import spanish_day_month, utc_to_local_hhmm
from ..functions.keys import canonical_long, is_real_key
from ..functions.text import clean, falsy_chain, iso_date_part, not_contains_ci, title_or_blank
from ..operators import joins, rules, status
from ..operators.aggs import any_value
from ..operators.history import valid_at, validity
from ..operators.latest import first_per_key, latest_per_key
from ..operators.status import status_fold
from ..params import NO_INFO_LABEL, NO_VISIT_LABEL, Params
from ..sources import sheets
from ..sources.documents import scan_reports_window
from .bindings import Tables

# --- fixed values: labels the original reports print ------------------------
CLIENT_PHOTOS_LABEL = "Publicado sin fotos profesionales"
UNPUBLISHED_LABEL = "Sin publicar"
WITH_CMS, WITHOUT_CMS = "Con CMS", "Sin CMS"
BUBBLE_DONE_LABEL = "360 Finalizado (correo)"
WITH_360_LABEL = "Con 360"
# ---------------------------------------------------------------------------

MASTER_COLS = ["c_comercial_captacion", "c_equipo_seller", "tel_fono_del_cliente_1", "direccion",
               "ciudad", "c_fecha_captacion", "v_fecha_venta", "fecha_desistio_inmobiliaria",
               "date_publication", "c_tipo_contrato_firmado"]
CRM_COLS = ["hubspot_owner_id", "equipo_sellers", "dealstage", "fecha_desistio_inmobiliaria"]


def _date_text(c) -> Column:
    """``str(DATE(x)) if x else ''``."""
    return F.coalesce(F.date_format(F.to_date(c), "yyyy-MM-dd"), F.lit(""))


def _or_blank(c) -> Column:
    """``x or ''`` (text)."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


#: Partition column of a visit log that is laid out by month (``materialize.visit_log_by_month``).
MONTH = "modified_month"


def visit_log(t: Tables, p: Params, since: str | None = None) -> DataFrame:
    """The visit log, or what of it was known at ``p.known_at``; only rows modified ``since`` then.

    A log laid out by month is pruned to the months in question.  With the role ``visit_history``
    (``visit_history``) a past state is read without ranking the log."""
    past = p.known_at is not None and "visit_history" in t
    v = t.visit_history if past else t.visit_log
    modified = F.col("modified_date")
    if since is not None:
        v = v.filter(modified >= F.lit(since))
        v = v.filter(F.col(MONTH) >= F.lit(since[:7])) if MONTH in v.columns else v
    if past:
        v = valid_at(v, F.lit(p.known_at))
    elif p.known_at is not None:
        v = v.filter(modified.isNull() | (modified <= F.lit(p.known_at)))
        v = v.filter(F.col(MONTH).isNull() | (F.col(MONTH) <= F.lit(p.known_at[:7]))) if MONTH in v.columns else v
    return v


def visit_history(log: DataFrame) -> DataFrame:
    """The role ``visit_history``: the visit log with validity intervals.  Kinds of visit are tracked apart, since a
    report picks the latest row among the kinds that it tracks."""
    return validity(log, ["nid", "visit_type"], "modified_date", "record_id")


def tracked_visits(t: Tables, p: Params, since: str | None = None) -> DataFrame:
    return visit_log(t, p, since).filter(F.col("visit_type").isin(list(p.visit_types)) & is_real_key("nid"))


def latest_visits(t: Tables, p: Params, only: Column | None = None, since: str | None = None) -> DataFrame:
    """Latest visit-log record per key among the tracked visit kind.

    ``only``: a predicate that the caller applies to the result.  A key whose
    latest row passes has a row that passes, so only such keys are ranked; the
    rest of the log is not shuffled.  ``since``: the caller keeps rows modified
    since then; the ranking column is that date, so older rows are never picked
    and are left out before the ranking (the filter reaches the scan)."""
    v = tracked_visits(t, p, since)
    if only is not None:
        v = joins.semi(v, v.filter(only).select("nid").distinct(), "nid", "nid")
    last = latest_per_key(v, "nid", "modified_date", tiebreak="record_id")
    return last if only is None else last.filter(only)


def visit_state(t: Tables, p: Params) -> DataFrame:
    """(b_nid, b_status, b_done) per numeric key of the tracked category: the
    latest status, and whether any visit was finished, from one aggregate."""
    # with a history, one row for each kind of a key; "was ever finished" needs all rows
    v = visit_log(Tables({"visit_log": t.visit_log}), p).filter(F.col("visit_category").isin(list(p.visit_categories)))
    v = v.select(canonical_long("nid").alias("b_nid"), "status", "modified_date", "record_id").filter(F.col("b_nid").isNotNull())
    return v.groupBy("b_nid").agg(
        F.max_by("status", F.struct("modified_date", "record_id")).alias("b_status"),
        F.coalesce(F.bool_or(F.col("status") == F.lit(p.done_status)), F.lit(False)).alias("b_done"))


def crm_in_pipeline(t: Tables, p: Params) -> DataFrame:
    return t.crm_deal.filter(F.col("pipeline") == F.lit(p.pipeline_id))


def with_master_crm(df: DataFrame, t: Tables, p: Params, key: str = "nid", key_is_string: bool = True) -> DataFrame:
    """Left join the property master (``cd_*``) and the CRM deal in the
    pipeline (``h_*``) onto a keyed frame (J1/J3 + J2)."""
    cd = t.property_master.select("nid", *MASTER_COLS)
    h = crm_in_pipeline(t, p).select("nid", *CRM_COLS)
    if key_is_string:
        out = joins.left_cast(df, cd, key, "nid", MASTER_COLS, prefix="cd_")
        out = joins.left_safecast_on(out, h, key, "nid", None, CRM_COLS, prefix="h_")
    else:
        out = df.join(cd.select(F.col("nid").alias("_k"), *[F.col(c).alias("cd_" + c) for c in MASTER_COLS]),
                      F.col(key) == F.col("_k"), "left").drop("_k")
        out = out.join(h.select(F.col("nid").alias("_k"), *[F.col(c).alias("h_" + c) for c in CRM_COLS]),
                       F.col(key) == F.col("_k"), "left").drop("_k")
    return out


def owner(prefix_h: str = "h_", prefix_c: str = "cd_") -> Column:
    """``COALESCE(h.hubspot_owner_id, c.c_comercial_captacion)``."""
    return F.coalesce(F.col(prefix_h + "hubspot_owner_id"), F.col(prefix_c + "c_comercial_captacion"))


def team(prefix_h: str = "h_", prefix_c: str = "cd_") -> Column:
    """``COALESCE(h.equipo_sellers, c.c_equipo_seller)``."""
    return F.coalesce(F.col(prefix_h + "equipo_sellers"), F.col(prefix_c + "c_equipo_seller"))


# ---------------------------------------------------------------- R1 ------
def visits_tomorrow(t: Tables, p: Params) -> DataFrame:
    """Tomorrow's visits (R1): latest record per key *then* the status and
    day filters, so a rescheduled visit never shows its stale row."""
    v = latest_visits(t, p, only=F.col("status").isin(list(p.scheduled_statuses)) & F.col("fecha_fin").startswith(p.day_prefix))
    j = with_master_crm(v, t, p)
    out = j.select(
        clean("nid").alias("nid"),
        clean("fecha_fin").alias("fecha_fin"),
        utc_to_local_hhmm("fecha_inicio", p.utc_offset_hours).alias("hora"),
        falsy_chain(clean(owner()), clean("email_agendador")).alias("c_comercial_captacion"),
        clean("nombre_agendador").alias("nombre_agendador"),
        title_or_blank(clean("ciudad_muni")).alias("ciudad"),
        clean("zona").alias("zona"), clean("direccion").alias("direccion"),
        clean("torre_apto").alias("torre_apto"), clean("conjunto").alias("conjunto"),
        clean("visit_type").alias("visit_type"), clean("visit_category").alias("visit_category"),
        clean("cd_tel_fono_del_cliente_1").alias("telefono_cliente"),
        clean(team()).alias("equipo"),
        F.col("fecha_inicio").alias("_order"),
    )
    return out.orderBy(F.col("_order").asc_nulls_first(), "nid").drop("_order")


# ---------------------------------------------------------------- R2 ------
def report_window(t: Tables, p: Params, days: int) -> DataFrame:
    """Rows of the report mails of the last ``days``: with a mailbox only the window's mails are read and parsed."""
    if t.mailbox is not None:
        return t.mailbox.window(t.photo_report, p.as_of, days, p.report_sender)
    return scan_reports_window(t.report_rows, p.as_of, days, p.report_sender)


def cancelled(t: Tables, p: Params) -> DataFrame:
    """Cancelled visits to reschedule (R2).

    Report rows marked not-done are kept when the visit log agrees
    (cancel status) or is stale (report newer than the last change and the
    visit not done), then rows whose property already has professional
    photos are dropped, one row per (key, report) is kept and the visit /
    master / CRM columns are attached.

    The report documents are parsed once: rows are deduplicated per
    (key, report) and carry their key's newest report date (a window over
    the few reports of one key), then meet the latest visit per key.
    """
    rows = report_window(t, p, p.cancelled_lookback_days).filter(~F.col("completado"))
    rows = rows.withColumn("report_date", spanish_day_month("fecha_reporte", p.as_of, p.future_slack_days))
    kept = first_per_key(rows, ["nid", "fecha_reporte"],
                         [F.col("received_at").asc_nulls_first(), "doc_id", "row_pos"])
    kept = kept.withColumn("last_report", F.max("report_date").over(Window.partitionBy("nid")))

    v = joins.semi(visit_log(t, p).filter(F.col("visit_type").isin(list(p.visit_types))), kept.select("nid").distinct(), "nid", "nid")
    last = latest_per_key(v, "nid", "modified_date", tiebreak="record_id")
    mod = F.col("modified_date")
    last = last.select(
        "nid", "status", "fecha_inicio",
        F.when(mod.contains("T"), F.try_to_date(iso_date_part(mod), "yyyy-MM-dd")).alias("mod_date"),
        F.when(mod.contains("T"), iso_date_part(mod)).otherwise(_or_blank(mod)).alias("ultima_actualizacion"))
    # keys missing from the visit log never count as cancelled (inner join)
    real = kept.join(last, "nid", "inner").filter(
        rules.cancelled_for_real("status", "last_report", "mod_date", p.cancel_statuses_report, p.done_status))
    # one pass over the images: any professional photo drops the row, a live one sets the flag
    # of the cards of reported keys
    keys = visits_by_numeric_key(kept, []).distinct()
    photos = rules.photo_flags(joins.semi(t.listing_card, keys, "nid", "nid"), t.listing_image,
                               {"p_any": (p.photo_professional, False), "p_live": (p.photo_professional, True)})
    real = joins.left_cast(real, photos, "nid", "nid", ["p_any", "p_live"]).filter(~F.coalesce("p_any", F.lit(False)))

    fi = F.col("fecha_inicio")
    fecha_agendada = (F.when(fi.isNotNull() & fi.contains("T"),
                             F.concat(iso_date_part(fi), F.lit(" "), utc_to_local_hhmm(fi, p.utc_offset_hours)))
                      .otherwise(F.lit("")))
    out = joins.left_cast(real, _master_by_key(t, p, keys), "nid", "nid",
                          ["m_comercial", "m_telefono", "m_direccion", "m_ciudad", "m_equipo"])
    out = out.withColumn("tiene_fotos_profesionales", F.coalesce("p_live", F.lit(False)))
    city = F.coalesce(F.nullif(F.col("m_ciudad"), F.lit("")), F.nullif(F.col("ciudad_correo"), F.lit("")))
    return out.select(
        "nid",
        title_or_blank(city).alias("ciudad"),
        "fotografo",
        F.col("motivo").alias("motivo_cancelacion"),
        _or_blank("m_comercial").alias("c_comercial_captacion"),
        _or_blank("m_telefono").alias("telefono_cliente"),
        _or_blank("m_direccion").alias("direccion"),
        "fecha_reporte",
        fecha_agendada.alias("fecha_agendada"),
        _or_blank("m_equipo").alias("equipo"),
        _or_blank("ultima_actualizacion").alias("ultima_actualizacion"),
        "tiene_fotos_profesionales",
    )


def cancelled_keys(last: DataFrame, newest: DataFrame, p: Params) -> DataFrame:
    """Keys whose cancellation is real (B7, J16): latest visit status joined
    with the newest report date per key."""
    status = last.join(newest, "nid", "left")
    return status.filter(rules.cancelled_for_real("status", "last_report", "mod_date",
                                                  p.cancel_statuses_report, p.done_status))


def _master_by_key(t: Tables, p: Params, keys: DataFrame) -> DataFrame:
    """Master + CRM of the numeric ``keys``, one row per key (a dict keyed by nid)."""
    cd = joins.semi(t.property_master.select("nid", *MASTER_COLS), keys, "nid", "nid")
    h = crm_in_pipeline(t, p).select(F.col("nid").alias("_k"), F.col("hubspot_owner_id").alias("h_hubspot_owner_id"),
                                     F.col("equipo_sellers").alias("h_equipo_sellers"))
    j = cd.join(h, F.col("nid") == F.col("_k"), "left")
    j = j.select("nid",
                 F.coalesce("h_hubspot_owner_id", "c_comercial_captacion").alias("m_comercial"),
                 F.col("tel_fono_del_cliente_1").alias("m_telefono"),
                 F.col("direccion").alias("m_direccion"),
                 F.col("ciudad").alias("m_ciudad"),
                 F.coalesce("h_equipo_sellers", "c_equipo_seller").alias("m_equipo"))
    payload = ["m_comercial", "m_telefono", "m_direccion", "m_ciudad", "m_equipo"]
    return first_per_key(j, ["nid"], [F.col(c).asc_nulls_first() for c in payload])


def report_dates(t: Tables, p: Params) -> DataFrame:
    """Distinct report-date texts, in order of first appearance."""
    rows = report_window(t, p, p.cancelled_lookback_days).filter(F.col("fecha_reporte") != "")
    return (rows.groupBy("fecha_reporte")
            .agg(F.min(F.struct("received_at", "doc_id")).alias("first_seen"))
            .orderBy("first_seen").select("fecha_reporte"))


# ---------------------------------------------------------------- R3 ------
def pipeline_keys(t: Tables, p: Params) -> DataFrame:
    return (crm_in_pipeline(t, p).filter(F.col("nid").isNotNull())
            .select(F.col("nid").cast("string").alias("nid")).distinct())


def court_candidates(t: Tables, p: Params) -> DataFrame:
    """Latest unfavourable opinion within the lookback, in the pipeline,
    without an active court phase (R3), newest opinion first.  Every join is on
    the numeric key.  The listing prints the master's key, so an opinion about
    a property without a master row is not listed."""
    d = rules.unfavourable_opinions(t.clearance_tower, p.as_of, p.unfavourable, p.opinion_lookback_months,
                                    as_string=False)
    d = joins.semi(d, crm_in_pipeline(t, p).filter(F.col("nid").isNotNull()).select("nid"), "nid", "nid")
    d = joins.anti(d, rules.active_phase_keys(t.process_history, p.court_pipes, p.closed_phases, as_string=False),
                   "nid", "nid")
    d = joins.semi(d, t.property_master, "nid", "nid")
    j = with_master_crm(d, t, p, key_is_string=False)
    out = j.select(
        F.col("nid").cast("string").alias("nid"),
        _date_text("fecha_desfavorable").alias("fecha_desfavorable"),
        _date_text("cd_c_fecha_captacion").alias("fecha_captacion"),
        clean(owner()).alias("comercial"),
        clean(team()).alias("equipo"),
        title_or_blank(F.col("cd_ciudad")).alias("ciudad"),
        clean(F.coalesce("telefono_plano", "cd_tel_fono_del_cliente_1")).alias("telefono_cliente"),
        clean("nombre_cliente_plano").alias("nombre_cliente"),
        _date_text("cd_v_fecha_venta").alias("fecha_venta"),
        _date_text("cd_fecha_desistio_inmobiliaria").alias("fecha_desistio"),
    ).filter(F.col("nid") != "")
    order = [F.col("fecha_desfavorable").desc(), *[F.col(c).asc() for c in out.columns if c not in ("nid", "fecha_desfavorable")]]
    return first_per_key(out, ["nid"], order).orderBy(F.col("fecha_desfavorable").desc(), "nid")


# ---------------------------------------------------------------- R4 ------
def _base_active(t: Tables, p: Params, keys: DataFrame | None = None) -> DataFrame:
    """Master (of the numeric ``keys``) ⟕ CRM deal in the pipeline, with string key ``nid_s``."""
    master = t.property_master if keys is None else joins.semi(t.property_master, keys, "nid", "nid")
    cd = master.select(F.col("nid"), F.col("nid").cast("string").alias("nid_s"),
                                  *[F.col(c).alias("cd_" + c) for c in MASTER_COLS])
    h = crm_in_pipeline(t, p).select(F.col("nid").alias("_hk"), *[F.col(c).alias("h_" + c) for c in CRM_COLS])
    return cd.join(h, F.col("nid") == F.col("_hk"), "left").drop("_hk")


def _flag(df: DataFrame, keys: DataFrame, on: str, key_col: str, name: str) -> DataFrame:
    return joins.exists_flag(df, keys, on, key_col, name)


def visits_by_numeric_key(df: DataFrame, cols) -> DataFrame:
    """A visit-keyed frame re-keyed on the numeric property key (exact:
    only keys written as the number's decimal form can match)."""
    return df.select(canonical_long("nid").alias("nid"), *cols).filter(F.col("nid").isNotNull())


def without_open_visit(base: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Rows of keyed properties with no finished visit (J7) whose latest visit
    is not scheduled; adds ``b_status``."""
    base = base.filter(F.col("nid").isNotNull()).join(visit_state(t, p), F.col("nid") == F.col("b_nid"), "left")
    return base.filter(F.col("b_nid").isNull() | (~F.col("b_done") & ~F.col("b_status").isin(list(p.scheduled_statuses))))


def to_schedule(t: Tables, p: Params) -> DataFrame:
    """Properties to schedule a visit for (R4), one row per key, newest
    capture first (patrimony rule v2).  All side inputs are keyed on the
    numeric property key, so the master is partitioned once for the chain."""
    fc = rules.photo_keyset(t.listing_card, t.listing_image, p.photo_client)
    epa = rules.latest_flag(t.clearance_tower, as_string=False).withColumnRenamed("nid", "epa_nid")
    cn = (t.seller_form.filter(F.col("nid_1").isNotNull() & F.col("nombre_de_edificio_conjunto").isNotNull()
                               & (F.col("nombre_de_edificio_conjunto") != ""))
          .groupBy(F.col("nid_1").alias("cn_nid"))
          .agg(any_value("nombre_de_edificio_conjunto").alias("conjunto")))
    fl = rules.first_final_phase(t.process_history, p.patrimony_pipes, p.final_phases, as_string=False) \
        .withColumnRenamed("nid", "fl_nid")
    d = t.intake_detail.select(F.col("nid").alias("d_nid"), F.col("estado_patrimonio").alias("d_estado"))

    base = _base_active(t, p)
    base = base.filter(rules.active_pipeline("cd_c_fecha_captacion", "cd_fecha_desistio_inmobiliaria",
                                             "h_fecha_desistio_inmobiliaria", "cd_v_fecha_venta",
                                             "h_dealstage", p.lost_stage))
    base = base.filter(not_contains_ci("cd_ciudad", p.excluded_city_substrings))
    base = _flag(base, fc, "nid", "nid", "has_fc")
    base = base.filter(rules.publication_ok("cd_date_publication", "has_fc", p.publication_cutoff))
    base = without_open_visit(base, t, p)
    base = base.join(epa, F.col("nid") == F.col("epa_nid"), "left")
    base = base.filter(rules.patrimony_v2("flag", "cd_c_tipo_contrato_firmado", p.flag_done,
                                          p.flag_in_process, p.patrimony_contract))
    base = base.join(d, F.col("nid") == F.col("d_nid"), "left")
    base = base.join(cn, F.col("nid") == F.col("cn_nid"), "left")
    base = base.join(fl, F.col("nid") == F.col("fl_nid"), "left")
    out = base.select(
        F.coalesce(F.col("nid_s"), F.lit("")).alias("nid"),
        _or_blank(owner()).alias("comercial"),
        title_or_blank("cd_ciudad").alias("ciudad"),
        _or_blank("conjunto").alias("conjunto"),
        _or_blank(team()).alias("equipo"),
        _date_text("cd_c_fecha_captacion").alias("fecha_captacion"),
        _date_text(F.when(F.col("d_estado") == F.lit(p.patrimony_lifted), F.col("fecha_levant")))
        .alias("fecha_levantamiento"),
        _or_blank("cd_tel_fono_del_cliente_1").alias("telefono_cliente"),
        F.coalesce(F.nullif(F.col("b_status"), F.lit("")), F.lit(NO_VISIT_LABEL)).alias("ultimo_status"),
        F.when(F.col("has_fc"), F.lit(CLIENT_PHOTOS_LABEL)).otherwise(F.lit(UNPUBLISHED_LABEL)).alias("tipo_fotos"),
        F.col("cd_c_fecha_captacion").alias("_cap"),
    )
    out = first_per_key(out, ["nid"], [F.col("_cap").desc_nulls_last()] +
                        [F.col(c).asc() for c in out.columns if c not in ("nid", "_cap")])
    return out.orderBy(F.col("_cap").desc_nulls_last(), "nid").drop("_cap")


# ---------------------------------------------------------------- R5 ------
def _newest_report_text(rows: DataFrame, p: Params) -> DataFrame:
    """Newest report per key (A5) and the last city the reports gave.

    The original compares '23 de abril' texts as strings; here the parsed
    dates decide (ties and unparsable texts fall back to the text)."""
    rd = spanish_day_month("fecha_reporte", p.as_of, p.future_slack_days)
    seq = F.struct("received_at", "doc_id", "row_pos")
    nonblank = F.col("fecha_reporte") != ""
    city_ok = F.coalesce(F.col("ciudad_correo"), F.lit("")) != ""
    return rows.groupBy("nid").agg(
        F.coalesce(F.max_by(F.when(nonblank, F.col("fecha_reporte")),
                            F.when(nonblank, F.struct(rd.alias("d"), F.col("fecha_reporte").alias("t")))),
                   F.lit("")).alias("fecha_recorrido"),
        F.max_by(F.when(city_ok, F.col("ciudad_correo")), F.when(city_ok, seq)).alias("ciudad_correo"))


def _card_choice(t: Tables, p: Params, cards: DataFrame) -> DataFrame:
    """Per key with listing ``cards``: the first card/state row (smallest card
    id, then state, nulls first) that passes the listing rules, once for a
    key with live professional photos (live rows excluded) and once without.

    Cards are reduced to one row per key *before* they meet the property
    master: the card side can hold a hot key (one property with a third of
    all cards), and the partial ``min(struct)`` aggregate shrinks it on every
    map task instead of sending it whole to one join task.
    """
    pc = cards.select(F.col("id").alias("pc_id"), F.col("nid").alias("card_nid"), F.col("active").alias("pc_active"))
    ps = t.listing_state.select(F.col("property_card_id").alias("ps_card"),
                                F.col("current_state_id").alias("ps_state"))
    states = pc.filter(F.col("card_nid").isNotNull()).join(ps, F.col("pc_id") == F.col("ps_card"), "left")
    row = F.struct(F.col("pc_id"), F.col("ps_state"))
    not_dead = rules.listing_not_dead("pc_active", "ps_state", p.dead_states)
    live = rules.listing_live_coalesced("pc_active", "ps_state", p.live_state)
    return states.groupBy("card_nid").agg(F.min(F.when(not_dead, row)).alias("best_any"),
                                         F.min(F.when(not_dead & ~live, row)).alias("best_not_live"))


def to_publish(t: Tables, p: Params, links: DataFrame | None = None,
               published: DataFrame | None = None) -> DataFrame:
    """Visited (report says done) properties still to publish."""
    rows = report_window(t, p, p.completed_lookback_days).filter(F.col("completado"))
    # one row per reported key; joining it (inner) both restricts to reported keys and
    # attaches the report columns, so the report documents are parsed once
    rep = _newest_report_text(rows.filter(F.col("nid") != ""), p)
    rep = rep.withColumn("rep_nid", canonical_long("nid")).drop("nid").filter(F.col("rep_nid").isNotNull())
    # cards, their images and states, and the clearance log of reported keys only
    keys = rep.select(F.col("rep_nid").alias("nid"))
    cards = joins.semi(t.listing_card, keys, "nid", "nid")
    photos = rules.photo_flags(cards, t.listing_image,
                               {"p_fc": p.photo_client, "p_360": p.photo_professional}, exclude_deleted=True)
    epa = rules.latest_flag(joins.semi(t.clearance_tower, keys, "nid", "nid"), as_string=False).withColumnRenamed("nid", "epa_nid")
    d = t.intake_detail.select(F.col("nid").alias("d_nid"), F.col("estado_patrimonio").alias("d_estado"))

    base = _base_active(t, p, keys).join(rep, F.col("nid") == F.col("rep_nid"), "inner")
    base = base.filter(rules.active_pipeline(None, "cd_fecha_desistio_inmobiliaria",
                                             "h_fecha_desistio_inmobiliaria", "cd_v_fecha_venta",
                                             "h_dealstage", p.lost_stage))
    base = base.join(epa, F.col("nid") == F.col("epa_nid"), "left")
    base = base.filter(rules.patrimony_v2("flag", "cd_c_tipo_contrato_firmado", p.flag_done,
                                          p.flag_in_process, p.patrimony_contract))
    base = base.join(photos.withColumnRenamed("nid", "ph_nid"), F.col("nid") == F.col("ph_nid"), "left")
    base = base.withColumn("has_fc", F.coalesce("p_fc", F.lit(False))) \
               .withColumn("has_360", F.coalesce("p_360", F.lit(False)))
    # A key with cards keeps its best passing card; a key without cards stays with no card;
    # a key whose cards all fail the listing rules is dropped (the row filter of the join).
    base = base.join(_card_choice(t, p, cards), F.col("nid") == F.col("card_nid"), "left")
    base = base.withColumn("best", F.when(F.col("has_360"), F.col("best_not_live")).otherwise(F.col("best_any")))
    base = base.filter(F.col("card_nid").isNull() | F.col("best").isNotNull())
    base = base.join(d, F.col("nid") == F.col("d_nid"), "left")
    if published is None:
        published = sheets.sheet_published(t.followup_tabs)
    base = joins.anti(base, visits_by_numeric_key(published, []), "nid", "nid")
    out = base.select(
        F.col("nid_s").alias("nid"),
        _or_blank(owner()).alias("comercial"),
        F.col("cd_ciudad").alias("_city"),
        _or_blank(team()).alias("equipo"),
        F.when(F.col("best.pc_id").isNull(), F.lit(WITHOUT_CMS)).otherwise(F.lit(WITH_CMS)).alias("ficha_cms"),
        _or_blank("d_estado").alias("patrimonio"),
        F.when(F.col("has_fc"), F.lit(CLIENT_PHOTOS_LABEL)).otherwise(F.lit(UNPUBLISHED_LABEL)).alias("tipo_fotos"),
        "fecha_recorrido", "ciudad_correo")
    out = first_per_key(out, ["nid"], ["comercial", "equipo", "patrimonio", "_city"])
    if links is None:
        links = sheets.lookup_links(t.link_tabs)
    out = joins.lookup_default(out, links, "nid", "nid", "link", "link_publicacion")
    pat, ficha = F.col("patrimonio"), F.col("ficha_cms")
    estado = F.concat(F.when(pat != "", F.concat(pat, F.lit(", "))).otherwise(F.lit("")),
                      F.when(ficha != "", F.concat(ficha, F.lit(", "))).otherwise(F.lit("")),
                      F.col("tipo_fotos"))
    city = F.coalesce(F.nullif(F.col("_city"), F.lit("")), F.col("ciudad_correo"), F.lit(""))
    res = out.select(
        "nid", "comercial", F.when(city == "", F.lit("")).otherwise(title_or_blank(city)).alias("ciudad"),
        "equipo", _or_blank("fecha_recorrido").alias("fecha_recorrido"),
        F.lit(BUBBLE_DONE_LABEL).alias("status_bubble"), "ficha_cms", "patrimonio",
        F.lit(WITH_360_LABEL).alias("visita_360"), "tipo_fotos", estado.alias("estado_actual"),
        "link_publicacion",
        spanish_day_month("fecha_recorrido", p.as_of, p.future_slack_days).alias("_d"))
    return res.orderBy(F.col("_d").desc_nulls_last(), F.col("fecha_recorrido").desc(), "nid").drop("_d")


# ---------------------------------------------------------------- R6 ------
def subject_keys(t: Tables, p: Params) -> DataFrame:
    """Keys named in recent client-photo mail subjects (S9 + F18 + O7)."""
    from ..functions.text import subject_key
    from ..sources.documents import subject_filter
    m = subject_filter(t.photo_subject, p.subject_text, p.as_of, p.subject_lookback_days)
    return m.select(subject_key("subject").alias("nid")).filter(F.col("nid").isNotNull()).distinct()


def to_publish_client_photos(t: Tables, p: Params) -> DataFrame:
    """Properties from client-photo mails that still need publishing.
    Rows are not deduplicated, as in the original."""
    keys = visits_by_numeric_key(subject_keys(t, p), [])
    photos = rules.photo_flags(joins.semi(t.listing_card, keys, "nid", "nid"), t.listing_image,
                               {"p_fc": p.photo_client, "p_360": p.photo_professional})
    epa = rules.latest_flag(joins.semi(t.clearance_tower, keys, "nid", "nid"), as_string=False).withColumnRenamed("nid", "epa_nid")
    d = t.intake_detail.select(F.col("nid").alias("d_nid"), F.col("estado_patrimonio").alias("d_estado"),
                               F.col("date_publication").alias("d_pub"))
    base = _base_active(t, p, keys)
    base = base.filter(F.col("cd_fecha_desistio_inmobiliaria").isNull())
    base = base.join(photos.withColumnRenamed("nid", "ph_nid"), F.col("nid") == F.col("ph_nid"), "left")
    base = base.filter(~F.coalesce("p_360", F.lit(False))).withColumn("has_fc", F.coalesce("p_fc", F.lit(False)))
    base = base.filter(F.col("cd_date_publication").isNull() | F.col("has_fc"))
    base = base.join(epa, F.col("nid") == F.col("epa_nid"), "left")
    base = base.filter(rules.patrimony_v2("flag", "cd_c_tipo_contrato_firmado", p.flag_done,
                                          p.flag_in_process, p.patrimony_contract))
    base = base.join(d, F.col("nid") == F.col("d_nid"), "left")
    base = base.filter(F.col("d_pub").isNull() | F.col("has_fc"))
    return base.select(
        F.col("nid_s").alias("nid"),
        _or_blank(owner()).alias("comercial"),
        title_or_blank("cd_ciudad").alias("ciudad"),
        _or_blank(team()).alias("equipo"),
        _date_text("cd_c_fecha_captacion").alias("fecha_captacion"),
        _or_blank("cd_tel_fono_del_cliente_1").alias("telefono_cliente"),
        F.coalesce(F.nullif(F.col("d_estado"), F.lit("")), F.lit(NO_INFO_LABEL)).alias("patrimonio"))


# ---------------------------------------------------------------- R7 ------
def to_publish_no_photos(t: Tables, p: Params) -> DataFrame:
    """Unpublished properties with no professional photos, outside the
    special-project set (R7), one row per key, newest capture first."""
    f360 = rules.photo_keyset(t.listing_card, t.listing_image, p.photo_professional)
    nph = (t.crm_deal_raw.filter(F.col("flag_inmueble_nph").isNotNull() & (F.col("flag_inmueble_nph") != "")
                                 & F.col("nid").isNotNull())
           .select("nid").distinct())
    epa = rules.latest_flag(t.clearance_tower, as_string=False).withColumnRenamed("nid", "epa_nid")
    base = _base_active(t, p)
    base = base.filter(rules.active_pipeline("cd_c_fecha_captacion", "cd_fecha_desistio_inmobiliaria",
                                             "h_fecha_desistio_inmobiliaria", "cd_v_fecha_venta",
                                             "h_dealstage", p.lost_stage)
                       & F.col("cd_date_publication").isNull())
    base = joins.anti(base, f360, "nid", "nid")
    base = joins.anti(base, nph, "nid", "nid")
    base = base.join(epa, F.col("nid") == F.col("epa_nid"), "left")
    base = base.filter(rules.patrimony_v2("flag", "cd_c_tipo_contrato_firmado", p.flag_done,
                                          p.flag_in_process, p.patrimony_contract))
    out = base.select(
        F.coalesce(F.col("nid_s"), F.lit("")).alias("nid"),
        _or_blank(owner()).alias("comercial"),
        title_or_blank("cd_ciudad").alias("ciudad"),
        _or_blank(team()).alias("equipo"),
        _date_text("cd_c_fecha_captacion").alias("fecha_captacion"),
        _or_blank("cd_tel_fono_del_cliente_1").alias("telefono_cliente"),
        F.col("cd_c_fecha_captacion").alias("_cap"))
    out = first_per_key(out, ["nid"], [F.col("_cap").desc_nulls_last()] +
                        [F.col(c).asc() for c in out.columns if c not in ("nid", "_cap")])
    return out.orderBy(F.col("_cap").desc_nulls_last(), "nid").drop("_cap")


# ---------------------------------------------------------------- R8 ------
def published_links(t: Tables, p: Params, links: DataFrame | None = None) -> DataFrame:
    """Live listings in the pipeline that have a link in the sheet, newest
    publication first (R8).  Each key's newest date is picked before the joins."""
    pc = t.listing_card.filter((F.col("active") == 1) & F.col("nid").isNotNull()).select("id", "nid")
    ps = t.listing_state.filter(F.col("current_state_id") == F.lit(p.live_state)) \
        .select("property_card_id", "date_publication")
    pa = (pc.join(ps, F.col("id") == F.col("property_card_id"), "inner")
          .groupBy("nid").agg(F.max(F.to_date("date_publication")).alias("fecha_publicacion")))
    pa = joins.semi(pa, crm_in_pipeline(t, p), "nid", "nid")
    j = with_master_crm(pa, t, p, key_is_string=False)
    if links is None:
        links = sheets.lookup_links(t.link_tabs)
    out = j.select(
        F.col("nid").cast("string").alias("nid"), F.col("fecha_publicacion"),
        clean(owner()).alias("comercial"), clean(team()).alias("equipo"),
        title_or_blank("cd_ciudad").alias("ciudad"))
    out = first_per_key(out, ["nid"], [F.col("fecha_publicacion").desc_nulls_last(),
                                       "comercial", "equipo", "ciudad"])
    out = joins.lookup_default(out, links, "nid", "nid", "link", "link_publicacion", required=True)
    out = out.withColumn("fecha_publicacion", _date_text("fecha_publicacion"))
    out = out.select("nid", "fecha_publicacion", "comercial", "equipo", "ciudad", "link_publicacion")
    return out.orderBy(F.col("fecha_publicacion").desc(), "nid")


# ------------------------------------------------------------ R9-R12 ------
def links_lookup(t: Tables, p: Params) -> DataFrame:
    """R9."""
    return sheets.lookup_links(t.link_tabs)


def reasons_lookup(t: Tables, p: Params) -> DataFrame:
    """R10."""
    return sheets.lookup_reasons(t.followup_tabs)


def sheet_published(t: Tables, p: Params) -> DataFrame:
    """R11."""
    return sheets.sheet_published(t.followup_tabs)


def status_current(t: Tables, p: Params) -> DataFrame:
    """Long (nid, kind, value) form of the shared status."""
    return status_fold(t.status_log, p.status_day_str)


def status_wide(t: Tables, p: Params) -> DataFrame:
    """R12 as the original answers it: one column for each of its eleven maps."""
    return status.status_wide(t.status_log, p.status_day_str)
