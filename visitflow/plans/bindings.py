"""Role tables: the domain inputs every report reads, and their binding onto
the driver's benchmark tables.

Reports only see role tables with the domain schema (``visit_log``,
``property_master``, ...).  ``driver_tables`` derives each role from the
driver parquet files with plain projections over whole tables (no sampling,
no id subsets), so the same report code runs on hand-made fixtures and at
benchmark scale.  ``oracle_roles.py`` restates every binding in DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import SPANISH_MONTHS
from ..operators.extract import report_rows
from ..params import Params
from ..session import checkpoint_path
from ..sources.mailbox import Mailbox
from ..sources.sheets import with_order

# Driver keys are offset so property ids look like real 8-digit NIDs (the
# subject-key regex needs 8+ digits).
KEY_OFFSET = 10_000_000

# Days of the visit and status logs, from this one on: any day of the four
# weeks has rows in both.
FIRST_DAY, DAYS = "2001-07-01", 28
# Keys that no property has: some deals and opinions carry them.
UNKNOWN_OFFSET = 9_000_000

ROLES = ("visit_log", "property_master", "crm_deal", "crm_deal_raw", "listing_card",
         "listing_image", "listing_state", "process_history", "clearance_tower",
         "intake_detail", "seller_intake", "seller_form", "status_log", "report_rows",
         "photo_subject", "link_tabs", "followup_tabs", "team_lead")


class Tables(dict):
    """Role name -> DataFrame (tabs roles hold a list of (DataFrame, label)).

    ``raw(name)`` reads a source table the roles were bound from, for the
    few operators that work on a source directly (HTML pages, documents).
    A role may be given as a function without arguments; it is bound when it
    is first read.
    """

    spark = None
    source_dir = None
    #: Parsed report mails; without one, reports filter the role ``report_rows``.
    mailbox: Mailbox | None = None

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        if args and isinstance(args[0], Tables):
            self.spark, self.source_dir, self.mailbox = args[0].spark, args[0].source_dir, args[0].mailbox

    def raw(self, name: str) -> DataFrame:
        return _read(self.spark, self.source_dir, name)

    def __getitem__(self, name):
        value = super().__getitem__(name)
        if callable(value):
            value = self[name] = value()
        return value

    def __getattr__(self, name):
        try:
            return self[name]
        except KeyError as e:
            raise AttributeError(name) from e


def _day(number: F.Column) -> F.Column:
    """One of the ``DAYS`` days of the visit and status logs."""
    return _date_plus(FIRST_DAY, number % DAYS)


def _iso(c) -> F.Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))


def _key(c: str) -> F.Column:
    return (F.col(c) + F.lit(KEY_OFFSET)).cast("bigint")


def _ts(s: str) -> F.Column:
    return F.lit(s).cast("timestamp_ntz")


def _date_plus(base: str, days: F.Column) -> F.Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int")).cast("timestamp_ntz")


def driver_params(as_of: dt.date, **kw) -> Params:
    """Report parameters expressed in the driver tables' own codes."""
    base = dict(
        as_of=as_of,
        pipeline_id="P1",
        lost_stage="7",
        visit_types=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"),
        scheduled_statuses=("O", "P"),
        reminder_statuses=("O",),
        cancel_statuses_report=("P",),
        cancel_statuses_digest=("P", "O"),
        done_status="F",
        visit_categories=("1-URGENT",),
        photo_professional=50,
        photo_client=49,
        patrimony_ok=("AUTOMOBILE", "MACHINERY"),
        patrimony_lifted="MACHINERY",
        encumbrance_deny=("Brand#11", "Brand#22"),
        flag_done="purchase",
        flag_in_process="view",
        patrimony_contract="BUILDING",
        court_pipes=("pipeA", "pipeB"),
        closed_phases=("signup", "error"),
        patrimony_pipes=("pipeA", "pipeB", "pipeC"),
        final_phases=("purchase",),
        unfavourable="error",
        excluded_city_substrings=("nation_7", "nation_13"),
        report_sender="reports@example.com",
    )
    base.update(kw)
    return Params(**base)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Roles of one scale folder, each bound when it is first read."""
    r = lambda n: _read(spark, sf_dir, n)
    t = Tables()
    t.spark, t.source_dir = spark, sf_dir
    bal, sbal, v = F.col("c_acctbal"), F.col("s_acctbal"), F.col("value")
    lang = F.col("lang")
    did = (F.col("doc_id") + F.lit(KEY_OFFSET)).cast("string")

    t["visit_log"] = lambda: bind_visit_log(r("orders"))
    t["property_master"] = lambda: r("customer").join(r("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        _key("c_custkey").alias("nid"),
        F.concat(F.lit(" Agent_"), F.col("c_nationkey").cast("string"), F.lit("@Example.com")).alias("c_comercial_captacion"),
        F.col("c_mktsegment").alias("c_equipo_seller"),
        F.concat(F.lit("+57"), F.col("c_custkey").cast("string")).alias("tel_fono_del_cliente_1"),
        F.concat(F.lit("Carrera "), F.col("c_custkey").cast("string")).alias("direccion"),
        F.col("n_name").alias("ciudad"),
        F.when(bal >= 0, _date_plus("2022-01-01", F.floor(bal / 4))).alias("c_fecha_captacion"),
        F.when(bal > 9000, _ts("2025-01-01 00:00:00")).alias("v_fecha_venta"),
        F.when((bal >= 0) & (bal < 300), _ts("2025-06-01 00:00:00")).alias("fecha_desistio_inmobiliaria"),
        F.when(F.col("c_nationkey") >= 12, _date_plus("2026-03-01", F.floor(bal / 100))).alias("date_publication"),
        F.col("c_mktsegment").alias("c_tipo_contrato_firmado"),
    )

    t["crm_deal"] = lambda: r("supplier").select(
        F.when(F.col("s_suppkey") % 10 == 9, F.col("s_suppkey") + UNKNOWN_OFFSET).otherwise(_key("s_suppkey")).cast("bigint").alias("nid"),
        F.when(sbal >= 0, F.lit("P1")).otherwise(F.lit("P0")).alias("pipeline"),
        F.col("s_nationkey").cast("string").alias("dealstage"),
        F.when(F.col("s_nationkey") == 5, F.lit(""))
        .otherwise(F.concat(F.lit("Owner_"), F.col("s_nationkey").cast("string"), F.lit("@example.com")))
        .alias("hubspot_owner_id"),
        F.when(sbal > 5000, F.lit("CRM_TEAM")).when(sbal > 2000, F.lit("")).alias("equipo_sellers"),
        F.when(sbal > 9000, _ts("2025-03-01 00:00:00")).alias("fecha_desistio_inmobiliaria"),
    )
    t["crm_deal_raw"] = lambda: r("supplier").select(
        _key("s_suppkey").alias("nid"),
        F.when(F.col("s_nationkey") == 3, F.lit("NPH")).when(F.col("s_nationkey") == 4, F.lit(""))
        .alias("flag_inmueble_nph"),
    )
    t["listing_card"] = lambda: r("orders").select(
        F.col("o_orderkey").alias("id"), _key("o_custkey").alias("nid"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(1)).alias("active"))
    t["listing_image"] = lambda: r("lineitem").select(
        F.col("l_orderkey").alias("property_card_id"),
        F.col("l_quantity").cast("int").alias("source_image_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("deleted_at"))
    t["listing_state"] = lambda: r("lineitem").select(
        F.col("l_orderkey").alias("property_card_id"),
        F.col("l_linenumber").alias("current_state_id"),
        F.col("l_shipdate").alias("date_publication"))

    t["process_history"] = lambda: r("events").select(
        _key("user_id").alias("nid"),
        F.when(v < 100, F.lit("pipeA")).when(v < 200, F.lit("pipeB")).otherwise(F.lit("pipeC")).alias("pipe_id"),
        F.col("event_type").alias("phase_name"),
        F.col("ts").alias("first_time_in_phase"),
        F.col("event_id").alias("record_id"))
    t["clearance_tower"] = lambda: r("events").select(
        F.when(F.col("event_id") % 10 == 0, F.col("user_id") + UNKNOWN_OFFSET).otherwise(_key("user_id")).cast("bigint").alias("nid"),
        F.col("event_type").alias("v_concepto_del_defensor_de_familia"),
        F.col("ts").alias("v_fecha_concepto_del_defensor_de_familia"),
        F.concat(F.lit("Client "), F.col("user_id").cast("string")).alias("v_nombre_cliente_1"),
        F.concat(F.lit("+1"), F.col("event_id").cast("string")).alias("v_numero_telefonico_cliente_1"),
        F.col("event_type").alias("v_flag_desistidos_patrimonio"),
        F.col("ts").alias("v_fecha_inicio_fase_actual_patrimonio_de_familia"),
        F.col("event_id").alias("record_id"))
    t["intake_detail"] = lambda: r("customer").select(
        _key("c_custkey").alias("nid"),
        F.when(bal >= 1000, F.col("c_mktsegment")).alias("estado_patrimonio"),
        F.when(bal > 7000, _ts("2026-05-01 00:00:00")).alias("date_publication"))
    t["seller_intake"] = lambda: r("part").select(_key("p_partkey").alias("nid"),
                                     F.col("p_brand").alias("gravamenes_del_apartamento"))
    t["seller_form"] = lambda: r("part").select(
        _key("p_partkey").alias("nid_1"),
        F.when(F.col("p_size") > 40, F.lit("")).otherwise(F.col("p_name")).alias("nombre_de_edificio_conjunto"))

    t["status_log"] = lambda: bind_status_log(r("events"))

    t["photo_report"] = lambda: bind_photo_reports(r("pages"))
    t.mailbox = Mailbox(spark, checkpoint_path(spark, f"mails/{uuid.uuid4().hex}"))
    t["report_rows"] = lambda: t.mailbox.every(t.photo_report)

    t["photo_subject"] = lambda: r("documents").select(
        F.col("doc_id").alias("msg_id"),
        _date_plus("2026-02-01", F.col("doc_id") % 90).alias("received_at"),
        F.when(lang == "es", F.concat(F.lit("Fotos cliente ("), did, F.lit(")")))
        .when(lang == "en", F.concat(F.lit("Fotos cliente "), did))
        .when(lang == "de", F.concat(F.lit("FOTOS CLIENTE ("), did, F.lit(") ref "), F.col("n_chars").cast("string")))
        .otherwise(F.concat(F.lit("Re: documento "), did)).alias("subject"))

    pid = (F.col("page_id") + F.lit(KEY_OFFSET)).cast("string")
    url = F.col("url")
    secure = F.when(url.contains("#"), F.lit("NO APLICA")).otherwise(F.regexp_replace(url, "^http:", "https:"))

    def link_tabs():
        pages = with_order(r("pages"), "page_id")
        return [(pages.select(pid.alias("NID"), url.alias("Link Publicación"), "__seq"), "Bogotá"),
                (pages.select(pid.alias("nid"), secure.alias(" link publicacion "), "__seq"), "Ciudades")]

    t["link_tabs"] = link_tabs
    nch = F.col("n_chars")
    estado = (F.when(nch < 500, F.lit("Publicado")).when(nch < 2000, F.lit(" PUBLICADA "))
              .otherwise(F.lit("No publicado")))

    def followup_tabs():
        documents = with_order(r("documents"), "doc_id")
        tab_c = documents.filter(lang == "es").select(
            did.alias("NID"), F.col("source").alias("Motivo"), F.col("lang").alias("Observaciones"),
            estado.alias("Estado Publicación"), "__seq")
        tab_d = documents.filter(lang != "es").select(
            did.alias("nid"), F.col("source").alias("Razón"), estado.alias("estado publicacion"), "__seq")
        return [(tab_c, "Bogotá"), (tab_d, "Ciudades")]

    t["followup_tabs"] = followup_tabs
    seg = F.col("c_mktsegment")
    # teams of deals and properties without a team have no lead
    t["team_lead"] = lambda: r("customer").select(seg.alias("equipo")).distinct().select(
        "equipo",
        F.when(F.col("equipo") == "HOUSEHOLD", F.lit(" "))
        .otherwise(F.concat(F.lower("equipo"), F.lit("-lead@example.com"))).alias("email"))
    return t


def bind_visit_log(orders: DataFrame) -> DataFrame:
    """``visit_log`` role from ``orders`` (batch or streaming)."""
    start = _day(F.col("o_custkey") + F.col("o_orderkey") % 3) + F.make_dt_interval(secs=F.floor("o_totalprice").cast("int") % 80_000)
    return orders.select(
        (F.col("o_custkey") + F.lit(KEY_OFFSET)).cast("string").alias("nid"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("visit_type"),
        F.col("o_orderpriority").alias("visit_category"),
        _iso(start).alias("fecha_inicio"),
        _iso(start + F.make_dt_interval(hours=F.lit(1))).alias("fecha_fin"),
        _iso(F.col("o_orderdate")).alias("modified_date"),
        F.col("o_orderpriority").alias("ciudad_muni"),
        F.col("o_orderstatus").alias("zona"),
        F.concat(F.lit("Calle "), F.col("o_orderkey").cast("string")).alias("direccion"),
        F.lit(None).cast("string").alias("torre_apto"),
        F.lit(None).cast("string").alias("conjunto"),
        F.concat(F.lit("Scheduler "), F.substring("o_orderpriority", 1, 1)).alias("nombre_agendador"),
        F.concat(F.lit("scheduler"), F.substring("o_orderpriority", 1, 1), F.lit("@example.com")).alias("email_agendador"),
        F.lit(None).cast("string").alias("nombre_visitador"),
        F.lit(None).cast("string").alias("email_visitador"),
        F.col("o_orderkey").alias("record_id"),
    )


def bind_status_log(events: DataFrame) -> DataFrame:
    """``status_log`` role from ``events`` (batch or streaming)."""
    v = F.col("value")
    et = F.col("event_type")
    person = F.col("user_id") * 10 + F.col("event_id") % 10
    return events.select(
        (person + F.lit(KEY_OFFSET)).cast("string").alias("nid"),
        F.when(et.isin("purchase", "signup"), F.lit("perm"))
        .otherwise(F.date_format(_day(person), "yyyy-MM-dd")).alias("fecha"),
        F.when(et == "view", F.when(F.col("event_id") % 2 == 0, F.lit("confirmada")).otherwise(F.lit("cancelada")))
        .when(et == "click", F.lit("wa:1"))
        .when(et == "error", F.when(v < 30, F.lit("cc:desistido")).otherwise(F.lit("cc:llamado")))
        .when(et == "purchase", F.when(v < 20, F.lit("ps:")).otherwise(F.lit("ps:listo")))
        .when(et == "signup", F.when(v < 50, F.lit("pc:")).when(v < 100, F.lit("jz:interesado"))
              .otherwise(F.lit("pc:nota")))
        .alias("estado"),
        F.lit(None).cast("string").alias("usuario"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"))


def bind_photo_reports(pages: DataFrame) -> DataFrame:
    """``photo_report`` documents from the driver's web pages (batch or
    streaming): each page is one mail with a date sentence and a table; the
    items of the page's first list are the table's rows, entities and inner
    tags included.  Every fifth table lies in a layout table, every third
    leaves out the cells' end tags of its last column."""
    pid = F.col("page_id")
    months = F.array(*[F.lit(m) for m in SPANISH_MONTHS])
    fecha = F.concat((pid % 31 + 1).cast("string"), F.lit(" de "), F.element_at(months, (pid % 12 + 1).cast("int")))
    items = F.regexp_extract_all(F.regexp_extract("html", r"(?is)<ul\b[^>]*>(.*?)</ul\s*>", 1), F.lit(r"(?is)<li\b[^>]*>.*?<a\b[^>]*>(.*?)</a\s*>.*?</li\s*>"), 1)
    end = F.when(pid % 3 == 0, F.lit("")).otherwise(F.lit("</td>"))

    def row(item, place):
        outcome = F.when(place == 0, F.lit(" si ")).otherwise(item)
        return F.concat(F.lit("<tr><td>"), (pid + F.lit(KEY_OFFSET)).cast("string"), F.lit("</td><td>"), item, F.lit("</td><td>Foto "),
                        place.cast("string"), F.lit("</td><td>"), outcome, end, F.lit("</tr>"))

    table = F.concat(F.lit("<table>"), F.array_join(F.transform(items, row), ""), F.lit("</table>"))
    table = F.when(pid % 5 == 0, F.concat(F.lit("<table><tr><td>"), table, F.lit("</td></tr></table>"))).otherwise(table)
    return pages.select(
        pid.alias("doc_id"),
        F.when(F.col("url").startswith("https"), F.lit("reports@example.com"))
        .otherwise(F.lit("noreply@example.org")).alias("sender"),
        _date_plus("2026-03-01", pid % 60).alias("received_at"),
        F.concat(F.lit("<p>Adjunto el reporte del registro fotográfico del "), fecha, F.lit(".</p>"), table).alias("html"))


def driver_report_rows(pages: DataFrame) -> DataFrame:
    """Rows parsed out of ``bind_photo_reports``."""
    return report_rows(bind_photo_reports(pages), keep=("doc_id", "sender", "received_at"))
