"""Role tables from real storage: the domain schemas of FIXTURES.md.

``read_roles`` maps each role to a parquet path or catalog table, checks
the columns it needs, and adds the tiebreak columns the reports rank with
when a source has none: ``record_id`` becomes a content hash of the row
(``xxhash64``), so the pick is the same on every run and every partitioning.
The status log must carry its writer's ``seq``: no content tells the order in
which two rows of one key were appended.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.bindings import Tables
from ..session import checkpoint_path
from .mailbox import Mailbox
from .sheets import read_sheet
from .tables import scan_table

# --- fixed values: role schemas (FIXTURES.md §1) -----------------------------
ROLE_SCHEMAS = {
    "visit_log": ("nid string, status string, visit_type string, visit_category string, fecha_inicio string, "
                  "fecha_fin string, modified_date string, ciudad_muni string, zona string, direccion string, "
                  "torre_apto string, conjunto string, nombre_agendador string, email_agendador string, "
                  "nombre_visitador string, email_visitador string"),
    "property_master": ("nid bigint, c_comercial_captacion string, c_equipo_seller string, "
                        "tel_fono_del_cliente_1 string, direccion string, ciudad string, "
                        "c_fecha_captacion timestamp_ntz, v_fecha_venta timestamp_ntz, "
                        "fecha_desistio_inmobiliaria timestamp_ntz, date_publication timestamp_ntz, "
                        "c_tipo_contrato_firmado string"),
    "crm_deal": ("nid bigint, pipeline string, dealstage string, hubspot_owner_id string, equipo_sellers string, "
                 "fecha_desistio_inmobiliaria timestamp_ntz"),
    "crm_deal_raw": "nid bigint, flag_inmueble_nph string",
    "listing_card": "id bigint, nid bigint, active int",
    "listing_image": "property_card_id bigint, source_image_id int, deleted_at timestamp_ntz",
    "listing_state": "property_card_id bigint, current_state_id int, date_publication timestamp_ntz",
    "process_history": "nid bigint, pipe_id string, phase_name string, first_time_in_phase timestamp_ntz",
    "clearance_tower": ("nid bigint, v_concepto_del_defensor_de_familia string, "
                        "v_fecha_concepto_del_defensor_de_familia timestamp_ntz, v_nombre_cliente_1 string, "
                        "v_numero_telefonico_cliente_1 string, v_flag_desistidos_patrimonio string, "
                        "v_fecha_inicio_fase_actual_patrimonio_de_familia timestamp_ntz"),
    "intake_detail": "nid bigint, estado_patrimonio string, date_publication timestamp_ntz",
    "seller_intake": "nid bigint, gravamenes_del_apartamento string",
    "seller_form": "nid_1 bigint, nombre_de_edificio_conjunto string",
    "status_log": "nid string, fecha string, estado string, usuario string",
    "report_rows": ("doc_id bigint, sender string, received_at timestamp_ntz, fecha_reporte string, row_pos bigint, "
                    "nid string, ciudad_correo string, fotografo string, resultado string, completado boolean, "
                    "motivo string"),
    "photo_report": "doc_id bigint, sender string, received_at timestamp_ntz, html string",
    "photo_subject": "msg_id bigint, received_at timestamp_ntz, subject string",
    "team_lead": "equipo string, email string",
}
# tiebreak column each ranked role needs
TIEBREAKS = {"visit_log": "record_id", "process_history": "record_id", "clearance_tower": "record_id",
             "status_log": "seq"}
# ---------------------------------------------------------------------------


def _columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(",")]


def conform(df: DataFrame, role: str) -> DataFrame:
    """Project a source onto the role schema: required columns must exist;
    types are cast (text through ``try_cast``) and the tiebreak is added
    when missing."""
    cols = _columns(ROLE_SCHEMAS[role])
    missing = [c for c, _ in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{role}: missing columns {missing}")
    keep = [TIEBREAKS.get(role)]
    out = df.select(*[F.col(c).try_cast(t).alias(c) if dict(df.dtypes)[c] != t else F.col(c)
                      for c, t in cols],
                    *[F.col(c) for c in df.columns if c in keep])
    tb = TIEBREAKS.get(role)
    if tb and tb not in out.columns:
        if role == "status_log":
            raise ValueError("status_log: no seq column; append order decides which status is current")
        out = out.withColumn(tb, F.xxhash64(*[F.col(c) for c, _ in cols]))
    return out


def read_roles(spark: SparkSession, locations: Mapping[str, str],
               link_tabs: Sequence[tuple[str, str]] = (), followup_tabs: Sequence[tuple[str, str]] = (),
               mail_folder: str | None = None) -> Tables:
    """Tables from ``role -> parquet path or catalog table`` plus sheet tabs
    given as ``(csv path, label)`` in priority order (later wins).

    Report mails can be given as ``photo_report`` documents; their rows
    (``report_rows``) are then parsed on the executors and kept below ``mail_folder``,
    where the next run finds them (default: a folder of this run).
    """
    t = Tables()
    t.spark = spark
    for role, loc in locations.items():
        t[role] = conform(scan_table(spark, loc), role)
    if "photo_report" in t and "report_rows" not in t:
        t.mailbox = Mailbox(spark, mail_folder or checkpoint_path(spark, f"mails/{uuid.uuid4().hex}"))
        t["report_rows"] = lambda: t.mailbox.every(t.photo_report)
    t["link_tabs"] = [(read_sheet(spark, p), lbl) for p, lbl in link_tabs]
    t["followup_tabs"] = [(read_sheet(spark, p), lbl) for p, lbl in followup_tabs]
    return t
