"""Hand-made domain rows (all values invented) covering the traps of SURVEY §2.9."""

from __future__ import annotations

import datetime as dt

from visitflow.plans.bindings import Tables

VISIT = ("nid string, status string, visit_type string, visit_category string, fecha_inicio string, "
         "fecha_fin string, modified_date string, ciudad_muni string, zona string, direccion string, "
         "torre_apto string, conjunto string, nombre_agendador string, email_agendador string, "
         "nombre_visitador string, email_visitador string, record_id bigint")
MASTER = ("nid bigint, c_comercial_captacion string, c_equipo_seller string, tel_fono_del_cliente_1 string, "
          "direccion string, ciudad string, c_fecha_captacion timestamp_ntz, v_fecha_venta timestamp_ntz, "
          "fecha_desistio_inmobiliaria timestamp_ntz, date_publication timestamp_ntz, c_tipo_contrato_firmado string")
CRM = ("nid bigint, pipeline string, dealstage string, hubspot_owner_id string, equipo_sellers string, "
       "fecha_desistio_inmobiliaria timestamp_ntz")
T = "Inmobiliaria"
KIND = {"visit_types": (T,), "visit_categories": (T,), "report_sender": "r@example.com"}


def ts(s):
    return None if s is None else dt.datetime.fromisoformat(s)


def visit(nid, status, fin, mod, rid, start=None, city="bogotá d.c.", sched="Sched One",
          email="sched1@example.com", vtype=T):
    return (nid, status, vtype, vtype, start or fin, fin, mod, city, "Norte", "Calle 1", None, None,
            sched, email, None, None, rid)


def master(nid, agent="agent1@example.com", team="Equipo A", city="BOGOTÁ D.C.", cap="2025-01-10 00:00:00",
           sold=None, withdrawn=None, pub=None, contract="Otro"):
    return (nid, agent, team, "+570000000", "Calle 9", city, ts(cap), ts(sold), ts(withdrawn), ts(pub), contract)


def domain_tables(spark) -> Tables:
    visits = [
        visit("nan", "Agendado", "2026-04-24T15:00:00.000Z", "2026-04-20T10:00:00", 1),
        visit(None, "Agendado", "2026-04-24T15:00:00.000Z", "2026-04-20T10:00:00", 2),
        # trap 1: older row is on tomorrow, newer row moved to another day
        visit("10000001", "Agendado", "2026-04-24T15:00:00.000Z", "2026-04-20T10:00:00", 3),
        visit("10000001", "Agendado", "2026-04-29T15:00:00.000Z", "2026-04-22T10:00:00", 4),
        # trap 2: same modified_date; the larger record id wins
        visit("10000002", "Cancelado", "2026-04-24T14:00:00.000Z", "2026-04-22T09:00:00", 5),
        visit("10000002", "Agendado", "2026-04-24T14:00:00.000Z", "2026-04-22T09:00:00", 6,
              start="2026-04-24T13:05:00.000Z"),
        # trap 15: 01:00 UTC of the day after tomorrow is evening tomorrow locally; not tomorrow by prefix
        visit("10000003", "Agendado", "2026-04-25T01:00:00.000Z", "2026-04-22T09:00:00", 7),
        # cancelled this month: new (yesterday) and pending
        visit("10000004", "Cancelado", "2026-04-22T15:00:00.000Z", "2026-04-22T18:00:00", 8),
        visit("10000005", "No realizada", "2026-04-10T15:00:00.000Z", "2026-04-10T18:00:00", 9),
        visit("10000006", "Finalizado", "2026-04-10T15:00:00.000Z", "2026-04-10T18:00:00", 10),
        visit("10000007", None, "2026-04-01T15:00:00.000Z", "2026-04-01T18:00:00", 11),
        visit("10000008", "Agendado", "2026-04-24T16:00:00.000Z", "2026-04-21T09:00:00", 12, city=None,
              sched="Sched Two", email="sched2@example.com"),
    ]
    masters = [
        master(10000001), master(10000002, agent=" Agent2@Example.com ", team=""),
        master(10000004), master(10000005, agent="agent2@example.com"),
        master(10000008, agent="", city="JAMUNDÍ"),
        master(10000009, cap=None), master(10000010, sold="2025-02-01 00:00:00"),
        master(10000011, pub="2026-04-01 00:00:00"), master(10000012, pub="2026-04-20 00:00:00"),
        master(10000013, contract="Contrato de Corretaje con patrimonio de familia"),
    ]
    crm = [
        (10000002, "803674753", "1", "", "Equipo CRM", None),        # empty owner (trap 12)
        (10000004, "803674753", "1182117639", "owner4@example.com", None, None),  # lost stage
        (10000005, "999", "1", "other@example.com", "Equipo X", None),  # other pipeline (J2)
    ]
    t = Tables()
    t["visit_log"] = spark.createDataFrame(visits, VISIT)
    t["property_master"] = spark.createDataFrame(masters, MASTER)
    t["crm_deal"] = spark.createDataFrame(crm, CRM)
    t["crm_deal_raw"] = spark.createDataFrame([(10000011, "NPH")], "nid bigint, flag_inmueble_nph string")
    t["listing_card"] = spark.createDataFrame([(1, 10000011, 1), (2, 10000012, 0), (3, 10000012, 1)],
                                              "id bigint, nid bigint, active int")
    t["listing_image"] = spark.createDataFrame(
        [(1, 3, None), (2, 1, ts("2026-01-01 00:00:00")), (3, 3, None)],
        "property_card_id bigint, source_image_id int, deleted_at timestamp_ntz")
    t["listing_state"] = spark.createDataFrame([(1, 2, ts("2026-04-20 00:00:00")), (2, 3, None), (3, 2, None)],
                                               "property_card_id bigint, current_state_id int, date_publication timestamp_ntz")
    t["process_history"] = spark.createDataFrame(
        [(10000001, "306710579", "Onhold", ts("2026-01-01 00:00:00"), 1),
         (10000001, "306710579", "En revisión", ts("2026-02-01 00:00:00"), 2),
         (10000002, "306725945", "En revisión", ts("2026-01-01 00:00:00"), 3),
         (10000002, "306725945", "Desistidos", ts("2026-02-01 00:00:00"), 4)],
        "nid bigint, pipe_id string, phase_name string, first_time_in_phase timestamp_ntz, record_id bigint")
    t["clearance_tower"] = spark.createDataFrame(
        [(10000001, "No favorable", ts("2025-10-23 08:00:00"), "Cli 1", "+1", "Finalizados", ts("2026-01-01 00:00:00"), 1),
         (10000002, "NO FAVORABLE", ts("2025-10-22 08:00:00"), "Cli 2", None, "En proceso", ts("2026-01-01 00:00:00"), 2),
         (10000004, "No favorable", ts("2026-03-01 08:00:00"), "Cli 4", "+4", None, None, 3)],
        "nid bigint, v_concepto_del_defensor_de_familia string, v_fecha_concepto_del_defensor_de_familia timestamp_ntz, "
        "v_nombre_cliente_1 string, v_numero_telefonico_cliente_1 string, v_flag_desistidos_patrimonio string, "
        "v_fecha_inicio_fase_actual_patrimonio_de_familia timestamp_ntz, record_id bigint")
    t["intake_detail"] = spark.createDataFrame(
        [(10000001, "Sin patrimonio", None), (10000004, None, None), (10000005, "Otro", None)],
        "nid bigint, estado_patrimonio string, date_publication timestamp_ntz")
    t["seller_intake"] = spark.createDataFrame([(10000004, "Patrimonio hijos")],
                                               "nid bigint, gravamenes_del_apartamento string")
    t["seller_form"] = spark.createDataFrame([(10000001, "Torres del Parque"), (10000001, "")],
                                             "nid_1 bigint, nombre_de_edificio_conjunto string")
    t["status_log"] = spark.createDataFrame(
        [("10000001", "2026-04-24", "confirmada", 1), ("10000001", "2026-04-24", "wa:si", 2),
         ("10000002", "2026-04-24", "cc:desistido", 3), ("10000002", "perm", "ps:listo", 4),
         ("10000002", "perm", "ps:", 5), ("10000002", "perm", "pc:texto", 6), ("10000002", "perm", "pc:", 7),
         ("10000003", "2026-04-24", "", 8), ("10000003", "perm", "zz:nope", 9),
         ("10000003", "2026-04-24", "jz:si", 10), ("10000008", "2026-04-24", "cancelada", 11),
         ("10000008", "2026-04-24", "confirmada", 12), ("10000008", "2026-04-24", "cancelada", 13)],
        "nid string, fecha string, estado string, seq bigint").withColumn("usuario", __import__(
            "pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string"))
    t["team_lead"] = spark.createDataFrame([("Equipo A", "lead-a@example.com"), ("Equipo CRM", "  ")],
                                           "equipo string, email string")
    return t
