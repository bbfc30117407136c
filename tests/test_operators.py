"""Operators on hand-made rows, one case per semantic trap."""

import os

from pyspark.sql import functions as F

from visitflow.functions.keys import is_real_key
from visitflow.operators import aggs, joins, latest, rules
from visitflow.operators.extract import html_rows, report_rows
from visitflow.operators.status import day_status, state_upsert, status_fold
from visitflow.sources import sheets, sinks, state
from visitflow.sources.tables import scan_csv_typed
from tests.fixtures import domain_tables


def _key(r):
    return tuple("" if x is None else str(x) for x in r)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def test_latest_per_key_tiebreak_and_sentinels(spark):
    t = domain_tables(spark)
    last = latest.latest_per_key(t.visit_log.filter(is_real_key("nid")), "nid", "modified_date", "record_id")
    got = dict(rows(last, "nid", "record_id"))
    assert got["10000001"] == 4 and got["10000002"] == 6
    assert "nan" not in got and None not in got


def test_dedup_then_filter_differs_from_filter_then_dedup(spark):
    t = domain_tables(spark)
    tomorrow = F.col("fecha_fin").startswith("2026-04-24")
    a = latest.latest_then_filter(t.visit_log, tomorrow, "nid", "modified_date", "record_id")
    b = latest.filter_then_latest(t.visit_log, tomorrow, "nid", "modified_date", "record_id")
    ids_a = {r[0] for r in rows(a, "nid")}
    ids_b = {r[0] for r in rows(b, "nid")}
    assert "10000001" not in ids_a and "10000001" in ids_b


def test_not_in_drops_null_keys(spark):
    left = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    keys = spark.createDataFrame([("1",), (None,)], "k string")
    assert rows(joins.not_in(left, keys, "k", "k"), "k") == [("2",)]


def test_exists_flag_and_lookup(spark):
    left = spark.createDataFrame([("1",), ("2",)], "k string")
    keys = spark.createDataFrame([("1",), ("1",)], "k string")
    assert rows(joins.exists_flag(left, keys, "k", "k", "f"), "k", "f") == [("1", True), ("2", False)]
    lk = spark.createDataFrame([("1", " "), ("2", "x@example.com")], "k string, v string")
    out = joins.lookup_fallback(spark.createDataFrame([("1",), ("2",), ("3",)], "k string"), lk, "k", "k", "v", "o", "d@x")
    assert rows(out, "k", "o") == [("1", "d@x"), ("2", "x@example.com"), ("3", "d@x")]


def test_merge_metrics_zero_fill(spark):
    a = spark.createDataFrame([("t1", 2, 1)], "k string, m1 bigint, m2 bigint")
    b = spark.createDataFrame([("t2", 5)], "k string, m3 bigint")
    out = joins.merge_metrics([a, b], "k", ["m1", "m2", "m3"])
    assert rows(out, "k", "m1", "m2", "m3") == [("t1", 2, 1, 0), ("t2", 0, 0, 5)]


def test_status_fold_rules(spark):
    t = domain_tables(spark)
    got = {(n, k): v for n, k, v in rows(status_fold(t.status_log, "2026-04-24"), "nid", "kind", "value")}
    assert got[("10000001", "visita")] == "confirmada"
    assert got[("10000001", "whatsapp")] == "true"
    assert got[("10000002", "cancelContacto")] == "desistido"
    assert got[("10000002", "cancelDesistido")] == "true"
    assert got[("10000002", "pubEstado")] == "listo"          # 'ps:' with no value is ignored
    assert got[("10000002", "pubComentario")] == ""           # 'pc:' clears the comment
    assert ("10000003", "juzgado") not in got                 # daily row with a permanent prefix
    assert not any(n == "10000003" for n, _ in got)           # blank status, unknown perm prefix
    assert got[("10000008", "visita")] == "cancelada"


def test_day_status_last_row_wins_even_blank(spark):
    t = domain_tables(spark)
    got = dict(rows(day_status(t.status_log, "2026-04-24"), "nid", "estado"))
    assert got["10000001"] == "wa:si"                          # a later wa: row hides 'confirmada'
    assert got["10000003"] == "jz:si"
    assert got["10000008"] == "cancelada"


def test_state_upsert_tombstones(spark):
    cur = spark.createDataFrame([("d1", "1", "confirmada"), ("d1", "2", "cancelada")], "fecha string, nid string, estado string")
    upd = spark.createDataFrame([("d1", "1", "", 1), ("d1", "3", "confirmada", 2), ("d1", "3", "cancelada", 3)],
                                "fecha string, nid string, estado string, seq bigint")
    assert rows(state_upsert(cur, upd), "fecha", "nid", "estado") == [("d1", "2", "cancelada"), ("d1", "3", "cancelada")]


def test_json_state_explode_bad_json(spark):
    df = spark.createDataFrame([('{"2026-04-24": {"1": "confirmada", "2": "cancelada"}}',), ("{not json",), ("{}",)],
                               "json string")
    assert rows(state.json_state_explode(df), "fecha", "nid", "estado") == [
        ("2026-04-24", "1", "confirmada"), ("2026-04-24", "2", "cancelada")]
    back = state.state_to_json(state.json_state_explode(df)).first()
    assert back["json"] == '{"2026-04-24":{"1":"confirmada","2":"cancelada"}}'


HTML = """<html><body><p>Este es el reporte del registro fotográfico del 23 de abril</p>
<table><tr><th>NID</th><th>Ciudad</th><th>Fotógrafo</th><th>Resultado</th></tr>
<tr><td> 10000001 </td><td>Bogotá</td><td>Ana &amp; Luis</td><td>SI</td></tr>
<tr><td>10000002</td><td>Cali</td><td><b>Pedro</b> P.</td><td>Cliente no estaba</td></tr>
<tr><td>10000003</td><td>Cali</td><td>x</td></tr>
<tr><td>ABC</td><td>Cali</td><td>x</td><td>SI</td></tr>
<tr><td>10000004</td><td>Medellín</td><td>y</td><td> si </td></tr></table>
<table><tr><td>99999999</td><td>a</td><td>b</td><td>SI</td></tr></table></body></html>"""


def test_html_report_rows(spark):
    docs = spark.createDataFrame([(1, "r@example.com", None, HTML), (2, "r@example.com", None, None),
                                  (3, "r@example.com", None, "<p>sin tabla</p>")],
                                 "doc_id bigint, sender string, received_at timestamp_ntz, html string")
    got = rows(report_rows(docs), "nid", "ciudad_correo", "fotografo", "completado", "motivo", "fecha_reporte")
    assert got == [("10000001", "Bogotá", "Ana & Luis", True, None, "23 de abril"),
                   ("10000002", "Cali", "PedroP.", False, "Cliente no estaba", "23 de abril"),
                   ("10000004", "Medellín", "y", True, None, "23 de abril")]
    assert html_rows(docs, "html", keep=["doc_id"]).filter("doc_id = 2 or doc_id = 3").count() == 0


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_sheet_tabs_bom_aliases_and_last_wins(spark, scratch):
    a = _write(os.path.join(scratch, "a.csv"), "﻿NID,Link Publicación\n1,http://a/1\n2,NO APLICA\n3,https://a/3\n")
    b = _write(os.path.join(scratch, "b.csv"), "nid , link publicacion\n1,https://b/1\n2,N/A\n")
    c = _write(os.path.join(scratch, "c.csv"), "id,otra\n1,http://c\n")
    tabs = [(sheets.read_sheet(spark, p), lbl) for p, lbl in ((a, "A"), (b, "B"), (c, "C"))]
    assert rows(sheets.lookup_links(tabs), "nid", "link") == [("1", "https://b/1"), ("3", "https://a/3")]


def test_reasons_and_published(spark, scratch):
    a = _write(os.path.join(scratch, "a.csv"),
               "NID,Motivo,Observaciones,Estado Publicación\n1,m1,o1,Publicado\n2,m2,o2,No publicado\n")
    b = _write(os.path.join(scratch, "b.csv"), "nid,Razón,estado publicacion\n1,m1b, PUBLICADA \n3,m3,\n")
    tabs = [(sheets.read_sheet(spark, a), "Bogotá"), (sheets.read_sheet(spark, b), "Ciudades")]
    assert rows(sheets.lookup_reasons(tabs), "nid", "motivo", "observaciones", "fuente") == [
        ("1", "m1b", "", "Ciudades"), ("2", "m2", "o2", "Bogotá"), ("3", "m3", "", "Ciudades")]
    assert rows(sheets.sheet_published(tabs), "nid") == [("1",)]


def test_positional_status_log(spark, scratch):
    p = _write(os.path.join(scratch, "log.csv"), "nid,fecha,estado\n1,2026-04-24,confirmada\n2,2026-04-24\n3,2026-04-24,\n")
    log = sheets.read_status_log_positional(spark, p)
    assert rows(log, "nid", "fecha", "estado") == [("1", "2026-04-24", "confirmada"), ("3", "2026-04-24", "")]


def test_scan_csv_typed(spark, scratch):
    p = _write(os.path.join(scratch, "r.csv"), "comercial,total\na@x,3\nb@x,nan\n")
    df = scan_csv_typed(spark, p, {"total": "bigint"})
    assert rows(df, "comercial", "total") == [("a@x", 3), ("b@x", None)]


def test_status_append_sink(spark, scratch):
    path = os.path.join(scratch, "log")
    df = spark.createDataFrame([("1", "perm", "ps:listo", None)], "nid string, fecha string, estado string, usuario string")
    sinks.status_append(df, path, ["nid"])
    sinks.status_append(df, path, ["nid"])
    back = spark.read.parquet(path)
    assert back.count() == 2 and rows(back, "usuario") == [("",), ("",)]


def test_photo_keyset_deleted(spark):
    t = domain_tables(spark)
    assert rows(rules.photo_keyset(t.listing_card, t.listing_image, 1), "nid") == [(10000012,)]
    assert rows(rules.photo_keyset(t.listing_card, t.listing_image, 1, exclude_deleted=True), "nid") == []


def test_patrimony_rules(spark):
    df = spark.createDataFrame(
        [(f, c) for f in (None, "Finalizados", "En proceso", "Desistidos") for c in (None, "PAT", "Otro")],
        "flag string, contract string")
    ok = df.filter(rules.patrimony_v2("flag", "contract", "Finalizados", "En proceso", "PAT"))
    got = {(r[0], r[1]) for r in ok.collect()}
    assert ("En proceso", "Otro") not in got and (None, "PAT") not in got and ("Finalizados", "PAT") in got
    v1 = spark.createDataFrame([(s, g) for s in (None, "Sin patrimonio", "Otro") for g in (None, "Patrimonio hijos", "x")],
                               "s string, g string")
    got1 = {(r[0], r[1]) for r in v1.filter(rules.patrimony_v1("s", "g", ["Sin patrimonio"], ["Patrimonio hijos"])).collect()}
    assert got1 == {("Sin patrimonio", None), ("Sin patrimonio", "Patrimonio hijos"), ("Sin patrimonio", "x"),
                    (None, None), (None, "x")}


def test_cancelled_for_real_null_status(spark):
    import datetime as dt
    d = dt.date
    df = spark.createDataFrame([(None, d(2026, 4, 20), d(2026, 4, 10)), ("Finalizado", d(2026, 4, 20), d(2026, 4, 10)),
                                ("Cancelado", None, None), ("Agendado", d(2026, 4, 5), d(2026, 4, 10))],
                               "status string, r date, m date")
    got = [r[0] for r in df.filter(rules.cancelled_for_real("status", "r", "m", ["Cancelado"], "Finalizado")).collect()]
    assert sorted(got, key=str) == sorted([None, "Cancelado"], key=str)


def test_global_flag_is_scalar_subquery(spark):
    df = spark.createDataFrame([(1, False), (2, True)], "k int, f boolean")
    gated = df.filter(aggs.global_flag(df, F.col("f")))
    assert gated.count() == 2
    assert df.filter(aggs.global_flag(df.filter("k = 1"), F.col("f"))).count() == 0
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_outbox_rows(spark, scratch):
    msgs = spark.createDataFrame([("a@x", "s", "b", 3)], "email string, subject string, body string, total bigint")
    assert sinks.outbox_rows(msgs).columns == ["to", "subject", "body", "total"]
    fixed = sinks.outbox_rows(msgs.drop("email"), fixed_to="coord@x").first()
    assert fixed["to"] == "coord@x"
    path = os.path.join(scratch, "outbox")
    sinks.outbox_write(msgs, path)
    assert spark.read.parquet(path).first()["to"] == "a@x"


NESTED = """<p>reporte del registro fotográfico del 2 de mayo</p>
<table><tr><td>10000001<td>Cali<td>Ana<td>SI</tr>
<tr><td>10000002</td><td>Bogotá</td><td><table><tr><td>x</td></tr></table>Luis</td><td>No</td></tr></table>"""


def test_nested_tables_and_omitted_end_tags(spark):
    docs = spark.createDataFrame([(1, NESTED)], "doc_id bigint, html string")
    got = [(r["row_pos"], r["cells"]) for r in html_rows(docs, "html", min_cells=1, keep=["doc_id"]).orderBy("row_pos").collect()]
    # unclosed cells nest inside each other; the nested table's row and cell count as descendants
    assert got[0] == (0, ["10000001CaliAnaSI", "CaliAnaSI", "AnaSI", "SI"])
    assert got[1] == (1, ["10000002", "Bogotá", "xLuis", "x", "No"])
    assert got[2] == (2, ["x"])


def test_layout_table_and_entities(spark):
    inner = "<tr><td>10000007</td><td>Bogot&aacute; &#38; Ch&#237;a</td><td>Ana&nbsp;</td><td>s&#105;</td></tr>"
    html = f"<p>reporte del registro fotográfico del 3 de marzo</p><table><tr><td><table>{inner}{inner.replace('07', '08')}</table></td></tr></table>"
    docs = spark.createDataFrame([(1, None, html)], "doc_id bigint, received_at timestamp_ntz, html string")
    got = rows(report_rows(docs), "nid", "ciudad_correo", "fotografo", "completado", "fecha_reporte", "row_pos")
    assert got == [("10000007", "Bogotá & Chía", "Ana", True, "3 de marzo", 1), ("10000008", "Bogotá & Chía", "Ana", True, "3 de marzo", 2)]


def test_read_roles_parses_landed_reports(spark, scratch):
    from visitflow.sources.roles import read_roles
    path = os.path.join(scratch, "mails")
    spark.createDataFrame([(1, "r@example.com", None, NESTED)], "doc_id bigint, sender string, received_at timestamp_ntz, html string").write.parquet(path)
    t = read_roles(spark, {"photo_report": path})
    assert rows(t.report_rows, "nid", "ciudad_correo", "resultado") == [("10000002", "Bogotá", "x")]


ODD = 'nid,Motivo,Observaciones\n1,m,"linea 1\nlinea 2"\n2,m,"dijo ""no"", y ya"\n3,m,"a, b"\n'


def test_cells_as_spreadsheets_write_them(spark, scratch):
    p = _write(os.path.join(scratch, "odd.csv"), ODD)
    got = rows(sheets.lookup_reasons([(sheets.read_sheet(spark, p), "B")]), "nid", "observaciones")
    assert got == [("1", "linea 1\nlinea 2"), ("2", 'dijo "no", y ya'), ("3", "a, b")]
    typed = scan_csv_typed(spark, p, {"nid": "bigint"})
    assert rows(typed, "nid", "Observaciones") == [(1, "linea 1\nlinea 2"), (2, 'dijo "no", y ya'), (3, "a, b")]
    log = _write(os.path.join(scratch, "log.csv"), 'NID ,Fecha,estado\n1,perm,"pc:a, ""b""\nc"\n2,"x,y"\n')
    assert rows(sheets.read_status_log(spark, log), "nid", "estado") == [("1", 'pc:a, "b"\nc'), ("2", None)]
    assert rows(sheets.read_status_log_positional(spark, log), "nid", "estado") == [("1", 'pc:a, "b"\nc')]


def test_last_write_wins_follows_files_and_lines(spark, scratch):
    """The later file of a tab is the smaller one; scans pack files by size."""
    tab = os.path.join(scratch, "tab")
    os.makedirs(tab)
    _write(os.path.join(tab, "part-0.csv"), "nid,link publicacion\n" + "".join(f"{i},http://old/{i}\n" for i in range(3000)) + "7,http://mid/7\n")
    _write(os.path.join(tab, "part-1.csv"), "nid,link publicacion\n5,http://new/5\n")
    got = dict(rows(sheets.lookup_links([(sheets.read_sheet(spark, tab), "A")]), "nid", "link"))
    assert got["5"] == "http://new/5" and got["7"] == "http://mid/7" and len(got) == 3000
    plain = spark.createDataFrame([("1", "http://a")], "nid string, `link publicacion` string")
    import pytest
    with pytest.raises(ValueError, match="no row order"):
        sheets.lookup_links([(plain, "A")])


def test_append_keeps_the_order_of_its_rows(spark, scratch):
    path = os.path.join(scratch, "log")
    schema = "nid string, fecha string, estado string, usuario string, at int"
    first = spark.createDataFrame([("1", "perm", f"ps:{i}", None, i) for i in range(50)], schema).repartition(4)
    sinks.status_append(first, path, ["at"])
    log = spark.read.parquet(path)
    assert rows(status_fold(log, "d"), "value") == [("49",)] and log.select("seq").distinct().count() == 50
    sinks.status_append(spark.createDataFrame([("1", "perm", "ps:z", None, 0)], schema), path, ["at"])
    assert rows(status_fold(spark.read.parquet(path), "d"), "value") == [("z",)]


def test_text_keys_without_a_number_do_not_meet_in_one_partition(spark):
    left = spark.createDataFrame([(f"x{i}",) for i in range(400)] + [("7",), ("07",), (" 7",), (None,)], "k string")
    right = spark.createDataFrame([(7, "a")], "k bigint, v string")
    assert rows(joins.left_cast(left, right, "k", "k", ["v"]).filter("v IS NOT NULL"), "k") == [("7",)]
    assert rows(joins.left_safecast_on(left, right, "k", "k", None, ["v"]).filter("v IS NOT NULL"), "k") == [(" 7",), ("07",), ("7",)]
    keys = left.select(joins.spread_key(left, "k").alias("s"))
    assert keys.filter("s IS NULL").count() == 0 and keys.distinct().count() >= 400
