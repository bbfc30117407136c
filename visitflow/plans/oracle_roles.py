"""The role bindings of ``bindings.py`` restated as DuckDB SQL.

Oracle queries are written against these role views, so a report's oracle
reads the same way as the report.  ``with_roles(sql, *roles)`` prefixes the
needed CTEs (dependencies included).
"""

from __future__ import annotations

from .bindings import KEY_OFFSET, UNKNOWN_OFFSET

K = KEY_OFFSET

ROLE_SQL: dict[str, str] = {
    "visit_log": f"""
  SELECT CAST(o_custkey + {K} AS VARCHAR) AS nid, o_orderstatus AS status,
         o_orderpriority AS visit_type, o_orderpriority AS visit_category,
         strftime(DATE '2001-07-01' + CAST((o_custkey + o_orderkey % 3) % 28 AS INTEGER) + to_seconds(CAST(FLOOR(o_totalprice) AS BIGINT) % 80000), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS fecha_inicio,
         strftime(DATE '2001-07-01' + CAST((o_custkey + o_orderkey % 3) % 28 AS INTEGER) + to_seconds(CAST(FLOOR(o_totalprice) AS BIGINT) % 80000) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS fecha_fin,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS modified_date,
         o_orderpriority AS ciudad_muni, o_orderstatus AS zona,
         'Calle ' || CAST(o_orderkey AS VARCHAR) AS direccion,
         CAST(NULL AS VARCHAR) AS torre_apto, CAST(NULL AS VARCHAR) AS conjunto,
         'Scheduler ' || substring(o_orderpriority, 1, 1) AS nombre_agendador,
         'scheduler' || substring(o_orderpriority, 1, 1) || '@example.com' AS email_agendador,
         CAST(NULL AS VARCHAR) AS nombre_visitador, CAST(NULL AS VARCHAR) AS email_visitador,
         o_orderkey AS record_id
  FROM orders""",
    "property_master": f"""
  SELECT CAST(c_custkey + {K} AS BIGINT) AS nid,
         ' Agent_' || CAST(c_nationkey AS VARCHAR) || '@Example.com' AS c_comercial_captacion,
         c_mktsegment AS c_equipo_seller,
         '+57' || CAST(c_custkey AS VARCHAR) AS tel_fono_del_cliente_1,
         'Carrera ' || CAST(c_custkey AS VARCHAR) AS direccion,
         n_name AS ciudad,
         CASE WHEN c_acctbal >= 0 THEN CAST(DATE '2022-01-01' + CAST(FLOOR(c_acctbal / 4) AS INTEGER) AS TIMESTAMP) END AS c_fecha_captacion,
         CASE WHEN c_acctbal > 9000 THEN TIMESTAMP '2025-01-01 00:00:00' END AS v_fecha_venta,
         CASE WHEN c_acctbal >= 0 AND c_acctbal < 300 THEN TIMESTAMP '2025-06-01 00:00:00' END AS fecha_desistio_inmobiliaria,
         CASE WHEN c_nationkey >= 12 THEN CAST(DATE '2026-03-01' + CAST(FLOOR(c_acctbal / 100) AS INTEGER) AS TIMESTAMP) END AS date_publication,
         c_mktsegment AS c_tipo_contrato_firmado
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "crm_deal": f"""
  SELECT CAST(CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey + {UNKNOWN_OFFSET} ELSE s_suppkey + {K} END AS BIGINT) AS nid,
         CASE WHEN s_acctbal >= 0 THEN 'P1' ELSE 'P0' END AS pipeline,
         CAST(s_nationkey AS VARCHAR) AS dealstage,
         CASE WHEN s_nationkey = 5 THEN '' ELSE 'Owner_' || CAST(s_nationkey AS VARCHAR) || '@example.com' END AS hubspot_owner_id,
         CASE WHEN s_acctbal > 5000 THEN 'CRM_TEAM' WHEN s_acctbal > 2000 THEN '' END AS equipo_sellers,
         CASE WHEN s_acctbal > 9000 THEN TIMESTAMP '2025-03-01 00:00:00' END AS fecha_desistio_inmobiliaria
  FROM supplier""",
    "crm_deal_raw": f"""
  SELECT CAST(s_suppkey + {K} AS BIGINT) AS nid,
         CASE WHEN s_nationkey = 3 THEN 'NPH' WHEN s_nationkey = 4 THEN '' END AS flag_inmueble_nph
  FROM supplier""",
    "listing_card": f"""
  SELECT o_orderkey AS id, CAST(o_custkey + {K} AS BIGINT) AS nid,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS active
  FROM orders""",
    "listing_image": """
  SELECT l_orderkey AS property_card_id, CAST(l_quantity AS INTEGER) AS source_image_id,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS deleted_at
  FROM lineitem""",
    "listing_state": """
  SELECT l_orderkey AS property_card_id, l_linenumber AS current_state_id,
         l_shipdate AS date_publication
  FROM lineitem""",
    "process_history": f"""
  SELECT CAST(user_id + {K} AS BIGINT) AS nid,
         CASE WHEN value < 100 THEN 'pipeA' WHEN value < 200 THEN 'pipeB' ELSE 'pipeC' END AS pipe_id,
         event_type AS phase_name, ts AS first_time_in_phase, event_id AS record_id
  FROM events""",
    "clearance_tower": f"""
  SELECT CAST(CASE WHEN event_id % 10 = 0 THEN user_id + {UNKNOWN_OFFSET} ELSE user_id + {K} END AS BIGINT) AS nid,
         event_type AS v_concepto_del_defensor_de_familia,
         ts AS v_fecha_concepto_del_defensor_de_familia,
         'Client ' || CAST(user_id AS VARCHAR) AS v_nombre_cliente_1,
         '+1' || CAST(event_id AS VARCHAR) AS v_numero_telefonico_cliente_1,
         event_type AS v_flag_desistidos_patrimonio,
         ts AS v_fecha_inicio_fase_actual_patrimonio_de_familia,
         event_id AS record_id
  FROM events""",
    "intake_detail": f"""
  SELECT CAST(c_custkey + {K} AS BIGINT) AS nid,
         CASE WHEN c_acctbal >= 1000 THEN c_mktsegment END AS estado_patrimonio,
         CASE WHEN c_acctbal > 7000 THEN TIMESTAMP '2026-05-01 00:00:00' END AS date_publication
  FROM customer""",
    "seller_intake": f"""
  SELECT CAST(p_partkey + {K} AS BIGINT) AS nid, p_brand AS gravamenes_del_apartamento FROM part""",
    "seller_form": f"""
  SELECT CAST(p_partkey + {K} AS BIGINT) AS nid_1,
         CASE WHEN p_size > 40 THEN '' ELSE p_name END AS nombre_de_edificio_conjunto FROM part""",
    "status_log": f"""
  SELECT CAST(user_id * 10 + event_id % 10 + {K} AS VARCHAR) AS nid,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'perm' ELSE strftime(DATE '2001-07-01' + CAST((user_id * 10 + event_id % 10) % 28 AS INTEGER), '%Y-%m-%d') END AS fecha,
         CASE event_type
           WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'confirmada' ELSE 'cancelada' END
           WHEN 'click' THEN 'wa:1'
           WHEN 'error' THEN CASE WHEN value < 30 THEN 'cc:desistido' ELSE 'cc:llamado' END
           WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'ps:' ELSE 'ps:listo' END
           WHEN 'signup' THEN CASE WHEN value < 50 THEN 'pc:' WHEN value < 100 THEN 'jz:interesado' ELSE 'pc:nota' END
         END AS estado,
         CAST(NULL AS VARCHAR) AS usuario, ts AS "timestamp", event_id AS seq
  FROM events""",
    # first <ul> of every page; each <li> is a row, its <a> texts the cells
    "page_items": r"""
  SELECT page_id, url, unnest(cl) AS cells, generate_subscripts(cl, 1) - 1 AS row_pos
  FROM (
    SELECT page_id, url,
      list_transform(
        regexp_extract_all(regexp_extract(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1), '(?is)<li\b[^>]*>(.*?)</li\s*>', 1),
        lambda r: list_transform(regexp_extract_all(r, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1),
          lambda c: array_to_string(list_transform(string_split_regex(c, '<[^>]*>'),
            lambda s: regexp_replace(replace(replace(replace(replace(replace(replace(s, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
                                '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')), ''))) AS cl
    FROM pages)""",
    # every fifth report lies in a layout table, whose row counts as row 0
    "report_rows": f"""
  SELECT page_id AS doc_id,
         CASE WHEN starts_with(url, 'https') THEN 'reports@example.com' ELSE 'noreply@example.org' END AS sender,
         CAST(DATE '2026-03-01' + CAST(page_id % 60 AS INTEGER) AS TIMESTAMP) AS received_at,
         CAST(page_id % 31 + 1 AS VARCHAR) || ' de ' ||
           ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'][CAST(page_id % 12 + 1 AS INTEGER)] AS fecha_reporte,
         row_pos + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS row_pos, CAST(page_id + {K} AS VARCHAR) AS nid, cells[1] AS ciudad_correo,
         'Foto ' || CAST(row_pos AS VARCHAR) AS fotografo,
         CASE WHEN row_pos = 0 THEN 'si' ELSE cells[1] END AS resultado,
         row_pos = 0 OR upper(cells[1]) = 'SI' AS completado,
         CASE WHEN NOT (row_pos = 0 OR upper(cells[1]) = 'SI') THEN cells[1] END AS motivo
  FROM page_items WHERE len(cells) >= 1""",
    "photo_subject": f"""
  SELECT doc_id AS msg_id,
         CAST(DATE '2026-02-01' + CAST(doc_id % 90 AS INTEGER) AS TIMESTAMP) AS received_at,
         CASE WHEN lang = 'es' THEN 'Fotos cliente (' || CAST(doc_id + {K} AS VARCHAR) || ')'
              WHEN lang = 'en' THEN 'Fotos cliente ' || CAST(doc_id + {K} AS VARCHAR)
              WHEN lang = 'de' THEN 'FOTOS CLIENTE (' || CAST(doc_id + {K} AS VARCHAR) || ') ref ' || CAST(n_chars AS VARCHAR)
              ELSE 'Re: documento ' || CAST(doc_id + {K} AS VARCHAR) END AS subject
  FROM documents""",
    # link sheet: later tab wins; rows must carry a real URL
    "link_rows": f"""
  SELECT CAST(page_id + {K} AS VARCHAR) AS nid, url AS link, 0 AS tab_order, page_id AS row_order FROM pages
  UNION ALL
  SELECT CAST(page_id + {K} AS VARCHAR) AS nid,
         CASE WHEN contains(url, '#') THEN 'NO APLICA' ELSE regexp_replace(url, '^http:', 'https:') END AS link,
         1 AS tab_order, page_id AS row_order
  FROM pages""",
    "followup_rows": f"""
  SELECT CAST(doc_id + {K} AS VARCHAR) AS nid, source AS motivo, lang AS observaciones,
         CASE WHEN n_chars < 500 THEN 'Publicado' WHEN n_chars < 2000 THEN ' PUBLICADA ' ELSE 'No publicado' END AS estado,
         'Bogotá' AS fuente, 0 AS tab_order, doc_id AS row_order
  FROM documents WHERE lang = 'es'
  UNION ALL
  SELECT CAST(doc_id + {K} AS VARCHAR) AS nid, source AS motivo, CAST(NULL AS VARCHAR) AS observaciones,
         CASE WHEN n_chars < 500 THEN 'Publicado' WHEN n_chars < 2000 THEN ' PUBLICADA ' ELSE 'No publicado' END AS estado,
         'Ciudades' AS fuente, 1 AS tab_order, doc_id AS row_order
  FROM documents WHERE lang <> 'es'""",
    "team_lead": """
  SELECT equipo, CASE WHEN equipo = 'HOUSEHOLD' THEN ' ' ELSE lower(equipo) || '-lead@example.com' END AS email
  FROM (SELECT DISTINCT c_mktsegment AS equipo FROM customer)""",
}

DEPENDS = {"report_rows": ("page_items",)}


def with_roles(sql: str, *roles: str) -> str:
    """``WITH <role CTEs> <sql>``; ``sql`` may start with its own ``WITH``."""
    order: list[str] = []

    def add(r: str) -> None:
        for d in DEPENDS.get(r, ()):
            add(d)
        if r not in order:
            order.append(r)

    for r in roles:
        add(r)
    ctes = ",\n".join(f"{r} AS ({ROLE_SQL[r]}\n)" for r in order)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
