"""Spreadsheet tabs exported as CSV.

Header names drift (accents, case, BOM, spacing); a logical column is found
by the first alias, in priority order, that equals a header after
strip+lower.  Header resolution is metadata only: no rows are read for it.
Later tabs (and later rows) override earlier ones for the same key.  The order
of rows is explicit: every tab carries ``SEQ`` (file, then place in the file),
and operators that need an order refuse a frame without it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip

BOM = "﻿"
#: Order of the rows of a tab: struct<file:string,pos:bigint>.
SEQ = "__seq"
#: Cells as spreadsheets write them: quoted line breaks, commas and doubled quotes.
CSV = {"header": True, "encoding": "UTF-8", "inferSchema": False, "mode": "PERMISSIVE", "multiLine": True, "quote": '"', "escape": '"'}

# --- fixed values: header aliases, in priority order -----------------------
LINK_ALIASES = {
    "nid": ("NID", "nid"),
    "link": ("Link Publicación", "Link Publicacion", "link_publicacion",
             "Link publicación", "link publicacion"),
}
REASON_ALIASES = {
    "nid": ("nid", "NID", "Nid", "id", "ID"),
    "motivo": ("motivo", "Motivo", "Razon", "Razón", "Causa", "Motivo no publicar",
               "Motivo por el que no se publica"),
    "observaciones": ("observaciones", "Observaciones", "Observaciones generales", "Obs",
                      "Comentario", "Comentarios", "Notas"),
}
PUBLISHED_ALIASES = {
    "nid": ("nid", "NID"),
    "estado": ("Estado Publicación", "Estado Publicacion", "estado publicacion",
               "estado publicación"),
}
PUBLISHED_PREFIX = "publicad"
# ---------------------------------------------------------------------------


def in_file_order(df: DataFrame) -> DataFrame:
    """Add ``SEQ`` to a file scan.  A file with quoted line breaks is read by
    one task, so ids that grow within a task follow the order of its lines."""
    return df.withColumn(SEQ, F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos")))


def with_order(df: DataFrame, column: str) -> DataFrame:
    """``SEQ`` of a frame that is not a file, from a column that orders its rows."""
    return df.withColumn(SEQ, F.struct(F.lit("").alias("file"), F.col(column).cast("bigint").alias("pos")))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """CSV tab, UTF-8, every column a string, BOM removed from the header (S3); carries ``SEQ``."""
    df = spark.read.options(**CSV).csv(path)
    df = in_file_order(df)
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def find_header(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """The column named by the first alias that occurs; of equal headers the leftmost."""
    named: dict[str, str] = {}
    for column in columns:
        named.setdefault((column or "").strip().lower(), column)
    return next((named[a] for a in map(str.lower, aliases) if a in named), None)


def resolve_header(df: DataFrame, aliases: Mapping[str, Sequence[str]],
                   required: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame | None:
    """Project logical columns out of drifting headers.

    Missing optional columns become null; a missing required column returns
    ``None`` (the tab is skipped, like the original).  ``keep`` names columns
    that pass through.
    """
    picked = {k: find_header(df.columns, a) for k, a in aliases.items()}
    if any(picked[k] is None for k in required):
        return None
    return df.select(*[(F.col(f"`{c}`") if c is not None else F.lit(None).cast("string")).alias(k)
                       for k, c in picked.items()], *keep)


def union_tabs(tabs: Sequence[tuple[DataFrame, str]], aliases: Mapping[str, Sequence[str]],
               required: Sequence[str]) -> DataFrame:
    """Resolved tabs stacked with ``fuente`` (tab label), ``tab_order`` and
    ``row_order`` (``SEQ`` of the tab) (S5)."""
    parts = []
    for i, (df, label) in enumerate(tabs):
        if SEQ not in df.columns:
            raise ValueError(f"tab {label!r} has no row order; read it with read_sheet or add with_order")
        r = resolve_header(df, aliases, required, keep=[SEQ])
        if r is None:
            continue
        parts.append(r.withColumn("fuente", F.lit(label))
                     .withColumn("tab_order", F.lit(i))
                     .withColumnRenamed(SEQ, "row_order"))
    if not parts:
        raise ValueError("no tab has the required columns")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def last_wins(df: DataFrame, key: str = "nid") -> DataFrame:
    """Later tab, then later row, overrides earlier for the same key."""
    w = Window.partitionBy(key).orderBy(F.col("tab_order").desc(), F.col("row_order").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lookup_links(tabs: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``nid -> link`` for real URLs only ("NO APLICA", "N/A" are skipped)."""
    u = union_tabs(tabs, LINK_ALIASES, ("nid", "link"))
    u = (u.withColumn("nid", F.coalesce(strip("nid"), F.lit("")))
         .withColumn("link", F.coalesce(strip("link"), F.lit(""))))
    u = u.filter((F.col("nid") != "") & F.lower("link").startswith("http"))
    return last_wins(u).select("nid", "link")


def lookup_reasons(tabs: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``nid -> (motivo, observaciones, fuente)``."""
    u = union_tabs(tabs, REASON_ALIASES, ("nid",))
    u = u.select(F.coalesce(strip("nid"), F.lit("")).alias("nid"),
                 F.coalesce(strip("motivo"), F.lit("")).alias("motivo"),
                 F.coalesce(strip("observaciones"), F.lit("")).alias("observaciones"),
                 "fuente", "tab_order", "row_order")
    u = u.filter(F.col("nid") != "")
    return last_wins(u).select("nid", "motivo", "observaciones", "fuente")


def sheet_published(tabs: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Keys whose publication status starts with 'publicad' (R11)."""
    u = union_tabs(tabs, PUBLISHED_ALIASES, ("nid", "estado"))
    u = u.select(F.coalesce(strip("nid"), F.lit("")).alias("nid"),
                 F.lower(F.coalesce(strip("estado"), F.lit(""))).alias("estado"))
    return u.filter((F.col("nid") != "") & F.col("estado").startswith(PUBLISHED_PREFIX)) \
        .select("nid").distinct()


# --- fixed values: header names of the status sheet ------------------------
STATUS_ALIASES = {"nid": ("nid",), "fecha": ("fecha",), "estado": ("estado",), "usuario": ("usuario",)}
# ---------------------------------------------------------------------------


def read_status_log(spark: SparkSession, path: str) -> DataFrame:
    """Status read by header (S6): (nid, fecha, estado, usuario, seq); a missing
    optional column is null, ``seq`` is the order of files and lines."""
    rows = resolve_header(read_sheet(spark, path), STATUS_ALIASES, ("nid", "fecha", "estado"), keep=[SEQ])
    if rows is None:
        raise ValueError(f"{path}: the status log needs the headers nid, fecha and estado")
    return rows.withColumnRenamed(SEQ, "seq")


def read_status_log_positional(spark: SparkSession, path: str) -> DataFrame:
    """Positional status read (S7): the header line is skipped, columns are
    taken by position, rows with fewer than three cells are dropped and an
    empty third cell is kept as ''.  ``seq`` is the order of files and lines.

    The CSV parser returns an unquoted empty cell as null, like a missing
    one; a row whose cell count differs from the three-column schema is
    flagged in ``_corrupt``, which tells a short row from an empty cell.
    """
    schema = "nid string, fecha string, estado string, _corrupt string"
    raw = spark.read.schema(schema).options(**CSV).option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    unquoted = F.regexp_replace("_corrupt", '"([^"]|"")*"', "")
    keep = F.col("_corrupt").isNull() | (F.size(F.split(unquoted, ",")) >= 3)
    rows = in_file_order(raw).filter(keep)
    return rows.select("nid", "fecha", F.coalesce(F.col("estado"), F.lit("")).alias("estado"), F.col(SEQ).alias("seq"))
