"""Status-log folds (B1, R12 input, R19 input) and keyed state upserts.

The status log is append-only ``(nid, fecha, estado, seq)``; ``seq`` is the
append order.  A fold is a ``groupBy(nid, kind).agg(max_by(value, seq))``:
partial aggregation on every map task, one shuffle on (nid, kind), no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# --- fixed values: status prefixes and the output kind each one feeds ------
DAILY_PREFIXES = {"wa:": "whatsapp", "cc:": "cancelContacto"}
PERM_PREFIXES = ("ps:", "pc:", "sf:", "sc:", "jz:", "fc:", "fd:", "cd:")
# prefix -> (kind, needs a non-empty value)
PERM_KINDS = {
    "ps:": ("pubEstado", True),
    "pc:": ("pubComentario", False),
    "sf:": ("sfEstado", True),
    "sc:": ("sfComentario", False),
    "fc:": ("fcEstado", True),
    "fd:": ("fcComentario", False),
    "jz:": ("juzgado", True),
    "cd:": ("cancelDesistido", True),
}
PERM_SCOPE = "perm"
WITHDRAWN = "desistido"
KINDS = ("visita", "whatsapp", "cancelContacto", "cancelDesistido", "pubEstado",
         "pubComentario", "sfEstado", "sfComentario", "fcEstado", "fcComentario", "juzgado")
FLAG_KINDS = ("whatsapp", "cancelDesistido")
# ---------------------------------------------------------------------------


def clean_log(log: DataFrame) -> DataFrame:
    """Header-read log: trimmed text, null -> '' (S6)."""
    return log.select(*[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in ("nid", "fecha", "estado")],
                      F.col("seq"))


def _entries(day: str) -> Column:
    """Array of (kind, value) entries one log row contributes."""
    est, fecha = F.col("estado"), F.col("fecha")
    p = F.substring(est, 1, 3)
    v = F.substr(est, F.lit(4))
    daily = fecha == F.lit(day)
    perm = fecha == F.lit(PERM_SCOPE)

    def entry(kind, value) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    # Daily scope: first matching branch wins, like an if/elif chain.
    daily_kind = (F.when(p == "wa:", entry("whatsapp", F.lit("true")))
                  .when(p == "cc:", entry("cancelContacto", v))
                  .when(~p.isin(*PERM_PREFIXES), entry("visita", est)))
    daily_extra = F.when((p == "cc:") & (v == WITHDRAWN), entry("cancelDesistido", F.lit("true")))
    perm_kind = None
    for prefix, (kind, needs_value) in PERM_KINDS.items():
        cond = (p == prefix) & (v != "") if needs_value else (p == prefix)
        val = F.lit("true") if kind == "cancelDesistido" else v
        perm_kind = (F.when(cond, entry(kind, val)) if perm_kind is None
                     else perm_kind.when(cond, entry(kind, val)))
    items = F.array(F.when(daily, daily_kind), F.when(daily, daily_extra), F.when(perm, perm_kind))
    return F.filter(items, lambda e: e.isNotNull())


def status_entries(log: DataFrame, day: str) -> DataFrame:
    """(nid, seq, kind, value): what each log row says, batch or streaming.

    Daily kinds read rows dated ``day``; permanent kinds read rows dated ``'perm'``."""
    rows = clean_log(log).filter((F.col("nid") != "") & (F.col("estado") != ""))
    rows = rows.filter(F.col("fecha").isin(day, PERM_SCOPE))
    return rows.select("nid", "seq", F.explode(_entries(day)).alias("e")).select("nid", "seq", "e.kind", "e.value")


def status_fold(log: DataFrame, day: str) -> DataFrame:
    """Current shared status in long form ``(nid, kind, value)`` (B1 / R12): the
    last write (highest ``seq``) wins per (nid, kind)."""
    return status_entries(log, day).groupBy("nid", "kind").agg(F.max_by("value", "seq").alias("value"))


def status_wide(log: DataFrame, day: str) -> DataFrame:
    """Current shared status, one row per key with a column per kind (R12): the
    original's eleven maps.  Where a map lacks the key the column is null; flags are true or null.

    One conditional aggregate per kind: the log is shuffled once, pre-aggregated."""
    def column(kind: str) -> Column:
        last = F.max_by("value", F.when(F.col("kind") == kind, F.col("seq")))
        return (last == "true" if kind in FLAG_KINDS else last).alias(kind)

    return status_entries(log, day).groupBy("nid").agg(*[column(k) for k in KINDS])


def day_status(log: DataFrame, day: str) -> DataFrame:
    """Positional read used by the coordinator summary (S7 / R19): rows dated
    ``day``, no prefix filter, last row per nid wins even when blank."""
    rows = clean_log(log).filter(F.col("fecha") == F.lit(day))
    return rows.groupBy("nid").agg(F.max_by("estado", "seq").alias("estado"))


def state_upsert(current: DataFrame, updates: DataFrame,
                 keys=("fecha", "nid"), value: str = "estado", seq: str = "seq") -> DataFrame:
    """Keyed upsert with tombstones (S11): the latest write per key wins and
    an empty value deletes the key.  ``current`` rows rank below any update."""
    cur = current.select(*keys, value, F.lit(-1).cast("bigint").alias(seq))
    upd = updates.select(*keys, F.coalesce(F.col(value), F.lit("")).alias(value), F.col(seq).cast("bigint"))
    merged = cur.unionByName(upd)
    latest = merged.groupBy(*keys).agg(F.max_by(value, seq).alias(value))
    return latest.filter(F.col(value) != "")
