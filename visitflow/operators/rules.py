"""Business rules (B2-B10) as Column predicates or small keyed DataFrames.

The original reports use slightly different variants of the same rule in
different places; each variant is a parameter here, never silently unified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import col_
from ..functions.dates import lit_date
from .latest import latest_per_key


def photo_keyset(cards: DataFrame, images: DataFrame, source_id: int,
                 exclude_deleted: bool = False, as_string: bool = False) -> DataFrame:
    """Distinct ``nid`` of cards holding an image of ``source_id`` (B2).

    Images are filtered (pushed to their scan) before the join; the join is
    on the card id and only the key column leaves it.
    """
    img = images.filter(F.col("source_image_id") == F.lit(source_id))
    if exclude_deleted:
        img = img.filter(F.col("deleted_at").isNull())
    img = img.select(F.col("property_card_id").alias("_cid")).distinct()
    keys = cards.select("id", "nid").join(img, F.col("id") == F.col("_cid"), "inner")
    k = F.col("nid").cast("string") if as_string else F.col("nid")
    return keys.select(k.alias("nid")).filter(F.col("nid").isNotNull()).distinct()


def photo_flags(cards: DataFrame, images: DataFrame, sources: dict,
                exclude_deleted: bool = False) -> DataFrame:
    """Several photo-source key sets in one pass over the images (B2).

    ``sources`` maps a flag name to a source id, or to ``(source id,
    exclude_deleted)`` when flags differ in whether deleted images count.
    The result has one row per ``nid`` holding any of the sources and a
    boolean column per flag.  The image table (the largest input) is scanned
    and shuffled once instead of once per flag.
    """
    spec = {k: (v if isinstance(v, tuple) else (v, exclude_deleted)) for k, v in sources.items()}
    img = images.filter(F.col("source_image_id").isin(sorted({s for s, _ in spec.values()})))
    if all(ex for _, ex in spec.values()):
        img = img.filter(F.col("deleted_at").isNull())
    img = img.select(F.col("property_card_id").alias("_cid"), F.col("source_image_id").alias("_src"),
                     F.col("deleted_at").isNull().alias("_live")).distinct()
    j = cards.select("id", "nid").filter(F.col("nid").isNotNull()).join(img, F.col("id") == F.col("_cid"), "inner")
    flags = [F.bool_or((F.col("_src") == F.lit(s)) & (F.col("_live") if ex else F.lit(True))).alias(k)
             for k, (s, ex) in spec.items()]
    return j.groupBy("nid").agg(*flags)


def patrimony_v1(state, encumbrance, ok: Sequence[str], deny: Sequence[str]) -> Column:
    """State in the allow-list, or no state and an encumbrance not denied."""
    s, g = col_(state), col_(encumbrance)
    return s.isin(list(ok)) | (s.isNull() & (g.isNull() | ~g.isin(list(deny))))


def patrimony_v2(flag, contract, done: str, in_process: str, contract_value: str) -> Column:
    """Flag done, or a contract without patrimony and a flag not in process."""
    f, c = col_(flag), col_(contract)
    return (f == F.lit(done)) | ((F.coalesce(c, F.lit("")) != F.lit(contract_value))
                                 & (F.coalesce(f, F.lit("")) != F.lit(in_process)))


def publication_ok(date_publication, has_client_photos, cutoff) -> Column:
    """Unpublished, or client photos and published on/after the cutoff."""
    d = col_(date_publication)
    return d.isNull() | (col_(has_client_photos) & (F.to_date(d) >= lit_date(cutoff)))


def active_pipeline(captured=None, master_withdrawn=None, crm_withdrawn=None, sold=None,
                    stage=None, lost_stage: str | None = None) -> Column:
    """Captured, not withdrawn (either source), not sold, stage not lost.

    Pass only the parts a report checks; the variants differ per report.
    """
    cond = F.lit(True)
    if captured is not None:
        cond = cond & col_(captured).isNotNull()
    if master_withdrawn is not None:
        cond = cond & col_(master_withdrawn).isNull()
    if crm_withdrawn is not None:
        cond = cond & col_(crm_withdrawn).isNull()
    if sold is not None:
        cond = cond & col_(sold).isNull()
    if stage is not None:
        st = col_(stage)
        cond = cond & (st.isNull() | (st != F.lit(lost_stage)))
    return cond


def cancelled_for_real(status, report_date, modified_date, cancel_statuses: Sequence[str],
                       done_status: str) -> Column:
    """Status is a cancel status, or the report is newer than the last change
    and the status is not done; a null status counts as "not done" (B7)."""
    s, r, m = col_(status), col_(report_date), col_(modified_date)
    direct = F.coalesce(s.isin(list(cancel_statuses)), F.lit(False))
    stale = (~s.eqNullSafe(F.lit(done_status))) & r.isNotNull() & m.isNotNull() & (r > m)
    return direct | F.coalesce(stale, F.lit(False))


def listing_live(active, state, live_state: int) -> Column:
    """``active = 1 AND state = live``."""
    return (col_(active) == F.lit(1)) & (col_(state) == F.lit(live_state))


def listing_not_dead(active, state, dead_states: Sequence[int]) -> Column:
    """``COALESCE(active,1) != 0 AND COALESCE(state,0) NOT IN dead``."""
    return ((F.coalesce(col_(active), F.lit(1)) != F.lit(0))
            & ~F.coalesce(col_(state), F.lit(0)).isin(list(dead_states)))


def listing_live_coalesced(active, state, live_state: int) -> Column:
    """``COALESCE(active,0) = 1 AND COALESCE(state,0) = live``."""
    return ((F.coalesce(col_(active), F.lit(0)) == F.lit(1))
            & (F.coalesce(col_(state), F.lit(0)) == F.lit(live_state)))


def _key(as_string: bool) -> Column:
    return F.col("nid").cast("string").alias("nid") if as_string else F.col("nid")


def active_phase_keys(history: DataFrame, pipes: Sequence[str], closed: Sequence[str],
                      as_string: bool = True) -> DataFrame:
    """Keys whose latest phase in ``pipes`` is not closed."""
    h = history.filter(F.col("pipe_id").isin(list(pipes)))
    last = latest_per_key(h, "nid", "first_time_in_phase", tiebreak="record_id")
    return last.filter(~F.col("phase_name").isin(list(closed))).select(_key(as_string))


def first_final_phase(history: DataFrame, pipes: Sequence[str], finals: Sequence[str],
                      as_string: bool = True) -> DataFrame:
    """First date each key reached a final phase."""
    return (history.filter(F.col("pipe_id").isin(list(pipes))
                           & F.col("phase_name").isin(list(finals))
                           & F.col("nid").isNotNull())
            .groupBy(_key(as_string))
            .agg(F.min(F.to_date("first_time_in_phase")).alias("fecha_levant")))


def latest_flag(tower: DataFrame, as_string: bool = True) -> DataFrame:
    """Latest patrimony flag per key, not filtered before ranking."""
    last = latest_per_key(tower, "nid", "v_fecha_inicio_fase_actual_patrimonio_de_familia",
                          tiebreak="record_id")
    return last.select(_key(as_string), F.col("v_flag_desistidos_patrimonio").alias("flag"))


def unfavourable_opinions(tower: DataFrame, as_of, unfavourable: str, months: int,
                          as_string: bool = True) -> DataFrame:
    """Latest unfavourable opinion per key within the lookback, filtered
    before ranking (W3)."""
    t = tower.filter((F.lower("v_concepto_del_defensor_de_familia") == F.lit(unfavourable))
                     & (F.to_date("v_fecha_concepto_del_defensor_de_familia")
                        >= F.add_months(lit_date(as_of), -months)))
    last = latest_per_key(t, "nid", "v_fecha_concepto_del_defensor_de_familia", tiebreak="record_id")
    return last.select(
        _key(as_string),
        F.to_date("v_fecha_concepto_del_defensor_de_familia").alias("fecha_desfavorable"),
        F.col("v_concepto_del_defensor_de_familia").alias("concepto"),
        F.col("v_nombre_cliente_1").alias("nombre_cliente_plano"),
        F.col("v_numero_telefonico_cliente_1").alias("telefono_plano"))
