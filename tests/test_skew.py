"""The pre-aggregated card choice of R5 equals the plain join-then-filter form,
including a hot property that holds a large share of all cards."""

import datetime as dt
import random

from pyspark.sql import functions as F

from visitflow.operators import rules
from visitflow.operators.latest import first_per_key
from visitflow.params import Params
from visitflow.plans import reports as R
from visitflow.plans.bindings import Tables


def naive_choice(t, p, photos):
    """cd ⟕ cards ⟕ states, row filter, first row per key (the SQL form)."""
    pc = t.listing_card.select(F.col("id").alias("pc_id"), F.col("nid").alias("pc_nid"), F.col("active").alias("pc_active"))
    ps = t.listing_state.select(F.col("property_card_id").alias("ps_card"), F.col("current_state_id").alias("ps_state"))
    cd = t.property_master.select("nid").join(photos, "nid", "left")
    j = cd.join(pc, F.col("nid") == F.col("pc_nid"), "left").join(ps, F.col("pc_id") == F.col("ps_card"), "left")
    j = j.filter(rules.listing_not_dead("pc_active", "ps_state", p.dead_states)
                 & (~rules.listing_live_coalesced("pc_active", "ps_state", p.live_state)
                    | ~F.coalesce("p_360", F.lit(False))))
    first = first_per_key(j, ["nid"], [F.col("pc_id").asc_nulls_first(), F.col("ps_state").asc_nulls_first()])
    return first.select("nid", "pc_id", "ps_state")


def engine_choice(t, p, photos):
    cd = t.property_master.select("nid").join(photos, "nid", "left")
    c = cd.join(R._card_choice(t, p, t.listing_card), F.col("nid") == F.col("card_nid"), "left")
    c = c.withColumn("best", F.when(F.coalesce("p_360", F.lit(False)), F.col("best_not_live"))
                     .otherwise(F.col("best_any")))
    c = c.filter(F.col("card_nid").isNull() | F.col("best").isNotNull())
    return c.select("nid", F.col("best.pc_id").alias("pc_id"), F.col("best.ps_state").alias("ps_state"))


def test_card_choice_matches_naive_form_under_skew(spark):
    rnd = random.Random(11)
    nids = list(range(1, 41))
    cards, states, card_id = [], [], 0
    for nid in nids:
        n = 600 if nid == 1 else rnd.randint(0, 4)          # property 1 holds most of the cards
        for _ in range(n):
            card_id += 1
            cards.append((card_id, nid, rnd.choice([0, 1, 1, None])))
            for _ in range(rnd.randint(0, 2)):                # cards with no state, one or two states
                states.append((card_id, rnd.choice([1, 2, 2, 3, 5, 8, None])))
    t = Tables()
    t["property_master"] = spark.createDataFrame([(n,) for n in nids], "nid bigint")
    t["listing_card"] = spark.createDataFrame(cards, "id bigint, nid bigint, active int")
    t["listing_state"] = spark.createDataFrame(states, "property_card_id bigint, current_state_id int")
    photos = spark.createDataFrame([(n, n % 3 == 0) for n in nids if n % 2], "nid bigint, p_360 boolean")
    p = Params(as_of=dt.date(2026, 4, 23), visit_types=(), visit_categories=(), report_sender="")
    a, b = naive_choice(t, p, photos), engine_choice(t, p, photos)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
