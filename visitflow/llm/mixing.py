"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Token counts are added up per cell (source, language, topic).  Raking scales
the cells in turn to the target share of every source, language and topic until
all three marginals hold.  A cell's calibrated weight over its tokens, divided
by the largest such ratio, is the probability with which its documents are
kept: the sample then has the target mix in expectation, no document is taken
twice, and each document's draw is a hash of its id and the seed.

Cells number at most |sources| * |languages| * |topics|; only they are raked.

Defined results: null source or language is a level of its own (``''``); a null
or empty text has no tokens and weighs nothing, its document is kept with its
cell's probability (0 when the whole cell has no tokens or its target is 0).
Rows repeated with one id share one draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, staged

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 12
#: Target share of a level: its own share to this power, normalised (1: as is, 0: all levels alike).
TEMPER = 0.9


def topic_of(text: Column) -> Column:
    """Rule-based register of a whole text, used as its topic."""
    return (F.when(text.contains("@"), "contact").when(text.contains(" | "), "table")
            .when(text.rlike("(?i)licen[cs]e"), "licence")
            .when(F.length(text) >= 2000, "long").otherwise("short"))


def weighed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens); tokens are words between white space."""
    text = F.coalesce("text", F.lit(""))
    # each word starts after white space or at the start: its first letter counts it
    tokens = F.regexp_count(text, F.lit("(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D]")).cast("long")
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                       topic_of(text).alias("topic"), tokens.alias("tokens"))


def cells_of(rows: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    return rows.groupBy(*dimensions).agg(F.sum("tokens").alias("tokens"))


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """Target shares (level, share) from the data's own shares."""
    share = F.pow(F.col("tokens").cast("double"), F.lit(power))
    level = cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = level.agg(F.sum(share).alias("total"))
    return level.select("level", (share / total.scalar()).alias("share"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: the calibrated share of all tokens.

    ``targets``: dimension -> (level, share); a level without a target gets 0.
    """
    cells = cells.where("tokens > 0")
    total = cells.agg(F.sum("tokens")).scalar()
    out = cells.withColumn("weight", F.col("tokens") / total)
    for dim, target in targets.items():
        out = out.join(target.select(F.col("level").alias(dim), F.col("share").alias(f"_{dim}")), dim, "left").fillna(0.0, [f"_{dim}"])
    for r in range(rounds):
        for dim in targets:
            have = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"_{dim}") / have).otherwise(F.lit(0.0)))
        if r % 4 == 3:
            out = staged(out, "mix-raked")  # cuts the growing plan
    return out.select(*cells.columns, "weight")


def probabilities(weights: DataFrame) -> DataFrame:
    """``keep_prob`` per cell: weight over tokens, the largest ratio scaled to 1."""
    ratio = F.col("weight") / F.col("tokens")
    top = weights.agg(F.max(ratio)).scalar()
    return weights.withColumn("keep_prob", F.when(top > 0, F.round(ratio / top, 9)).otherwise(F.lit(0.0)))


def draw(key: Column, seed: int) -> Column:
    """Uniform in [0, 1) from the id and the seed."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mixed(rows: DataFrame, targets: dict[str, DataFrame] | None = None, seed: int = 7, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (see ``weighed``) with keep_prob, draw and kept."""
    cells = staged(cells_of(rows), "mix-cells")
    targets = targets or {d: tempered(cells, d) for d in DIMENSIONS}
    prob = staged(probabilities(raked(cells, targets, rounds)).select(*DIMENSIONS, "keep_prob"), "mix-probabilities")
    # the rows stay where they are when the cells are few enough for Spark's own size check
    out = rows.join(prob, list(DIMENSIONS), "left").withColumn("keep_prob", F.coalesce("keep_prob", F.lit(0.0)))
    return out.withColumn("draw", draw(F.col("doc_id"), seed)).withColumn("kept", F.col("draw") < F.col("keep_prob"))


def mix_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    return mixed(staged(weighed(docs), "mix-rows"), seed=seed).select("doc_id", "source", "lang", "topic", "tokens", "keep_prob", "draw", "kept")


def sample(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents kept by ``mix_documents``, with their own columns."""
    rows = staged(weighed(docs), "mix-rows").drop("doc_id")
    cells = staged(cells_of(rows), "mix-cells")
    prob = probabilities(raked(cells, {d: tempered(cells, d) for d in DIMENSIONS}))
    prob = staged(prob.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.col("keep_prob").alias("__keep_prob")), "mix-probabilities")
    at = ((F.coalesce(docs["source"], F.lit("")) == prob["__source"]) & (F.coalesce(docs["lang"], F.lit("")) == prob["__lang"])
          & (topic_of(F.coalesce(docs["text"], F.lit(""))) == prob["__topic"]))
    return docs.join(prob, at, "inner").where(draw(F.col("doc_id"), seed) < F.col("__keep_prob")).select(*docs.columns)


def _oracle(seed: int = 7, rounds: int = ROUNDS) -> str:
    parts = [r"""
WITH n AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
rows_ AS (SELECT doc_id, source, lang,
  CASE WHEN contains(t, '@') THEN 'contact' WHEN contains(t, ' | ') THEN 'table'
       WHEN regexp_matches(t, '(?i)licen[cs]e') THEN 'licence' WHEN length(t) >= 2000 THEN 'long' ELSE 'short' END AS topic,
  CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM n),
w0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens, sum(tokens) / (SELECT sum(tokens) FROM rows_) AS weight
  FROM rows_ GROUP BY ALL HAVING sum(tokens) > 0)"""]
    for d in DIMENSIONS:
        parts.append(f"""
t_{d} AS MATERIALIZED (SELECT {d}, sum(tokens) ^ {TEMPER} / sum(sum(tokens) ^ {TEMPER}) OVER () AS share FROM w0 GROUP BY {d})""")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            k += 1
            parts.append(f"""
w{k} AS MATERIALIZED (SELECT w.* REPLACE (weight * share / sum(weight) OVER (PARTITION BY w.{d}) AS weight) FROM w{k - 1} w JOIN t_{d} USING ({d}))""")
    return ",".join(parts) + f""",
p AS (SELECT source, lang, topic, round(weight / tokens / max(weight / tokens) OVER (), 9) AS keep_prob FROM w{k}),
u AS (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{seed}'), 1, 8) AS UBIGINT) / 4294967296.0 AS draw FROM rows_)
SELECT doc_id, source, lang, topic, tokens, coalesce(keep_prob, 0) AS keep_prob, CAST(draw AS DOUBLE) AS draw,
       CAST(draw AS DOUBLE) < coalesce(keep_prob, 0) AS kept
FROM u LEFT JOIN p USING (source, lang, topic)"""


ORACLE = _oracle()
