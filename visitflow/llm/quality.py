"""Quality classifier by Bradley-Terry pairwise ranking.

A document has a latent score linear in features of its whole text.  Labelled
rows give preference pairs (a label-1 document is preferred to a label-0 one);
the weights minimise the mean logistic loss of the feature differences of all
pairs.  The cut is a quantile of the training scores: the share of label 0 among
all labelled training rows.  Scores are shifted so that the cut lies at ``CUT``.

The fit uses all labelled rows.  The loss of a pair depends on the difference of
two latent scores, so a Newton step needs the rows only as sums by score: each row
is dealt between the two nearest points of a grid over all scores, Spark adds up
the tasks' grids, and the driver, which holds nothing but one grid a class, goes
through all pairs of points.  The cut is exact: counts by score narrow down to the
two rows beside it.

Features of every document come from its whole text.  It is read in blocks that
end at white space (words) or at a line break (lines), with one set of distinct
words and one of distinct lines for the whole text, so no feature depends on the
block size.

Defined results: a null text is the empty text and gets a score; labels that
are null, without an id, or contradict each other for one id are not used; with
no pair to learn from, every score is 0.5.  Repeated rows get equal scores.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from .common import staged

CUT = 0.3
BLOCK = 1 << 16
FEATURES = 17
#: Points of the grids over all scores: for sums of the features, and for sums of their products, which only set the
#: length of a step.
POINTS, COARSE = 2048, 64
#: Tasks' sums are added up in so many parts before they reach the driver.
PARTS = 16
#: Ranges of scores that are counted at once for the cut.
BINS = 1024
_SPACE = re.compile(rb"\s")
_BREAK = re.compile(rb"\n")


def _blocks(data: bytes, end_of: re.Pattern) -> Iterator[bytes]:
    """Pieces of at least ``BLOCK`` bytes, each up to a place where ``end_of`` matches."""
    at = 0
    while at < len(data):
        found = end_of.search(data, at + BLOCK)
        end = found.end() if found else len(data)
        yield data[at:end]
        at = end


def text_features(text: str | None) -> np.ndarray:
    """Features of one whole text: shares of letter and sign classes, repetition, length."""
    data = (text or "").encode("utf-8", "replace")
    counts = np.zeros(256, np.int64)
    words = again = breaks = 0
    distinct, lines, last = set(), set(), []
    for block in _blocks(data, _SPACE):
        counts += np.bincount(np.frombuffer(block, np.uint8), minlength=256)
        tokens = block.split()
        words += len(tokens)
        distinct.update(tokens)
        line = last + tokens
        again += sum(map(operator.eq, line, line[1:]))
        last = line[-1:]
    for block in _blocks(data, _BREAK):
        breaks += block.count(b"\n")
        lines.update(block.removesuffix(b"\n").split(b"\n"))
    # a text that ends with a break ends with an empty line
    if data.endswith(b"\n") or not data:
        lines.add(b"")
    n, w = max(1, len(data)), max(1, words)
    letters = max(1, counts[65:91].sum() + counts[97:123].sum())
    signs = counts[[35, 36, 37, 38, 42, 64, 94, 126]].sum()
    shares = np.array([
        counts[65:91].sum() / letters, counts[48:58].sum() / n, counts[128:].sum() / n,
        min(1.0, counts[33] / w), min(1.0, counts[124] / w), min(1.0, signs / w), min(1.0, counts[[44, 46, 58, 59]].sum() / w),
        again / w, 1 - len(distinct) / w if words else 0.0, 1 - len(lines) / (breaks + 1), counts[10] / n])
    return np.concatenate([shares, np.sqrt(shares[[0, 3, 4, 5, 7]]), [np.log1p(words) / 10]])


@dataclass
class Ranker:
    """Weights on standardised features, and the score at the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        latent = ((features - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(latent - self.cut + np.log(CUT / (1 - CUT)), -30, 30)))


SUMS = "task int, sums binary"


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of the sums; tasks are added in their order."""
    rows = rows.sort_values("task")
    return pd.DataFrame({"task": [rows["task"].iloc[0]], "sums": [sum(map(np.frombuffer, rows["sums"])).tobytes()]})


def _totals(rows: DataFrame, size: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``of`` (features, labels) -> ``size`` sums, added up over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                features = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                sums += of(features, batch.column(0).to_numpy())
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["task", "sums"])

    parts = rows.select("quality", "f").mapInArrow(run, SUMS).groupBy(F.col("task") % PARTS).applyInPandas(lambda part: _added(part), SUMS).toPandas()
    return np.frombuffer(_added(parts)["sums"].iloc[0]).copy() if len(parts) else np.zeros(size)


def grid(reach: float, points: int) -> np.ndarray:
    """Points from -reach to reach, dense around 0."""
    return np.sinh(np.linspace(-np.arcsinh(reach), np.arcsinh(reach), points))


def grid_sums(grid: np.ndarray, latent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows' values at the grid's points; a row counts at the two points beside it, more at the nearer one."""
    at = np.clip(np.searchsorted(grid, latent, "right") - 1, 0, len(grid) - 2)
    far = np.clip((latent - grid[at]) / (grid[at + 1] - grid[at]), 0, 1)
    return np.stack([np.bincount(at, v * (1 - far), len(grid)) + np.bincount(at + 1, v * far, len(grid)) for v in values.T], 1)


def _moved(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean loss of all pairs at ``w``."""
    fine, coarse, k = grid(reach, POINTS), grid(reach, COARSE), len(w)
    wide = 1 + k + k * k

    def of(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
        out = []
        for label in (0, 1):
            x = (features[labels == label] - mean) / scale
            ones, latent = np.ones((len(x), 1)), x @ w
            out.append(grid_sums(fine, latent, np.concatenate([ones, x], 1)).ravel())
            out.append(grid_sums(coarse, latent, np.concatenate([ones, x, (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)], 1)).ravel())
        return np.concatenate(out)

    half = POINTS * (1 + k) + COARSE * wide
    low, high = _totals(rows, 2 * half, of).reshape(2, half)
    pairs = low[:POINTS * (1 + k)].reshape(POINTS, -1)[:, 0].sum() * high[:POINTS * (1 + k)].reshape(POINTS, -1)[:, 0].sum()

    def wrong(points: np.ndarray) -> np.ndarray:
        """Chance that a pair of a high row at one point and a low one at another is ranked wrongly."""
        p = points[:, None] - points
        np.exp(np.clip(p, -30, 30, out=p), out=p)
        p += 1
        return np.reciprocal(p, out=p)

    (n0, m0), (n1, m1) = ((t[:, 0], t[:, 1:]) for t in (c[:POINTS * (1 + k)].reshape(POINTS, -1) for c in (low, high)))
    p = wrong(fine)
    slope = (m1.T @ (p @ n0) - m0.T @ (n1 @ p)) / pairs
    (n0, m0, s0), (n1, m1, s1) = ((t[:, 0], t[:, 1:1 + k], t[:, 1 + k:]) for t in (c[POINTS * (1 + k):].reshape(COARSE, -1) for c in (low, high)))
    p = wrong(coarse)
    q = p * (1 - p)
    cross = m1.T @ q @ m0
    return slope, (((q @ n0) @ s1 + (n1 @ q) @ s0).reshape(k, k) - cross - cross.T) / pairs


def fit_pairs(rows: DataFrame, share_low: float, ridge: float = 1e-3, steps: int = 25) -> Ranker | None:
    """Bradley-Terry weights by Newton steps on the logistic loss of all pairs of ``rows`` (quality, f); None without pairs."""

    def moments(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return np.concatenate([[(labels == 0).sum(), (labels == 1).sum()], features.sum(0), (features * features).sum(0)])

    total = _totals(rows, 2 + 2 * FEATURES, moments)
    n_low, n_high = total[:2]
    if not n_low or not n_high:
        return None
    mean, square = total[2:].reshape(2, -1) / (n_low + n_high)
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6
    # no score is farther from 0 than the largest features allow
    edges = rows.select(F.posexplode("f")).groupBy("pos").agg(F.min("col"), F.max("col")).orderBy("pos").collect()
    widest = np.array([max(abs(low - m), abs(high - m)) for (_, low, high), m in zip(edges, mean, strict=True)]) / scale
    w = np.zeros(FEATURES)
    for _ in range(steps):
        slope, curve = _moved(rows, mean, scale, w, max(1.0, float(np.abs(w) @ widest)))
        step = np.linalg.solve(curve + ridge * np.eye(len(w)), slope - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Ranker(mean, scale, w, _cut(rows, mean, scale, w, share_low, n_low, n_high))


def _cut(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, share_low: float, n_low: float, n_high: float) -> float:
    """The score between the rows beside the quantile ``share_low``, each class weighted by its true share."""

    @pandas_udf(DoubleType())
    def latent(features: pd.Series) -> pd.Series:
        return pd.Series([float(((f - mean) / scale) @ w) for f in features], dtype="float64")

    scores = staged(rows.select("quality", latent("f").alias("s")), "quality-latent")
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    mass, before = np.array([share_low / n_low, (1 - share_low) / n_high]), None
    below = np.zeros(2)
    while True:
        inside = scores.where(F.col("s").between(low, high))
        at = F.least(F.floor((F.col("s") - low) / ((high - low) / BINS)), F.lit(BINS - 1)) if high > low else F.lit(0)
        bins = (inside.groupBy(at.cast("int").alias("bin")).agg(F.sum(1 - F.col("quality")), F.sum("quality"), F.min("s"), F.max("s"))
                .orderBy("bin").collect())
        for _, zeros, ones, low, high in bins:  # noqa: B007
            if (below + [zeros, ones]) @ mass >= share_low + 1e-12 or high == bins[-1][4]:
                break
            below += [zeros, ones]
            before = high
        if low == high:
            break
    # of rows of one score, those with label 0 come first
    first = (below + ([1, 0] if zeros else [0, 1])) @ mass
    if before is None and zeros + ones == 1:
        after = scores.where(F.col("s") > low).agg(F.min("s")).first()[0]
        return (low + after) / 2
    return (before + low) / 2 if before is not None and first >= share_low + 1e-12 else low


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@pandas_udf(ArrayType(DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: text_features(t).tolist())


def train(docs: DataFrame, labels: DataFrame) -> Ranker | None:
    """Fit on all labelled rows outside the held-out fold."""
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high").where(~held_out("doc_id")))
    share = known.agg(F.avg(1 - F.col("low"))).first()[0]
    if share is None:
        return None
    # the features, not the texts, go to the labels
    features = docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id", _features("text").alias("f"))
    rows = staged(features.join(known.select("doc_id", F.col("low").alias("quality")), "doc_id").select("quality", "f"), "quality-features")
    return fit_pairs(rows, float(share))


def score_column(model: Ranker | None, text: str = "text") -> Column:
    if model is None:
        return F.lit(0.5)

    @pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.stack([text_features(t) for t in texts])))

    return score(F.col(text))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model = train(docs, labels)
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), score_column(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the cut, with their own columns."""
    model = train(docs, labels)
    return docs.withColumn("__score", score_column(model)).where(F.col("__score") >= CUT).drop("__score")
