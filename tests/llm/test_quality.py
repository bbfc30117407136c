import random

import numpy as np
import pandas as pd

from visitflow.llm import quality

from .data import awkward, cluttered, docs, words

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = words(rng, rng.randint(5, 200))
        kind = i % 5
        text = " ".join(w) + "."
        if kind == 0:
            text = [" ".join(x.upper() + "!!" for x in w), " | ".join(w), " ".join(x + "%%%" for x in w), " ".join(w[0] for _ in w)][i // 10 % 4]
        rows.append((i, text, "en", "a", len(text)))
        if i % 2:
            labels.append((i, int(kind != 0), 0))
    return rows, labels


def test_held_out_accuracy_and_independence_of_held_out_labels(spark):
    rows, labels = labelled()
    frame = spark.createDataFrame(labels, LABELS)
    out = quality.classify(docs(spark, rows), frame)
    got = out.toPandas().merge(pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
    test = got[got.held_out]
    assert len(out.collect()) == len(rows) and len(test) > 30
    assert (test.predicted == test.quality).mean() >= 0.97
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    # labels of the held-out fold, sources and languages change no score
    flipped = frame.withColumn("quality", (quality.held_out("doc_id") != (frame["quality"] == 1)).cast("int"))
    other = quality.classify(docs(spark, [(d, t, "xx", "zz", 0) for d, t, *_ in rows]), flipped).toPandas()
    assert (other.sort_values("doc_id").score.to_numpy() == out.toPandas().sort_values("doc_id").score.to_numpy()).all()


def test_awkward_rows_and_labels(spark):
    rows, labels = labelled(100)
    more = [(d + 1_000 if d is not None else None, t, *r) for d, t, *r in awkward()]
    odd = labels + [(None, 1, 0), (1_001, None, 0), (1_002, 7, 0), (1, 1, 0), (3, 0, 0), (3, 1, 0)]
    out = quality.classify(cluttered(docs(spark, rows + more)), cluttered(spark.createDataFrame(odd, LABELS))).collect()
    assert len(out) == len(rows) + len(more) and all(0 <= r.score <= 1 for r in out)
    same = {r.score for r in out if r.doc_id == 1_001}
    assert len(same) == 1


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in quality.classify(docs(spark), none).collect()} == {(0.5, 1)}
    assert quality.classify(docs(spark, []), none).count() == 0
    assert quality.accepted(docs(spark), none).count() == len(awkward())


def test_features_do_not_need_the_whole_text_at_once(monkeypatch):
    text = " ".join(words(random.Random(1), 5_000))
    whole = quality.text_features(text)
    monkeypatch.setattr(quality, "BLOCK", 4096)
    assert abs(whole[:8] - quality.text_features(text)[:8]).max() < 0.2


def test_features_are_those_of_the_whole_text_for_any_block(monkeypatch):
    rng = random.Random(7)
    short = "\n".join(" ".join(words(rng, 9)) for _ in range(40)) + "\n\n same same\n"
    long = "\n".join(["buy now now"] * 9_000 + [" ".join(words(rng, 30)) for _ in range(300)]) + "\n"
    assert len(short) < 1 << 16 < len(long)
    for text in (short, long, "x" * 70_000, "\n" * 70_000, " ", ""):
        w, lines = text.split(), text.split("\n")
        got = quality.text_features(text)
        want = (sum(a == b for a, b in zip(w, w[1:], strict=False)) / max(1, len(w)), 1 - len(set(w)) / len(w) if w else 0.0,
                1 - len(set(lines)) / len(lines))
        assert tuple(got[7:10]) == want
        for block in (1, 17, 4096, 1 << 16, 1 << 24):
            monkeypatch.setattr(quality, "BLOCK", block)
            assert (quality.text_features(text) == got).all()


def test_accepted_keeps_columns(spark):
    rows, labels = labelled()
    df = cluttered(docs(spark, rows))
    out = quality.accepted(df, spark.createDataFrame(labels, LABELS))
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    assert len(kept & {i for i in range(600) if i % 5}) >= 470 and len(kept & {i for i in range(600) if i % 5 == 0}) <= 6


def brute_force(x, y, share, ridge=1e-3):
    """Weights over all pairs one by one, and the cut in the sorted scores."""
    high, low = x[y == 1], x[y == 0]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    diff = ((high[:, None] - low[None]) / scale).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        w += np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w)), diff.T @ p / len(diff) - ridge * w)
    latent = ((x - mean) / scale) @ w
    order = np.argsort(latent, kind="stable")
    mass = np.where(y == 0, share / len(low), (1 - share) / len(high))[order].cumsum()
    at = min(max(int(np.searchsorted(mass, share + 1e-12)), 1), len(order) - 1)
    return w, latent[order[at - 1:at + 1]].mean()


def test_fit_is_that_of_all_labelled_rows_and_pairs(spark):
    rng = np.random.default_rng(5)
    for share in (0.3, 0.05):
        y = (rng.random(700) >= share).astype(int)
        x = np.abs(rng.normal(size=(700, quality.FEATURES))) * 0.1 + 0.03 * y[:, None] * rng.random(quality.FEATURES)
        x[:, 3] = 0
        frame = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, x, strict=True)], "quality int, f array<double>").repartition(5)
        for of in (float((1 - y).mean()), 0.5):
            got, (w, cut) = quality.fit_pairs(frame, of), brute_force(x, y, of)
            assert np.abs(got.weights - w).max() < 1e-3 * np.abs(w).max() and abs(got.cut - cut) < 2e-3
            # the cut for these weights lies between the same two scores
            latent = np.sort(((x - got.mean) / got.scale) @ got.weights)
            mass = np.where(y == 0, of / (y == 0).sum(), (1 - of) / (y == 1).sum())[np.argsort(((x - got.mean) / got.scale) @ got.weights)].cumsum()
            at = min(max(int(np.searchsorted(mass, of + 1e-12)), 1), 699)
            assert abs(got.cut - latent[at - 1:at + 1].mean()) < 1e-9


def test_no_labelled_row_is_left_out(spark, monkeypatch):
    """Every labelled row outside the fold reaches the fit, more than 40,000 of them too."""
    n, seen = 60_000, {}
    frame = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 50, if(id % 3 = 0, ' !!', ' b')) AS text", "'en' AS lang", "'a' AS source", "1 AS n_chars")
    labels = spark.range(n).selectExpr("id AS doc_id", "cast(id % 3 > 0 AS int) AS quality", "0 AS toxic")
    monkeypatch.setattr(quality, "fit_pairs", lambda rows, share: seen.update(rows=rows.count(), share=share))
    quality.train(frame, labels)
    assert seen["rows"] == labels.where(~quality.held_out("doc_id")).count() > 40_000
