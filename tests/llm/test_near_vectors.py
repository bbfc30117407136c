import math

import numpy as np
import pytest

from visitflow.llm import near_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(seed=0, clusters=5, size=60, alone=300, dim=24, noise=0.03):
    rng = np.random.default_rng(seed)
    rows = [c + noise * rng.standard_normal(dim) for c in rng.standard_normal((clusters, dim)) for _ in range(size)]
    rows += list(rng.standard_normal((alone, dim)))
    rows += rows[:20]  # equal vectors
    order = rng.permutation(len(rows))
    return [(int(i), [float(np.float32(x)) for x in rows[k]], 0) for i, k in enumerate(order)]


def brute(rows, threshold=0.95):
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    hit = m @ m.T >= threshold
    label = np.arange(len(rows))
    while True:
        new = np.array([label[h].min() for h in hit])
        if (new == label).all():
            return hit.sum(1) - 1, label
        label = new


@pytest.mark.parametrize("block,window", [(2048, 512), (64, 40)])
def test_links_and_components(spark, monkeypatch, block, window):
    """Small blocks and windows: clusters are wider than a window and span blocks."""
    monkeypatch.setattr(nv, "BLOCK", block)
    rows = clustered()
    out = {r.vec_id: r for r in nv.groups(spark.createDataFrame(rows, SCHEMA), window=window).collect()}
    links, label = brute(rows)
    assert len(out) == len(rows)
    got = np.array([out[i].n_links for i in range(len(rows))])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    assert [out[i].component_id for i in range(len(rows))] == label.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def dense():
    """One cluster of 1,500 different vectors, in which pairs lie on both sides of the threshold."""
    return clustered(seed=3, clusters=1, size=1_500, alone=500, noise=0.2)


@pytest.mark.parametrize("tile", [4096, 100])
def test_a_cluster_wider_than_all_windows_together(spark, monkeypatch, tile):
    monkeypatch.setattr(nv, "BLOCK", 64)
    monkeypatch.setattr(nv, "TILE", tile)
    window, rows = 8, dense()
    passes = nv.passes_for(len(rows), 0.95, window, 0.99)
    out = {r.vec_id: r for r in nv.groups(spark.createDataFrame(rows, SCHEMA), window=window).collect()}
    links, label = brute(rows)
    got = np.array([out[i].n_links for i in range(len(rows))])
    assert links.max() > 2 * 2 * window * passes
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    assert (np.array([out[i].component_id for i in range(len(rows))]) == label).mean() >= 0.99
    print("recall", got.sum() / links.sum(), "passes", passes, "most links", links.max(), "of", links.sum())


def test_awkward_vectors(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [], 0),
            (7, [1.0, 1.0], 0), (8, [2.0, 2.0], 0), (9, [1.0, 1.0, 0.0], 0), (None, [1.0, 1.0], 0), (8, [2.0, 2.0], 0), (10, [-1.0, -1.0], 0)]
    from .data import cluttered
    out = nv.groups(cluttered(spark.createDataFrame(rows, SCHEMA))).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None)
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                   (7, 3, 7, True), (8, 3, 7, False), (8, 3, 7, False), (9, 0, 9, True), (10, 0, 10, True)]
    assert [(r.n_links, r.component_id) for r in out if r.vec_id is None] == [(3, 7)]


def test_empty_table(spark):
    assert nv.groups(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nv.groups(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()[0].n_links == 0


def test_a_pair_counts_once_over_all_passes(spark):
    rows = [(i, [1.0, 0.001 * i], 0) for i in range(300)]
    out = nv.groups(spark.createDataFrame(rows, SCHEMA), window=30).collect()
    assert all(r.n_links <= 299 and r.component_id == 0 for r in out)


def test_passes_grow_with_the_table():
    n = [nv.passes_for(r, 0.95, 512, 0.99) for r in (1, 10**4, 10**6, 10**8)]
    assert n == sorted(n) and n[0] == 8 and n[-1] > n[1]
    met = 1 - math.acos(0.95) / math.pi
    assert 1 - (1 - met ** (math.log2(10**6 / 512) + 1)) ** n[2] >= 0.99
