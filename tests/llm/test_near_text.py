import random
import re
from collections import Counter, defaultdict

import pytest

from visitflow.llm import near_text

from .data import awkward, cluttered, docs, words


def shingle_set(text, width):
    lower = {i: i + 32 for i in range(65, 91)}
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width=4, percent=80):
    """doc_id -> (set size, smallest id reachable); ids without null."""
    sets = [(d, shingle_set(t, width)) for d, t, *_ in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            places[x].append(k)
    for k, (d, s) in enumerate(sets):
        for o, i in Counter(j for x in s for j in places[x] if j > k).items():
            e, t = sets[o]
            if 100 * i >= percent * (len(s) + len(t) - i):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def corpus(seed=1, clusters=6, copies=40, alone=150):
    """Bases with near copies of one to four changed words, a shared line, and unrelated texts."""
    rng = random.Random(seed)
    rows, line = [], words(rng, 12)
    for _ in range(clusters):
        base = words(rng, rng.randint(60, 110))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = words(rng, 1)[0]
            rows.append(" ".join(w))
    rows += [" ".join(line + words(rng, rng.randint(5, 80))) for _ in range(alone)]
    rng.shuffle(rows)
    return [(i, t, "en", "a", len(t)) for i, t in enumerate(rows)]


def check(out, rows, width=4):
    want = brute(rows, width)
    got = {r.doc_id: r for r in out.collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items() if d is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for d, r in got.items() if d is not None)


@pytest.mark.parametrize("leaf,outside", [(64, 4096), (6, 6), (6, 4096)])
def test_components_match_brute_force(spark, monkeypatch, leaf, outside):
    """A small leaf sends the clusters through pivots, cores and deeper nodes, or compares them whole."""
    monkeypatch.setattr(near_text, "LEAF", leaf)
    monkeypatch.setattr(near_text, "OUTSIDE", outside)
    monkeypatch.setattr(near_text, "PART", 16)
    monkeypatch.setattr(near_text, "PART_ITEMS", 900)
    rows = corpus()
    check(near_text.groups(docs(spark, rows)), rows)


def test_pairs_at_the_threshold_meet_in_deep_trees(spark, monkeypatch):
    """Three of five tokens are common to all, so nodes stay large for some levels; pairs are planted at 0.8."""
    monkeypatch.setattr(near_text, "LEAF", 2)
    monkeypatch.setattr(near_text, "OUTSIDE", 2)
    rng, rows = random.Random(3), []
    for i in range(0, 400, 2):
        first = [k if rng.random() < 0.6 else rng.getrandbits(40) for k in range(near_text.TOKENS)]
        rows += [(i, first), (i + 1, [t if t == k or rng.random() < 0.5 else rng.getrandbits(40) for k, t in enumerate(first)])]
    agree = {i: sum(map(int.__eq__, rows[i][1], rows[i + 1][1])) / near_text.TOKENS for i in range(0, 400, 2)}
    classes = spark.createDataFrame([(*r, 100) for r in rows], "id long, tokens array<long>, size long").coalesce(1).cache()
    none = spark.createDataFrame([], "id long, component_id long")
    pairs, level, ends = near_text.candidate_pairs(classes, range(4, 12), none)
    found = {(r.a, r.b) for r in pairs.select("a", "b").collect()}
    nodes = {}
    for r in ends.collect():
        nodes.setdefault(r.node, []).append(r.id)
    # nodes that are compared on full sets
    found |= {(a, b) for ids in nodes.values() for a in ids for b in ids if a < b}
    want = [i for i, share in agree.items() if share >= near_text.MAYBE]
    met = sum((i, i + 1) in found for i in want)
    print("met", met, "of", len(want), "level", level)
    assert len(want) >= 190 and met >= 0.995 * len(want)


def test_outsiders_are_linked_on_full_sets(spark, monkeypatch):
    """Links that join components of a part, at and below the threshold, and none inside a component."""
    monkeypatch.setattr(near_text, "PART_ITEMS", 40)
    sets = {1: range(10), 2: range(10), 3: range(8), 4: range(1, 10), 5: range(100, 110), 6: range(7), 7: [*range(8), 20, 21]}
    frame = spark.createDataFrame([(i, [*s]) for i, s in sets.items()], "id long, items array<long>")
    ends = spark.createDataFrame([(9, i, 1 if i < 3 else i, i < 3, len(sets[i])) for i in sets] + [(8, 5, 5, True, 10), (8, 6, 6, False, 7)],
                                 "node long, id long, comp long, inside boolean, size long")
    got = {tuple(sorted((r.a, r.b))) for r in near_text._exact_links(ends, frame, 80).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})}
    assert got <= links
    parent = {i: i for i in sets}
    parent[2] = 1

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def joined(pairs):
        parent.update({i: i for i in sets} | {2: 1})
        for a, b in sorted(pairs):
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in sets]

    assert joined(got) == joined(links)


def test_trees_grow_with_the_levels_and_the_recall():
    n = [near_text.trees_for(level, 0.99) for level in range(8)]
    assert n == sorted(n) and n[0] < n[7] <= 8
    assert all(near_text.missed(level, k) <= 0.01 < near_text.missed(level, k - 1) for level, k in enumerate(n))
    assert near_text.trees_for(3, 0.999) > near_text.trees_for(3, 0.99)
    with pytest.raises(ValueError, match="minwise"):
        near_text.trees_for(0, 0.999999)


def test_awkward_rows(spark):
    out = near_text.groups(cluttered(docs(spark)), trees=4)
    assert out.count() == len(awkward())
    check(out, awkward())
    alone = out.where("doc_id IS NULL AND n_shingles = 0").collect()
    assert alone[0].component_id is None and alone[0].kept


def test_empty_table(spark):
    assert near_text.groups(docs(spark, []), trees=4).count() == 0


def test_only_empty_texts(spark):
    out = near_text.groups(docs(spark, [(1, "", "en", "a", 0), (2, None, "en", "a", 0)]), trees=4)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_one_id_with_several_texts_links_them(spark):
    rng = random.Random(2)
    a, b = " ".join(words(rng, 30)), " ".join(words(rng, 30))
    out = near_text.groups(docs(spark, [(1, a, "en", "a", 1), (2, b, "en", "a", 1), (5, a, "en", "a", 1), (5, b, "en", "a", 1)]), trees=4)
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(1, 1), (2, 1), (5, 1)}


def test_dedup_keeps_one_of_each_group_and_all_columns(spark):
    rows = corpus(seed=3, clusters=3, copies=12, alone=40)
    df = cluttered(docs(spark, rows))
    out = near_text.dedup(df, width=5, trees=8)
    want = {d for d, (_, c) in brute(rows, 5).items() if d == c}
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want


def test_shingles_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(words(random.Random(5), 3_000)).encode()
    whole = near_text.Shingler(4).shingles(text)
    monkeypatch.setattr(near_text, "_BLOCK", 997)
    assert (near_text.Shingler(4).shingles(text) == whole).all() and len(whole) == len(shingle_set(text.decode(), 4))
