import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitflow.llm import substrings as sub

from .data import awkward, cluttered, docs, rows_of


def brute(rows, length):
    data = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, data, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r[0], len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def corpus(seed, n=40):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    shared = [text(rng.randint(40, 400)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 200)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(shared)[rng.randint(0, 9):])
        rows.append((i, "".join(parts), "en", "a", 1))
    rows += [(n, "z" * 700, "en", "a", 1), (n + 1, "ab" * 300, "en", "a", 1), (n + 2, shared[0] + shared[0], "en", "a", 1)]
    return rows


@pytest.mark.parametrize("hot", [5000, 2])
@pytest.mark.parametrize("length", [200, 61])
def test_matches_brute_force(spark, monkeypatch, hot, length):
    """A small HOT sends the anchors of shared passages through counted hashes."""
    monkeypatch.setattr(sub, "HOT", hot)
    rows = corpus(length)
    assert rows_of(sub.remove_repeats(docs(spark, rows), length).drop("runs")) == brute(rows, length)


def test_awkward_rows(spark):
    rows = [r if r[0] not in (5, 11) else (r[0], r[1][:3_000], *r[2:]) for r in awkward()]
    assert rows_of(sub.remove_repeats(cluttered(docs(spark, rows))).drop("runs")) == brute(rows, 200)


def test_empty_table(spark):
    assert sub.remove_repeats(docs(spark, [])).count() == 0


def test_runs_lie_on_the_removed_bytes(spark):
    rows = corpus(9)
    for r in sub.remove_repeats(docs(spark, rows)).collect():
        data = rows[r.doc_id][1].encode()
        assert sum(x.y - x.x for x in r.runs) == r.n_removed and len(r.runs) == r.n_spans
        kept = b"".join(sub.kept_bytes(data, [(x.x, x.y) for x in r.runs]))
        assert hashlib.sha256(kept).hexdigest() == r.kept_sha256


def test_blocks_of_a_long_text_change_nothing(spark, monkeypatch):
    rows = corpus(5, 12)
    monkeypatch.setattr(sub, "BLOCK", 150)
    assert rows_of(sub.remove_repeats(docs(spark, rows)).drop("runs")) == brute(rows, 200)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=0, max_size=120), st.integers(0, 2)), max_size=12), st.integers(8, 60))
def test_sorted_suffixes_match_counting(items, length):
    data = "".join(t for t, _ in items).encode()
    starts, groups, at = [], [], 0
    for t, g in items:
        for i in range(max(0, len(t) - length + 1)):
            starts.append(at + i)
            groups.append(g)
        at += len(t)
    seen = Counter((g, data[s:s + length]) for s, g in zip(starts, groups, strict=True))
    want = [seen[(g, data[s:s + length])] > 1 for s, g in zip(starts, groups, strict=True)]
    got = sub.repeated_suffixes(np.frombuffer(data + bytes(8), np.uint8), np.array(starts, np.int64), np.array(groups, np.int64), length)
    assert got.tolist() == want


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_first_smallest(values, width):
    width = min(width, len(values))
    got = sub.first_smallest(np.array(values, np.uint64), width)
    assert got.tolist() == [s + int(np.argmin(values[s:s + width])) for s in range(len(values) - width + 1)]
