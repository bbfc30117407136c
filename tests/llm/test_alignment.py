"""Alignment and counts against whole-text encodings and plain loops."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitflow.llm import alignment as A
from visitflow.llm.registry import BYTE_VOCABULARY, PIECE_VOCABULARY, vocabulary

from .data import awkward, cluttered, docs, rows_of

PATHS = vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    return A.Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())


def plain(coder, text):
    """(A ids, B ids, links as (A place, B place), groups) of the whole text, by byte ranges; None without tokens."""
    if not text:
        return None
    want = (" " + text).encode()
    a, b = coder.a.slow.encode(" " + text, add_special_tokens=False).ids, coder.b.encode(text)
    if b"".join(coder.bytes_a[i] for i in a) != want or b"".join(coder.bytes_b[i] for i in b) != want:
        return None
    ends = []
    for ids, table in ((a, coder.bytes_a), (b, coder.bytes_b)):
        ends.append(np.cumsum([len(table[i]) for i in ids]))
    starts = [np.concatenate([[0], e[:-1]]) for e in ends]
    links = [(i, j) for i in range(len(a)) for j in np.flatnonzero((starts[1] < ends[0][i]) & (ends[1] > starts[0][i])).tolist()]
    groups, i, j = [], 0, 0
    for e in sorted({*ends[0].tolist()} & {*ends[1].tolist()}):
        x, y = int(np.searchsorted(ends[0], e)) + 1, int(np.searchsorted(ends[1], e)) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, links, groups


def brute(coder, rows):
    held = [plain(coder, r[1]) for r in rows]
    count, best = {}, {}
    for got in held:
        for p in {(got[0][i], got[1][j]) for i, j in got[2]} if got else ():
            count[p] = count.get(p, 0) + 1
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for r, got in zip(rows, held, strict=True):
        if not got:
            out.append((r[0], 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = got
        n = [(a[i], count[a[i], b[j]]) for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((r[0], len(a), len(b), len(groups), len(links), sum(c == best[x] for x, c in n), sum(c for _, c in n), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def texts():
    rng = random.Random(6)
    words = ["the", "Wörter", "don't", "naïve", "1234567", "x" * 40, "日本語", "\U0001f600", "<|endoftext|>", "<s>", "</s>", "<0x41>", "a▁b", "é", " ", "\x00"]
    gaps = [" ", " ", " ", "  ", "\n", " \n ", "\t", "   ", "　 ", "\x1c"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 12))) for _ in range(120)]


def check_pieces(coder, held):
    pieces, lengths = coder.numbers(held)
    at = 0
    for text, n in zip(held, lengths.tolist(), strict=True):
        got, own = plain(coder, text), pieces[at:at + n]
        at += n
        assert (n == 0) == (got is None)
        if got:
            assert coder.sizes[own].sum(0).tolist() == [len(got[0]), len(got[1]), len(got[3])]
            assert ";".join(coder.texts[i] for i in own) == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in got[3])
            pairs, of = coder.links(own)
            assert sorted(pairs.tolist()) == sorted(got[0][i] * coder.width + got[1][j] for i, j in got[2]) and of.sum() == len(pairs)
    assert at == len(pieces)


def test_pieces_equal_whole_texts(coder):
    assert coder.a.fast is not None
    check_pieces(coder, [*texts(), None, "", " ", "a ", " a", "a\n", "\n b", "x  y", "x \u3000y"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_texts(coder, held):
    check_pieces(coder, held)


@pytest.mark.parametrize("fast", [True, False])
def test_long_runs_and_the_definitions_own_encoder(fast):
    own = A.Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())
    if not fast:
        own.a.fast = None
    check_pieces(own, ["q" * 5_000 + " a", "ab" * 3_000, *texts()[:30]])


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1_000, 40_000])
def test_perfect_hash(n):
    pairs = np.unique(np.random.default_rng(n).integers(0, 1 << 31, n))
    h = A.PerfectHash.of(pairs)
    again = A.PerfectHash.unpacked(h.sizes, h.packed())
    assert sorted(h.numbers(pairs).tolist()) == list(range(len(pairs))) and (again.numbers(pairs) == h.numbers(pairs)).all()
    # a few bits a pair
    assert n < 1_000 or sum(h.sizes) < 4 * n


@pytest.mark.parametrize("round_pairs", [A.ROUND_PAIRS, 300])
def test_equals_plain_loops(spark, coder, round_pairs):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts())] + [(r[0], r[1], *r[2:]) for r in awkward() if len(r[1] or "") < 5_000]
    got = A.align_documents(cluttered(docs(spark, rows)).repartition(40), *PATHS, round_pairs=round_pairs)
    assert rows_of(got) == brute(coder, rows)


def test_long_texts_many_runs_and_a_deep_tree(spark, coder, monkeypatch):
    monkeypatch.setattr(A, "RUN_PAIRS", 50)
    monkeypatch.setattr(A, "MEMO", 500)
    monkeypatch.setattr(A, "CHUNK", 300)
    monkeypatch.setattr(A, "FAN", 2)
    rows = [(i, t * 3, "en", "s", 1) for i, t in enumerate(texts()[:60])] + [(100, "word " * 3_000, "en", "s", 1), (101, "q" * 9_000, "en", "s", 1)]
    got = A.align_documents(docs(spark, rows).repartition(9), *PATHS)
    assert rows_of(got) == brute(coder, rows)


def test_two_tables_one_after_the_other(spark, coder):
    for held in (texts()[:50], texts()[60:90]):
        rows = [(i, t, "en", "s", 1) for i, t in enumerate(held)]
        assert rows_of(A.align_documents(docs(spark, rows), *PATHS)) == brute(coder, rows)


def test_empty_table(spark):
    out = A.align_documents(docs(spark).limit(0), *PATHS)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == 0


def test_lookups_are_verified(coder):
    """A worker may remember pieces of another table: only those that the documents hold must have counts."""
    pairs = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 5_000))
    buckets, rows = A.bucket_of(pairs), []
    for b in np.unique(buckets).tolist():
        h, own = A.PerfectHash.of(pairs[buckets == b]), pairs[buckets == b]
        order = np.empty_like(own)
        order[h.numbers(own)] = own
        rows.append((b, len(own), h.sizes, h.packed(), order.tobytes(), (order * 3).tobytes()))
    table = A.Counts(rows, np.zeros(len(coder.bytes_a), np.int64), coder.width)
    got, mine, lost = table.of(pairs)
    assert (got == pairs * 3).all() and mine.all() and not lost.any()
    other = np.setdiff1d(np.random.default_rng(2).integers(0, 1 << 30, 5_000), pairs)
    got, mine, lost = table.of(other)
    assert not got.any() and (lost == mine).all()
    looked = A.Looked(table)
    pieces, _ = coder.numbers(["some words of another table"])
    assert looked.of(coder, pieces[:0]).shape == (0, 2)
    with pytest.raises(RuntimeError):
        looked.of(coder, pieces)
