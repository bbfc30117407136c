import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitflow.llm import packing

from .data import awkward, cluttered, docs

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END], "<u4")


def check(out, rows, most):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(zlib.crc32(ids_of(tokenizer, r[1]).tobytes()) for r in rows)
    wholes = {len(ids_of(tokenizer, r[1])): ids_of(tokenizer, r[1]) for r in rows}
    covered = {}
    for r in out.itertuples():
        ids = wholes[r.doc_tokens]
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_tokens] = covered.get(r.doc_tokens, 0) + r.length
    assert sum(covered.values()) == sum(len(ids_of(tokenizer, r[1])) for r in rows) and len(want) == len(rows)
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= most
        assert (g.sequence_segments == len(g)).all()


@pytest.mark.parametrize("most", [4096, 64])
def test_awkward_rows_round_trip(spark, most):
    out = packing.pack_documents(cluttered(docs(spark)), PATH, max_tokens=most).toPandas()
    check(out, awkward(), most)
    fill = out.groupby("sequence_id").length.sum()
    assert all(n == most or n & (n - 1) == 0 for n in fill)


def test_empty_table(spark):
    assert packing.pack_documents(docs(spark, []), PATH).count() == 0


def test_limits_on_segments(spark):
    rows = [(i, "a b c", "en", "a", 1) for i in range(500)]
    out = packing.pack_documents(docs(spark, rows), PATH, max_segments=8).toPandas()
    assert out.sequence_segments.max() <= 8 and out.length.sum() == 500 * 4


@pytest.mark.parametrize("text", ["Don't WE'LL 's x's a'b", "İstanbul ΣΑΣ ß ﬁ é x　y \x1cz", "<|endoftext|> foo<|endoftext|>bar", "a1b2 3,4 ... ''s ''",
                                  "café, CAFÉ! İ!", "x́y, q's!", "​zero‍ 日本語。", " \n\t "])
def test_words_apart_give_the_same_ids(text):
    coder = packing.WordIds(open(PATH).read())
    assert coder.encode([text])[0] == ids_of(Tokenizer.from_file(PATH), text).tobytes()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text_gives_the_same_ids(texts):
    assert _CODER.encode(texts) == [ids_of(_TOKENIZER, t).tobytes() for t in texts]


_TOKENIZER = Tokenizer.from_file(PATH)
_CODER = packing.WordIds(open(PATH).read())


def test_latin_words_need_only_the_model(monkeypatch):
    coder = packing.WordIds(open(PATH).read())
    latin = [chr(c) for c in range(0xC0, 0x100)]
    words = ["Word", "ÀÉÎÕÜ", "straße,", "Ñandú!?", "x" * 300, "".join(c for c in latin if c.isalpha()), *[f"a{c}B{c}" for c in latin if c.isalpha()]]
    want = [ids_of(_TOKENIZER, w).tobytes() for w in words]
    coder.encode([",", "!?"])
    for name in ("_letters", "_any"):
        monkeypatch.setattr(coder, name, lambda words: pytest.fail(f"encoded beside the model: {words}"))
    assert coder.encode(words) == want and coder.encode([" ".join(words)])[0] == b"".join(w[:-4] for w in want) + packing.ENDING


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZéÉßÿÿŸ×÷ªºµÀİſΣςǅﬁ1'.,!\u0300\u0301 \u00ad\u00a0\x85"), max_size=12), max_size=30))
def test_letters_near_latin_give_the_same_ids(texts):
    assert _CODER.encode(texts) == [ids_of(_TOKENIZER, t).tobytes() for t in texts]


def test_memo_may_be_forgotten(monkeypatch):
    coder = packing.WordIds(open(PATH).read(), memo=5)
    texts = ["one two three four", "five six seven one, two!", "eight nine one two ten"] * 2
    assert [coder.encode([t])[0] for t in texts] == [ids_of(_TOKENIZER, t).tobytes() for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.floats(0, 1)), min_size=1, max_size=40), st.integers(1, 6), st.integers(20, 100), st.booleans())
def test_limits_hold_together(items, segments, most_loss, cut):
    """Instruction data: an answer's tokens bear loss, the prompt's do not."""
    tokens = np.array([n for n, _ in items])
    loss = np.minimum((tokens * [f for _, f in items]).astype(int), most_loss)
    got = [[0] * n for n in tokens]
    for sequence in packing.pack(tokens, loss, (100, segments, most_loss), cut):
        assert sequence and len(sequence) <= segments and sum(n for _, _, n in sequence) <= 100
        lossy = 0
        for i, start, n in sequence:
            lossy += max(0, start + n - max(start, tokens[i] - loss[i]))
            for k in range(start, start + n):
                got[i][k] += 1
            if not cut:
                assert (start, n) == (0, tokens[i])
        assert lossy <= most_loss
    assert all(x == 1 for item in got for x in item)


def test_dot_product_prefers_what_the_room_has():
    # after the first item much room for loss is left and little for tokens
    tokens, loss = np.array([60, 40, 40, 60]), np.array([10, 90, 5, 95])
    assert [sorted(i for i, _, _ in s) for s in packing.pack(tokens, loss, (100, 10, 100))] == [[2, 3], [0, 1]] or \
        [sorted(i for i, _, _ in s) for s in packing.pack(tokens, loss, (100, 10, 100))] == [[0, 1], [2, 3]]


def test_uncuttable_item_raises():
    with pytest.raises(ValueError, match="beyond the limits"):
        packing.pack(np.array([101]), np.array([1]), (100, 4, 100))
