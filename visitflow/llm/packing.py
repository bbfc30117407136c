"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence has three limits at once: tokens, segments (pieces of documents) and
loss-bearing tokens.  Among the items that fit, the next one is the item whose
demand vector has the largest dot product with the room that is left.  When
nothing fits whole and cutting is allowed, the largest item is cut to fill the
sequence.

Every task packs the rows it reads: texts are tokenised once, no row is
shuffled, and a task holds at most ``pool`` items (each below one sequence) at a
time.  What does not fill a sequence goes back to the pool; only the last one of
a task stays open, and it is cut into sequences whose lengths are powers of two,
which need no padding.

Defined results: a null or empty text has the single closing id; repeated rows
are packed one by one; a null id is kept as null.  ``sequence_id`` holds the
task's number in its upper bits.
"""

from __future__ import annotations

import gc
import itertools
import string
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

END = 2
ENDING = END.to_bytes(4, "little")
SIGNS = string.punctuation.encode()
#: Bytes of UTF-8 texts of the letters A-Z, a-z and U+00C0 to U+00FF: these have one normal form, and letters among them one lower case.
LATIN = string.ascii_letters.encode() + bytes([0xC3, *range(0x80, 0xC0)])
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "loss_tokens long, sequence_segments int")
BLOCK = 1 << 20
#: Words whose ids a Python worker remembers, and twice as many parts of words: about 0.6 kB a word.
MEMO = 400_000
#: Characters of text that are encoded together.
CHUNK = 1 << 20


def blocks(data: bytes) -> Iterator[bytes]:
    """The text in blocks that end at white space, so that no word is cut."""
    i = 0
    while len(data) - i > BLOCK:
        j = i + BLOCK
        while j < len(data) and data[j] not in b" \t\n\x0b\x0c\r":
            j += 1
        yield data[i:j]
        i = j
    yield data[i:]


class WordIds:
    """Token ids of texts.

    White space always ends a token of this vocabulary, and so does a change
    from letters to signs; letter case does not count.  Words are therefore
    encoded once, and a word of letters followed by ASCII signs is put together
    from its two parts."""

    def __init__(self, definition: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        self.memo = memo
        self.tokenizer = Tokenizer.from_str(definition)
        #: ids that close a word
        suffix = self.tokenizer.model.end_of_word_suffix
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = bool(suffix) and token.endswith(suffix)
        #: little-endian ids, and the vocabulary's letter for each byte (those that print, else the next from U+0100 on)
        self.code = [i.to_bytes(4, "little") for i in range(len(self.closes))]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letter = dict(zip([*shown, *sorted({*range(256)} - {*shown})], [*shown, *range(256, 256 + 256 - len(shown))], strict=True))
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}

    def _letters(self, cores: list[bytes]) -> None:
        """Encode runs of letters together: each ends at its first id that closes a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(cores).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
        if len(ends) == len(cores):
            self._store(cores, ids, ends)
        else:
            self._any(cores)

    def _latin(self, core: bytes) -> bytes:
        """Encode one run of lower-case letters of ``LATIN``: normalising and splitting would leave it as it is."""
        text = core.decode("latin-1")
        ids = b"".join([self.code[t.id] for t in self.tokenizer.model.tokenize(text if text.isascii() else text.translate(self.letter))])
        self.parts[core] = ids
        return ids

    def _any(self, words: list[bytes]) -> None:
        got = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        of = np.array([-1 if i is None else i for i in got.word_ids], np.int64)
        self._store(words, np.array(got.ids, "<u4"), np.searchsorted(of, np.arange(len(words)), "right") * 4)

    def _store(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        data, ends = ids.tobytes(), ends.tolist()
        self.parts.update(zip(words, map(data.__getitem__, map(slice, [0, *ends], ends))))

    def learn(self, words: set[bytes]) -> None:
        if len(self.words) + len(words) > self.memo:
            self.words.clear()
        if len(self.parts) > 2 * self.memo:
            self.parts.clear()
        parts, known = self.parts, self.words
        parts[b""] = b""
        rest, letters, others = [], [], []
        for w in words:
            core, tail = w, b""
            if not w.isalpha():  # ASCII letters
                core = w.rstrip(SIGNS)
                tail = w[len(core):]
            if core.isalpha():
                key = core.lower()
            else:
                text = core.decode()
                plain = text.isalpha()
                if plain and not core.translate(None, LATIN):
                    key = text.lower().encode()
                else:
                    if plain and text.lower().isalpha():  # lower case of some letters adds a sign
                        letters.append(core)
                    else:
                        core, tail = w, b""
                        others.append(w)
                    rest.append((w, core, tail))
                    continue
            ids = parts.get(key)
            if ids is None:
                ids = self._latin(key)
            if tail:
                end = parts.get(tail)
                if end is None:
                    self._any([tail])
                    end = parts[tail]
                ids += end
            known[w] = ids
        if new := [x for x in {*others, *(tail for _, _, tail in rest)} if x not in parts]:
            self._any(new)
        if new := [x for x in {*letters} if x not in parts]:
            self._letters(new)
        for w, core, tail in rest:
            known[w] = parts[core] + parts[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the closing id."""
        split = [[block.split() for block in blocks((t or "").encode("utf-8", "replace"))] for t in texts]
        found = [[list(map(self.words.get, words)) for words in text] for text in split]
        gaps = [(words, ids, at) for text, got in zip(split, found, strict=True) for words, ids in zip(text, got, strict=True)
                if (at := [i for i, x in enumerate(ids) if x is None])]
        if gaps:
            self.learn({words[i] for words, _, at in gaps for i in at})
            find = self.words.__getitem__
            for words, ids, at in gaps:
                for i in at:
                    ids[i] = find(words[i])
        return [b"".join(itertools.chain(*got, [ENDING])) for got in found]


def pack(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], cut: bool = False) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, first token, tokens).

    ``tokens`` and ``loss`` are the items' demands (each takes one segment);
    ``limits`` holds tokens, segments and loss-bearing tokens of a sequence.
    With ``cut``, an item may be cut when nothing fits whole; the tokens cut
    off count as loss-bearing in the order: those without loss come first.
    An item beyond a limit by itself raises unless it can be cut.
    """
    most, segments, most_loss = limits
    left, lossy = tokens.astype(np.int64).copy(), loss.astype(np.int64).copy()
    at = np.zeros(len(left), np.int64)
    if not cut and ((left > most) | (lossy > most_loss)).any():
        raise ValueError("an item is beyond the limits of a sequence")
    open_items = left > 0
    out: list[list[tuple[int, int, int]]] = []
    while open_items.any():
        room, seats, loss_room = most, segments, most_loss
        here: list[tuple[int, int, int]] = []
        while room and seats and open_items.any():
            # demand . room, each in shares of its limit; the segment's part is the same for all items
            score = np.where(open_items & (left <= room) & (lossy <= loss_room),
                             left * (room / most ** 2) + lossy * (loss_room / most_loss ** 2), -1.0)
            i = int(score.argmax())
            if score[i] >= 0:
                n, n_loss = int(left[i]), int(lossy[i])
            elif cut:
                i = int(np.where(open_items, left, -1).argmax())
                plain = int(left[i] - lossy[i])
                n = min(room, int(left[i]), plain + loss_room)
                if n <= 0:
                    break
                n_loss = max(0, n - plain)
            else:
                break
            here.append((i, int(at[i]), n))
            at[i] += n
            left[i] -= n
            lossy[i] -= n_loss
            room, seats, loss_room = room - n, seats - 1, loss_room - n_loss
            open_items[i] = left[i] > 0
        out.append(here)
    return out


def powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """One open sequence as sequences whose lengths are powers of two, the longest first."""
    rest = list(pieces)
    total = sum(n for _, _, n in rest)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        here = []
        while size:
            i, start, n = rest.pop(0)
            take = min(n, size)
            here.append((i, start, take))
            size -= take
            if n > take:
                rest.insert(0, (i, start + take, n - take))
        yield here


def worker_coder(definition: str, memo: int) -> WordIds:
    """The coder of this Python worker: later tasks of the worker find its words."""
    held = sys.modules.setdefault("visitflow_packing_worker", types.ModuleType("visitflow_packing_worker"))
    if getattr(held, "definition", None) != (definition, memo):
        held.definition, held.coder = (definition, memo), WordIds(definition, memo)
    return held.coder


def coded(coder: WordIds, batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids) of a batch, some texts at a time."""
    keys, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        keys.append(doc_id)
        texts.append(text.as_py())
        held += len(texts[-1] or "")
        if held >= CHUNK:
            yield from zip(keys, coder.encode(texts), strict=True)
            keys, texts, held = [], [], 0
    yield from zip(keys, coder.encode(texts), strict=True)


def _packed(definition, limits: tuple[int, int, int], pool: int, memo: int):
    most = limits[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the memo's many small objects hold no cycles
        try:
            yield from pieces(batches)
        finally:
            gc.enable()
            release()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(definition.value, memo)
        base = TaskContext.get().partitionId() << 32
        count = 0
        rows: list[tuple] = []
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in SCHEMA.split(", ")]
        items: list[tuple] = []  # (doc_id, first id, ids, ids of the document)

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)], names)
            rows.clear()
            return out

        def emit(pieces: list[tuple[int, int, int]]) -> None:
            nonlocal count
            offset = 0
            for i, start, n in pieces:
                doc_id, first, ids, total = items[i]
                at = first + start
                rows.append((doc_id, at, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total, base + count, offset, n - (at == 0), len(pieces)))
                offset += n
            count += 1

        def settle(last: bool) -> None:
            """Pack the pool; all but the last sequences go out, its open pieces return to the pool."""
            if not items:
                return
            tokens = np.array([len(x[2]) // 4 for x in items])
            loss = tokens - np.array([x[1] == 0 for x in items])
            sequences = pack(tokens, loss, limits, cut=True)
            rest = sequences.pop() if sum(n for _, _, n in sequences[-1]) < most else []
            for pieces in sequences:
                emit(pieces)
            if last:
                for pieces in powers(rest):
                    emit(pieces)
                items.clear()
            else:
                items[:] = [(items[i][0], items[i][1] + s, items[i][2][4 * s:4 * (s + n)], items[i][3]) for i, s, n in rest]

        for batch in batches:
            for doc_id, ids in coded(coder, batch):
                total, start = len(ids) // 4, 0
                while total - start >= most and most - (start == 0) <= limits[2]:
                    items.append((doc_id, start, ids[4 * start:4 * (start + most)], total))
                    emit([(len(items) - 1, 0, most)])
                    items.pop()
                    start += most
                if start < total:
                    items.append((doc_id, start, ids[4 * start:], total))
                if len(items) >= pool:
                    settle(False)
                if len(rows) >= 10_000:
                    yield flush()
        settle(True)
        yield flush()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, max_segments: int = 256,
                   max_loss: int | None = None, pool: int = 1024, memo: int = MEMO) -> DataFrame:
    """Pieces of all documents in sequences within the limits; the vocabulary file is read on the driver.

    ``memo``: words that a worker remembers; fewer take less memory and more time, with the same result."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _packed(definition, (max_tokens, max_segments, max_loss or max_tokens), pool, memo), SCHEMA)
