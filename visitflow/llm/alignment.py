"""Cross-tokenizer alignment, with counts of linked id pairs behind a minimal perfect hash.

A text is encoded by two vocabularies, and the byte ranges of their tokens are laid side by side.  Two tokens whose
ranges overlap are linked; byte offsets where tokens of both end cut the tokens into groups.  A pair of ids counts in
how many documents of the corpus it is linked.

Three steps, none of which moves a text:

1. Each task aligns its documents and adds up, for each id pair, in how many of them it is linked: a *run* of sorted
   pairs with counts, dealt over ``BUCKETS`` by a hash of the pair.
2. For each bucket, the distinct pairs of all runs get a minimal perfect hash: bit arrays in levels, each holding the
   pairs that fell alone on their place, the others going one level down; a pair's number is the rank of its bit.
   Every run becomes a dense vector of counts in that order, and the vectors are summed up a tree, ``FAN`` at a time.
   Beside the sums lie the pairs themselves, so that a lookup is verified.
3. A second pass aligns the documents again and looks up the counts of their pairs.

Bounds: a pair is one of ``|A| * |B|`` (1.6 billion for the vocabularies of the query), so a bucket holds at most 1/1024
of that; runs are emitted before they pass ``RUN_PAIRS``.  The table of step 3 goes to the tasks in rounds of
at most ``ROUND_PAIRS`` pairs (12 bytes each on the driver, 8 in a task, and the bit arrays), each round adding its buckets' share to each
document's sums: one round for a corpus of up to 8 million distinct pairs, at most 192 for any.

Encoding.  Both vocabularies never join what comes before a space that follows and precedes other than white space with
what comes after: the texts are cut there, and a piece is aligned once per worker while its memory holds it, together
with the other new pieces of some texts.

Defined results: null and empty texts, and texts whose tokens of either vocabulary do not give back the space and the
text, have no tokens; repeated rows count one by one; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

BUCKETS = 1024
#: Runs whose vectors one step of the tree adds up.
FAN = 16
#: Pairs that a task holds before it emits a run.
RUN_PAIRS = 1 << 21
#: Pairs of one lookup round.
ROUND_PAIRS = 1 << 23
#: Characters and number of remembered pieces.
MEMO, PIECES = 1 << 23, 600_000
#: Characters of a piece from which it is encoded by itself.
LONG = 2_000
#: Characters of text that are aligned together.
CHUNK = 1 << 20

# --- fixed values: how byte-level vocabularies of this kind cut texts, and separators of groups as text -------
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATORS = np.array([",", "|", ";", "\n"], object)
# ----------------------------------------------------------------------------------------------------------------
_CUT = re.compile(r"(?<=\S) (?=\S)")
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs, 0) % np.uint64(BUCKETS)).astype(np.int32)


# ------------------------------------------------------- alignment of one piece

def byte_characters() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable ones stand for themselves, the other bytes for those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level vocabulary, of many pieces at once.

    Where the ids of merged tokens ascend in the order of their merges, an encoder by ranks gives the same ids as the
    definition's own, several times faster; pieces with a very long run go to the latter in any case."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(definition)
        self.slow.encode_special_tokens = True
        model, chars = json.loads(definition)["model"], byte_characters()
        self.bytes = [b""] * self.slow.get_vocab_size()
        for token, i in self.slow.get_vocab().items():
            self.bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        self.fast = None
        if merged == sorted(merged) and max(model["vocab"][c] for c in chars) < merged[0]:
            import tiktoken

            ranks = {self.bytes[i]: i for token, i in model["vocab"].items() if all(c in chars for c in token) and i <= merged[-1]}
            self.fast = tiktoken.Encoding("by ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _one(self, piece: str) -> list[int]:
        if self.fast is None or len(piece) > LONG:
            return self.slow.encode(piece, add_special_tokens=False).ids
        return self.fast.encode_ordinary(piece)

    def encode(self, pieces: list[str]) -> list[int]:
        """Ids of all pieces, one after the other; each starts with a space and other than white space."""
        out, plain = [], []
        for p in pieces:
            if p[-1].isspace() or len(p) > LONG:  # what follows would be joined with its end
                if plain:
                    out += self._one("".join(plain)) if self.fast is None else self.fast.encode_ordinary("".join(plain))
                    plain = []
                out += self._one(p)
            else:
                plain.append(p)
        if plain:
            out += self._one("".join(plain)) if self.fast is None else self.fast.encode_ordinary("".join(plain))
        return out


class Aligner:
    """Both vocabularies, and the pieces that they were aligned on; ``a_json`` is a byte-level definition, ``b_model``
    a piece model with byte fallback.

    Pieces have numbers.  Of piece ``i`` are held: numbers of ids and groups (``sizes[i]``), the pairs of its links
    (``pairs[starts[i]:starts[i + 1]]``) and its groups as text.  A full memory is emptied as a whole, between chunks."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece

        self.a = Encoder(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.bytes_a, self.bytes_b = self.a.bytes, []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = np.array([*map(len, self.bytes_a)]), np.array([*map(len, self.bytes_b)])
        self.text_a, self.text_b = (np.array([*map(str, range(len(x)))], object) for x in (self.bytes_a, self.bytes_b))
        #: no piece goes on after white space, so texts may be cut before a space
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.width = len(self.bytes_b)
        #: grows whenever the memory is emptied
        self.generation = 0
        self._empty()

    def _empty(self) -> None:
        self.generation += 1
        self.memo: dict[str, int] = {}
        self.held, self.count = 0, 0
        self.sizes, self.starts, self.pairs = np.zeros((1024, 3), np.int64), np.zeros(1025, np.int64), np.zeros(8192, np.int64)
        self.texts: list[str] = []

    def _store(self, pieces: list[str], sizes: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, texts: list[str]) -> None:
        n, at = self.count, int(self.starts[self.count])
        while len(self.sizes) < n + len(pieces):
            self.sizes, self.starts = np.concatenate([self.sizes, np.zeros_like(self.sizes)]), np.concatenate([self.starts, np.zeros(len(self.sizes), np.int64)])
        while len(self.pairs) < at + len(pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.sizes[n:n + len(pieces)] = sizes
        self.starts[n + 1:n + 1 + len(pieces)] = at + np.cumsum(lengths)
        self.pairs[at:at + len(pairs)] = pairs
        self.texts += texts
        self.memo.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.count += len(pieces)

    def _learn(self, pieces: list[str]) -> None:
        """Align new pieces, all at once: their tokens lie on one line of bytes."""
        if not pieces:
            return
        spaced = [" " + p for p in pieces]
        bytes_of = [x.encode("utf-8", "replace") for x in spaced]
        ids_b = self.b.encode(pieces, num_threads=1)
        whole = b"".join(bytes_of)
        flat_b = [*itertools.chain.from_iterable(ids_b)]
        flat_a = self.a.encode(spaced)
        if b"".join(map(self.bytes_b.__getitem__, flat_b)) != whole or b"".join(map(self.bytes_a.__getitem__, flat_a)) != whole:
            good = [b"".join(map(self.bytes_b.__getitem__, y)) == z and b"".join(map(self.bytes_a.__getitem__, self.a.encode([x]))) == z
                    for x, y, z in zip(spaced, ids_b, bytes_of, strict=True)]
            if all(good):
                raise RuntimeError("pieces do not encode alike alone and together")
            self.memo.update((p, -1) for p, ok in zip(pieces, good, strict=True) if not ok)
            return self._learn([p for p, ok in zip(pieces, good, strict=True) if ok])
        a, b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        end_a, end_b = self.size_a[a].cumsum(), self.size_b[b].cumsum()
        end = np.cumsum([*map(len, bytes_of)])
        # between two neighbouring ends lie one token of each, and they overlap nowhere else
        both = np.union1d(end_a, end_b)
        pairs = a[np.searchsorted(end_a, both)] * self.width + b[np.searchsorted(end_b, both)]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last = [np.searchsorted(x, end, "right") for x in (end_a, end_b, common, both)]
        if not (common[last[2] - 1] == end).all():
            raise RuntimeError("a token of both vocabularies goes on behind a piece")
        sizes = [np.diff(x, prepend=0) for x in last]
        # tokens group by group, those of A first, each followed by its separator
        group = np.concatenate([np.searchsorted(common, end_a), np.searchsorted(common, end_b)])
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        words = np.empty(2 * len(order), object)
        words[::2] = np.concatenate([self.text_a[a], self.text_b[b]])[order]
        closes = np.zeros(len(common), bool)
        closes[last[2] - 1] = True
        new_group = np.concatenate([group[1:] != group[:-1], [True]])
        new_side = np.concatenate([side[1:] != side[:-1], [True]])
        words[1::2] = SEPARATORS[np.where(new_group, np.where(closes[group], 3, 2), np.where(new_side, 1, 0))]
        texts = "".join(words.tolist()).split("\n")
        self._store(pieces, np.stack(sizes[:3], 1), sizes[3], pairs, texts[:-1])

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and how many each text has (none: a text without tokens)."""
        if self.held > MEMO or self.count > PIECES:
            self._empty()
        cut = [[] if not t else _CUT.split(t) if self.cuts else [t] for t in texts]
        new = [p for p in dict.fromkeys(itertools.chain.from_iterable(cut)) if p not in self.memo]
        self._learn(new)
        self.held += sum(map(len, new))
        lengths = np.array([*map(len, cut)], np.int64)
        got = np.fromiter(map(self.memo.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(lengths.sum()))
        of = np.repeat(np.arange(len(cut)), lengths)
        bad = np.zeros(len(cut), bool)
        bad[of[got < 0]] = True
        return got[~bad[of]], np.where(bad, 0, lengths)

    def links(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of the pieces' links, one piece after the other, and how many each has."""
        n = self.starts[pieces + 1] - self.starts[pieces]
        at = np.repeat(self.starts[pieces] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.pairs[at], n


def worker_module() -> types.ModuleType:
    """What this Python worker keeps for its later tasks."""
    return sys.modules.setdefault("visitflow_alignment_worker", types.ModuleType("visitflow_alignment_worker"))


def worker_aligner(a_json: str, b_model: bytes) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = worker_module()
    if getattr(held, "definition", None) != (a_json, b_model):
        held.definition, held.aligner = (a_json, b_model), Aligner(a_json, b_model)
    return held.aligner


def aligned(aligner: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray]]:
    """Some rows at a time: their columns but the text, the numbers of their pieces, and how many pieces each has."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for *key, text in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns - 1)], batch.column(batch.num_columns - 1), strict=True):
            keys.append(key)
            texts.append(text.as_py())
            held += len(texts[-1] or "")
            if held >= CHUNK:
                yield keys, *aligner.numbers(texts)
                keys, texts, held = [], [], 0
    yield keys, *aligner.numbers(texts)


# ------------------------------------------------------------ runs of counts

RUNS = "bucket int, node int, pairs binary, counts binary"


def _added(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(counts, first) if len(pairs) else counts


def _runs(vocabularies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(*vocabularies.value)
        node = TaskContext.get().partitionId()
        pairs, counts, fresh, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def emit() -> pa.RecordBatch:
            of = bucket_of(pairs)
            order = np.argsort(of, kind="stable")
            of, p, c = of[order], pairs[order], counts[order]
            cuts = np.flatnonzero(np.diff(of)) + 1
            starts = [0, *cuts.tolist()] if len(of) else []
            return pa.record_batch([pa.array(of[starts], pa.int32()), pa.array([node] * len(starts), pa.int32()),
                                    pa.array([x.tobytes() for x in np.split(p, cuts)] if starts else [], pa.binary()),
                                    pa.array([x.tobytes() for x in np.split(c, cuts)] if starts else [], pa.binary())],
                                   ["bucket", "node", "pairs", "counts"])

        for _, pieces, lengths in aligned(aligner, batches):
            # pieces of a text once, then pairs of a text once
            row = np.unique(np.repeat(np.arange(len(lengths)), lengths) * aligner.count + pieces)
            found, n = aligner.links(row % max(1, aligner.count))
            most = len(aligner.bytes_a) * aligner.width
            own = np.unique(np.repeat(row // max(1, aligner.count), n) * most + found) % most
            fresh.append(own)
            waiting += len(own)
            if waiting > RUN_PAIRS:
                pairs, counts = _added(np.concatenate([pairs, *fresh]), np.concatenate([counts, np.ones(waiting, np.int64)]))
                fresh, waiting = [], 0
                if len(pairs) > RUN_PAIRS:
                    yield emit()
                    pairs, counts = pairs[:0], counts[:0]
        pairs, counts = _added(np.concatenate([pairs, *fresh]), np.concatenate([counts, np.ones(waiting, np.int64)]))
        yield emit()

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def _sorted_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[pa.Scalar]]]:
    """(key, rest of the row) of rows in order of their first ``keys`` columns."""
    for batch in batches:
        for row in zip(*[batch.column(i) for i in range(batch.num_columns)], strict=True):
            yield tuple(x.as_py() for x in row[:keys]), list(row[keys:])


def _longs(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer() or b"", np.int64)


# ------------------------------------------------------- minimal perfect hash

class PerfectHash:
    """Numbers 0 to n - 1 for n distinct pairs: bit arrays in levels, and the rank of a pair's bit (Limasset et al. 2017).

    ``sizes`` are the levels' bits, ``bits`` all of them one after the other."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def of(cls, pairs: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(pairs):
            size = 2 * len(pairs)
            at = (mix(pairs, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            hits = np.bincount(at, minlength=size)
            levels.append(hits == 1)
            sizes.append(size)
            pairs = pairs[hits[at] != 1]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each pair; of a pair that was not among them, any number or -1."""
        out = np.full(len(pairs), -1, np.int64)
        left = np.arange(len(pairs))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (mix(pairs[left], level + 1) % np.uint64(size)).astype(np.int64)
            here = self.bits[at]
            out[left[here]] = self.ranks[at[here]]
            left = left[~here]
        return out

    def packed(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    @classmethod
    def unpacked(cls, sizes: list[int], data: bytes) -> PerfectHash:
        return cls(sizes, np.unpackbits(np.frombuffer(data, np.uint8), count=sum(sizes)).astype(bool))


HASHES = "bucket int, n long, sizes array<long>, bits binary, pairs binary"


def _build_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, pairs) by bucket -> its perfect hash, and its pairs in the order of their numbers."""
    def row(bucket: int, pairs: np.ndarray) -> pa.RecordBatch:
        h = PerfectHash.of(pairs)
        placed = np.empty_like(pairs)
        placed[h.numbers(pairs)] = pairs
        return pa.record_batch([pa.array([bucket], pa.int32()), pa.array([len(pairs)], pa.int64()), pa.array([h.sizes], pa.list_(pa.int64())),
                                pa.array([h.packed()], pa.binary()), pa.array([placed.tobytes()], pa.binary())], ["bucket", "n", "sizes", "bits", "pairs"])

    last, known, more, waiting = None, np.zeros(0, np.int64), [], 0
    for (bucket,), (pairs,) in _sorted_rows(batches, 1):
        if bucket != last and last is not None:
            yield row(last, np.unique(np.concatenate([known, *more])))
            known, more, waiting = known[:0], [], 0
        last = bucket
        more.append(_longs(pairs).copy())
        waiting += len(more[-1])
        if waiting > max(1 << 18, len(known)):
            known, more, waiting = np.unique(np.concatenate([known, *more])), [], 0
    if last is not None:
        yield row(last, np.unique(np.concatenate([known, *more])))


VECTORS = "bucket int, node int, counts binary"


def _vector_batch(bucket: int, node: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([bucket], pa.int32()), pa.array([node], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["bucket", "node", "counts"])


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, node, pairs, counts, n, sizes, bits), by bucket and node -> one dense vector for each."""
    last, total, numbering = None, None, None
    for key, (pairs, counts, n, sizes, bits) in _sorted_rows(batches, 2):
        if key != last:
            if last is not None:
                yield _vector_batch(*last, total)
            if last is None or last[0] != key[0]:
                numbering = PerfectHash.unpacked(sizes.as_py(), bits.as_py())
            last, total = key, np.zeros(n.as_py(), np.int64)
        total[numbering.numbers(_longs(pairs))] += _longs(counts)
    if last is not None:
        yield _vector_batch(*last, total)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, node, counts), by bucket and node -> their sums."""
    last, total = None, None
    for key, (counts,) in _sorted_rows(batches, 2):
        if key != last:
            if last is not None:
                yield _vector_batch(*last, total)
            last, total = key, _longs(counts).copy()
        else:
            total += _longs(counts)
    if last is not None:
        yield _vector_batch(*last, total)


def pair_counts(docs: DataFrame, vocabularies) -> DataFrame:
    """(bucket, n, sizes, bits, pairs, counts): for each bucket its perfect hash, and pairs and counts by number."""
    runs = staged(_texts(docs).mapInArrow(_runs(vocabularies), RUNS), "align-runs")
    hashes = staged(runs.select("bucket", "pairs").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_build_hashes, HASHES), "align-hashes")
    step = (F.col("node") / FAN).cast("int").alias("node")
    wide = runs.select("bucket", step, "pairs", "counts").join(hashes.select("bucket", "n", "sizes", "bits"), "bucket")
    vectors = wide.repartition("bucket", "node").sortWithinPartitions("bucket", "node").mapInArrow(_dense, VECTORS)
    # nodes are task numbers: one for each step of the tree remains in the end
    last = runs.agg(F.max("node")).first()[0] or 0
    last //= FAN
    while last > 0:
        vectors = staged(vectors, "align-vectors").select("bucket", step, "counts")
        vectors = vectors.repartition("bucket", "node").sortWithinPartitions("bucket", "node").mapInArrow(_summed, VECTORS)
        last //= FAN
    return staged(hashes.join(vectors.select("bucket", "counts"), "bucket"), "align-counts")


def _best(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (pairs, counts) -> the highest count of each A id of the row."""
        for batch in batches:
            for pairs, counts in zip(batch.column(0), batch.column(1), strict=True):
                a, c = _longs(pairs) // width, _longs(counts)
                order = np.lexsort((c, a))
                a, c = a[order], c[order]
                ends = np.flatnonzero(np.concatenate([a[1:] != a[:-1], [True]])) if len(a) else np.zeros(0, np.int64)
                yield pa.record_batch([pa.array(a[ends], pa.int64()), pa.array(c[ends], pa.int64())], ["a", "n"])

    return run


# ------------------------------------------------------------------ lookups

class Counts:
    """Counts of the pairs of some buckets, looked up by perfect hash and verified against the pairs."""

    def __init__(self, rows: list[tuple], best: np.ndarray, width: int):
        self.best, self.width = best, width
        depth = max((len(r[2]) for r in rows), default=0)
        #: bits of each bucket's levels, and where they start among all bits
        self.sizes, self.starts = np.zeros((depth, BUCKETS), np.int64), np.zeros((depth, BUCKETS), np.int64)
        self.here = np.zeros(BUCKETS, bool)
        bits, pairs, counts, at = [], [], [], 0
        for bucket, _, sizes, data, p, c in sorted(rows):
            self.here[bucket] = True
            for level, size in enumerate(sizes):
                self.sizes[level, bucket], self.starts[level, bucket] = size, at
                at += size
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8), count=sum(sizes)))
            pairs.append(np.frombuffer(p, np.int64).astype(np.uint32))
            counts.append(np.frombuffer(c, np.int64))
        self.bits = np.packbits(np.concatenate([*bits, np.zeros(8, np.uint8)]))
        # a bucket sets one bit for each of its pairs, so ranks run on from bucket to bucket like the pairs
        self.ones = np.concatenate([[0], np.bitwise_count(self.bits).cumsum(dtype=np.int64)]).astype(np.uint32)
        self.pairs = np.concatenate([*pairs, np.zeros(0, np.uint32)])
        counts = np.concatenate([*counts, np.zeros(0, np.int64)])
        self.counts = counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs' counts, whether they lie in these buckets, and whether they should but were not counted."""
        bucket = bucket_of(pairs)
        mine = self.here[bucket]
        out, found, left = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool), np.flatnonzero(mine)
        for level in range(len(self.sizes)):
            size, start = self.sizes[level, bucket[left]], self.starts[level, bucket[left]]
            at = start + (mix(pairs[left], level + 1) % np.maximum(size, 1).astype(np.uint64)).astype(np.int64)
            byte, place = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (size > 0) & ((byte >> (7 - place)) & 1 == 1)
            number = self.ones[at[hit] >> 3].astype(np.int64) + np.bitwise_count((byte[hit].astype(np.uint16) >> (8 - place[hit])).astype(np.uint8))
            # the place may be another pair's
            same = self.pairs[number] == pairs[left[hit]]
            out[left[hit][same]] = self.counts[number[same]]
            found[left[hit][same]] = True
            left = left[~hit]
        return out, mine, mine & ~found


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Looked:
    """Sums over the links of an aligner's pieces, looked up once a piece: links at their A id's best, counts, and links
    that were not counted.  The aligner may remember pieces of other tables, whose pairs this one lacks."""

    def __init__(self, counts: Counts):
        self.counts, self.generation, self.upto = counts, -1, 0
        self.sums = np.zeros((0, 3), np.int64)

    def of(self, aligner: Aligner, pieces: np.ndarray) -> np.ndarray:
        if self.generation != aligner.generation:
            self.generation, self.upto = aligner.generation, 0
        if len(self.sums) < len(aligner.sizes):
            self.sums = np.concatenate([self.sums, np.zeros((len(aligner.sizes) - len(self.sums), 3), np.int64)])
        if self.upto < aligner.count:
            starts = aligner.starts[self.upto:aligner.count + 1]
            pairs = aligner.pairs[starts[0]:starts[-1]]
            got, mine, lost = self.counts.of(pairs)
            best = mine & ~lost & (got == self.counts.best[pairs // self.counts.width])
            # every piece has a link
            self.sums[self.upto:aligner.count] = np.add.reduceat(np.stack([best, got, lost], 1), starts[:-1] - starts[0])
            self.upto = aligner.count
        own = self.sums[pieces]
        if own[:, 2].any():
            raise RuntimeError("a linked pair was not counted: the documents changed between the passes")
        return own[:, :2]


def worker_lookups(table, token: str) -> Looked:
    held = worker_module()
    if getattr(held, "token", None) != token:
        held.token, held.looked = token, Looked(Counts(*table.value))
    return held.looked


def _lookups(vocabularies, table, token: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, looked = worker_aligner(*vocabularies.value), worker_lookups(table, token)
        names = [f.split()[0] for f in ALIGNED.split(", ")]
        for keys, pieces, lengths in aligned(aligner, batches):
            own = looked.of(aligner, pieces)
            per_piece = np.concatenate([aligner.sizes[pieces], (aligner.starts[pieces + 1] - aligner.starts[pieces])[:, None], own], 1)
            sums = np.zeros((len(lengths), 6), np.int64)
            full = np.flatnonzero(lengths)
            ends = np.cumsum(lengths)
            if len(full):
                sums[full] = np.add.reduceat(per_piece, (ends - lengths)[full])
            texts, digests = aligner.texts, []
            at = pieces.tolist()
            for e, n in zip(ends.tolist(), lengths.tolist(), strict=True):
                digests.append(hashlib.sha256(";".join([texts[i] for i in at[e - n:e]]).encode()).hexdigest() if n else "")
            columns = [[k[0] for k in keys], [k[1] for k in keys], *sums.T]
            yield pa.record_batch([*[pa.array(c, pa.int64()) for c in columns], pa.array(digests, pa.string())], names)

    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of ``docs``.

    The vocabulary files are read on the driver: ``a_path`` a byte-level definition, ``b_path`` a piece model."""
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        definition = a.read(), b.read()
    vocabularies = sc.broadcast(definition)
    reader = Aligner(*definition)
    width = reader.width
    table = pair_counts(docs, vocabularies)
    # at most one row for each id of A
    tops = table.select("pairs", "counts").mapInArrow(_best(width), "a long, n long").groupBy("a").agg(F.max("n").alias("n")).collect()
    best = np.zeros(len(reader.bytes_a), np.int64)
    for r in tops:
        best[r.a] = r.n
    rounds = -(-(table.agg(F.sum("n")).first()[0] or 1) // round_pairs)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    parts = []
    for k in range(rounds):
        # at most round_pairs pairs, but for the spread of the buckets' sizes
        rows = [tuple(r) for r in table.where(F.col("bucket") % rounds == k).select("bucket", "n", "sizes", "bits", "pairs", "counts").collect()]
        parts.append(texts.mapInArrow(_lookups(vocabularies, sc.broadcast((rows, best, width)), uuid.uuid4().hex), ALIGNED))
    if rounds == 1:
        return parts[0].drop("row")
    out = staged(parts[0], "align-round")
    for part in parts[1:]:
        out = out.unionByName(staged(part, "align-round"))
    same = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    out = out.groupBy("row").agg(*[F.first(c).alias(c) for c in same], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
