"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Every token is predicted from the ``SIDE`` tokens before and after it, never
from itself; a document's score is the sum of these conditional log
probabilities.  A token is a hashed word.  The probability of a token is the
network's probability of its class times the token's corpus share of the class
(classes are bands of frequency; the most frequent tokens are classes of their
own).

Counts cover all words of all documents, and the number of hash buckets grows
with the square root of the number of words, between 2**10 and ``MOST``.
Training predicts every position of every document once: positions are dealt
into ``SHARES`` by a hash of document and place, each round takes its part of the
shares, and the rounds together take all.  In a round every task trains a copy of
the network on what it reads, and the copies are averaged by their numbers of
tokens, in two steps of bounded groups.
The driver holds counts and weights of at most ``MOST`` buckets.

Defined results: a null or empty text has no tokens, log likelihood 0 and null
mean; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near_text import Shingler

MOST = 1 << 16
SIDE = 2
DIM = 16
HIDDEN = 32
OWN = 63
CLASSES = 128
#: Positions are trained in so many shares; a training step takes one share of what was read.
SHARES = 8
ROUNDS = 2
#: Tokens read before training steps.
CHUNK = 1 << 14
#: Tokens of a text that the network scores together.
BLOCK = 1 << 11
#: Bytes of text that are hashed together.
READ = 1 << 17
#: Sums of magnitudes of output weights up to which outputs need no shift before ``exp`` in single precision.
SAFE = 60.0
#: Weights are averaged in pieces of so many numbers, over so many parts of the tasks.
PIECE, PARTS = 4096, 64


def word_hashes(shingler: Shingler, text: str | None) -> np.ndarray:
    """One 64-bit hash a word of the whole text; A-Z count as a-z."""
    return shingler.words((text or "").encode("utf-8", "replace"))


def column_hashes(shingler: Shingler, column: pa.Array) -> Iterator[np.ndarray]:
    """``word_hashes`` of every text of a column, some texts at a time."""
    texts, size = [], 0
    for text in column:
        data = (text.as_py() or "").encode("utf-8", "replace")
        if len(data) >= READ:
            yield from shingler.words_of(texts)
            yield shingler.words(data)
            texts, size = [], 0
            continue
        texts.append(data)
        size += len(data)
        if size >= READ:
            yield from shingler.words_of(texts)
            texts, size = [], 0
    yield from shingler.words_of(texts)


@dataclass
class Vocabulary:
    """Counts of hash buckets, their classes, and log shares of the class."""

    counts: np.ndarray
    class_of: np.ndarray = field(init=False)
    log_share: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.counts)
        mass = self.counts + 0.5
        order = np.argsort(-self.counts, kind="stable")
        self.class_of = np.empty(n, np.int32)
        self.class_of[order[:OWN]] = np.arange(OWN)
        rest = order[OWN:]
        done = mass[rest].cumsum()
        self.class_of[rest] = OWN + np.minimum((done - mass[rest]) / done[-1] * (CLASSES - OWN), CLASSES - OWN - 1).astype(np.int32)
        total = np.bincount(self.class_of, mass, CLASSES)
        self.log_share = np.log(mass / total[self.class_of]).astype(np.float32)

    @property
    def bits(self) -> int:
        return len(self.counts).bit_length() - 1

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int32)


class Network:
    """Embeddings of the window -> tanh layer -> softmax over classes.  Bucket ``n`` is the edge of a text."""

    def __init__(self, buckets: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.embed = (rng.standard_normal((buckets + 1, DIM)) * 0.1).astype(f)
        self.w1 = (rng.standard_normal((2 * SIDE * DIM, HIDDEN)) / math.sqrt(2 * SIDE * DIM)).astype(f)
        self.b1 = np.zeros(HIDDEN, f)
        self.w2 = (rng.standard_normal((HIDDEN, CLASSES)) * 0.1).astype(f)
        self.b2 = np.zeros(CLASSES, f)

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.w1, self.b1, self.w2, self.b2]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.parts():
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size

    def top(self) -> tuple[np.ndarray, bool]:
        """Output weights with their offsets as the last row, and whether no output can leave the range of ``exp``."""
        top = np.concatenate([self.w2, self.b2[None]])
        return top, float(np.abs(top).sum(0).max()) < SAFE

    def _outputs(self, x: np.ndarray, top: tuple[np.ndarray, bool]) -> tuple[np.ndarray, np.ndarray]:
        """Inputs -> hidden values with a last column of ones, outputs before the softmax; where outputs may be large,
        the largest of a row at 0."""
        values = x @ self.w1
        values += self.b1
        h = np.empty((len(x), HIDDEN + 1), values.dtype)
        h[:, :HIDDEN] = np.tanh(values, out=values)
        h[:, HIDDEN] = 1
        z = h @ top[0]
        if not top[1]:
            z -= z.max(1, keepdims=True)
        return h, z

    def _inputs(self, around: np.ndarray) -> np.ndarray:
        return self.embed.take(around.ravel(), 0).reshape(len(around), -1)

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window ids (n x 2 SIDE) -> inputs, hidden values, log probabilities of classes."""
        x = self._inputs(around)
        h, z = self._outputs(x, self.top())
        return x, h[:, :HIDDEN], z - np.log(np.exp(z).sum(1, keepdims=True))

    def log_probabilities(self, x: np.ndarray, target: np.ndarray, top: tuple[np.ndarray, bool]) -> np.ndarray:
        """Log probability of one class for each row of inputs; ``top`` as ``top()`` gives it."""
        z = self._outputs(x, top)[1]
        at = z[np.arange(len(target)), target]
        np.exp(z, out=z)
        return at - np.log(z @ np.ones(CLASSES, z.dtype))

    def gradients(self, around: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log probability of the target classes, and its gradients in the order of
        (input rows, w1, b1, w2, b2)."""
        x = self._inputs(around)
        h, e = self._outputs(x, self.top())
        n, rows = len(target), np.arange(len(target))
        at = e[rows, target]
        total = np.exp(e, out=e) @ np.ones(CLASSES, e.dtype)
        loss = float((np.log(total) - at).mean())
        # the gradient of the outputs is e * scale: rows are scaled where they are narrow
        e[rows, target] -= total
        scale = (1 / (total * n))[:, None]
        values = h[:, :HIDDEN]
        dh = e @ self.w2.T
        dh *= scale
        dh *= 1 - values * values
        dw2 = e.T @ (values * scale)
        return loss, [(dh @ self.w1.T).reshape(-1, DIM), x.T @ dh, dh.sum(0), dw2.T, scale[:, 0] @ e]


class Trainer:
    """Adagrad steps; a step predicts some positions from their windows."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate = net, rate
        self.square = [np.full(p.shape, 1e-6, np.float32) for p in net.parts()]
        self.cell = np.zeros(len(net.embed), np.int64)
        self.room = np.empty((0, DIM), np.int64)

    def _room(self, n: int) -> np.ndarray:
        if len(self.room) < n:
            self.room = np.empty((n * 5 // 4, DIM), np.int64)
        return self.room[:n]

    def step(self, around: np.ndarray, target: np.ndarray) -> float:
        loss, (rows, *grads) = self.net.gradients(around, target)
        # one sum for each bucket that occurs
        around = around.ravel()
        ids = np.flatnonzero(np.bincount(around, minlength=len(self.cell)))
        self.cell[ids] = np.arange(0, len(ids) * DIM, DIM)
        cells = np.add(self.cell.take(around)[:, None], np.arange(DIM), out=self._room(len(around)))
        dense = np.bincount(cells.ravel(), rows.ravel(), len(ids) * DIM).astype(np.float32).reshape(-1, DIM)
        square = self.square[0].take(ids, 0)
        square += dense * dense
        self.square[0][ids] = square
        dense *= self.rate
        dense /= np.sqrt(square, out=square)
        self.net.embed[ids] = self.net.embed.take(ids, 0) - dense
        for p, s, g in zip(self.net.parts()[1:], self.square[1:], grads, strict=True):
            s += g * g
            p -= self.rate * g / np.sqrt(s)
        return loss


def windows(texts: list[np.ndarray], edge: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of several texts -> (tokens, their windows), texts parted by edges."""
    pad = np.full(SIDE, edge, np.int32)
    line = np.concatenate([x for t in texts for x in (pad, t)] + [pad])
    keep = np.concatenate([x for t in texts for x in (np.zeros(SIDE, bool), np.ones(len(t), bool))] + [np.zeros(SIDE, bool)])
    at = np.flatnonzero(keep)
    offsets = [*range(-SIDE, 0), *range(1, SIDE + 1)]
    return line[at], np.stack([line[at + o] for o in offsets], 1)


def token_scores(net: Network, vocabulary: Vocabulary, text: np.ndarray, top: tuple[np.ndarray, bool] | None = None) -> np.ndarray:
    """Conditional log probability of every token of a text.

    The network sees a text by itself, in blocks counted from its start: the scores of a text do not depend on what else
    lies in its batch."""
    n, top = len(text), top or net.top()
    pad = np.full(SIDE, len(vocabulary.counts), text.dtype)
    rows = net.embed.take(np.concatenate([pad, text, pad]), 0)
    target, share, out = vocabulary.class_of.take(text), vocabulary.log_share.take(text), np.empty(n, np.float64)
    for s in range(0, n, BLOCK):
        e = min(n, s + BLOCK)
        x = np.concatenate([rows[SIDE + o + s:SIDE + o + e] for o in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)
        out[s:e] = net.log_probabilities(x, target[s:e], top) + share[s:e]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler, counts = Shingler(1), np.zeros(MOST, np.int64)
    shift = np.uint64(64 - (MOST.bit_length() - 1))
    for batch in batches:
        for hashes in column_hashes(shingler, batch.column(0)):
            if len(hashes):
                np.add.at(counts, (hashes >> shift).astype(np.int64), 1)
    seen = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["bucket", "n"])


def corpus_vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts over all words of all documents; at most ``MOST`` rows reach the driver."""
    rows = docs.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    fine = np.zeros(MOST, np.int64)
    fine[rows["bucket"]] = rows["n"]
    buckets = 1 << 10
    while buckets < min(MOST, math.sqrt(fine.sum())):
        buckets *= 2
    return Vocabulary(fine.reshape(buckets, -1).sum(1))


def position_shares(doc_id: int | None, n: int) -> np.ndarray:
    """The share of each of a document's ``n`` positions, by a hash of document and place."""
    return _dealt(np.arange(n, dtype=np.uint64) + _document_key(doc_id))


def _document_key(doc_id: int | None) -> np.uint64:
    return np.uint64((doc_id or 0) * 0xD6E8FEB86659FD93 % (1 << 64))


def _dealt(key: np.ndarray) -> np.ndarray:
    for _ in range(2):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key >>= np.uint64(32)
    return (key % np.uint64(SHARES)).astype(np.int8)


def _train(model, rate: float, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = model.value
        net, shingler = Network(len(vocabulary.counts)), Shingler(1)
        net.load(flat)
        trainer, held, dealt, size, seen = Trainer(net, rate), [], [], 0, 0

        def learn() -> int:
            tokens, around = windows(held, len(vocabulary.counts))
            share, done = _dealt(np.concatenate(dealt)), 0
            # more rounds than shares begin again
            for k in range(turn % SHARES, SHARES, rounds):
                at = np.flatnonzero(share == k)
                if len(at):
                    trainer.step(around[at], vocabulary.class_of[tokens[at]])
                done += len(at)
            return done

        for batch in batches:
            for doc_id, hashes in zip(batch.column(0), column_hashes(shingler, batch.column(1)), strict=True):
                ids = vocabulary.ids(hashes)
                key = _document_key(doc_id.as_py())
                for s in range(0, len(ids), CHUNK):
                    held.append(ids[s:s + CHUNK])
                    dealt.append(np.arange(s, s + len(held[-1]), dtype=np.uint64) + key)
                    size += len(held[-1])
                    if size >= CHUNK:
                        seen += learn()
                        held, dealt, size = [], [], 0
        if held:
            seen += learn()
        flat = net.flat()
        pieces = [flat[s:s + PIECE].tobytes() for s in range(0, len(flat), PIECE)] if seen else []
        part = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array(range(len(pieces)), pa.int32()), pa.array([part] * len(pieces), pa.int32()),
                               pa.array([seen] * len(pieces), pa.int64()), pa.array(pieces, pa.binary())], ["piece", "task", "n", "weights"])

    return run


PIECES = "piece int, task int, n long, weights binary"


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of the weighted mean; tasks are added in their order."""
    rows = rows.sort_values("task")
    mean, total = 0.0, int(rows["n"].sum())
    for n, weights in zip(rows["n"], rows["weights"], strict=True):
        mean = mean + np.frombuffer(weights, np.float32).astype(np.float64) * (n / total)
    return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "task": [rows["task"].iloc[0]], "n": [total], "weights": [mean.astype(np.float32).tobytes()]})


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, rate: float = 0.15) -> Network:
    """Rounds of local training and averaging over all documents; together they train every position."""
    net = Network(len(vocabulary.counts))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sc = docs.sparkSession.sparkContext
    for turn in range(rounds):
        model = sc.broadcast((vocabulary, net.flat()))
        copies = rows.mapInArrow(_train(model, rate / (1 + turn), turn, rounds), PIECES)
        halves = copies.withColumn("part", F.col("task") % PARTS).groupBy("piece", "part").applyInPandas(lambda rows: _average(rows), PIECES)
        mean = halves.groupBy("piece").applyInPandas(lambda rows: _average(rows), PIECES).toPandas().sort_values("piece")
        if len(mean):
            net.load(np.frombuffer(b"".join(mean["weights"]), np.float32))
    return net


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = model.value
        net, shingler = Network(len(vocabulary.counts)), Shingler(1)
        net.load(flat)
        top = net.top()

        for batch in batches:
            sizes, sums = [], []
            for hashes in column_hashes(shingler, batch.column(1)):
                sizes.append(len(hashes))
                sums.append(float(token_scores(net, vocabulary, vocabulary.ids(hashes), top).sum()) if len(hashes) else 0.0)
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()),
                                   pa.array([s / n if n else None for s, n in zip(sums, sizes, strict=True)], pa.float64())],
                                  ["doc_id", "n_tokens", "log_likelihood", "mean_log_prob"])

    return run


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_prob), one row for each row of ``docs``."""
    vocabulary = corpus_vocabulary(docs)
    net = train(docs, vocabulary, rounds)
    model = docs.sparkSession.sparkContext.broadcast((vocabulary, net.flat()))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_score(model), "doc_id long, n_tokens long, log_likelihood double, mean_log_prob double")
