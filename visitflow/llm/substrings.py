"""Removal of byte strings that repeat across a corpus, by deep-shallow suffix sorting.

A byte goes when a string of ``length`` bytes that covers it also starts
somewhere else.  Strings start at every byte; sorting all of those suffixes at
once would multiply the corpus, so suffixes are brought together in three steps
that never part two equal strings:

1. Anchors.  The smallest hashed ``GRAM`` of a string is its anchor.  Equal
   strings have equal anchors at equal places.  Consecutive strings with one
   anchor form a stretch; about one byte in 85 starts one.
2. Stretches that repeat as a whole are found by their 128-bit hash: all of their
   strings repeat.  Anchors that occur once are dropped by a Bloom filter.
3. The other stretches of a repeated anchor meet in one group, and the suffixes
   at their string starts are sorted to depth ``length``: a multikey quicksort,
   eight bytes a step, down to ``SHALLOW`` bytes, then blind tries for the groups
   that still share a prefix: each suffix is compared with the group's first
   one, and placed by the depth and the word at which it branches off.  Suffixes that share all
   ``length`` bytes are the repeated strings.

An anchor with more than ``HOT`` different stretches is not gathered: the hashes
of its strings are counted instead, with partial sums before the shuffle.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes; rows that repeat with their id count as other places, so all copies go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, with_group
from .exact import may_repeat, repeat_filter

LENGTH = 200
GRAM = 32
SHALLOW = 32
HOT = 5000
BLOCK = 1 << 20
#: Suffixes sorted at a time.
SORT = 1 << 18

_B1, _B2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of byte ranges from prefix sums of a polynomial."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int):
        n = len(data) + 1
        if base not in self.powers or len(self.powers[base][0]) < n:
            m = max(1 << 16, 1 << n.bit_length())
            back = pow(base, -1, 1 << 64)
            self.powers[base] = tuple(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (base, back))
        power, self.inverse = self.powers[base]
        self.total = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n - 1], out=self.total[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.inverse[:len(self.total)][start]


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value of each window, by doubling."""
    best, at, step = values, np.arange(len(values), dtype=np.int32), 1
    while step * 2 <= width:
        less = best[step:] < best[:-step]
        best, at = np.where(less, best[step:], best[:-step]), np.where(less, at[step:], at[:-step])
        step *= 2
    if step < width:
        d, n = width - step, len(values) - width + 1
        less = best[d:d + n] < best[:n]
        at = np.where(less, at[d:d + n], at[:n])
    return at


def stretches(data: bytes, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, first start, last start, gram hash, two stretch hashes) of a text, block by block."""
    for at in range(0, max(0, len(data) - length + 1), BLOCK):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, BLOCK + length - 1), at)
        r1, r2 = Rolling(part, _B1), Rolling(part, _B2)
        n = len(part) - GRAM + 1
        grams = _mix(r1.of(slice(0, n), slice(GRAM, GRAM + n)))
        anchor = first_smallest(grams, length - GRAM + 1)
        cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        low = np.concatenate([[0], cut])
        high = np.concatenate([cut, [len(anchor)]]) - 1
        a, size = anchor[low], (high - low).astype(np.uint64)
        yield a + at, low + at, high + at, grams[a], _mix(r1.of(low, high + length) + size), _mix(r2.of(low, high + length) ^ size)


def _bytes(value: str | None) -> bytes:
    return (value or "").encode("utf-8", "replace")


ANCHORS = "doc long, mark long, a int, lo int, hi int, kg long, s1 long, s2 long"


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ANCHORS.split(", ")]
        for batch in batches:
            docs, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows: list[tuple] = []
            held = 0

            def flush() -> pa.RecordBatch:
                cols = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 8
                kinds = [np.int64, np.int64, np.int32, np.int32, np.int32, np.int64, np.int64, np.int64]
                out = pa.record_batch([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(k)) for c, k in zip(cols, kinds, strict=True)], names)
                rows.clear()
                return out

            for i, text in enumerate(batch.column(2)):
                for part in stretches(_bytes(text.as_py()), length):
                    rows.append((np.full(len(part[0]), docs[i]), np.full(len(part[0]), marks[i]), *part))
                    held += len(part[0])
                if held >= 200_000:
                    yield flush()
                    held = 0
            yield flush()

    return run


def repeated_suffixes(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes equal another one of their group in their first ``length`` bytes.

    ``data`` needs eight spare bytes at its end; lengths need not be multiples of eight."""
    word = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    steps = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])

    def split(rows: np.ndarray, g: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sort by group and keys, number the new groups, drop single suffixes."""
        order = np.lexsort((*keys[::-1], g))
        rows, g, keys = rows[order], g[order], [k[order] for k in keys]
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for k in (g, *keys):
            new[1:] |= k[1:] != k[:-1]
        alone = new & np.append(new[1:], True)
        return rows[~alone], np.cumsum(new)[~alone]

    rows, g = split(np.arange(len(start)), group)
    shallow = [s for s in steps if s + 8 <= SHALLOW]
    for s in shallow:  # multikey quicksort, eight bytes a step
        if not len(rows):
            break
        rows, g = split(rows, g, word[start[rows] + s].astype(np.uint64))
    out = np.zeros(len(start), bool)
    deep = steps[len(shallow):]
    while len(rows):  # blind tries: branch off the first suffix of the group
        new = np.append(True, g[1:] != g[:-1])
        first = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
        depth = np.full(len(rows), len(deep), np.int32)
        value = np.zeros(len(rows), np.uint64)
        open_ = np.arange(len(rows))
        for d, s in enumerate(deep):
            here = word[start[rows[open_]] + s]
            off = here != word[start[first[open_]] + s]
            depth[open_[off]], value[open_[off]] = d, here[off]
            open_ = open_[~off]
        same = depth == len(deep)
        # the first suffix is repeated if another one never left its path
        number = np.cumsum(new) - 1
        hits = np.bincount(number, same)
        out[rows[same & (hits[number] > 1)]] = True
        rows, g = split(rows[~same], g[~same], depth[~same], value[~same])
    return out


def _sorted_groups(length: int):
    """Rows sorted by anchor -> byte ranges of repeated strings, many groups at a time."""

    def solve(rows: list[tuple]) -> list[tuple]:
        data = np.frombuffer(b"".join(r[5] for r in rows) + bytes(8), np.uint8)
        base = np.cumsum([0] + [len(r[5]) for r in rows])[:-1]
        count = np.array([r[4] - r[3] + 1 for r in rows])
        row = np.repeat(np.arange(len(rows)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        lows, anchors = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
        _, gram = np.unique([r[6] for r in rows], return_inverse=True)
        # only strings that lie alike around their anchors can be equal
        group = gram[row] * (2 * length) + (anchors - lows)[row] - inside
        hit = np.flatnonzero(repeated_suffixes(data, base[row] + inside, group, length))
        out = []
        if len(hit):
            run = np.flatnonzero(np.append(True, (np.diff(hit) > 1) | (np.diff(row[hit]) > 0)))
            for s, e in zip(run, np.append(run[1:], len(hit)), strict=True):
                r = row[hit[s]]
                out.append((rows[r][0], rows[r][1], int(lows[r] + inside[hit[s]]), int(lows[r] + inside[hit[e - 1]] + length)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, last = 0, None

        def flush() -> pa.RecordBatch:
            found = solve(rows) if rows else []
            rows.clear()
            cols = zip(*found, strict=True) if found else [()] * 4
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc", "mark", "x", "y"])

        for batch in batches:
            for r in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                if r[6] != last and held >= SORT:
                    yield flush()
                    held = 0
                last = r[6]
                rows.append(r)
                held += r[4] - r[3] + 1
        yield flush()

    return run


def _contexts(length: int):
    """(doc, mark, text, spots) -> the bytes of each stretch; for hot anchors the hashes of its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "mark", "a", "lo", "hi", "bytes", "kg", "h1", "h2"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[tuple] = []
            for doc, mark, text, spots in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                data = _bytes(text)
                for spot in spots:
                    a, lo, hi, kg = spot["a"], spot["lo"], spot["hi"], spot["kg"]
                    piece = data[lo:hi + length]
                    if not spot["hot"]:
                        rows.append((doc, mark, a, lo, hi, piece, kg, None, None))
                        continue
                    part = np.frombuffer(piece, np.uint8)
                    n = slice(0, hi - lo + 1), slice(length, length + hi - lo + 1)
                    h1, h2 = (_mix(Rolling(part, b).of(*n)).view(np.int64).tolist() for b in (_B1, _B2))
                    rows += [(doc, mark, a, lo + i, lo + i, None, kg, x, y) for i, (x, y) in enumerate(zip(h1, h2, strict=True))]
                if len(rows) >= 20_000:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            cols = zip(*rows, strict=True) if rows else [()] * 9
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of byte ranges."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> Iterator[bytes]:
    at = 0
    for x, y in runs:
        yield data[at:x]
        at = y
    yield data[at:]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            data = _bytes(text)
            runs = merged([(s["x"], s["y"]) for s in spans])
            digest = hashlib.sha256()
            for piece in kept_bytes(data, runs):
                digest.update(piece)
            rows.append((doc_id, len(data), sum(y - x for x, y in runs), len(runs), digest.hexdigest(), [{"x": x, "y": y} for x, y in runs]))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())]))]
        cols = zip(*rows, strict=True) if rows else [()] * 6
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "runs"])


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, mark, doc_id, text): rows are told apart by id and text; repeated rows share both."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("doc"), F.xxhash64(text).alias("mark"), F.col("doc_id").cast("long"), text.alias("text"))


def _among(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``keyed`` whose (doc, mark) may be in ``wanted``; the others do not shuffle."""
    table, bits = repeat_filter(wanted.select(F.xxhash64("doc", "mark").alias("key")), "key", times=1)
    return may_repeat(keyed.withColumn("key", F.xxhash64("doc", "mark")), table, bits, "key", "wanted")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, mark, spans): byte ranges, possibly overlapping, of the repeated strings of a text."""
    keyed = _keyed(docs)
    anchors = staged(keyed.where(F.octet_length("text") >= length).select("doc", "mark", "text").mapInArrow(_anchors(length), ANCHORS), "sub-anchors")
    table, bits = repeat_filter(anchors, "kg")
    # of an anchor that occurs once, no string repeats
    again = staged(may_repeat(anchors, table, bits, "kg").where("may_repeat").drop("may_repeat"), "sub-again")
    stretch = ["kg", "s1", "s2"]
    counted = staged(with_group(again, stretch, F.xxhash64("doc", "mark", "a"), {"n": F.count(F.lit(1))}, {"n": F.sum("n")}), "sub-counted")
    whole = counted.where("n > 1").select("doc", "mark", F.col("lo").cast("long").alias("x"), (F.col("hi") + length).cast("long").alias("y"))
    # one place of each different stretch, in the anchors that have several and any single one
    place = F.struct("doc", "mark", "a", "lo", "hi")
    different = staged(counted.groupBy(*stretch).agg(F.min(place).alias("p"), F.first("n").alias("n")), "sub-different")
    unsure = with_group(different, ["kg"], F.col("s1"), {"m": F.count(F.lit(1)), "single": F.max(F.col("n") == 1)}, {"m": F.sum("m"), "single": F.max("single")})
    spots = (unsure.where("m > 1 AND single").select("kg", "p.*", (F.col("m") > HOT).alias("hot"))
             .groupBy("doc", "mark").agg(F.collect_list(F.struct("a", "lo", "hi", "kg", "hot")).alias("spots")))
    spots = staged(spots, "sub-spots")
    texts = _among(keyed, spots).where("wanted").select("doc", "mark", "text")
    shown = texts.join(spots, ["doc", "mark"]).select("doc", "mark", "text", "spots").mapInArrow(
        _contexts(length), "doc long, mark long, a int, lo int, hi int, bytes binary, kg long, h1 long, h2 long")
    shown = staged(shown, "sub-contexts")
    # a group holds at most HOT stretches
    near = (shown.where("bytes IS NOT NULL").select("doc", "mark", "a", "lo", "hi", "bytes", "kg").repartition("kg").sortWithinPartitions("kg")
            .mapInArrow(_sorted_groups(length), "doc long, mark long, x long, y long"))
    hot = with_group(shown.where("bytes IS NULL").select("doc", "mark", "a", "lo", "kg", "h1", "h2").withColumn("d", F.col("a") - F.col("lo")),
                     ["kg", "d", "h1", "h2"], F.xxhash64("doc", "mark"), {"n": F.count(F.lit(1))}, {"n": F.sum("n")})
    hot = hot.where("n > 1").select("doc", "mark", F.col("lo").cast("long").alias("x"), (F.col("lo") + length).cast("long").alias("y"))
    spans = whole.unionByName(near).unionByName(hot)
    return staged(spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("x", "y")).alias("spans")), "sub-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs), one row for each row of ``docs``."""
    spans = repeated_spans(docs, length)
    probed = _among(_keyed(docs), spans)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, runs array<struct<x:long,y:long>>"
    none = F.array().cast("array<struct<x:long,y:long>>")
    zero = F.lit(0).cast("long")
    whole = [F.col("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
             F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), none.alias("runs")]
    hit = (probed.where("wanted").join(spans, ["doc", "mark"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans")).mapInArrow(_cut, schema))
    return probed.where("NOT wanted").select(*whole).unionByName(hit)
