"""Near-duplicate documents by chosen-path set similarity join.

A document is the set of its word shingles, and 64 minwise tokens stand for it.
Documents with one set are one class; a class takes part once.  Each of
``trees`` independent trees branches the classes recursively: a node picks
positions of the minwise tokens, and classes that agree there go to one child.
A position is agreed on with the probability of the similarity, and deeper nodes
branch on ``DEEPER`` positions, ``WAYS`` ways each time (1 / 0.8 a position in the
first round).  A node of at most ``LEAF`` classes is compared
exhaustively.  A larger one compares its members with ``PIVOTS`` of them.
Members close to pivots that share close members form the node's core, which is
one component.  If at most ``OUTSIDE`` members stay outside, these are compared
with the whole node and it ends; else it branches on.

Trees are grown in two rounds.  Nodes of the first ``FIRST_TREES`` return the
likeliest pairs that would join their members, not all pairs.  Once these are
confirmed, a node of a later tree ends where its members already are one
component, and its core is its largest component.  More than ``LEAF`` outsiders are
compared with the whole node on full sets: a group of copies around the threshold
has very many pairs that minwise tokens cannot rule out, and of its links only
those are needed that join components.

Nodes compare minwise tokens only.  Every pair that may reach the threshold is
then confirmed on full sets, in steps: the pairs of the first round, then one
pair for each two components that a pair may join, then all pairs whose classes
are still in different components.  A pair that is left out lies
in one component already, so components lose nothing by it.

Recall: at 1 / 0.8 ways a pair at 0.8 shares one child on average, and its chance to
stay together falls with every level (0.71, 0.56, 0.47 after one to three), faster
for the half of such pairs that agree in fewer tokens.  Later trees therefore
branch ``WAYS`` ways a node.  ``missed`` is the share of pairs at the threshold that the later
trees miss at a level; trees are added until it meets ``recall`` at the deepest
level that they have reached.  The trees of the first round are not counted.

Defined results: null and empty texts have no set and link with nothing.  Rows
with one id are one document, linked if any of its texts is.  A null id gets a
null component and is kept.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, staged, with_group
from .components import connected
from .exact import may_repeat, repeat_filter

TOKENS = 64
LEAF = 64
#: Share of equal minwise tokens from which a pair is confirmed on full sets.
MAYBE = 0.62
#: Share from which a member counts as close to a pivot.
CLOSE = 0.875
PIVOTS = 8
FIRST_TREES = 4
#: Positions in which the children of a large node agree.
DEEPER = 4
#: Children of a large node in later trees; a pair at 0.8 shares two of them on average.
WAYS = 5
#: Members outside a large node's core up to which the node is compared and ends: fewer steps than its branches' rows.
OUTSIDE = 4096
#: Members of a large node, and shingles of members, that one comparison holds, about.
PART, PART_ITEMS = 1024, 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed word shingles of whole texts; A-Z count as a-z, words lie between ASCII white space."""

    def __init__(self, width: int):
        self.width = width
        # for bytes.translate: lower case, and whether a byte belongs to a word
        self.lower = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
        self.solid = bytes(b != 32 and not 9 <= b < 14 for b in range(256))
        self.power = self.inverse = np.ones(1, np.uint64)
        rng = np.random.default_rng(11)
        self.order = rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
        self.minwise = rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            m = 1 << int(n).bit_length()
            back = np.uint64(pow(int(_ODD), -1, 1 << 64))
            self.power = np.concatenate([np.ones(1, np.uint64), np.full(m - 1, _ODD)]).cumprod(dtype=np.uint64)
            self.inverse = np.concatenate([np.ones(1, np.uint64), np.full(m - 1, back)]).cumprod(dtype=np.uint64)

    def _placed(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word starts, and one 64-bit hash a word: a polynomial of its bytes, taken from prefix sums."""
        n = len(data)
        self._powers(n)
        word = np.frombuffer(b"\0" + data.translate(self.solid) + b"\0", bool)
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, end = edge[::2], edge[1::2]
        value = np.frombuffer(data.translate(self.lower), np.uint8).astype(np.uint64)
        value += np.uint64(1)
        value *= self.power[:n]
        total = np.zeros(n + 1, np.uint64)
        value.cumsum(out=total[1:])
        return start, _mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * self.order[0])

    def words(self, data: bytes) -> np.ndarray:
        out, i, n = [], 0, len(data)
        while i < n:
            j = min(n, i + _BLOCK)
            while j < n and data[j] not in b" \t\n\x0b\x0c\r":
                j += 1
            out.append(self._placed(data[i:j])[1])
            i = j
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def words_of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The words of each text, as ``words`` has them; the texts are read as one, so short ones cost little."""
        if not texts:
            return []
        start, words = self._placed(b"\n".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = [0, *np.searchsorted(start, ends).tolist()]
        return [words[a:b] for a, b in itertools.pairwise(cuts)]

    def shingles(self, data: bytes) -> np.ndarray:
        """Sorted distinct hashes; a text of fewer words is one shingle."""
        words = self.words(data)
        n, k = len(words), self.width
        if not n:
            return words
        if n < k:
            return _mix((words * self.order[1:n + 1]).sum(keepdims=True) + np.uint64(n))
        total = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            total += words[i:n - k + 1 + i] * self.order[i + 1]
        return np.unique(_mix(total))

    def signature(self, items: np.ndarray) -> np.ndarray:
        return np.array([(items * a).min() for a in self.minwise], np.uint64) >> np.uint64(33)


def _bytes(text) -> bytes:
    got = text.as_py()
    return b"" if got is None else got.encode("utf-8", "replace")


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                items = shingler.shingles(_bytes(text))
                if len(items):
                    rows.append((len(items), int(items.sum().view(np.int64)), int(_mix(items * _ODD).sum().view(np.int64)),
                                 shingler.signature(items).astype(np.int32)))
                else:
                    rows.append((0, 0, 0, None))
            n, a, b, s = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                   pa.array(s, pa.list_(pa.int32()))], ["doc_id", "n_shingles", "fp1", "fp2", "tokens"])
        release()

    return run


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, tokens): set size, 128-bit fingerprint of the set, minwise tokens."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _sketches(width), "doc_id long, n_shingles long, fp1 long, fp2 long, tokens array<int>")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                part = batch.slice(s, 500)
                sets = [shingler.shingles(_bytes(t)).view(np.int64) for t in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "items"])
        release()

    return run


PAIRS = "a long, b long, share float, first boolean"


def _pair_batch(found: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    cols = zip(*found, strict=True) if found else [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def _by_node(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows sorted by their first ``keys`` columns -> (key, its rows), one key at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            key = tuple(int(c[s]) for c in cols)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(s, e - s))
    if held:
        yield last, pa.Table.from_batches(held)


def _matrix(table: pa.Table) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in table.column("tokens").chunks]).reshape(table.num_rows, TOKENS)


def _forest(share: np.ndarray) -> list[tuple[int, int]]:
    """The likeliest pairs that join all rows that pairs of at least MAYBE can join."""
    n = len(share)
    best, link, seen, out = np.full(n, -1.0), np.zeros(n, np.int64), np.zeros(n, bool), []
    for _ in range(n):
        i = int(np.where(seen, -2.0, best).argmax())
        if best[i] >= MAYBE:
            out.append((i, int(link[i])))
        seen[i] = True
        nearer = ~seen & (share[i] > best)
        best[nearer], link[nearer] = share[i][nearer], i
    return out


def _leaf_pairs(forest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (node, id, comp, tokens) sorted by node -> pairs that agree enough and lie in different
        components: a forest of them, or all.  A node has at most LEAF rows."""
        names, kinds = ["a", "b", "share", "first"], [pa.int64(), pa.int64(), pa.float32(), pa.bool_()]
        out: list[tuple] = []
        for _, rows in _by_node(batches, 1):
            ids, comp, m = rows.column("id").to_pylist(), rows.column("comp").to_numpy(), _matrix(rows)
            share = np.stack([(m == x).mean(1) for x in m])
            share[comp[:, None] == comp[None, :]] = -1.0
            hits = _forest(share) if forest else np.argwhere(np.triu(share, 1) >= MAYBE).tolist()
            out += [(ids[i], ids[j], float(share[i, j]), forest) for i, j in hits]
            if len(out) >= 20_000:
                yield _pair_batch(out, names, kinds)
                out = []
        yield _pair_batch(out, names, kinds)

    return run


def _with_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, part, rank, id, tokens) sorted by (node, part); rank >= 0 is a pivot, -1 a member.

    A member gives one row with the bits of its close pivots, and a row for the pivot that it agrees with best.  For
    two pivots that share close members, one such member is paired with both."""
    names = ["node", "id", "close", "other", "share", "first"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float32(), pa.bool_()]
    out: list[tuple] = []
    for (node, _), rows in _by_node(batches, 2):
        rank, ids, m = rows.column("rank").to_numpy(), rows.column("id").to_numpy(), _matrix(rows)
        pivots = np.flatnonzero(rank >= 0)
        pivots = pivots[np.argsort(rank[pivots], kind="stable")]
        members = np.flatnonzero(rank < 0)
        share = np.stack([(m[members] == m[p]).mean(1) for p in pivots], 1)
        bits = ((share >= CLOSE) << np.arange(len(pivots))).sum(1)
        own = ids[members][:, None] == ids[pivots][None, :]
        # the pair that is confirmed first: the earliest close pivot, else the best one
        rated = np.where(own, -1.0, np.where(share >= CLOSE, 2.0 - np.arange(len(pivots)) / 100, share))
        best = rated.argmax(1)
        for i, k in enumerate(members.tolist()):
            out.append((node, int(ids[k]), int(bits[i]), None, None, None))
            if share[i, best[i]] >= MAYBE and not own[i, best[i]]:
                out.append((node, int(ids[k]), None, int(ids[pivots[best[i]]]), float(share[i, best[i]]), True))
        for j in range(len(pivots)):
            for k in range(j):
                both = np.where(own[:, j] | own[:, k], -1.0, np.minimum(share[:, j], share[:, k]))
                i = int(both.argmax()) if len(both) else 0
                if len(both) and both[i] >= CLOSE:
                    out += [(node, int(ids[members[i]]), None, int(ids[pivots[x]]), float(share[i, x]), True) for x in (j, k)]
        if len(out) >= 20_000:
            yield _pair_batch(out, names, kinds)
            out = []
    yield _pair_batch(out, names, kinds)


def _core(rows: pd.DataFrame) -> pd.DataFrame:
    """(node, close, n) of one node, at most 2 ** PIVOTS rows -> the bits of its core and the number outside."""
    bits, n = rows["close"].to_numpy(), rows["n"].to_numpy()
    best, inside = 0, -1
    for k in range(PIVOTS):
        core = 1 << k
        while True:
            wider = core | int(np.bitwise_or.reduce(bits[(bits & core) != 0], initial=0))
            if wider == core:
                break
            core = wider
        size = int(n[(bits & core) != 0].sum())
        if size > inside:
            best, inside = core, size
    return pd.DataFrame({"node": [rows["node"].iloc[0]], "core": [best], "outside": [int(n.sum()) - inside]})


def _with_outside(forest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (node, part, rank, id, comp, tokens) sorted by (node, part); rank 0 stands outside the core, -1
        is any member -> each outsider's best pair of the part, or all its pairs, of different components."""
        names, kinds = ["a", "b", "share", "first"], [pa.int64(), pa.int64(), pa.float32(), pa.bool_()]
        out: list[tuple] = []
        for _, rows in _by_node(batches, 2):
            rank, ids, comp, m = rows.column("rank").to_numpy(), rows.column("id").to_numpy(), rows.column("comp").to_numpy(), _matrix(rows)
            members = np.flatnonzero(rank < 0)
            for k in np.flatnonzero(rank >= 0).tolist():
                share = np.where(comp[members] == comp[k], -1.0, (m[members] == m[k]).mean(1))
                hits = np.flatnonzero(share >= MAYBE)
                if forest and len(hits):
                    hits = [int(share.argmax())]
                out += [(int(ids[k]), int(ids[members[j]]), float(share[j]), forest) for j in hits]
            if len(out) >= 20_000:
                yield _pair_batch(out, names, kinds)
                out = []
        yield _pair_batch(out, names, kinds)

    return run


def _exact_outside(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (node, part, rank, id, comp, items) sorted by (node, part, rank): the members of a part (rank -1), then the
        outsiders one by one -> links that join components of the part."""
        out: list[tuple[int, int]] = []
        key, members, index = None, [], None

        def flush() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
            out.clear()
            return batch

        def find(c: int) -> int:
            while parent.get(c, c) != c:
                parent[c] = c = parent.get(parent[c], parent[c])
            return c

        parent: dict[int, int] = {}
        for batch in batches:
            node, part, rank, ids, comp = (batch.column(i).to_pylist() for i in range(5))
            lists = batch.column(5)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], lists.value_lengths().to_numpy().cumsum()])
            for k in range(batch.num_rows):
                if (node[k], part[k]) != key:
                    key, members, index, parent = (node[k], part[k]), [], None, {}
                items = flat[at[k]:at[k + 1]]
                if rank[k] < 0:
                    members.append((ids[k], comp[k], items.copy()))
                    continue
                if index is None:
                    sizes = np.array([len(m[2]) for m in members], np.int64)
                    owner = np.repeat(np.arange(len(members), dtype=np.int32), sizes)
                    every = np.concatenate([m[2] for m in members]) if members else np.zeros(0, np.int64)
                    order = np.argsort(every, kind="stable")
                    index = every[order], owner[order], sizes, np.array([m[1] for m in members], np.int64)
                every, owner, sizes, comps = index
                low, high = np.searchsorted(every, items, "left"), np.searchsorted(every, items, "right")
                n = high - low
                places = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                shared = np.bincount(owner[places], minlength=len(sizes))
                hits = np.flatnonzero((100 * shared >= percent * (sizes + len(items) - shared)) & (comps != comp[k]))
                for j in hits[np.unique(comps[hits], return_index=True)[1]].tolist():
                    x, y = find(comp[k]), find(int(comps[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        out.append((ids[k], members[j][0]))
            if len(out) >= 20_000:
                yield flush()
        yield flush()

    return run


def _exact_links(ends: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the outsiders of large nodes; ``ends`` (node, id, comp, inside, size), size: shingles of the set."""
    parts = ends.groupBy("node").agg(F.ceil(F.sum("size") / PART_ITEMS).cast("int").alias("parts"))
    rows = ends.join(parts, "node")
    a = rows.select("node", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(-1).alias("rank"), "id", "comp")
    b = rows.where("NOT inside").select("node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("rank"), "id", "comp")
    dealt = a.unionByName(b).join(sets, "id").select("node", "part", "rank", "id", "comp", "items")
    dealt = dealt.repartition("node", "part").sortWithinPartitions("node", "part", "rank")
    return staged(dealt.mapInArrow(_exact_outside(percent), "a long, b long"), "near-exact")


def _token(at: Column) -> Column:
    return F.element_at("tokens", (F.pmod(at, F.lit(TOKENS)) + 1).cast("int"))


def _parts(n: Column) -> Column:
    return F.ceil(n / PART).cast("int")


def _side_by_side(members: DataFrame, few: DataFrame) -> DataFrame:
    """Members (node, id, comp, n, tokens) in parts of a node, with the few (also rank) in each part."""
    a = members.select("node", F.pmod(F.xxhash64("id"), _parts(F.col("n"))).cast("int").alias("part"), F.lit(-1).alias("rank"), "id", "comp", "tokens")
    b = few.select("node", F.explode(F.sequence(F.lit(0), _parts(F.col("n")) - 1)).alias("part"), "rank", "id", "comp", "tokens")
    return a.unionByName(b).repartition("node", "part").sortWithinPartitions("node", "part")


def _cores_by_pivots(members: DataFrame, pivots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with ``inside`` (the core) and ``outside`` (number of the others), and the pairs met."""
    seen = staged(_side_by_side(members, pivots).mapInArrow(
        _with_pivots, "node long, id long, close int, other long, share float, first boolean"), "near-seen")
    pairs = seen.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"), "share", "first")
    rated = seen.where("close IS NOT NULL").select("node", "id", "close")
    # one row a node
    cores = rated.groupBy("node", "close").agg(F.count(F.lit(1)).alias("n")).groupBy("node").applyInPandas(
        lambda rows: _core(rows), "node long, core int, outside long")
    rated = members.join(rated, ["node", "id"]).join(cores, "node")
    return staged(rated.withColumn("inside", F.col("close").bitwiseAND(F.col("core")) != 0).drop("close", "core"), "near-rated"), pairs


def _cores_by_components(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
    cores = sizes.groupBy("node").agg(F.max_by("comp", F.struct("k", "comp")).alias("core"), (F.first("n") - F.max("k")).alias("outside"))
    rated = members.join(cores, "node")
    return staged(rated.withColumn("inside", F.col("comp") == F.col("core")).drop("core"), "near-rated")


def missed(level: int, trees: int, similarity: float = 0.8) -> float:
    """Bound of the share of pairs of this similarity that no node of the trees compares, if these end at ``level``
    or above: the mean over the number of minwise tokens in which a pair agrees."""
    total = 0.0
    for k in range(TOKENS + 1):
        share = k / TOKENS
        meet, chance = 1.0, math.comb(TOKENS, k) * similarity ** k * (1 - similarity) ** (TOKENS - k)
        for _ in range(level):
            meet = 1 - (1 - share ** DEEPER * meet) ** WAYS
        total += chance * ((1 - share * meet) ** trees if share >= MAYBE else 1.0)
    return total


def trees_for(level: int, recall: float, similarity: float = 0.8) -> int:
    """Trees after which at most 1 - ``recall`` of the pairs at the threshold are missed."""
    if missed(0, 1 << 20, similarity) > 1 - recall:
        raise ValueError(f"{TOKENS} minwise tokens do not reach a recall of {recall}")
    trees = 1
    while missed(level, trees, similarity) > 1 - recall:
        trees += 1
    return trees


def candidate_pairs(classes: DataFrame, trees: range, comps: DataFrame | None = None,
                    max_depth: int = 64) -> tuple[DataFrame, int, DataFrame | None]:
    """``classes`` (id, tokens, size of the set) -> pairs (a, b, share, first) that some node of the
    trees compares and that may be links, the deepest level with a node, and the large
    nodes (node, id, comp, inside, size) whose outsiders are to be compared on full sets.
    ``comps`` (id, component_id): components known so far; pairs inside one are left out."""
    # the root of each tree picks one position; the position is part of the child's name
    nodes = classes.select("id", F.explode(F.array(*[F.xxhash64(F.lit(t), _token(F.xxhash64(F.lit(t)))) for t in trees])).alias("node"))
    known = None if comps is None else comps.select("id", F.col("component_id").alias("comp"))
    if known is not None:
        nodes = nodes.join(known, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    else:
        nodes = nodes.withColumn("comp", F.col("id"))
    leaves, found, whole, deepest, ways = [], [], None, 0, 1.25 ** DEEPER if known is None else WAYS
    for level in range(max_depth):
        nodes = staged(nodes.select("node", "id", "comp"), "near-nodes")
        if level and nodes.isEmpty():
            break
        deepest = level
        salt = F.pmod("node", F.lit(4))
        pick = {f"p{k}": F.min(F.struct(F.xxhash64("id", salt, F.lit(k)).alias("h"), "id")) for k in range(PIVOTS if known is None else 0)}
        first = {"n": F.count(F.lit(1)), "lo": F.min("comp"), "hi": F.max("comp")} | pick
        last = {"n": F.sum("n"), "lo": F.min("lo"), "hi": F.max("hi")} | {k: F.min(k) for k in pick}
        sized = with_group(nodes, ["node"], F.col("id"), first, last).where("lo <> hi")
        sized = staged(sized.select("node", "id", "comp", "n", F.array(*[F.col(f"{k}.id") for k in pick]).cast("array<long>").alias("pivots")), "near-sized")
        leaves.append(sized.where(F.col("n") <= LEAF).select("node", "id", "comp"))
        large = sized.where(F.col("n") > LEAF)
        if large.isEmpty():
            break
        members = staged(large.drop("pivots").join(classes, "id"), "near-large")
        if known is None:
            pivots = (large.groupBy("node").agg(F.first("n").alias("n"), F.first("pivots").alias("pivots"))
                      .select("node", "n", F.posexplode(F.array_distinct("pivots")).alias("rank", "id")).join(classes, "id"))
            rated, met = _cores_by_pivots(members, pivots.withColumn("comp", F.col("id")))
            found.append(met)
        else:
            rated = _cores_by_components(members)
        ends = rated.where(F.col("outside").between(1, OUTSIDE if known is None else LEAF))
        found.append(_side_by_side(ends, ends.where("NOT inside").withColumn("rank", F.lit(0))).mapInArrow(_with_outside(known is None), PAIRS))
        if known is not None:
            more = rated.where(F.col("outside").between(LEAF + 1, OUTSIDE)).select("node", "id", "comp", "inside", "size")
            whole = more if whole is None else whole.unionByName(more)

        def child(k: int) -> Column:
            # ``ways`` children on average
            at = [_token(F.xxhash64("node", F.lit(DEEPER * k + i))) for i in range(DEEPER)]
            return F.when(F.lit(k) < F.floor(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(1000)) / 1000 + ways), F.xxhash64("node", F.lit(k), *at))

        nodes = (rated.where(F.col("outside") > OUTSIDE)
                 .select("id", "comp", F.explode(F.array_compact(F.array(*[child(k) for k in range(math.ceil(ways))]))).alias("node")))
    else:
        raise RuntimeError("nodes stay large; raise max_depth")
    met = leaves[0]
    for more in leaves[1:]:
        met = met.unionByName(more)
    small = met.join(classes, "id").select("node", "id", "comp", "tokens").repartition("node").sortWithinPartitions("node")
    pairs = small.mapInArrow(_leaf_pairs(known is None), PAIRS)
    for more in found:
        pairs = pairs.unionByName(more)
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "share", "first")
    return staged(ordered.groupBy("a", "b").agg(F.max("share").alias("share"), F.max("first").alias("first")), "near-pairs"), deepest, whole


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets have intersection >= percent / 100 of the union."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    inter = F.size(F.array_intersect("x", "y"))
    hit = both.select("a", "b", inter.alias("i"), (F.size("x") + F.size("y")).alias("s")).where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent)
    return hit.select("a", "b").distinct()


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet, with their components."""
    for end in ("a", "b"):
        pairs = pairs.join(comps.select(F.col("id").alias(end), F.col("component_id").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return pairs.where("ca <> cb")


def _joined(comps: DataFrame, links: DataFrame, salts: int = 16) -> DataFrame:
    """``comps`` (id, component_id) after more links: only the components that these join are searched."""
    between = _apart(links, comps).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    merged = connected(between)
    # a component may hold any share of the ids
    spread = merged.select(F.col("id").alias("component_id"), F.col("component_id").alias("now"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    old = comps.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).join(spread, ["component_id", "_salt"], "left")
    new = merged.join(comps.select("id"), "id", "left_anti")
    return staged(old.select("id", F.coalesce("now", "component_id").alias("component_id")).unionByName(new), "near-comps")


def _extend(docs: DataFrame, classes: DataFrame, trees: range, links: DataFrame, comps: DataFrame | None, width: int,
            percent: int) -> tuple[DataFrame, DataFrame, int]:
    """Links confirmed with those that the trees bring, their components, and the trees' deepest level."""
    pairs, level, ends = candidate_pairs(classes, trees, comps)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    if ends is not None:
        ends = staged(ends, "near-nodes")
        wanted = wanted.unionByName(ends.select(F.col("id").alias("doc_id")))
    wanted = staged(wanted.distinct(), "near-wanted")
    if comps is not None and wanted.isEmpty():
        return links, comps, level
    # a filter of the wanted ids drops the other texts before they shuffle
    table, bits = repeat_filter(wanted, "doc_id", times=1)
    some = may_repeat(docs.select(F.col("doc_id").cast("long"), "text"), table, bits, "doc_id").where("may_repeat").select("doc_id", "text")
    sets = staged(some.join(wanted, "doc_id").mapInArrow(_sets(width), "id long, items array<long>"), "near-sets")
    if comps is None:
        links = staged(links.unionByName(confirmed(pairs, sets, percent)), "near-links")
        return links, connected(links), level
    if ends is not None:
        exact = _exact_links(ends, sets, percent)
    else:
        exact = links.limit(0)  # nothing to compare on full sets
    # one pair for each two components, the likeliest; then all pairs that are still apart
    apart = staged(_apart(pairs, comps), "near-apart")
    tops = apart.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(F.max_by(F.struct("a", "b"), F.struct("share", "a", "b")).alias("p"))
    for rest in (tops.select("p.a", "p.b"), None):
        rest = staged(_apart(apart.select("a", "b"), comps).select("a", "b") if rest is None else rest, "near-rest")
        found = confirmed(rest, sets, percent)
        if exact is not None:
            found, exact = found.unionByName(exact), None
        elif rest.isEmpty():
            break
        found = staged(found, "near-found")
        if not found.isEmpty():
            links, comps = links.unionByName(found), _joined(comps, found)
    return links, comps, level


def groups(docs: DataFrame, width: int = 4, percent: int = 80, trees: int = 12, recall: float = 0.99) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    ``trees`` is the least number; more are grown until a pair at the threshold is compared with probability ``recall``."""
    rows = staged(sketches(docs, width), "near-sketches")
    member = staged(with_group(rows.select("doc_id", "n_shingles", "fp1", "fp2"), ["fp1", "fp2", "n_shingles"], F.col("doc_id"),
                               {"rep": F.min("doc_id")}, {"rep": F.min("rep")}).select("doc_id", "n_shingles", "fp1", "rep"), "near-members")
    leads = member.where("n_shingles > 0 AND doc_id = rep").select("doc_id", "fp1").distinct()
    classes = staged(rows.join(leads, ["doc_id", "fp1"], "left_semi").dropDuplicates(["doc_id", "fp1"])
                     .select(F.col("doc_id").alias("id"), "tokens", F.col("n_shingles").alias("size")), "near-classes")
    # an id with several texts links the classes of all of them
    several = member.where("n_shingles > 0").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    own = member.where("n_shingles > 0").join(several, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))
    links, cut, deepest = staged(own, "near-links"), min(FIRST_TREES, trees), 0
    links, comps, _ = _extend(docs, classes, range(cut), links, None, width, percent)
    grown, wanted = cut, max(trees, cut + trees_for(0, recall, percent / 100))
    while grown < wanted:
        links, comps, level = _extend(docs, classes, range(grown, wanted), links, comps, width, percent)
        deepest = max(deepest, level)
        grown, wanted = wanted, max(wanted, cut + trees_for(deepest, recall, percent / 100))
    out = member.withColumn("rep", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")))
    out = out.join(comps.select(F.col("id").alias("rep"), "component_id"), "rep", "left")
    component = F.coalesce("component_id", "rep")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def dedup(docs: DataFrame, width: int = 5, percent: int = 80, trees: int = 12) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    A filter of the dropped ids lets most texts pass without a shuffle."""
    dropped = staged(groups(docs, width, percent, trees).where("NOT kept").select("doc_id").distinct(), "near-dropped")
    table, bits = repeat_filter(dropped, "doc_id", times=1)
    flag, key = "__may_drop", "__doc_id"
    probed = may_repeat(docs.withColumn(key, F.col("doc_id").cast("long")), table, bits, key, flag)
    again = probed.where(F.col(flag)).join(dropped.select(F.col("doc_id").alias("__dropped")), F.col(key) == F.col("__dropped"), "left_anti")
    return probed.where(~F.col(flag)).unionByName(again).select(*docs.columns)
