"""Near-duplicate embeddings by sorted projection passes.

Each pass gives a vector 64 random hashes (the sides of random hyperplanes),
orders all vectors lexicographically by the concatenated hashes, and compares
each with the next ``window`` vectors of that order.  Similar vectors share a
long prefix in some pass and lie close there.  Compared pairs at or above the
threshold are links; passes unite by connected components.

Equal vectors are one class and take part once, with their number as a weight.
A pass is cut into blocks of ``BLOCK`` ranks plus the window that follows.  A
window is saturated where more vectors share the hash prefix that the recall
counts on than it holds: such a run is compared as a whole, cut into tiles of
``TILE`` vectors, each two of them a task's unit of work.  Rows carry their ranks
and runs in all passes, so a pair counts only in the first pass that compares
it; a unit returns link counts and a spanning forest of its links, never the pairs.

The number of passes grows with the table so that a pair at the threshold shares
that prefix in some pass, and so is compared, with probability ``recall`` however
dense its surroundings are.  The work of a run grows with the square of its
size; ``n_links`` counts the links found.

Defined results: null vectors, zero vectors and vectors with null or non-finite
components link with nothing and are kept; vectors of different length do not
link.  A null id gets a null component.  Repeated rows count as vectors of
their own; an id with several different vectors is compared by one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged, with_group
from .components import connected

BITS = 64
BLOCK = 2048
#: Vectors of a saturated run that one comparison holds on each side.
TILE = 4096


def passes_for(rows: int, threshold: float, window: int, recall: float, least: int = 8, most: int = 96) -> int:
    """Passes after which a pair at the threshold has shared a window with probability ``recall``.

    A prefix of log2(rows / window) hashes leaves a window's worth of random
    vectors; a pair agrees on one hash with probability 1 - angle / pi."""
    prefix = max(0.0, math.log2(max(1, rows) / window)) + 1
    met = (1 - math.acos(threshold) / math.pi) ** prefix
    return min(most, max(least, math.ceil(math.log(1 - recall) / math.log(1 - met)) if met < 1 else least))


def prefix_bits(rows: int, window: int) -> int:
    """Hashes that a run shares; no more than ``passes_for`` counts on, so all pairs that it expects to meet do."""
    return min(BITS - 1, int(max(0.0, math.log2(max(1, rows) / window))) + 1)


def _hashes(batch: np.ndarray, seed: int, first: int, last: int) -> np.ndarray:
    """Sort keys (rows x passes) as signed longs in the hashes' lexicographic order."""
    out = np.empty((len(batch), last - first), np.int64)
    for p in range(first, last):
        planes = np.random.default_rng([seed, p, batch.shape[1]]).standard_normal((batch.shape[1], BITS))
        bits = np.packbits(batch @ planes > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)
        out[:, p - first] = (bits ^ np.uint64(1 << 63)).view(np.int64)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, fp1, fp2, dim): a 128-bit fingerprint of the vector; dim 0 for one that links with nothing."""
    import hashlib

    for batch in batches:
        rows = []
        for v in batch.column(1).to_pylist():
            x = np.array([math.nan if c is None else c for c in v] if v is not None else [], np.float64) + 0.0
            if len(x) and np.isfinite(x).all() and x.any():
                d = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                rows.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), len(x)))
            else:
                rows.append((0, 0, 0))
        a, b, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.record_batch([batch.column(0), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int32()), batch.column(1)],
                              ["vec_id", "fp1", "fp2", "dim", "embedding"])


def _keyed(passes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            vectors = batch.column(2).to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                keys = _hashes(np.array([vectors[i] for i in at], np.float64), seed, 0, passes)
                n = len(at)
                yield pa.record_batch([pa.array(np.tile(np.arange(passes, dtype=np.int32), n)), pa.array(np.full(n * passes, d, np.int32)),
                                       pa.array(keys.ravel()), pa.array(np.repeat(ids[at], passes))], ["pass", "dim", "key", "id"])

    return run


def _ranks(classes: DataFrame, passes: int, bits: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(id, ranks, runs): the place of each class in the order of every pass, and its hash prefix there;
    and (pass, dim, run, start, n): the first place and the size of each run of one prefix.

    The id is part of the range key, so equal hashes are dealt over partitions too."""
    spark = classes.sparkSession
    keyed = classes.select("id", "dim", "embedding").mapInArrow(_keyed(passes, seed), "pass int, dim int, key long, id long")
    order = ["pass", "dim", "key", "id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .select("pass", "dim", F.shiftright("key", BITS - bits).alias("run"), "id", F.monotonically_increasing_id().alias("at")), "vec-order")
    part = F.shiftright("at", 33)
    # one row a partition of the sort
    starts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    ranked = placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1))
    runs = ranked.groupBy("pass", "dim", "run").agg(F.min("rank").alias("start"), F.count(F.lit(1)).alias("n"))
    sorted_ = F.array_sort(F.collect_list(F.struct("pass", "rank", "run")))
    placed_in = ranked.groupBy("id").agg(sorted_.alias("all"))
    return placed_in.select("id", F.col("all.rank").alias("ranks"), F.col("all.run").alias("runs")), runs


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Label every vertex of a component of the links (a, b) with its smallest index."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _compare(window: int, threshold: float):
    def links(rows: dict[str, np.ndarray]) -> Iterator[tuple]:
        rank, which, size, dim, ids, ranks, runs, x = (rows[k] for k in ("rank", "pass", "size", "dim", "id", "ranks", "runs", "x"))
        main = int(rows["main"].sum())
        m = len(rank)
        counts, label = np.zeros(m, np.int64), np.arange(m)
        for s in range(0, main, 256):
            e = min(main, s + 256)
            t = min(m, e + window)
            i, j = np.nonzero(x[s:e] @ x[s:t].T >= threshold)
            i, j = i + s, j + s
            ok = (rank[j] > rank[i]) & (rank[j] - rank[i] <= window) & (which[i] == which[j]) & (dim[i] == dim[j])
            i, j = i[ok], j[ok]
            # a pair that an earlier pass has compared was counted there
            far = (np.abs(ranks[i] - ranks[j]) > window) & (runs[i] != runs[j])
            fresh = (far | (np.arange(ranks.shape[1]) >= which[i][:, None])).all(1)
            i, j = i[fresh], j[fresh]
            counts += np.bincount(i, size[j], m).astype(np.int64) + np.bincount(j, size[i], m).astype(np.int64)
            _unite(label, i, j)
        yield from _found(ids, counts, label)

    return _by_unit(links, 1)


def _compare_tiles(window: int, threshold: float):
    """Pairs of one run that lie further apart than the window: those of two tiles, or of one with itself."""

    def links(rows: dict[str, np.ndarray]) -> Iterator[tuple]:
        rank, size, ids, ranks, runs, x, tile = (rows[k] for k in ("rank", "size", "id", "ranks", "runs", "x", "tile"))
        p, m = int(rows["pass"][0]), len(rank)
        counts, label = np.zeros(m, np.int64), np.arange(m)
        left, right = np.flatnonzero(tile == rows["u"][0]), np.flatnonzero(tile == rows["v"][0])
        # neighbours of earlier runs side by side: a chunk then skips what these have compared
        left = left[np.lexsort(runs[left, :p].T[::-1])] if p else left
        for s in range(0, len(left), 256):
            i, new = left[s:s + 256], np.ones(len(right), bool)
            for q in range(p):
                if (runs[i, q] == runs[i[0], q]).all():
                    new &= runs[right, q] != runs[i[0], q]
            j = right[new]
            hit = (x[i] @ x[j].T >= threshold) & (rank[j] - rank[i][:, None] > window)
            for q in range(p):
                if not hit.any():
                    break
                hit &= (runs[i, q][:, None] != runs[j, q]) & (np.abs(ranks[i, q][:, None] - ranks[j, q]) > window)
            # a vector stands once on a side, so no place is added to twice
            counts[i] += hit @ size[j]
            counts[j] += size[i] @ hit
            a, b = np.nonzero(hit & (label[i][:, None] != label[j]))
            _unite(label, i[a], j[b])
        yield from _found(ids, counts, label)

    return _by_unit(links, 3)


def _found(ids: np.ndarray, counts: np.ndarray, label: np.ndarray) -> Iterator[tuple]:
    for k in np.flatnonzero(counts):
        yield int(ids[k]), None, int(counts[k])
    for k in np.flatnonzero(label != np.arange(len(label))):
        yield int(ids[k]), int(ids[label[k]]), 0


def _by_unit(links, keys: int):
    """Rows sorted by their first ``keys`` columns -> the links of each unit of equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts)
            cols = {k: t.column(k).to_numpy() for k in t.column_names if k not in ("embedding", "ranks", "runs")}
            vectors = t.column("embedding").to_pylist()
            x = np.zeros((len(vectors), int(cols["dim"].max())))
            for k, v in enumerate(vectors):
                x[k, :len(v)] = v
            x /= np.sqrt((x * x).sum(1, keepdims=True))
            cols |= {"x": x} | {k: np.array(t.column(k).to_pylist(), np.int64) for k in ("ranks", "runs")}
            out = list(links(cols))
            a, b, n = zip(*out, strict=True) if out else ((), (), ())
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

        unit, held = None, []
        for batch in batches:
            units = np.stack([batch.column(k).to_numpy() for k in range(keys)], 1)
            cuts = [0, *(np.flatnonzero((units[1:] != units[:-1]).any(1)) + 1).tolist(), len(units)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if held and (units[s] != unit).any():
                    yield flush(held)
                    held = []
                unit = units[s]
                held.append(batch.slice(s, e - s))
        if held:
            yield flush(held)

    return run


def groups(vectors: DataFrame, threshold: float = 0.95, window: int = 512, recall: float = 0.99, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``."""
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding")
    schema = f"vec_id long, fp1 long, fp2 long, dim int, embedding {dict(vectors.dtypes)['embedding']}"
    prints = staged(vectors.mapInArrow(_fingerprints, schema).withColumn("row", F.monotonically_increasing_id()), "vec-prints")
    member = staged(with_group(prints.drop("embedding"), ["fp1", "fp2", "dim"], F.col("vec_id"), {"rep": F.min("vec_id"), "size": F.count(F.lit(1))},
                               {"rep": F.min("rep"), "size": F.sum("size")}), "vec-members")
    leads = (member.where("dim > 0 AND vec_id = rep").groupBy(F.col("rep").alias("id"))
             .agg(F.min(F.struct("fp1", "fp2", "row", "size", "dim")).alias("lead")).select("id", "lead.row", "lead.size", "lead.dim"))
    classes = staged(leads.join(prints.select("row", "embedding"), "row").select("id", "dim", "size", "embedding"), "vec-classes")
    total = classes.count()
    passes = passes_for(total, threshold, window, recall)
    places, runs = _ranks(classes, passes, prefix_bits(total, window), seed)
    placed = staged(classes.join(places, "id"), "vec-placed")
    rank, block = F.col("rank"), F.floor(F.col("rank") / BLOCK).cast("long")
    rows = placed.select("*", F.posexplode("ranks").alias("pass", "rank"))
    # the first ranks of a block also end the block before
    near = rows.select("*", F.explode(F.when((rank % BLOCK < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))).alias("block"))
    near = near.select("block", "rank", "pass", (F.col("block") == block).alias("main"), "id", "size", "dim", "ranks", "runs", "embedding")
    links = "a long, b long, n long"
    found = staged(near.repartition("block").sortWithinPartitions("block", "rank").mapInArrow(_compare(window, threshold), links), "vec-links")
    # runs that no window holds; at most passes * rows / window of them
    wide = staged(runs.where(F.col("n") > window + 1), "vec-wide")
    if not wide.isEmpty():
        tile, last = F.floor((rank - F.col("start")) / TILE).cast("int"), F.floor((F.col("n") - 1) / TILE).cast("int")
        far = rows.withColumn("run", F.element_at("runs", F.col("pass") + 1)).join(wide, ["pass", "dim", "run"])
        far = far.select("*", tile.alias("tile"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
        far = far.select("start", F.least("tile", "other").alias("u"), F.greatest("tile", "other").alias("v"), "tile", "rank", "pass", "id", "size", "dim", "ranks", "runs", "embedding")
        unit = ["start", "u", "v"]
        more = far.repartition(*unit).sortWithinPartitions(*unit, "rank").mapInArrow(_compare_tiles(window, threshold), links)
        found = found.unionByName(staged(more, "vec-far-links"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    comps = connected(found.where("b IS NOT NULL").select("a", "b"))
    out = member.withColumn("rep", F.when(F.col("dim") > 0, F.col("rep")).otherwise(F.col("vec_id")))
    out = out.join(counts, "rep", "left").join(comps.select(F.col("id").alias("rep"), "component_id"), "rep", "left")
    component = F.coalesce("component_id", "rep")
    links = F.when(F.col("dim") > 0, F.col("size") - 1 + F.coalesce("others", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
