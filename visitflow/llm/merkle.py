"""Merkle manifest of a dataset: one tree per group, one tree over the groups' roots.

Rows become leaf digests, which are numbered in their group's order by a range
sort and offsets (no group meets in one task).  Every level then equijoins its
nodes with themselves on computed sibling indices: index XOR 1 in binary trees,
the index shifted by each slot offset otherwise.  A joined row knows its siblings
before and after it, and the rows of slot zero emit the parents, so that a level
is one job over a table ``arity`` times smaller than the one below.

Proofs go the other way: from the root down, each node puts its own siblings in
front of its parent's proof.  A level joins once, and most of the work is the last
one, whatever the depth.

Digests are SHA-256 over concatenated text, digests as lowercase hex; tables
hold them as 32 bytes.

Defined results: null fields are ``-``; a null id comes before all ids and is
never tampered with; a null group is a group of its own and the first; rows with
equal ids ascend by their leaf digest, and equal rows are leaves of their own; an
empty table has no root and gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.operators.positions import attach_offsets, placed, with_position

from .common import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:binary,after:binary>>"


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def _digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated texts, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as ``<bytes>:<value>``, null as ``-``."""
    texts = [v.cast("string") for v in values]
    return _digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


@dataclass
class Trees:
    """Levels of some trees, the leaves first, and (tree, h, height) of their roots.

    A level holds the nodes of the trees that have more than one node there:
    (tree, n, idx, h, before, after) with the siblings' digests before and after."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    none = F.lit(b"")
    if arity == 2:
        other = nodes.select("tree", F.col("idx").bitwiseXOR(F.lit(1).cast("long")).alias("idx"), F.col("h").alias("s"))
        even, s = F.col("idx") % 2 == 0, F.coalesce("s", none)
        return nodes.join(other, ["tree", "idx"], "left").withColumns(
            {"before": F.when(even, none).otherwise(s), "after": F.when(even, s).otherwise(none)}).drop("s")
    slot, out = F.col("idx") % arity, nodes
    for k in range(1, arity):
        # the node k slots further on, counted round the run
        home = F.col("idx") - slot + (slot + arity - k) % arity
        out = out.join(nodes.select("tree", home.alias("idx"), F.col("h").alias(f"s{k}")), ["tree", "idx"], "left")

    def side(before: bool) -> Column:
        at = [F.when((slot + k >= arity) == before, F.coalesce(f"s{k}", none)).otherwise(none) for k in range(1, arity)]
        return F.concat(*at)

    # k slots on, those that wrap round the run come first, in the order of k
    return out.withColumns({"before": side(True), "after": side(False)}).drop(*[f"s{k}" for k in range(1, arity)])


def grow(leaves: DataFrame, arity: int = 2) -> Trees:
    """``leaves`` (tree, n, idx, h, ...): all nodes of trees of ``n`` leaves, ``idx`` from 0.  Further columns stay with
    the leaves' level.  The leaves are read several times: pass a staged table."""
    if arity < 2:
        raise ValueError("a tree joins at least two nodes")
    width = leaves.agg(F.max("n")).first()[0]
    roots = [leaves.where("n = 1").select("tree", "h", F.lit(0).alias("height"))]
    levels, nodes = [], leaves.where("n > 1")
    while width is not None and width > 1:
        level = staged(_with_siblings(nodes, arity), "merkle-level")
        levels.append(level)
        # the slot-zero rows emit the parents
        up = F.ceil(F.col("n") / arity).cast("long").alias("n")
        parents = level.where(F.col("idx") % arity == 0).select("tree", up, F.floor(F.col("idx") / arity).cast("long").alias("idx"),
                                                                _digest(_hex("h"), _hex("after")).alias("h"))
        roots.append(parents.where("n = 1").select("tree", "h", F.lit(len(levels)).alias("height")))
        nodes = parents.where("n > 1")
        width = -(-width // arity)
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return Trees(levels, staged(out, "merkle-roots"), arity)


def proofs(trees: Trees, roots: DataFrame, carry: list[str]) -> DataFrame:
    """``roots`` (tree, height, path, ``carry``) -> the same columns for each leaf, with its (tree, idx): ``path`` is the
    leaf's siblings level by level, then the path of its root."""
    keep = ["path", *carry]
    at = roots.select("tree", F.lit(0).cast("long").alias("idx"), "height", *keep)
    paths = at.where(F.col("height") == len(trees.levels)).select("tree", "idx", *keep)
    for depth in range(len(trees.levels) - 1, -1, -1):
        up = paths.select(F.col("tree").alias("_t"), F.col("idx").alias("_up"), *keep)
        nodes = trees.levels[depth].select("tree", "idx", "before", "after").join(
            up, (F.col("tree") == F.col("_t")) & (F.floor(F.col("idx") / trees.arity).cast("long") == F.col("_up")))
        own = F.array(F.struct("before", "after")).cast(PATH)
        down = nodes.select("tree", "idx", F.concat(own, "path").alias("path"), *carry)
        paths = down.unionByName(at.where(F.col("height") == depth).select("tree", "idx", *keep))
        if depth % 8 == 7:
            paths = staged(paths, "merkle-paths")
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root's digest (hex) that a leaf and its siblings give."""
    return F.aggregate(path, _hex(leaf), lambda h, s: F.sha2(F.concat(_hex(s["before"]), h, _hex(s["after"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest (hex) of all siblings of a path, level by level, left to right."""
    texts = F.transform(path, lambda s: F.concat(_hex(s["before"]), _hex(s["after"])))
    return F.sha2(F.array_join(texts, "").cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves`` (tree, n, idx, h and the columns that were carried), ``groups`` (tree, group, subroot as bytes, height),
    and the trees of both levels."""

    leaves: DataFrame
    groups: DataFrame
    forest: Trees
    top: Trees


def build(rows: DataFrame, group: str, order: list[str], arity: int = 2) -> Manifest:
    """Manifest of ``rows`` (``group``, ``order`` columns, h: leaf digests, further columns to carry).

    Groups ascend (null first, texts bytewise), and so do a group's rows by ``order`` and digest."""
    # equal rows differ by their place in the input, so that a run of them is dealt over many ranges
    rows = staged(rows.withColumn("_tie", F.monotonically_increasing_id()), "merkle-leaves")
    sizes = staged(rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "merkle-groups")
    sizes = staged(with_position(sizes, [group], pos="tree"), "merkle-groups")
    ranged, offsets = placed(rows, [*order, "h", "_tie"], [group], "merkle-ordered")
    named = sizes.select(F.col(group).alias("_group"), "tree", "n")
    offsets = offsets.join(named, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    leaves = staged(attach_offsets(ranged, offsets, [group], "idx").drop("_tie"), "merkle-placed")
    forest = grow(leaves, arity)
    top = forest.roots.select(F.lit(0).cast("long").alias("tree"), F.lit(sizes.count()).cast("long").alias("n"), F.col("tree").alias("idx"), "h")
    groups = forest.roots.join(named, "tree").select("tree", F.col("_group").alias(group), F.col("h").alias("subroot"), "height")
    return Manifest(leaves, groups, forest, grow(top, arity))


def leaf_proofs(manifest: Manifest) -> DataFrame:
    """(tree, idx, path, subroot, root) of each leaf; the path runs through the subroot to the root."""
    whole = proofs(manifest.top, manifest.top.roots.select("tree", "height", F.array().cast(PATH).alias("path"), F.col("h").alias("root")), ["root"])
    whole = whole.select(F.col("idx").alias("tree"), "path", "root")
    roots = manifest.groups.select("tree", "subroot", "height").join(whole, "tree")
    return proofs(manifest.forest, roots, ["subroot", "root"])


def verify(claims: DataFrame, proven: DataFrame) -> DataFrame:
    """``claims`` (tree, idx, claim: a leaf digest to be proven, ...) with proof_sha256, folded_root, verified."""
    out = claims.join(proven, ["tree", "idx"])
    out = out.withColumn("folded_root", folded(F.col("claim"), F.col("path")))
    return out.withColumns({"proof_sha256": proof_digest(F.col("path")), "verified": F.col("folded_root") == _hex("root")})


def manifest_documents(docs: DataFrame, arity: int = 2) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row for each row of ``docs``.

    Verified are the original leaves, but where 7 divides the CRC-32 of the decimal id a leaf whose ``n_chars`` is one more."""
    values = [F.col(c) for c in FIELDS]
    more = [F.col("n_chars").cast("long") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    rows = docs.select("doc_id", "lang", leaf_digest(values).alias("h"), F.when(hit, leaf_digest(more)).alias("changed"))
    made = build(rows, "lang", ["doc_id"], arity)
    claims = made.leaves.select("tree", "idx", "doc_id", "h", F.coalesce("changed", "h").alias("claim"))
    out = verify(claims, leaf_proofs(made))
    return out.select("doc_id", _hex("h").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"), "proof_sha256", "folded_root", "verified")


ORACLE = r"""
WITH RECURSIVE crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 7 = 0 AS hit FROM documents),
fields AS (SELECT *, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS v,
    [doc_id::VARCHAR, source, lang, CASE WHEN hit THEN n_chars + 1 ELSE n_chars END::VARCHAR, text] AS w FROM crc),
leaf AS (SELECT doc_id, lang, sha256(array_to_string(list_transform(v, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS h,
    sha256(array_to_string(list_transform(w, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS claim FROM fields),
leaves AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM leaf),
nodes(lang, lvl, idx, h, n) AS (SELECT lang, 0, idx, h, n FROM leaves UNION ALL
    SELECT lang, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), max((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 2),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, h, n) AS (SELECT 1000, idx, h, n FROM subroots UNION ALL
    SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), max((n + 1) // 2) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2),
low AS (SELECT l.rid, w.lvl, (l.idx >> w.lvl) % 2 AS slot, coalesce(s.h, '') AS s
    FROM leaves l JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) w ON w.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.idx = xor(l.idx >> w.lvl, 1)),
high AS (SELECT l.rid, w.lvl, (r.idx >> (w.lvl - 1000)) % 2 AS slot, coalesce(s.h, '') AS s
    FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang CROSS JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) w
    LEFT JOIN tops s ON s.lvl = w.lvl AND s.idx = xor(r.idx >> (w.lvl - 1000), 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS ord FROM (SELECT * FROM low UNION ALL SELECT * FROM high)),
fold(rid, ord, h) AS (SELECT rid, 0, claim FROM leaves UNION ALL
    SELECT f.rid, f.ord + 1, sha256(CASE WHEN slot = 1 THEN s || f.h ELSE f.h || s END) FROM fold f JOIN steps t ON t.rid = f.rid AND t.ord = f.ord + 1),
done AS (SELECT rid, arg_max(h, ord) AS folded_root FROM fold GROUP BY rid),
proof AS (SELECT rid, sha256(string_agg(s, '' ORDER BY ord)) AS p FROM steps GROUP BY rid)
SELECT l.doc_id, l.h AS leaf, r.h AS subroot, t.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, d.folded_root, d.folded_root = t.h AS verified
FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN done d ON d.rid = l.rid LEFT JOIN proof p ON p.rid = l.rid
CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
"""
