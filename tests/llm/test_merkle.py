"""The manifest against a plain recursive one, for any arity, nulls, ties and lone leaves."""

import hashlib
import zlib

import pytest

from visitflow.llm import merkle

from .data import awkward, cluttered, docs, rows_of


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, extra=0) -> str:
    doc_id, text, lang, source, n = row
    n = None if n is None else n + extra
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def tree(hashes: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each leaf its (before, after) siblings from the bottom up."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, k in enumerate(at):
            run = k - k % arity
            paths[i].append(("".join(hashes[run:k]), "".join(hashes[k + 1:run + arity])))
        hashes = [digest(*hashes[s:s + arity]) for s in range(0, len(hashes), arity)]
        at = [k // arity for k in at]
    return hashes[0], paths


def brute(rows: list[tuple], arity: int) -> list[tuple]:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[x] = tree([leaf(r) for r in by_lang[x]], arity)
    root, above = tree([trees[x][0] for x in langs], arity)
    out = []
    for k, x in enumerate(langs):
        subroot, paths = trees[x]
        for r, path in zip(by_lang[x], paths, strict=True):
            path = path + above[k]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, hit)
            for before, after in path:
                h = digest(before, h, after)
            out.append((r[0], leaf(r), subroot, root, digest(*[b + a for b, a in path]), h, h == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("arity", [2, 3])
def test_equals_a_plain_tree(spark, arity):
    rows = awkward() + [(i, f"t{i % 9}", "hot", "s", i) for i in range(100, 337)] + [(500, "x", "lone", None, None)]
    got = merkle.manifest_documents(cluttered(docs(spark, rows)), arity)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(got) == ordered(brute(rows, arity))


def test_trees_of_any_size(spark):
    rows = [(100 * n + i, f"t{i}", f"size {n}", "s", i) for n in (1, 2, 3, 4, 7, 8, 9) for i in range(n)]
    assert rows_of(merkle.manifest_documents(docs(spark, rows))) == ordered(brute(rows, 2))


def test_one_leaf(spark):
    assert rows_of(merkle.manifest_documents(docs(spark, [(1, "t", "en", "s", 1)]))) == brute([(1, "t", "en", "s", 1)], 2)


def test_repeated_rows_and_tampering(spark):
    rows = [(1, "same", "en", "s", 4)] * 30 + [(i, "x", "fr", "s", None) for i in range(20)]
    got = merkle.manifest_documents(docs(spark, rows)).collect()
    want = brute(rows, 2)
    assert sorted(map(tuple, got)) == sorted(want)
    # a null n_chars stays null, so nothing was tampered with
    assert all(r.verified for r in got if r.doc_id != 1)
    tampered = [(i, "x", "fr", "s", 1) for i in range(60)]
    marked = {r.doc_id for r in merkle.manifest_documents(docs(spark, tampered)).collect() if not r.verified}
    assert marked == {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0} and marked


def test_empty_table(spark):
    assert merkle.manifest_documents(docs(spark).limit(0)).count() == 0


def test_a_foreign_leaf_is_not_proven(spark):
    made = merkle.build(docs(spark).selectExpr("doc_id", "lang", "unhex(sha2(cast(doc_id AS string), 256)) AS h").where("doc_id IS NOT NULL"), "lang", ["doc_id"])
    claims = made.leaves.selectExpr("tree", "idx", "doc_id", "unhex(sha2('other', 256)) AS claim")
    assert not any(r.verified for r in merkle.verify(claims, merkle.leaf_proofs(made)).collect())
