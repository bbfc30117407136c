import hashlib
import re
from collections import defaultdict

from visitflow.llm import exact

from .data import awkward, cluttered, docs, rows_of


def brute(rows):
    groups = defaultdict(list)
    digest = {}
    for i, (doc_id, text, *_) in enumerate(rows):
        digest[i] = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups[digest[i]].append(doc_id)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = groups[digest[i]]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, digest[i]))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_groups_match_brute_force(spark):
    assert rows_of(exact.groups(docs(spark))) == brute(awkward())
    assert rows_of(exact.groups(cluttered(docs(spark)))) == brute(awkward())


def test_empty_table(spark):
    assert exact.groups(docs(spark, [])).count() == 0
    assert exact.dedup(docs(spark, [])).columns == docs(spark, []).columns


def test_saturated_filter_changes_nothing(spark):
    rows = [(i, f"text {i % 70_000}", "en", "a", 1) for i in range(80_000)]
    small, large = (exact.groups(docs(spark, rows), max_bits=b) for b in (exact.ROW_BITS, 1 << 27))
    assert small.exceptAll(large).isEmpty() and small.count() == 80_000
    assert large.where("NOT kept").count() == 10_000


def test_filter_lets_unrepeated_rows_pass(spark):
    rows = [(i, f"text {i}", "en", "a", 1) for i in range(5_000)] + [(9_000, "text 3", "en", "a", 1)]
    df = docs(spark, rows)
    digests = df.select("doc_id", exact.text_digest(df["text"]).alias("text_sha256"))
    table, bits = exact.repeat_filter(digests)
    flagged = exact.may_repeat(digests, table, bits).where("may_repeat")
    ids = {r.doc_id for r in flagged.collect()}
    assert {3, 9_000} <= ids and len(ids) < 400


def test_dedup_keeps_columns_and_smallest_id(spark):
    df = cluttered(docs(spark))
    out = exact.dedup(df)
    assert out.columns == df.columns
    want = {}
    for row, b in zip(awkward(), [r for r in _in_order()], strict=True):
        if b[3]:
            want[(row[0], b[4])] = 1
    assert sorted(map(str, want)) == sorted(str((r.doc_id, exact_digest(r.text))) for r in out.collect())


def exact_digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def _in_order():
    rows = awkward()
    found = {(r[0], r[4]): r for r in brute(rows)}
    return [found[(doc_id, exact_digest(text))] for doc_id, text, *_ in rows]


def test_one_key_with_a_third_of_all_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}", "en", "a", 1) for i in range(9_000)]
    out = exact.groups(docs(spark, rows))
    assert out.where("group_size = 3000 AND keep_id = 0").count() == 3_000
    assert out.where("kept").count() == 6_001
