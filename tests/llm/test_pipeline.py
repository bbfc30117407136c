"""run() against the brute-force versions of its stages, on the smallest driver tables."""

import hashlib
import re
import zlib

import corpus_pipeline  # noqa: I001
import numpy as np
import pandas as pd
from tokenizers import Tokenizer
from visitflow.llm import mixing, quality
from visitflow.llm.registry import vocabulary

from .data import cluttered, docs
from .test_near_text import brute as near_brute
from .test_near_text import corpus as near_corpus
from .test_quality import LABELS, labelled

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_run_matches_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = table.toPandas().sort_values("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    # quality: the learned scores decide, one document at a time
    model = quality.train(table, labels)
    keep = [float(model.scores(quality.text_features(t)[None])[0]) >= quality.CUT for t in rows.text]
    # 87 labelled rows here; tests/llm/test_quality.py measures the accuracy on a larger table
    known = rows.merge(labels.toPandas(), on="doc_id")
    assert (known.doc_id.isin(rows.doc_id[keep]) == (known.quality == 1)).mean() >= 0.95
    rows = rows[keep]
    # exact copies: the smallest id of equal normalised texts
    digest = rows.text.map(lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t).encode()).hexdigest())
    rows = rows[~digest.duplicated()]
    # near copies: the smallest id of each component at five words
    comp = near_brute(list(rows[["doc_id", "text"]].itertuples(index=False, name=None)), 5)
    rows = rows[[comp[d][1] == d for d in rows.doc_id]]
    # mixing: independent raking in numpy
    out = corpus_pipeline.run(spark, SF).toPandas()
    got = set(out.doc_id)
    assert got <= set(rows.doc_id)
    assert got == set(rows.doc_id[_kept(rows)])
    # packing: every id once, at its place
    tokenizer = Tokenizer.from_file(vocabulary())
    for d, g in out.groupby("doc_id"):
        ids = np.array(tokenizer.encode(rows.set_index("doc_id").text[d], add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in g.sort_values("start").itertuples():
            assert r.start == at and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    fill = out.groupby("sequence_id").length.sum()
    assert (fill <= 4096).all()


def _kept(rows: pd.DataFrame) -> list[bool]:
    def topic(t):
        return ("contact" if "@" in t else "table" if " | " in t else "licence" if re.search("licen[cs]e", t, re.I)
                else "long" if len(t) >= 2000 else "short")

    frame = rows.assign(topic=rows.text.map(topic), tokens=rows.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))))
    cells = frame.groupby(["source", "lang", "topic"]).tokens.sum()
    cells = cells[cells > 0]
    weight = cells / cells.sum()
    target = {}
    for d in mixing.DIMENSIONS:
        share = cells.groupby(level=d).sum() ** mixing.TEMPER
        target[d] = share / share.sum()
    for _ in range(mixing.ROUNDS):
        for d in mixing.DIMENSIONS:
            weight = weight * target[d].reindex(weight.index.get_level_values(d)).to_numpy() / weight.groupby(level=d).transform("sum")
    ratio = weight / cells
    prob = (ratio / ratio.max()).round(9)
    draws = [int(hashlib.md5(f"{d}:7".encode()).hexdigest()[:8], 16) / 2**32 for d in frame.doc_id]
    return [u < prob.get(k, 0.0) for u, k in zip(draws, frame[["source", "lang", "topic"]].itertuples(index=False, name=None), strict=True)]


def test_every_stage_takes_awkward_rows_and_keeps_columns(spark, scratch):
    rows, labels = labelled(200)
    spark.createDataFrame(labels, LABELS).write.parquet(f"{scratch}/labels.parquet")
    odd = [(None, None, None, None, None), (900, "", "en", "a", 0), (901, None, "en", None, None), (5, "x y z", "en", "a", 5)]
    for table in (docs(spark, rows + odd + odd), docs(spark, [])):
        df = cluttered(table)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, scratch).columns == df.columns
            stage(spark, df, scratch).count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, scratch).count() >= df.count()


def test_stages_keep_clean_documents(spark, scratch):
    """Near copies leave one of each group; unrelated texts all stay."""
    rows = near_corpus(seed=8, clusters=3, copies=10, alone=60)
    want = {d for d, (_, c) in near_brute(rows, 5).items() if d == c}
    table = docs(spark, rows)
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
        table = stage(spark, table, scratch)
    assert {r.doc_id for r in table.collect()} == want
