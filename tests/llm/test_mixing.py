import pytest

from visitflow.llm import mixing

from .data import awkward, cluttered, docs


def test_raked_weights_meet_all_targets(spark):
    cells = spark.createDataFrame([(s, lang, t, 1 + 7 * i + 3 * j + k) for i, s in enumerate("abc") for j, lang in enumerate(("en", "de")) for k, t in enumerate("xyz")],
                                  "source string, lang string, topic string, tokens long")
    share = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.2, "y": 0.2, "z": 0.6}}
    targets = {d: spark.createDataFrame(list(v.items()), "level string, share double") for d, v in share.items()}
    out = mixing.probabilities(mixing.raked(cells, targets)).collect()
    for d, v in share.items():
        for level, want in v.items():
            assert sum(r.weight for r in out if r[d] == level) == pytest.approx(want, abs=1e-6)
    assert max(r.keep_prob for r in out) == 1.0
    # expected tokens have the target mix
    total = sum(r.keep_prob * r.tokens for r in out)
    assert sum(r.keep_prob * r.tokens for r in out if r.source == "a") / total == pytest.approx(0.5, abs=1e-5)


def test_levels_without_target_get_nothing(spark):
    cells = spark.createDataFrame([("a", "en", "x", 5), ("b", "en", "x", 5)], "source string, lang string, topic string, tokens long")
    one = lambda level: spark.createDataFrame([(level, 1.0)], "level string, share double")
    out = {r.source: r.keep_prob for r in mixing.probabilities(mixing.raked(cells, {"source": one("a"), "lang": one("en"), "topic": one("x")})).collect()}
    assert out == {"a": 1.0, "b": 0.0}


def test_sample_follows_the_probabilities(spark):
    rows = [(i, "w " * 50, "en" if i % 4 else "de", "big" if i % 3 else "small", 1) for i in range(6_000)]
    out = mixing.mix_documents(docs(spark, rows))
    for r in out.groupBy("source", "lang").agg({"keep_prob": "max", "kept": "count"}).collect():
        kept = out.where(f"source = '{r.source}' AND lang = '{r.lang}' AND kept").count()
        assert kept / r["count(kept)"] == pytest.approx(r["max(keep_prob)"], abs=0.05)
    ids = {r.doc_id for r in out.where("kept").collect()}
    assert {r.doc_id for r in mixing.sample(docs(spark, rows)).collect()} == ids


def test_awkward_rows(spark):
    out = mixing.mix_documents(cluttered(docs(spark)))
    got = out.collect()
    assert len(got) == len(awkward()) and all(0 <= r.keep_prob <= 1 for r in got)
    assert {r.tokens for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert {r.tokens for r in got if r.doc_id == 5} == {60_000}
    df = cluttered(docs(spark))
    assert mixing.sample(df).columns == df.columns
    assert mixing.mix_documents(docs(spark, [])).count() == 0 and mixing.sample(docs(spark, [])).count() == 0
