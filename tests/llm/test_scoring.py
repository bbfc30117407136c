import random

import numpy as np
import pyarrow as pa

from visitflow.llm import scoring as S

from .data import awkward, cluttered, docs


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = S.Network(20)
    for name in ("embed", "w1", "b1", "w2", "b2"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    around, target = rng.integers(0, 21, (6, 2 * S.SIDE)), rng.integers(0, S.CLASSES, 6)
    _, grads = net.gradients(around, target)
    rows = np.zeros_like(net.embed)
    np.add.at(rows, around.ravel(), grads[0])
    for p, g in zip(net.parts(), [rows, *grads[1:]], strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in p.shape)
            old, eps = p[at], 1e-5
            p[at] = old + eps
            up = net.gradients(around, target)[0]
            p[at] = old - eps
            down = net.gradients(around, target)[0]
            p[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-6


def test_token_probabilities_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 50, 1024)
    v, net = S.Vocabulary(counts), S.Network(1024)
    around = np.random.default_rng(2).integers(0, 1025, (3, 2 * S.SIDE))
    logp = net.forward(around)[2]
    p = np.exp(logp[:, v.class_of] + v.log_share)
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_a_token_is_not_its_own_context():
    tokens, around = S.windows([np.array([1, 2, 3], np.int32), np.array([], np.int32), np.array([4], np.int32)], 9)
    assert tokens.tolist() == [1, 2, 3, 4]
    assert around.tolist() == [[9, 9, 2, 3], [9, 1, 3, 9], [1, 2, 9, 9], [9, 9, 9, 9]]


def patterned(n=400):
    """Texts in which both neighbours decide a word."""
    rng = random.Random(1)
    out = []
    for i in range(n):
        word = "abcd"[i % 4]
        out.append((i, " ".join(f"{word}{rng.randrange(3)} {word}x" for _ in range(60)), "en", "a", 1))
    return out


def test_training_lowers_the_loss_and_ranks_documents(spark):
    rows = patterned() + [(9_000, " ".join(random.Random(2).sample([f"{w}{k} {w}x" for w in "abcd" for k in range(3)] * 10, 60)), "en", "a", 1)]
    plain, trained = (S.score_documents(docs(spark, rows), rounds=r).toPandas().set_index("doc_id") for r in (0, 3))
    assert trained.mean_log_prob.mean() > plain.mean_log_prob.mean() + 0.3
    # the mixed-up document is less likely than those with the pattern
    assert trained.mean_log_prob[9_000] < trained.mean_log_prob.drop(9_000).mean() - 0.3
    assert np.allclose(trained.log_likelihood, trained.mean_log_prob * trained.n_tokens)


def test_scores_equal_direct_sums(spark):
    df = docs(spark, patterned(40))
    v = S.corpus_vocabulary(df)
    net = S.train(df, v, 1)
    got = {r.doc_id: r for r in S.score_documents(df, rounds=1).collect()}
    assert int(v.counts.sum()) == 40 * 120
    for i, text, *_ in patterned(40)[:5]:
        ids = v.ids(S.word_hashes(S.Shingler(1), text))
        line = [len(v.counts)] * 2 + ids.tolist() + [len(v.counts)] * 2
        total = 0.0
        for k, t in enumerate(ids):
            around = np.array([[line[k], line[k + 1], line[k + 3], line[k + 4]]])
            total += net.forward(around)[2][0, v.class_of[t]] + v.log_share[t]
        assert abs(got[i].log_likelihood - total) < 1e-2


def test_awkward_rows(spark):
    got = S.score_documents(cluttered(docs(spark))).collect()
    assert len(got) == len(awkward())
    assert {(r.n_tokens, r.log_likelihood, r.mean_log_prob) for r in got if r.doc_id in (2, 3, 4)} == {(0, 0.0, None)}
    assert {r.n_tokens for r in got if r.doc_id == 5} == {60_000}
    assert len({r.log_likelihood for r in got if r.doc_id == 1}) == 1
    assert S.score_documents(docs(spark, [])).count() == 0


def test_buckets_grow_with_the_corpus(spark):
    few = S.corpus_vocabulary(docs(spark, patterned(10)))
    many = S.corpus_vocabulary(docs(spark, [(i, " ".join(f"w{i}x{k}" for k in range(20_000)), "en", "a", 1) for i in range(120)]))
    assert len(few.counts) == 1 << 10 and len(many.counts) == 1 << 11


def test_rounds_together_train_every_position_once(spark):
    rows = patterned(30) + [(None, "no id here", "en", "a", 1), (50, "long " * 20_000, "en", "a", 1), (50, None, "en", "a", 1)]
    df = docs(spark, rows).repartition(3).localCheckpoint()
    v = S.corpus_vocabulary(df)
    model = spark.sparkContext.broadcast((v, S.Network(len(v.counts)).flat()))
    for rounds in (1, 2, 3):
        seen = [df.select("doc_id", "text").mapInArrow(S._train(model, 0.1, turn, rounds), S.PIECES).select("task", "n").distinct().groupBy().sum("n").first()[0]
                for turn in range(rounds)]
        assert sum(seen) == 30 * 120 + 3 + 20_000 and max(seen) < 1.3 * sum(seen) * -(-S.SHARES // rounds) / S.SHARES
    # places of a document and documents are dealt apart, evenly
    share = S.position_shares(7, 80_000)
    assert abs(np.bincount(share.astype(int), minlength=S.SHARES) / 10_000 - 1).max() < 0.05
    assert (share != S.position_shares(8, 80_000)).mean() > 0.8 and (share[::2] % 2 == 0).mean() < 0.55


def test_short_texts_are_hashed_together(monkeypatch):
    texts = ["A b  c", "", None, " \n", "x" * 30, "tail ", " head", "é\x00 \x1c İ", "long " * 40_000, *[f"w{i} W{i}" for i in range(5_000)]]
    shingler, calls = S.Shingler(1), []
    want = [S.word_hashes(shingler, t).tolist() for t in texts]
    placed = S.Shingler._placed
    monkeypatch.setattr(S.Shingler, "_placed", lambda self, data: calls.append(len(data)) or placed(self, data))
    got = list(S.column_hashes(shingler, pa.array(texts)))
    assert [x.tolist() for x in got] == want and len(calls) < 5
    assert list(S.column_hashes(shingler, pa.array([], pa.string()))) == []


def test_large_outputs_are_shifted(monkeypatch):
    rng = np.random.default_rng(3)
    net, around, target = S.Network(50), rng.integers(0, 51, (40, 2 * S.SIDE)), rng.integers(0, S.CLASSES, 40)
    assert net.top()[1]
    plain, scores = net.gradients(around, target), net.log_probabilities(net._inputs(around), target, net.top())
    assert np.allclose(scores, net.forward(around)[2][np.arange(40), target], atol=1e-5)
    monkeypatch.setattr(S, "SAFE", 0.0)
    shifted = net.gradients(around, target)
    assert np.allclose(scores, net.log_probabilities(net._inputs(around), target, net.top()), atol=1e-5)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(plain[1], shifted[1], strict=True))
    monkeypatch.undo()
    net.w2 *= 5_000
    net.embed *= 50
    assert not net.top()[1] and np.isfinite(net.log_probabilities(net._inputs(around), target, net.top())).all()
    assert all(np.isfinite(g).all() for g in net.gradients(around, target)[1])


def test_positions_are_dealt_alike_alone_and_together():
    keys = [np.arange(n, dtype=np.uint64) + S._document_key(i) for i, n in ((3, 50), (None, 7), (-4, 90))]
    assert S._dealt(np.concatenate(keys)).tolist() == [x for i, n in ((3, 50), (None, 7), (-4, 90)) for x in S.position_shares(i, n).tolist()]
