import math
import random
import zlib
from collections import Counter

import numpy as np

from vitalmart.llm import hmm


def small_model(states=3, classes=5):
    rng = np.random.default_rng(0)
    draw = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1])
    return hmm.Model(draw(states), draw(states, states), draw(states, classes).T.copy())


def all_paths(model, sequence):
    """Likelihood and posterior counts by summing over every state path."""
    paths = [((s,), model.start[s] * model.emit[sequence[0], s]) for s in range(len(model.start))]
    for x in sequence[1:]:
        paths = [((*p, s), v * model.move[p[-1], s] * model.emit[x, s]) for p, v in paths for s in range(len(model.start))]
    return paths


def test_forward_and_expectations_against_all_paths(monkeypatch):
    rng = random.Random(1)
    model = small_model()
    sequences = [np.array([rng.randrange(5) for _ in range(n)]) for n in (1, 4, 6, 2, 6, 1)]
    for padded in (200_000, 8):
        monkeypatch.setattr(hmm, "PADDED", padded)
        start, move, emit, logs = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), []
        for s in sequences:
            paths = all_paths(model, s)
            total = sum(v for _, v in paths)
            logs.append(math.log(total))
            for p, v in paths:
                start[p[0]] += v / total
                for t, x in enumerate(s):
                    emit[x, p[t]] += v / total
                    if t:
                        move[p[t - 1], p[t]] += v / total
        got = hmm.expectations(model, sequences)
        assert np.allclose(hmm.log_likelihoods(model, sequences), logs)
        assert np.allclose(got[0], start) and np.allclose(got[1], move) and np.allclose(got[2], emit)
        assert math.isclose(got[3], sum(logs))


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(2)
    sequences = [np.array(rng.integers(0, 3, 60) + 3 * (k % 2)) for k in range(40)]
    shares = np.full(6, 1 / 6)
    model, last = hmm.Model.draw(2, shares), -math.inf
    for _ in range(6):
        start, move, emit, logs = hmm.expectations(model, sequences)
        assert logs > last - 1e-6
        model, last = model.fitted(start, move, emit, shares, prior=1e-6), logs
    assert last > 40 * 60 * math.log(1 / 3.2)  # the two kinds of sequences are told apart


def words(text):
    return (text or "").encode().lower().split() + [b""]


def test_scores(spark):
    rng = random.Random(7)
    pool = {"a": ["the", "of", "and", "to"] + [f"w{i}ing" for i in range(40)], "b": ["der", "die", "und"] + [f"v{i}ung" for i in range(40)]}
    rows = [(i, " ".join(rng.choice(pool["ab"[i % 2]]) for _ in range(rng.randrange(1, 80)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "The THE of\x0bOF"), (5, rows[5][1]), (None, "unseen words only"), (303, "long " * 30000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, block int, tokens string")
    got = hmm.score(docs).collect()
    assert len(got) == len(rows)
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), held(i), len(w := words(t)), sum(count[x] > 0 for x in w), n,
                   round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in got)
    assert hmm.score(docs.limit(0)).count() == 0
    lone = hmm.score(docs, held_out=__import__("pyspark.sql.functions").sql.functions.lit(True))
    assert {(r.train_tokens, r.base_score) for r in lone.collect()} == {(0, 0.0)}


def test_probabilities_of_all_one_token_texts_sum_below_one(spark):
    """Scores are probabilities: over all texts of up to one known word plus the unseen mass they stay within 1."""
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(30)]
    train = [(i, " ".join(rng.choice(vocabulary) for _ in range(5))) for i in range(200)]
    probes = [(1000 + i, w) for i, w in enumerate(["", *vocabulary])]
    docs = spark.createDataFrame(train + probes, "doc_id bigint, text string")
    f = __import__("pyspark.sql.functions").sql.functions
    got = hmm.score(docs, held_out=f.col("doc_id") >= 1000, states=3, rounds=2).where("held_out").collect()
    assert 0 < sum(10 ** r.score for r in got) < 1
