"""Multi-index hashing against brute force: recall, exact scores and ties, copies, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotspark.llm import neighbour_search as ns

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, qid string"


def table(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "clash", "clash", "clash") for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(5)


def brute(ids, x, k):
    """query -> [(vec_id, score)] by the measure in double precision, ties to the smaller id."""
    x = np.asarray(x, np.float32).astype(float)
    out = {}
    for at in np.flatnonzero(np.array(ids) % 20 == 0):
        score = np.zeros(len(x))
        for d in range(x.shape[1]):
            score += x[at, d] * x[:, d]
        order = sorted((i for i in range(len(ids)) if ids[i] != ids[at]), key=lambda i: (-score[i], ids[i]))[:k]
        out[ids[at]] = [(ids[i], score[i]) for i in order]
    return out


def found(df, k, **kw):
    out = {}
    rows = ns.nearest(df, F.col("id") % 20 == 0, k, **kw).collect()
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("kind", ["even", "clusters", "lengths"])
def test_recall_and_scores(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24))
    if kind == "clusters":
        x = rng.normal(size=(30, 24))[rng.integers(0, 30, 1500)] * 3 + x * 0.3
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * (rng.uniform(0.2, 3, (1500, 1)) if kind == "lengths" else 1)
    ids = list(range(1000, 2500))
    got, want = found(table(spark, ids, x), 10), brute(ids, x, 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert recall(got, want) >= 0.9
    score = {q: dict(w) for q, w in brute(ids, x, 1500).items()}
    assert all(s == score[q][i] for q, own in got.items() for i, s in own)


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 8)).round(1)
    ids = list(range(120))
    copies = [x[0]] * 300
    odd = [None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")], [float("inf")] * 8, [1.0] * 3]
    every, vectors = [*ids, *range(200, 500)], [*x, *copies]
    df = table(spark, [*every, 3, *range(600, 600 + len(odd)), None], [*vectors, x[3], *odd, x[5]])  # id 3 twice over
    got, want = found(df, 7, target=1.0, block=50, width=4), brute(every, vectors, 7)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95
    for q in (0, 200, 480):  # the copies: their least ids, in order
        assert [i for i, _ in got[q]] == [i for i in [0, *range(200, 209)] if i != q][:7]


def test_few_and_none(spark):
    x = np.eye(5)
    got = found(table(spark, [0, 20, 1, 2, 3], x), 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 2, 3, 20], 20: [0, 1, 2, 3]}
    assert found(table(spark, [1, 2], x[:2]), 20) == {}
    assert found(table(spark, [20], x[:1]), 20) == {}
    assert found(table(spark, [], []), 20) == {}


def test_shares_cover_the_radius():
    rng = np.random.default_rng(8)
    for bits in (4, 8, 16):
        for r in (0, 5, 17, 40, 64):
            near = np.array(ns.shares(r, 64 // bits))
            flips = np.array([rng.permutation(64) < r for _ in range(200)]).reshape(200, 64 // bits, bits).sum(axis=2)
            assert (flips <= near).any(axis=1).all()
