import math

import numpy as np
import pytest

from chartmill.llm import maxscore, neighbours


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(700, 16)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[100:140] = rows[60]  # a group of copies
    table = [(i, v.tolist(), "own") for i, v in enumerate(rows)]
    table += [(800, None, "own"), (801, [0.0] * 16, "own"), (820, [math.nan] * 16, "own"), (840, [None, *[0.5] * 15], "own"), (860, [], "own"), (880, [math.inf] * 16, "own"), (880, [0.1] * 3, "own")]
    return spark.createDataFrame(table, "vec_id long, embedding array<float>, score string")


def expected(vectors, every, k, change, zero):
    rows = [(r.vec_id, r.embedding) for r in vectors.collect() if r.embedding]
    rows = [(i, np.array(v, np.float64)) for i, v in rows if None not in v and np.isfinite(np.array(v, np.float64)).all()]
    rows = [(i, change(v)) for i, v in rows if zero or v.any()]
    out = {}
    for i, q in rows:
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return {i: v for i, v in out.items() if v}


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 100, "block_rows": 7}])
def test_maxscore_is_exact(vectors, sizes):
    out = maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, **sizes).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert got == expected(vectors, 50, 5, lambda v: np.floor(256 * v).astype(int), zero=True)


def test_nearest_reranks_everything_when_asked_to(vectors):
    out = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20, shard_rows=200, block_rows=10).collect()
    want = expected(vectors, 20, 20, lambda v: v, zero=False)
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


@pytest.mark.parametrize("unequal", [False, True])
def test_recall_of_the_index(spark, unequal):
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(6000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    if unequal:
        rows *= rng.uniform(0.5, 1.5, size=(6000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, df.where("vec_id % 100 = 0"), 20, shard_rows=3000).collect()
    hits = 0
    for i in range(0, 6000, 100):
        score = rows @ rows[i]
        score[i] = -2
        hits += len(set(np.argsort(-score)[:20]) & {r.vec_id for r in out if r.query_id == i})
    assert hits / (60 * 20) >= 0.9


def test_empty(vectors):
    assert maxscore.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0), 5).count() == 0
