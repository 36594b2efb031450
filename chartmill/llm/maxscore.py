"""Exact top-k search by MaxScore over sharded postings.

A vector is a document whose terms are its components; a posting holds a component's value.  A query
term's contribution is ``query component * posting``, and its bound the largest contribution in the
shard.  Terms are taken in the order of their spread, largest minus smallest contribution.  The first
ones are essential: as long as the terms left could still lift an unseen row to the threshold, their
postings are walked in full.  After that only rows that stay competitive are probed in the other terms,
and rows drop out as soon as their score plus the bounds of what is left falls below the threshold, the
k-th best score known so far.  Contributions may be negative, so bounds are kept for both ends.
Results are exact; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chartmill.llm.blocks import search, top, usable

# Probed terms between two looks at which rows are still competitive.
STEP = 4


def best_rows(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the ``k`` best rows of one shard.

    ``postings`` has one row per term; ``low`` and ``high`` are the smallest and largest value of each;
    ``out`` marks rows that are no candidates.
    """
    most = np.maximum(query * low, query * high)
    least = np.minimum(query * low, query * high)
    terms = np.argsort(least - most, kind="stable")
    rest_most = np.append(np.cumsum(most[terms][::-1])[::-1], 0)
    rest_least = np.append(np.cumsum(least[terms][::-1])[::-1], 0)
    alive = np.flatnonzero(~out)
    if not len(alive):
        return alive, np.empty(0, np.int64)
    score = np.zeros(len(alive), np.int64)
    everyone = len(alive) == len(out)
    for done, term in enumerate(terms):
        posting = postings[term]
        score += query[term] * (posting if everyone else posting[alive])
        if (done + 1) % STEP or len(alive) <= k:
            continue
        # Each of the k best so far ends at this score at least, so others must be able to reach it.
        threshold = np.partition(score, len(score) - k)[len(score) - k] + rest_least[done + 1]
        competitive = score + rest_most[done + 1] >= threshold
        if not competitive.all():
            alive, score, everyone = alive[competitive], score[competitive], False
    at = top(score, ids[alive], k)
    return alive[at], score[at]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, **sizes: int
) -> DataFrame:
    """The ``k`` highest integer inner products of each query: query_id, rank, vec_id, score (long).

    Components become ``floor(scale * x)``.  Rows that :mod:`chartmill.llm.blocks` calls unusable take
    no part; zero vectors do, with score 0.
    """

    def rows(df: DataFrame) -> DataFrame:
        made = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        made = made.where(usable(F.col("vector")))
        return made.withColumn("vector", F.transform("vector", lambda x: F.floor(scale * x).cast("double")))

    def best(ids: np.ndarray, own: np.ndarray, asked_ids: np.ndarray, asked: np.ndarray) -> pd.DataFrame:
        postings = np.ascontiguousarray(own.T).astype(np.int64)
        low, high = postings.min(axis=1), postings.max(axis=1)
        found = [best_rows(q, postings, low, high, ids, ids == i, k) for i, q in zip(asked_ids, asked.astype(np.int64))]
        return pd.DataFrame({
            "query_id": np.repeat(asked_ids, [len(at) for at, _ in found]),
            "vec_id": np.concatenate([ids[at] for at, _ in found]), "score": np.concatenate([s for _, s in found]),
        })

    return search(rows(vectors), rows(queries), best, k, "long", **sizes)
