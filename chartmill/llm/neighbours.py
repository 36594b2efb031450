"""Approximate nearest neighbours by a permutation index.

Every vector is described by its nearest pivots in order.  Each pivot's inverted file lists the vectors
that have it among their nearest, with its place.  A query walks the files of its own pivots and adds
up, for every vector met, the places they share; that sum ranks vectors exactly as the footrule
distance of the truncated permutations does:

    footrule(q, x) = constant - 2 * sum over shared pivots of min(m - place in q, m - place in x)

A fixed share of each shard, the best by footrule, is then scored exactly.

Pivots are near by angle, queries ask for inner products.  Every vector is therefore lifted by one more
component that brings it to the length of the longest; queries get a zero there.  The order of lifted
angles is the order of inner products.

Zero vectors take no part, nor do those that :mod:`chartmill.llm.blocks` leaves out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chartmill.llm.blocks import search, top, usable

# The index is fitted on this many vectors, those with the smallest hash of the id: the pivots.
PIVOTS = 256
NEAREST = 64
RERANKED = 0.1
LEAST_RERANKED = 400


def places(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the nearest pivots by angle, nearest first."""
    near = vectors @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :nearest]


def inverted_files(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that list it, and the weight of the place they give it."""
    n, m = order.shape
    weight = np.broadcast_to(np.arange(m, 0, -1, dtype=np.int32), (n, m)).ravel()
    by_pivot = np.argsort(order.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(order.ravel(), minlength=pivots))[:-1]
    rows = (by_pivot // m).astype(np.int32)
    return list(zip(np.split(rows, ends), np.split(weight[by_pivot], ends)))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of squared length ``longest``, by one more component."""
    rest = np.maximum(longest - (vectors * vectors).sum(axis=1), 0)
    return np.column_stack((vectors, np.sqrt(rest)))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added from the first component to the last."""
    total = np.zeros(len(b))
    for i in range(b.shape[1]):
        total += a[..., i] * b[:, i]
    return total


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding",
    pivots: int = PIVOTS, listed: int = NEAREST, reranked: float = RERANKED, least: int = LEAST_RERANKED, **sizes: int,
) -> DataFrame:
    """The ``k`` vectors of largest inner product found for each query: query_id, rank, vec_id, score.

    ``queries`` has the same id and vector columns.  Every vector is indexed; ``reranked`` is the share
    of each shard that is scored exactly, ``least`` rows at least.
    """

    def rows(df: DataFrame) -> DataFrame:
        made = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return made.where(usable(F.col("vector")) & F.exists("vector", lambda x: x != 0))

    base = rows(vectors)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    longest = base.agg(F.coalesce(F.max(squares), F.lit(0.0))).first()[0]
    sample = base.orderBy(F.xxhash64("id"), "id").limit(pivots).toPandas()["vector"]
    by_length: dict[int, np.ndarray] = {}
    for n in sorted({len(v) for v in sample}):
        by_length[n] = lifted(np.stack([np.asarray(v) for v in sample if len(v) == n]), longest)

    def best(ids: np.ndarray, own: np.ndarray, asked_ids: np.ndarray, asked: np.ndarray) -> pd.DataFrame:
        pivot = by_length.get(own.shape[1])
        pivot = lifted(own[:pivots], longest) if pivot is None else pivot
        m = min(listed, len(pivot))
        files = inverted_files(places(lifted(own, longest), pivot, m), len(pivot))
        share = max(least, int(np.ceil(reranked * len(own))))
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for i, order in enumerate(places(np.column_stack((asked, np.zeros(len(asked)))), pivot, m)):
            shared = np.zeros(len(own), np.int32)
            for place, p in enumerate(order):
                listed_rows, weight = files[p]
                shared[listed_rows] += np.minimum(weight, m - place)
            shared[ids == asked_ids[i]] = -1
            chosen = top(shared, ids, share)
            chosen = chosen[shared[chosen] >= 0]
            score = inner(asked[i], own[chosen])
            at = top(score, ids[chosen], k)
            out.append((asked_ids[i], ids[chosen[at]], score[at]))
        sizes_of = [len(x[1]) for x in out]
        return pd.DataFrame({
            "query_id": np.repeat(asked_ids, sizes_of), "vec_id": np.concatenate([x[1] for x in out]),
            "score": np.concatenate([x[2] for x in out]),
        })

    return search(base, rows(queries), best, k, "double", **sizes)
