"""A set of query vectors against all vectors, in blocks.

Candidates are dealt over shards and queries over blocks, both of bounded size, by a hash of the id.
Each (shard, block) is one group: it returns the best of its shard for each query, and the merge keeps
the best over all shards.  No task holds more than one shard and one block.

A vector takes part if it is not null and all its components are finite numbers.  Vectors are compared
with those of the same length only.  Rows that repeat an id count as rows of their own; a query's own
rows are those with its id, and are no candidates.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARD_ROWS = 8192
BLOCK_ROWS = 2048

# (candidate ids, candidate matrix, query ids, query matrix) -> frame of query_id, vec_id, score
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def usable(vector: Column) -> Column:
    """Not null, not empty, and free of null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def search(
    vectors: DataFrame, queries: DataFrame, best: Search, k: int, score: str,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank, vec_id, score.

    Both inputs have the columns id and vector (arrays of double), already free of unusable rows.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        placed = rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).withColumn("_length", F.size("vector"))

    keys = ["_shard", "_block", "_length"]
    left = dealt(vectors, "_shard", shards, "_block", blocks)
    right = dealt(queries, "_block", blocks, "_shard", shards)

    def meet(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best(candidates["id"].to_numpy(), matrix(candidates["vector"]), asked["id"].to_numpy(), matrix(asked["vector"]))

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, f"query_id long, vec_id long, score {score}")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, best first, smaller ids first among equals."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        likely = np.flatnonzero(score >= least)
    else:
        likely = np.arange(len(score))
    return likely[np.lexsort((ids[likely], -score[likely]))][:k]
