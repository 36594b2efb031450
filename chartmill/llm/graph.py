"""Connected components of an undirected graph, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chartmill.llm.base import written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them: the larger ones, or the smaller and the node."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if larger:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for every node of ``edges`` (columns a and b, long).

    The edges shrink to one star per component; each round is written to the shared scratch folder,
    and the rounds end when one changes nothing.  Loops and repeated edges do no harm.
    """
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))]
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        edges = written(_stars(written(_stars(edges, True), "large"), False), "small")
        now = tuple(edges.agg(*mark).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
