"""Near-duplicate groups by MinHash bands, sequential Bayesian verification and exact confirmation.

A text is the set of its distinct five-word shingles.  Texts with equal sets are one node.  Nodes that
agree on a band of their signatures are candidates.  Candidates meet in *units* of bounded size: a cluster
of candidates, or each bucket of a very large one, cut into pairs of blocks where it is large.  Within a
unit, signatures are compared a batch at a time; a pair is dropped as soon as the posterior probability
that its similarity reaches the threshold is below ``MISS``.  Survivors are confirmed on their full sets,
unless links found before connect them already.  Only links that join two groups are emitted, so a large
group of copies gives about as many links as it has members.

Shingles and sets are known by 64-bit hashes.  Texts without a word, null ones included, are linked with
nothing.  Rows alike in everything are in one group; where ids are missing the smallest id that is there
names the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.llm.base import shielded, written
from chartmill.llm.graph import components
from chartmill.llm.repeats import Hashes, _each_text, _mixed

WORDS = 5
SIMILAR = 0.75
HASHES = 128
BAND = 4  # hashes in a band: at the threshold, all 32 bands differ once in 190,000 pairs
BATCH = 32
MISS = 1e-5
UNIT = 1024

_random = np.random.default_rng(7)
_A = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_PLACE = _mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text in UTF-8; all words as one if they are fewer."""
    data = _LOWER[data]
    edge = np.diff(np.concatenate(([True], _BLANK[data], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(start)
    if not n:
        return np.empty(0, np.uint64)
    each = _mixed(Hashes(data).raw(start, end) + (end - start).astype(np.uint64))
    size = min(words, n)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += each[k : n - size + 1 + k] * _PLACE[k]
    return np.unique(_mixed(total))


def signature(own: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(own), 256):
        hashed = (own[at : at + 256, None] * _A + _B) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=0).astype(np.uint32))
    return least


def node(own: np.ndarray) -> int:
    return int(_mixed(own).sum(dtype=np.uint64).astype(np.int64))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key per row and band."""
    parts = signatures.reshape(len(signatures), -1, BAND).astype(np.uint64)
    total = np.arange(parts.shape[1], dtype=np.uint64)[None, :]
    for k in range(BAND):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return total.view(np.int64)


def fewest_matches(hashes: int, similar: float = SIMILAR, miss: float = MISS) -> int:
    """The fewest agreeing hashes with which a pair stays.

    From a uniform prior, the posterior after m of n agree is Beta(m + 1, n - m + 1), and its mass from
    ``similar`` upwards is that of at most m successes in n + 1 trials.
    """
    mass = 0.0
    for m in range(hashes + 1):
        mass += comb(hashes + 1, m) * similar**m * (1 - similar) ** (hashes + 1 - m)
        if mass >= miss:
            return m
    return hashes


def links(signatures: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of rows whose links span all groups of similar candidates among the rows."""
    n = len(sets)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marked = np.zeros(int(flat.max()) + 1, np.int64)
    bands = signatures.reshape(n, -1, BAND)
    enough = [fewest_matches(k) for k in range(BATCH, HASHES + 1, BATCH)]
    # The row most like the others first: in a group of copies of one text it links most of them at once.
    modal = np.array([np.bincount(np.unique(c, return_inverse=True)[1]).argmax() for c in signatures.T]) if n > 8 else None
    order = np.arange(n)
    if modal is not None:
        common = np.array([np.unique(c)[m] for c, m in zip(signatures.T, modal)], np.uint32)
        order = np.argsort(-(signatures == common).sum(axis=1), kind="stable")
    out = []
    group = parent.copy()
    for turn, x in enumerate(order):
        others = order[turn + 1 :]
        others = others[group[others] != group[x]]
        fits = np.minimum(sizes[others], sizes[x]) * 100 >= 75 * np.maximum(sizes[others], sizes[x])
        others = others[fits]
        if not len(others):
            continue
        others = others[(bands[others] == bands[x]).all(axis=2).any(axis=1)]
        matches = np.zeros(len(others), np.int64)
        for k, least in enumerate(enough):
            batch = slice(k * BATCH, (k + 1) * BATCH)
            matches += (signatures[others, batch] == signatures[x, batch]).sum(axis=1)
            others, matches = others[matches >= least], matches[matches >= least]
        if not len(others):
            continue
        own = flat[starts[x] : ends[x]]
        marked[own] = 1
        if len(others) > 16:
            shared = np.add.reduceat(marked[flat], starts)[others]
        else:
            shared = np.array([marked[flat[starts[y] : ends[y]]].sum() for y in others])
        marked[own] = 0
        union = sizes[others] + sizes[x] - shared
        linked = False
        for y in others[100 * shared >= 75 * union]:
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(x), int(y)))
                linked = True
        if linked:
            group = np.array([root(i) for i in range(n)])
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(data) for data in _each_text(batch.column("_text"))]
        yield pa.RecordBatch.from_pydict({
            "_id": batch.column("_id"), "_hash": batch.column("_hash"), "n": pa.array([len(s) for s in sets], pa.int64()),
            "node": pa.array([node(s) if len(s) else None for s in sets], pa.int64()),
            "sig": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
        })


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(data) for data in _each_text(batch.column("_text"))]
        yield pa.RecordBatch.from_pydict({
            "node": batch.column("node"), "sig": pa.array([signature(s).tobytes() for s in sets], pa.binary()),
            "own": pa.array([s.tobytes() for s in sets], pa.binary()),
        })


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signatures = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
        keys = band_keys(signatures)
        nodes = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
        yield pa.RecordBatch.from_pydict({"band": keys.ravel(), "node": nodes})


def _verify(group: pd.DataFrame) -> pd.DataFrame:
    signatures = np.frombuffer(b"".join(group["sig"]), np.uint32).reshape(-1, HASHES)
    found = links(signatures, [np.frombuffer(x, np.uint64) for x in group["own"]])
    nodes = group["node"].to_numpy()
    return pd.DataFrame({"a": [nodes[x] for x, _ in found], "b": [nodes[y] for _, y in found]}, dtype=np.int64)


def node_of(text: str) -> Column:
    """The node of a text, null without words."""

    @F.pandas_udf("long")
    def made(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            sets = [shingles(np.frombuffer(t.encode(), np.uint8)) if t else () for t in batch]
            yield pd.Series([node(s) if len(s) else None for s in sets], dtype="Int64")

    return made(F.col(text))


def units(pairs: DataFrame, largest: int, copies: int) -> DataFrame:
    """Where nodes meet: unit, i, j, node.

    ``pairs`` has band, node, head and m, the bucket's smallest node and size.  A cluster is one unit, cut
    into pairs of blocks if it is large; beyond ``copies`` blocks its buckets take its place, as they then
    send each node less often.
    """
    cluster = components(pairs.select(F.col("node").alias("a"), F.col("head").alias("b")))
    sizes = cluster.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    cluster = written(cluster.join(sizes, "component"), "clusters")
    block = largest // 2
    whole = cluster.where(F.col("m") <= block * copies).select(F.col("component").alias("unit"), "m", "node")
    big = pairs.join(cluster.where(F.col("m") > block * copies).select("node"), "node")
    # Buckets with the same members are compared once.
    alike = big.groupBy("band", "m").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    chosen = alike.groupBy("m", "x", "y").agg(F.min("band").alias("band")).select("band")
    buckets = big.join(chosen, "band").select(F.col("band").alias("unit"), "m", "node")
    blocks = F.when(F.col("m") <= largest, 1).otherwise(F.ceil(F.col("m") / block)).cast("int")
    placed = whole.unionByName(buckets).withColumn("_n", blocks).withColumn("_b", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    met = placed.withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return met.select("unit", F.least("_b", "_c").alias("i"), F.greatest("_b", "_c").alias("j"), "node")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: int = UNIT, copies: int = HASHES // BAND) -> tuple[DataFrame, DataFrame]:
    """Two tables: every row's _id, text _hash, n (set size) and node; and of all nodes the node,
    component (its smallest node) and component_id."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    base = written(rows.mapInArrow(_sketch, f"_id {kind}, _hash long, n long, node long, sig binary"), "sketches")
    named = base.where("node is not null").groupBy("node").agg(F.min("_id").alias("label"))
    nodes = written(base.where("node is not null").select("node", "sig").dropDuplicates(["node"]).join(named, "node"), "nodes")
    bands = nodes.select("node", "sig").mapInArrow(_bands, "band long, node long")
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("head")).where("m > 1")
    pairs = written(bands.join(buckets, "band"), "buckets")
    met = written(units(pairs, largest, copies), "units")
    needed = nodes.select("node", "label").join(met.select("node").distinct(), "node", "left_semi")
    texts = rows.drop("_hash").withColumn("node", node_of("_text"))
    same = (texts["node"] == needed["node"]) & texts["_id"].eqNullSafe(needed["label"])
    texts = texts.join(needed, same, "left_semi").dropDuplicates(["node"])
    sets = texts.select("node", "_text").mapInArrow(_sets, "node long, sig binary, own binary")
    found = met.join(sets, "node").groupBy("unit", "i", "j").applyInPandas(_verify, "a long, b long")
    joined = components(found)
    member = nodes.select("node", "label").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("label").alias("component_id"))
    return base.drop("sig"), member.join(least, "component").select("node", "component", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: int = UNIT, copies: int = HASHES // BAND) -> DataFrame:
    """Per row: the id, n_shingles, component_id (smallest id in the group), kept (the row has that id)."""
    base, member = groups(docs, doc_id, text, largest, copies)
    joined = base.join(member, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


@shielded("doc_id", "text")
def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: int = UNIT, copies: int = HASHES // BAND) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the smallest id stays, one row of it."""
    base, member = groups(docs, doc_id, text, largest, copies)
    decided = base.join(member, "node", "left").where(F.col("node").isNull() | F.col("_id").eqNullSafe(F.col("component_id")))
    decided = decided.select("_id", "_hash", F.col("node").alias("_node"), F.col("component").alias("_component")).distinct()
    rows = docs.withColumn("_text_hash", F.xxhash64(text))
    joined = rows.join(decided, rows[doc_id].eqNullSafe(decided["_id"]) & (rows["_text_hash"] == decided["_hash"]))
    # Rows without a word are linked with nothing, so each stays; of others that share an id, one does.
    place = F.row_number().over(Window.partitionBy(doc_id, "_component", F.col("_node").isNull()).orderBy("_text_hash"))
    chosen = joined.withColumn("_place", place).where("_node is null or _place = 1")
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])
