"""Removal of long byte strings that occur more than once, by suffix sorting.

A *window* is a string of ``length`` bytes.  Its leader is the gram of ``GRAM`` bytes inside it with the
smallest hash, the leftmost of equals, so equal windows have equal leaders at equal offsets.  The
consecutive windows of a text that share a leader form a *piece*.  Only pieces whose leader occurs at
least twice can hold a repeated window.  A piece that occurs twice as a whole is repeated throughout;
the others, at the edges of repeated passages, are suffix-sorted together with all pieces of the same
leader (:mod:`chartmill.llm.suffixes`), words being the symbols.  Hash values only bring pieces
together; 128 bits (leader and piece) stand for equal pieces.

Sorting tasks hold whole leaders, up to a bounded number of pieces.  A leader with more pieces than
that is resolved by counting its windows instead, in a plain aggregation without large groups.

Null text counts as empty.  Text shorter than a window has nothing to remove.  Strings never cross rows.
Rows alike in id and text are occurrences of their own: their common text is repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chartmill.llm.base import shielded, written
from chartmill.llm.suffixes import suffix_array

LENGTH = 200
GRAM = 64
SORTED_PIECES = 3000
LARGEST_LEADER = 20_000

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORDS = re.compile(rb"[^ \n]*[ \n]|[^ \n]+")


class _Powers:
    """Powers of the multiplier and of its inverse, as far as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) <= n:
            size = max(n + 1, 2 * len(cls.up), 1 << 14)
            for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of one byte string."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        _Powers.reach(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _Powers.up[:n], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _Powers.down[start]

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * _Powers.down[:n])


def pieces(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First and last window start, leader's position, leader and piece hash of each piece of a text."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    width = length - gram + 1
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: -(width - span)], least[width - span :])
    lead = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])))
    last = np.append(first[1:], n) - 1
    at = lead[first]
    shape = ((at - first) * 4096 + (last - first)).astype(np.uint64)
    piece = _mixed(hashes.raw(first, last + length) ^ _mixed(shape))
    return first, last, at, grams[at].view(np.int64), piece.view(np.int64)


def _each_text(column: pa.Array) -> Iterator[np.ndarray]:
    binary = column.cast(pa.large_binary())
    for value in binary:
        yield np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid and len(value.as_buffer()) else np.empty(0, np.uint8)


def _leaders(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per piece: its leader only."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [pieces(data, length, gram)[3] for data in _each_text(batch.column("_text"))]
            yield pa.RecordBatch.from_pydict({"leader": np.concatenate([*parts, np.empty(0, np.int64)])})

    return rows.select("_text").mapInArrow(found, "leader long")


def _pieces(rows: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["first", "last", "at", "leader", "piece"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [pieces(data, length, gram) for data in _each_text(batch.column("_text"))]
            sizes = [len(p[0]) for p in parts]
            columns = {name: np.repeat(batch.column(name).to_numpy(), sizes) for name in ("_h1", "_h2")}
            for k, name in enumerate(names):
                values = np.concatenate([*[p[k] for p in parts], np.empty(0, np.int64)])
                columns[name] = values.astype(np.int32) if k < 3 else values
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(found, "_h1 long, _h2 int, first int, last int, at int, leader long, piece long")


def repeated_windows(texts: list[bytes], at: np.ndarray, groups: np.ndarray, length: int, gram: int) -> list[tuple[int, int] | None]:
    """For each piece, first and last start of a window that another piece of its group has too.

    ``texts`` are the pieces' bytes, ``at`` the leader's offset in each.  Windows of a piece start at
    0 up to ``len - length``.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts])
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
    words = [_WORDS.findall(t) for t in texts]
    rank = {w: k for k, w in enumerate(sorted({w for piece in words for w in piece}), n + 1)}
    symbols: list[int] = []
    # A window starts within a word, or at its first byte; it is known by the rest of that word and the
    # suffix after it.  Here are the words such suffixes begin with.
    places: list[int] = []  # in symbols
    starts: list[int] = []  # in data
    before: list[int] = []  # length of the word before
    owner: list[int] = []
    lone: list[int] = []  # starts of windows that lie within one word
    for k, piece in enumerate(words):
        here, behind, lead, kept = 0, 0, int(at[k]), False
        origin, final = int(base[k]), len(texts[k]) - length
        for word in piece:
            size = len(word)
            if here and here - behind <= min(lead, final):
                places.append(len(symbols))
                starts.append(origin + here)
                before.append(behind)
                owner.append(k)
            if size >= length:
                lone += range(origin + here, origin + min(here + size - length, final) + 1)
            if here > lead and here + size <= lead + gram and word[-1] in b" \n":
                if not kept:  # the words that begin and end within the leader are the same in the whole group
                    symbols.append(int(groups[k]) + 1)
                    kept = True
            else:
                symbols.append(rank[word])
            here, behind = here + size, size
        symbols.append(0)
    repeated = np.zeros(len(data), bool)
    hashes = Hashes(data)
    if lone:
        spots = np.unique(np.array(lone))
        _, back, count = np.unique(hashes.raw(spots, spots + length), return_inverse=True, return_counts=True)
        repeated[spots[count[back] > 1]] = True
    place, start, behind, own = (np.array(x, np.int64) for x in (places, starts, before, owner))
    turn = np.empty(len(symbols), np.int64)
    turn[suffix_array(np.array(symbols))] = np.arange(len(symbols))
    order = np.argsort(turn[place])
    start, behind, own = start[order], behind[order], own[order]
    shared = _shared_prefix(data, start, base[own] + sizes[own] - start, length)
    for back in range(1, min(int(behind.max(initial=0)), length - 1) + 1):
        need = length - back
        alike = shared >= need  # with the suffix before
        some = alike | np.append(alike[1:], False)
        some &= behind >= back
        spots = start[some] - back
        fits = (spots - base[own[some]]) <= sizes[own[some]] - length
        if not fits.any():
            continue
        classes = np.cumsum(~alike)[some][fits].astype(np.uint64)
        spots = spots[fits]
        keys = _mixed(hashes.raw(spots, spots + back) + classes * np.uint64(_MULTIPLIER))
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        repeated[spots[count[inverse] > 1]] = True
    out: list[tuple[int, int] | None] = []
    for k in range(n):
        found = np.flatnonzero(repeated[base[k] : base[k] + sizes[k] - length + 1])
        out.append((int(found[0]), int(found[-1])) if len(found) else None)
    return out


def _shared_prefix(data: np.ndarray, start: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Bytes, up to ``length``, that each suffix shares with the one before it in the order."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    shared = np.zeros(len(start), np.int64)
    for at in range(1, len(start), 20_000):
        here = start[at : at + 20_000]
        differ = view[here] != view[start[at - 1 : at - 1 + len(here)]]
        shared[at : at + 20_000] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    shared[1:] = np.minimum(shared[1:], np.minimum(room[1:], room[:-1]))
    return shared


def ranges(docs: DataFrame, length: int, gram: int, sorted_pieces: int, largest: int) -> DataFrame:
    """Byte ranges to remove: ``_h1``, ``_h2``, start, end; ranges of a text may overlap.

    ``docs`` has the row's hashes and its text in ``_text``.
    """
    # Written, so that the join below meets both sides fresh from a shuffle and can split a hot leader.
    twice = _leaders(docs, length, gram).groupBy("leader").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = written(twice.select("leader"), "leaders")
    found = written(_pieces(docs, length, gram).join(twice, "leader", "left_semi"), "pieces")
    one = [F.first(c).alias(c) for c in ("_h1", "_h2", "first", "last", "at")]
    distinct = written(found.groupBy("leader", "piece").agg(F.count(F.lit(1)).alias("n"), *one), "distinct")
    whole = found.join(distinct.where("n > 1").select("leader", "piece"), ["leader", "piece"], "left_semi")
    whole = whole.select("_h1", "_h2", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    open_leaders = distinct.groupBy("leader").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1")
    unsure = distinct.join(open_leaders.select("leader", "m"), "leader")
    cuts = unsure.groupBy("_h1", "_h2").agg(F.collect_list(F.struct("leader", "m", "n", "first", "last", "at")).alias("cuts"))
    bodies = docs.select("_h1", "_h2", "_text").join(cuts, ["_h1", "_h2"])
    raw = F.col("_text").cast("binary")
    cut = F.transform("cuts", lambda c: F.struct(
        *[c[x].alias(x) for x in ("leader", "m", "n", "first", "at")],
        F.substring(raw, c["first"] + 1, c["last"] - c["first"] + length).alias("bytes"),
    ))
    parts = bodies.dropDuplicates(["_h1", "_h2"]).select("_h1", "_h2", F.inline(cut))
    parts = written(parts, "edges")
    tasks = max(1, -(-parts.count() // sorted_pieces))

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        _, groups = np.unique(group["leader"], return_inverse=True)
        texts = [bytes(b) for b in group["bytes"]]
        spans = repeated_windows(texts, (group["at"] - group["first"]).to_numpy(), groups, length, gram)
        hit = np.array([s is not None and n == 1 for s, n in zip(spans, group["n"])], bool)
        lo, hi = np.array([s or (0, 0) for s in spans]).T
        first = group["first"].to_numpy()
        made = pd.DataFrame({"_h1": group["_h1"], "_h2": group["_h2"], "start": first + lo, "end": first + hi + length})
        return made[hit]

    schema = "_h1 long, _h2 int, start int, end int"
    task = F.pmod(F.xxhash64("leader"), F.lit(tasks)).alias("_task")
    edges = parts.where(F.col("m") <= largest).groupBy(task).applyInPandas(sort, schema)

    starts = F.sequence(F.lit(0), F.length("bytes") - length)
    windows = parts.where(F.col("m") > largest).select("*", F.explode(starts).alias("_s"))
    windows = windows.withColumn("_window", F.md5(F.expr(f"substring(bytes, _s + 1, {length})"))).withColumn("_off", F.col("_s") + F.col("first") - F.col("at"))
    key = ["leader", "_off", "_window"]
    common = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(*key)
    counted = windows.where("n = 1").join(common, key, "left_semi")
    counted = counted.select("_h1", "_h2", (F.col("first") + F.col("_s")).alias("start"), (F.col("first") + F.col("_s") + length).alias("end"))
    return whole.unionByName(edges).unionByName(counted)


@shielded("text", "ids", adds=("kept", "spans"))
def remove(
    docs: DataFrame, text: str = "text", ids: tuple[str, ...] = ("doc_id",), kept: str = "kept", spans: str = "removed",
    length: int = LENGTH, gram: int = GRAM, sorted_pieces: int = SORTED_PIECES, largest: int = LARGEST_LEADER,
) -> DataFrame:
    """Add ``kept``, the bytes left of ``text``, and ``removed``, the byte ranges taken out.

    Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else.
    All other columns pass unchanged.
    """
    same = [*ids, text]
    rows = docs.withColumn("_h1", F.xxhash64(*same)).withColumn("_h2", F.hash(*same))
    bare = rows.select("_h1", "_h2", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    gone = ranges(bare, length, gram, sorted_pieces, largest)
    gone = gone.groupBy("_h1", "_h2").agg(F.collect_list(F.struct("start", "end")).alias("_gone"))

    @F.pandas_udf("kept binary, removed array<struct<start:int,end:int>>")
    def left(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for body, some in zip(texts, found):
            data = body.encode() if isinstance(body, str) else b""
            merged: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in (some if some is not None else ())):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            edges = [0, *[e for span in merged for e in span], len(data)]
            out.append((b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), [{"start": a, "end": b} for a, b in merged]))
        return pd.DataFrame(out, columns=["kept", "removed"], dtype=object)

    done = rows.join(gone, ["_h1", "_h2"], "left").withColumn("_left", left(F.col(text), F.col("_gone")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_left.kept").alias(kept), F.col("_left.removed").alias(spans))
