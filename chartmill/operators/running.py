"""Aggregates over the past of a moment, for any number of moments, without pairing facts with moments.

Facts and reference rows of an entity become one timeline.  A measure is made of sums, minima and maxima
of a fact's values, which can be carried along that timeline and across its slices, so that each reference
row reads off what has been gathered before it.  The rows shuffled are the facts and the references.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from chartmill.functions.columns import epoch_micros
from chartmill.operators import timeline
from chartmill.operators.skew import any_null


@dataclass(frozen=True)
class Measure:
    """``folds``: pairs of a fold and a value per fact; ``finish`` makes the result from the folded values."""

    folds: tuple[tuple[str, Column], ...]
    finish: Callable[..., Column] = lambda value: value


def count(value: Column | None = None) -> Measure:
    """Facts, or facts with a known value; null where there is no fact at all."""
    return Measure((("sum", F.lit(1).cast("long") if value is None else value.isNotNull().cast("long")),))


def total(value: Column) -> Measure:
    return Measure((("sum", value),))


def mean(value: Column) -> Measure:
    known = value.isNotNull().cast("long")
    return Measure((("sum", value.cast("double")), ("sum", known)), lambda s, n: s / F.nullif(n, F.lit(0)))


def least(value: Column) -> Measure:
    return Measure((("min", value),))


def greatest(value: Column) -> Measure:
    return Measure((("max", value),))


def latest(value: Column, ts: Column) -> Measure:
    """The known value at the latest time, the largest of several."""
    return Measure((("max", F.when(value.isNotNull(), F.struct(ts.alias("t"), value.alias("v")))),), lambda pair: pair["v"])


def earliest(value: Column, ts: Column) -> Measure:
    """The known value at the earliest time, the smallest of several."""
    return Measure((("min", F.when(value.isNotNull(), F.struct(ts.alias("t"), value.alias("v")))),), lambda pair: pair["v"])


def _merged(
    refs: DataFrame, facts: DataFrame, keys: Sequence[str], times: dict[int, Column], ts: str, values: dict[str, Column]
) -> DataFrame:
    """One timeline: facts on side 1, and each reference row once per side in ``times``, at that time."""
    sides = F.array(*[F.struct(F.lit(side).alias("_side"), time.alias("_t")) for side, time in times.items()])
    kinds = facts.select(*[value.alias(name) for name, value in values.items()]).schema
    left = refs.select(*keys, F.struct(*[F.col(c) for c in refs.columns]).alias("_row"), F.explode(sides).alias("_at")).select(
        *keys, "_at._t", "_at._side", "_row", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
    )
    right = facts.where(~any_null([*keys, ts])).select(
        *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
        *[value.alias(name) for name, value in values.items()],
    )
    return left.unionByName(right)


def until(
    refs: DataFrame, facts: DataFrame, keys: Sequence[str], ref_time: str, ts: str, measures: dict[str, Measure],
    strictly_before: bool = True, **cutting,
) -> DataFrame:
    """Add to each reference row the measures over its entity's facts before (or at) its time.

    Where there is no such fact, or the row has no key or time, the measures are null.
    """
    keys, order = list(keys), ["_t", "_side"]
    values = {f"_f{i}_{j}": value for i, m in enumerate(measures.values()) for j, (_, value) in enumerate(m.folds)}
    unknown = any_null([*keys, ref_time])
    merged = _merged(refs.where(~unknown), facts, keys, {0 if strictly_before else 2: F.col(ref_time)}, ts, values)
    steps = {
        f"_r{i}_{j}": timeline.running_step(keys, order, fold, F.col(f"_f{i}_{j}"))
        for i, m in enumerate(measures.values()) for j, (fold, _) in enumerate(m.folds)
    }
    done = timeline.extend(merged, keys, order, steps, **cutting).where(F.col("_row").isNotNull())
    found = done.select("_row.*", *[
        m.finish(*[F.col(f"_r{i}_{j}") for j in range(len(m.folds))]).alias(name) for i, (name, m) in enumerate(measures.items())
    ])
    kinds = found.select(*measures).schema
    return found.unionByName(refs.where(unknown).withColumns({f.name: F.lit(None).cast(f.dataType) for f in kinds}))


def greatest_within(
    refs: DataFrame, facts: DataFrame, keys: Sequence[str], ref_time: str, ts: str, value: str, seconds: int, name: str, **cutting
) -> DataFrame:
    """Add to each reference row the largest value in the ``seconds`` after its time, the end included.

    Time is cut into cells as long as the window, so a window is the rest of one cell and the start of the
    next: the largest value after the reference in its cell, and the largest up to the end in the next.
    Both are running maxima, one backwards and one forwards, read off in one pass over (entity, cell).
    """
    keys, micros = list(keys), seconds * 1_000_000
    unknown = any_null([*keys, ref_time])
    start = epoch_micros(F.col(ref_time))
    # Sides 2 and 3 lie after the facts of their instant: not after the reference, but up to the end.
    timed = facts.withColumn("_us", epoch_micros(F.col(ts)))
    merged = _merged(refs.where(~unknown), timed, keys, {2: start, 3: start + micros}, "_us", {"_v": F.col(value)})
    cells = merged.withColumn("_cell", F.floor(F.col("_t") / micros))
    by, order = [*keys, "_cell"], ["_t", "_side"]
    steps = {
        "_after": timeline.running_step(by, order, "max", F.col("_v"), following=True),
        "_upto": timeline.running_step(by, order, "max", F.col("_v")),
    }
    done = timeline.extend(cells, by, order, steps, **cutting).where(F.col("_row").isNotNull())
    best = F.max(F.when(F.col("_side") == 2, F.col("_after")).otherwise(F.col("_upto")))
    found = done.groupBy("_row").agg(best.alias(name), F.count_if(F.col("_side") == 2).alias("_copies"))
    each = found.select("_row.*", name, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copy")
    return each.unionByName(refs.where(unknown).withColumn(name, F.lit(None).cast(each.schema[name].dataType)))
