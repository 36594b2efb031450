"""Checkpoint sequences: first occurrences, gaps between steps, order violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartmill.functions.columns import first_match, minutes_between
from chartmill.operators.aggregate import exact_quantiles, rate_by

# Records never closed by hand are closed by the system after seven days.
AUTOCLOSE_MINUTES = 7 * 24 * 60.0
AUTOCLOSE_TOLERANCE = 10.0


def first_occurrence_pivot(events: DataFrame, keys: Sequence[str], kind: str, ts: str, types: Sequence[str]) -> DataFrame:
    """One row per encounter, one column per checkpoint with its first time."""
    return events.where(F.col(kind).isin(list(types))).groupBy(*keys).agg(
        *[F.min(F.when(F.col(kind) == name, F.col(ts))).alias(name) for name in types]
    )


def _steps(types: Sequence[str]) -> list[tuple[str, str]]:
    return list(zip(types[:-1], types[1:]))


def _step_rows(pivot: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row per encounter and adjacent pair with both times known."""
    lines = [
        F.struct(
            F.lit(i).alias("step_no"), F.lit(f"{a} -> {b}").alias("step"),
            F.col(f"`{a}`").alias("start"), F.col(f"`{b}`").alias("end"),
        )
        for i, (a, b) in enumerate(_steps(types), start=1)
    ]
    rows = pivot.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
    return rows.where("start IS NOT NULL AND end IS NOT NULL")


def step_gaps(pivot: DataFrame, types: Sequence[str]) -> DataFrame:
    """Per adjacent pair: encounters with both, median and mean gap in minutes."""
    gaps = _step_rows(pivot, types).withColumn("minutes", minutes_between(F.col("start"), F.col("end")))
    basic = gaps.groupBy("step_no", "step").agg(F.count(F.lit(1)).alias("n"), F.avg("minutes").alias("mean_minutes"))
    median = exact_quantiles(gaps, ["step_no"], "minutes", [0.5]).select("step_no", F.col("quantile").alias("median_minutes"))
    return basic.join(median, "step_no", "left").select("step_no", "step", "n", "median_minutes", "mean_minutes")


def in_order(types: Sequence[str]) -> Column:
    """True when every adjacent pair is in order, null when a step is missing."""
    condition = F.lit(True)
    for a, b in _steps(types):
        condition = condition & (F.col(f"`{a}`") <= F.col(f"`{b}`"))
    missing = F.lit(False)
    for name in types:
        missing = missing | F.col(f"`{name}`").isNull()
    return F.when(~missing, condition)


def order_violations(pivot: DataFrame, types: Sequence[str]) -> DataFrame:
    """Violations per adjacent pair and for the complete chain, all in one pass."""
    chain = in_order(types)
    measures = [F.struct(
        F.lit(0).alias("step_no"), F.lit("complete chain").alias("step"),
        F.count(chain).alias("n"), F.count_if(~chain).alias("violations"),
    ).alias("s0")]
    for i, (a, b) in enumerate(_steps(types), start=1):
        late = F.col(f"`{b}`") < F.col(f"`{a}`")
        measures.append(F.struct(
            F.lit(i).alias("step_no"), F.lit(f"{a} -> {b}").alias("step"),
            F.count(late).alias("n"), F.count_if(late).alias("violations"),
        ).alias(f"s{i}"))
    one = pivot.agg(*measures)
    rows = one.select(F.explode(F.array(*one.columns)).alias("r")).select("r.*")
    return rows.withColumn("share_in_order", F.lit(1.0) - F.col("violations") / F.nullif("n", F.lit(0)))


def violation_rate_by(pivot: DataFrame, before: str, after: str, dimensions: Sequence[str]) -> DataFrame:
    """Share of encounters whose pair is out of order, per dimension value.

    The pivot has one row per encounter; attach dimensions to it, not to the events.
    """
    return rate_by(pivot, dimensions, F.col(f"`{after}`") < F.col(f"`{before}`"))


def repeated_checkpoints(events: DataFrame, keys: Sequence[str], kind: str, ts: str) -> DataFrame:
    """Per checkpoint: encounters having it, and those having it at several distinct times."""
    extent = events.groupBy(*keys, kind).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return rate_by(extent, [kind], F.col("_first") < F.col("_last"))


def relative_order(pivot: DataFrame, a: str, b: str) -> DataFrame:
    """Of the encounters with both: how often b is at, after or before a."""
    both = pivot.select(F.col(f"`{a}`").alias("_a"), F.col(f"`{b}`").alias("_b")).where("_a IS NOT NULL AND _b IS NOT NULL")
    n = F.count(F.lit(1))
    counts = {"equal": F.count_if(F.col("_b") == F.col("_a")), "after": F.count_if(F.col("_b") > F.col("_a")),
              "before": F.count_if(F.col("_b") < F.col("_a"))}
    return both.agg(
        n.alias("n"), *[value.alias(f"n_{name}") for name, value in counts.items()],
        *[(value / F.nullif(n, F.lit(0))).alias(f"share_{name}") for name, value in counts.items()],
    )


def exclude_autoclosed(
    pivot: DataFrame, start: str, end: str, minutes: float = AUTOCLOSE_MINUTES, tolerance: float = AUTOCLOSE_TOLERANCE
) -> DataFrame:
    """Remove records the system closed after its fixed timeout; all others stay as they are."""
    gap = minutes_between(F.col(f"`{start}`"), F.col(f"`{end}`"))
    return pivot.where(~F.coalesce(F.abs(gap - F.lit(minutes)) <= tolerance, F.lit(False)))


def exposure_actions(df: DataFrame, action: str, classes: DataFrame, default: str = "unclassified") -> DataFrame:
    """Mark each administration action as exposure or logistics through a lookup table.

    ``classes`` has the columns ``action`` and ``action_class``, one row per action; spaces around an
    action do not matter.
    """
    lookup = classes.select(F.trim("action").alias("_action"), "action_class").dropDuplicates(["_action"])
    marked = df.join(lookup, F.trim(F.col(action)) == F.col("_action"), "left").drop("_action")
    return marked.withColumn("action_class", F.coalesce("action_class", F.lit(default)))


def case_duration(pivot: DataFrame, phases: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Length of each named phase in minutes, from the first times of two checkpoints."""
    return pivot.withColumns({
        f"{name}_minutes": minutes_between(F.col(f"`{a}`"), F.col(f"`{b}`")) for name, (a, b) in phases.items()
    })
