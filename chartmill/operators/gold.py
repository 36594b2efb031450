"""Labels and features with explicit time cut-offs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartmill.functions.columns import days_between, epoch_micros
from chartmill.operators import running, timeline
from chartmill.operators.running import Measure

# The generic reporting flag among the complication elements, and the useful context.
GENERIC_COMPLICATION = "AN AQI POST-OP COMPLICATIONS"
ENCOUNTER_CONTEXT = "ENCOUNTER"


def real_complications(
    df: DataFrame, element: str = "Element_Name", context: str = "CONTEXT_NAME",
    generic: str = GENERIC_COMPLICATION, wanted_context: str = ENCOUNTER_CONTEXT,
) -> DataFrame:
    """Specific complication classes only: the generic reporting flag is not a class."""
    return df.where((F.col(element) != generic) & (F.col(context) == wanted_context))


def label_from_code(df: DataFrame, code: str, positive: Sequence, name: str) -> DataFrame:
    """A boolean label from a category, null when the category is unknown."""
    return df.withColumn(name, F.col(code).isin(list(positive)))


def composite_label(encounters: DataFrame, facts: DataFrame, key: str, classes: str, names: Sequence[str]) -> DataFrame:
    """One boolean per class plus ``any_class`` for every encounter; facts shrink to one row per key first."""
    flags = facts.groupBy(key).agg(
        F.lit(True).alias("any_class"),
        *[F.max(F.coalesce(F.col(classes) == name, F.lit(False))).alias(f"is_{name}") for name in names],
    )
    labels = ["any_class", *[f"is_{name}" for name in names]]
    return encounters.join(flags, key, "left").fillna(False, labels)


def leakage_window(
    facts: DataFrame, cutoffs: DataFrame, key: str, ts: str, cutoff: str, measures: dict[str, Measure], **cutting
) -> DataFrame:
    """Aggregates per cut-off over the entity's facts strictly before it, so features cannot see the outcome.

    An entity with several cut-offs has features for each, from the facts before that one alone; without
    any they are null.  Facts and cut-offs are one timeline (see :mod:`running`), so many cut-offs cost
    no more than as many facts.
    """
    return running.until(cutoffs.select(key, cutoff), facts, [key], cutoff, ts, measures, **cutting)


def rise_label(
    series: DataFrame, encounters: DataFrame, key: str, ts: str, value: str, start: str, stop: str,
    window_seconds: int, absolute: float, relative: float, **cutting,
) -> DataFrame:
    """Does a measure rise after a procedure against the last value before it?

    Baseline: the latest value before ``start`` (the larger of ties).  Peak: the largest value within
    the window after ``stop``.  The label is null when either is missing.  Each procedure of an entity
    is judged by its own times: the result has the key, ``start``, ``stop`` and what was found.
    """
    cases = encounters.select(key, start, stop)
    usable = series.where(F.col(value).isNotNull())
    before = {"baseline": running.latest(F.col(value), F.col(ts))}
    based = running.until(cases, usable, [key], start, ts, before, **cutting)
    found = running.greatest_within(based, usable, [key], stop, ts, value, window_seconds, "peak", **cutting)
    risen = (F.col("peak") - F.col("baseline") >= absolute) | (F.col("peak") >= F.col("baseline") * F.lit(relative))
    return found.withColumn("risen", risen)


def threshold_breach_ahead(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, limit: float, horizon_seconds: int,
    below: bool = True, **cutting,
) -> DataFrame:
    """For each reading: does a later reading within the horizon cross the limit?

    It does exactly when the first later crossing lies within the horizon, so one "next time" lookup
    replaces a window over all readings ahead.
    """
    crossing = F.col(value) < limit if below else F.col(value) > limit
    ahead = timeline.next_time(series, keys, ts, crossing, "next_breach", **cutting)
    gap = epoch_micros(F.col("next_breach")) - epoch_micros(F.col(ts))
    within = gap <= F.lit(horizon_seconds * 1_000_000)
    return ahead.withColumn("breach_ahead", F.coalesce(within, F.lit(False)))


def repeat_event(df: DataFrame, keys: Sequence[str], order: Sequence[str], **cutting) -> DataFrame:
    """Does the entity return, and after how many days?"""
    ts = order[0]
    ahead = timeline.neighbour(df, keys, order, [ts], "_next", following=True, **cutting)
    next_ts = F.col(f"_next.{ts}")
    return ahead.withColumn("returns", next_ts.isNotNull()).withColumn(
        "days_to_next", days_between(F.col(ts), next_ts)
    ).drop("_next")


def history_features(df: DataFrame, keys: Sequence[str], order: Sequence[str], **cutting) -> DataFrame:
    """Number of earlier events of the entity and days since the last one."""
    ts = order[0]
    steps = {"_position": timeline.position_step(keys, order), "_previous": timeline.neighbour_step(keys, order, [ts])}
    timed = timeline.extend(df, keys, order, steps, **cutting)
    return timed.withColumn("prior_events", F.col("_position") - 1).withColumn(
        "days_since_previous", days_between(F.col(f"_previous.{ts}"), F.col(ts))
    ).drop("_position", "_previous")


def phase_fallback(label: Column, ts: Column, start: Column, stop: Column) -> Column:
    """The recorded phase, or the one that follows from the times."""
    derived = F.when(ts < start, "PRE-OP").when(ts > stop, "POST-OP").when((ts >= start) & (ts <= stop), "INTRA-OP")
    return F.coalesce(label, derived)


def wide_features(summary: DataFrame, keys: Sequence[str], measure: str, names: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """A per-measure summary as one row per encounter; the measures are listed, never discovered."""
    return summary.groupBy(*keys).agg(*[
        F.max(F.when(F.col(measure) == name, F.col(stat))).alias(f"{name}_{stat}") for name in names for stat in stats
    ])


def exposure_flag(
    encounters: DataFrame, facts: DataFrame, key: str, ts: str, start: str, stop: str, classes: Sequence[str],
    class_column: str, **cutting,
) -> DataFrame:
    """Was any item of each class recorded within the encounter's time window, ends included?

    It was exactly when the last one up to the end is not before the start, so no pair of fact and
    encounter is formed.  A window without start or end, or ending before it starts, has no items.
    """
    wanted = facts.where(F.col(class_column).isin(list(classes)))
    last = {f"exposed_{name}": running.greatest(F.when(F.col(class_column) == name, F.col(ts))) for name in classes}
    found = running.until(encounters, wanted, [key], stop, ts, last, strictly_before=False, **cutting)
    return found.withColumns({name: F.coalesce(F.col(name) >= F.col(start), F.lit(False)) for name in last})


def attributable(facts: DataFrame, encounters: DataFrame, entity: str, encounter: str) -> DataFrame:
    """Share of entity-level facts that belong to an entity with exactly one encounter."""
    per_entity = facts.groupBy(entity).agg(F.count(F.lit(1)).alias("_facts"))
    counts = encounters.groupBy(entity, encounter).agg(F.lit(1).alias("_one")).groupBy(entity).agg(
        F.count(encounter).alias("_encounters")
    )
    single = F.col("_encounters") == 1
    return per_entity.join(counts, entity, "left").agg(
        F.sum("_facts").alias("n_facts"),
        F.coalesce(F.sum(F.when(single, F.col("_facts"))), F.lit(0)).alias("attributable_facts"),
        F.count_if(single).alias("single_encounter_entities"),
        (F.coalesce(F.sum(F.when(single, F.col("_facts"))), F.lit(0)) / F.sum("_facts")).alias("attributable_share"),
    )
