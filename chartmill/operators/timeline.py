"""Order-dependent steps over long timelines, cut into equal slices where needed.

A window over one entity sorts all of its rows in one task, which is fine until one entity holds a
large share of the rows.  All rows, in the order of (entity, order), are therefore cut into slices of
about equal numbers of rows, at borders taken from a sample; a border is a whole tuple, so rows of one
instant, or without a time, are cut too.  A window runs within (entity, slice).  Only an entity with a
border among its rows lies in several slices: there each slice is reduced to one summary row, and what
a slice needs from the others is computed over the summaries and joined back.  There are no more such
entities than borders, and at most two summaries per border, so both stay small whatever the table.

Rows without a time come last.  Rows without an entity form one timeline, as they form one partition
of a window; like any other it is cut where a border falls.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.functions.columns import epoch_micros
from chartmill.operators.skew import HOT_KEY_ROWS, join_null_safe

DAY = 24 * 3_600

SLICE = "_slice"
# The rows are cut into so many slices at most (a power of two), borders being taken from so many sampled rows per slice.
MOST_SLICES = 4096
PER_SLICE = 64


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def _descending(order: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_first() for name in order]


def _sort_key(order: Sequence[str]) -> Column:
    parts = []
    for i, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


def _slices(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE)


def _earlier(keys: Sequence[str]):
    return _slices(keys).rowsBetween(Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Step:
    """One value to add to every row of a timeline.

    ``within`` is computed over the rows of the slice, ``summary`` reduces a slice to one value,
    ``across`` is computed over the summaries (a column named like the step), and ``combine`` joins
    what the slice and the other slices say.
    """

    within: Column
    summary: Column
    across: Callable[[str], Column]
    combine: Callable[[Column, Column], Column]


def _borders(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """The sorted (entity, order) tuples at which slices begin: one row with one array.

    The sample is chosen by a hash of the tuple, so a repeated task, and every use of the plan, finds the
    same borders.  Its size depends on the number of slices, not on the number of rows.
    """
    n = F.count(F.lit(1))
    slices = F.least(F.ceil(n / hot_rows), F.lit(MOST_SLICES)).cast("int")
    rate = F.when(slices > 1, slices * PER_SLICE / n).otherwise(F.lit(0.0))
    sizes = df.agg(F.struct(slices.alias("slices"), rate.alias("rate"))).scalar()
    chance = F.pmod(F.xxhash64(F.lit(11), *keys, *order), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Chosen inside the aggregate: the optimizer cannot compare filters that hold a subquery of a subquery.
    chosen = F.when(chance < sizes["rate"], _sort_key([*keys, *order]))
    sample = df.agg(F.sort_array(F.collect_list(chosen)).alias("_sample")).withColumn("_slices", sizes["slices"])
    picked = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_slices") - 1, F.lit(1))),
        lambda i: F.get(F.col("_sample"), F.floor(i * F.size("_sample") / F.col("_slices")).cast("int")),
    )
    flat = sample.select(F.array_compact(picked).alias("_flat"))
    new = F.filter("_flat", lambda border, i: (i == 0) | (border > F.get(F.col("_flat"), i - 1)))
    return flat.select(new.alias("_borders"))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Number the slice of each row: the borders at or below it, by bisection.

    The borders come as a scalar subquery, which the optimizer moves into the one place that asks for it: no
    row carries them.
    """
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_SLICES.bit_length() - 1))])
    here = _sort_key([*keys, *order])

    def step(at: Column, by: Column) -> Column:
        return F.when(F.get(F.col("_borders"), at + by - 1) <= here, at + by).otherwise(at)

    given = df.withColumn("_borders", _borders(df, keys, order, hot_rows).scalar())
    return given.withColumn(SLICE, F.reduce(halves, F.lit(0), step)).drop("_borders")


def _across(cut: DataFrame, borders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of entities that lie in several slices, which are those with a border among their rows."""
    # Outer, because the filter that Spark infers for a plain explode repeats the borders' expression in itself.
    several = borders.select(F.explode_outer("_borders").alias("_border")).where(F.col("_border").isNotNull()).select(
        *[F.col(f"_border.v{i}").alias(name) for i, name in enumerate(keys)]
    ).distinct()
    return join_null_safe(cut, F.broadcast(several), keys, "inner")


def _join_carried(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What slices take over from others: at most two rows per border, sent to every task, so that no row moves."""
    return join_null_safe(rows, F.broadcast(carried), [*keys, SLICE])


def extend(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: dict[str, Step], hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add the given steps, all in one order, in one pass: one shuffle of the rows, and small ones of summaries."""
    keys = list(keys)
    cut = _cut(df, keys, order, hot_rows)
    per_slice = _across(cut, _borders(df, keys, order, hot_rows), keys).groupBy(*keys, SLICE).agg(*[step.summary.alias(f"_s_{name}") for name, step in steps.items()])
    carried = per_slice.select(*keys, SLICE, *[step.across(f"_s_{name}").alias(f"_c_{name}") for name, step in steps.items()])
    rows = cut.withColumns({f"_w_{name}": step.within for name, step in steps.items()})
    joined = _join_carried(rows, carried, keys)
    combined = {name: step.combine(F.col(f"_w_{name}"), F.col(f"_c_{name}")) for name, step in steps.items()}
    return joined.withColumns(combined).drop(SLICE, *[f"_w_{name}" for name in steps], *[f"_c_{name}" for name in steps])


def _in_slice(keys: Sequence[str], ordering: Sequence[Column]):
    return Window.partitionBy(*keys, SLICE).orderBy(*ordering)


def neighbour_step(keys: Sequence[str], order: Sequence[str], take: Sequence[str], following: bool = False) -> Step:
    """A struct with columns of the previous (or following) row."""
    value = F.struct(*take)
    edge = F.min_by if following else F.max_by
    over_slices = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc() if following else F.col(SLICE).asc())
    return Step(
        within=F.lag(value).over(_in_slice(keys, _descending(order) if following else _ascending(order))),
        summary=edge(value, _sort_key(order)),
        across=lambda edges: F.lag(edges).over(over_slices),
        combine=F.coalesce,
    )


def position_step(keys: Sequence[str], order: Sequence[str]) -> Step:
    """Number of the row, from 1."""
    return Step(
        within=F.row_number().over(_in_slice(keys, _ascending(order))),
        summary=F.count(F.lit(1)),
        across=lambda counts: F.sum(counts).over(_earlier(keys)),
        combine=lambda inner, before: inner + F.coalesce(before, F.lit(0).cast("bigint")),
    )


def last_known_step(keys: Sequence[str], order: Sequence[str], value: str) -> Step:
    """The latest non-null value at or before the row."""
    so_far = _in_slice(keys, _ascending(order)).rowsBetween(Window.unboundedPreceding, 0)
    return Step(
        within=F.last(value, ignorenulls=True).over(so_far),
        summary=F.max_by(value, F.when(F.col(value).isNotNull(), _sort_key(order))),
        across=lambda edges: F.last(edges, ignorenulls=True).over(_earlier(keys)),
        combine=F.coalesce,
    )


# The running aggregates that merge by themselves: what Spark calls them, and how two results become one.
FOLDS: dict[str, tuple[Callable[[Column | str], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running_step(keys: Sequence[str], order: Sequence[str], fold: str, value: Column, following: bool = False) -> Step:
    """Sum, min or max of the known values up to the row (or from the row on, itself included)."""
    aggregate, merge = FOLDS[fold]
    inside = _in_slice(keys, _descending(order) if following else _ascending(order))
    slices = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc() if following else F.col(SLICE).asc())
    return Step(
        within=aggregate(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        summary=aggregate(value),
        across=lambda parts: aggregate(parts).over(slices.rowsBetween(Window.unboundedPreceding, -1)),
        combine=merge,
    )


def next_time_step(keys: Sequence[str], ts: str, when: Column) -> Step:
    """The first strictly later moment at which a condition holds; slices must not part rows of one instant.

    The running frame goes backwards in time: Spark recomputes a frame that is open to the end for
    every row, but extends one that is open to the start.
    """
    moment = F.when(when, F.col(ts))
    later = _in_slice(keys, [epoch_micros(F.col(ts)).desc()]).rangeBetween(Window.unboundedPreceding, -1)
    backwards = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    return Step(
        within=F.min(moment).over(later),
        summary=F.min(moment),
        across=lambda firsts: F.min(firsts).over(backwards),
        combine=F.coalesce,
    )


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str], name: str,
    following: bool = False, **cutting,
) -> DataFrame:
    return extend(df, keys, order, {name: neighbour_step(keys, order, take, following)}, **cutting)


def position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", **cutting
) -> DataFrame:
    return extend(df, keys, order, {name: position_step(keys, order)}, **cutting)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, **cutting
) -> DataFrame:
    return extend(df, keys, order, {name: last_known_step(keys, order, value)}, **cutting)


def next_time(df: DataFrame, keys: Sequence[str], ts: str, when: Column, name: str, **cutting) -> DataFrame:
    """Rows of one instant stay in one slice; rows without a time find nothing and are cut by their content."""
    known = F.when(F.col(ts).isNull(), F.xxhash64(*df.columns))
    cut = extend(df.withColumn("_spread", known), keys, [ts, "_spread"], {name: next_time_step(keys, ts, when)}, **cutting)
    return cut.withColumn(name, F.when(F.col(ts).isNotNull(), F.col(name))).drop("_spread")


def runs(df: DataFrame, keys: Sequence[str], label: str, order: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Number the runs of consecutive equal labels within a timeline, from 1 (column ``run``)."""
    keys = list(keys)
    cut = _cut(df, keys, order, hot_rows)
    within = _in_slice(keys, _ascending(order))
    # A row starts a run when its label differs from the row before; the first row of a slice is
    # compared with the last row of the slice before it.
    changed = (~F.col(label).eqNullSafe(F.lag(label).over(within))).cast("bigint")
    stepped = cut.withColumn("_start", F.when(F.row_number().over(within) > 1, changed).otherwise(F.lit(0)))
    counted = stepped.withColumn("_inner", F.sum("_start").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    edges = _across(counted, _borders(df, keys, order, hot_rows), keys).groupBy(*keys, SLICE).agg(
        F.min_by(F.struct(label), _sort_key(order)).alias("_head"),
        F.max_by(F.struct(label), _sort_key(order)).alias("_tail"),
        F.max("_inner").alias("_starts"),
    )
    opens = (~F.col("_head").eqNullSafe(F.lag("_tail").over(_slices(keys)))).cast("bigint")
    before = F.coalesce(F.sum(F.col("_opens") + F.col("_starts")).over(_earlier(keys)), F.lit(0))
    carried = edges.withColumn("_opens", opens).select(*keys, SLICE, (before + F.col("_opens")).alias("_offset"))
    joined = _join_carried(counted, carried, keys)
    number = F.coalesce("_offset", F.lit(1).cast("bigint")) + F.col("_inner")
    return joined.withColumn("run", number).drop(SLICE, "_start", "_inner", "_offset")
