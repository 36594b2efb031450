"""Summaries: per-group statistics, rates, exact quantiles, histograms, profiles of columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.functions import columns as C
from chartmill.operators.skew import join_null_safe
from chartmill.session import written


def totals(df: DataFrame, measures: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Named aggregates, overall or per group, in one pass."""
    return df.groupBy(*by).agg(*[value.alias(name) for name, value in measures.items()])


def safe_total(df: DataFrame, by: Sequence[str], quantity: str) -> DataFrame:
    """Total of a quantity over collapsed rows.

    The multiplicity column says how often a fact was exported, not how often it happened, so it is
    never multiplied in.
    """
    return df.groupBy(*by).agg(F.sum(quantity).alias("total"), F.count(quantity).alias("n_facts"))


def summary_by_group(df: DataFrame, keys: Sequence[str], value: str, ts: str) -> DataFrame:
    """n, mean, min, max and the latest value per group; of several latest values the largest counts.

    Time and number are packed into one of fixed width, so the whole summary is kept by hash; only values
    that are no numbers, or times of another kind, are compared as pairs.
    """
    kinds = dict(df.dtypes)
    whole = kinds[value] in ("tinyint", "smallint", "int", "bigint")
    if kinds[ts].startswith("timestamp") and (whole or kinds[value] in ("float", "double")):
        number = F.col(value).cast("long") if whole else C.order_code(F.col(value).cast("double"))
        code = C.unpacked(F.max(C.packed(F.col(ts), number)))
        last = (code if whole else C.from_order_code(code)).cast(kinds[value])
    else:
        last = F.max_by(value, F.struct(ts, value))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), last.alias("last"),
    )


def top_groups(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows per group, largest group first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), *[F.asc_nulls_last(name) for name in columns])
    return ordered if limit is None else ordered.limit(limit)


def rate_by(df: DataFrame, by: Sequence[str], flag: Column) -> DataFrame:
    """Rows, rows with the flag set, and their share, per group; an unknown flag is left out."""
    hit = F.count_if(flag)
    known = F.count(flag)
    return df.groupBy(*by).agg(known.alias("n"), hit.alias("n_true"), (hit / F.nullif(known, F.lit(0))).alias("rate"))


def rate_by_year(df: DataFrame, ts: str, flag: Column) -> DataFrame:
    return rate_by(df.withColumn("year", F.year(ts)), ["year"], flag)


def null_rate_by(df: DataFrame, category: str, column: str) -> DataFrame:
    """How often a column is missing within each category."""
    missing = F.count_if(F.col(column).isNull())
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"), missing.alias("n_null"), (missing / F.count(F.lit(1))).alias("null_rate")
    )


def sentinel_share(
    df: DataFrame, category: str, flag: Column, nearly_all: float = 0.99, minority: float = 0.02
) -> DataFrame:
    """Share of sentinel values per category, put into bands: none, minority, mixed, all."""
    shares = rate_by(df, [category], flag)
    band = C.first_match(
        [
            (F.col("rate") >= nearly_all, "all"),
            (F.col("rate") == 0, "none"),
            (F.col("rate") < minority, "minority"),
        ],
        "mixed",
    )
    return shares.withColumn("band", band)


# --- distributions ------------------------------------------------------------------------------


# Distinct values of a group that may lie inside its brackets when ranks are resolved among them in one task.
MOST_VALUES = 100_000
# Ranges into which an overfull group of values is counted at a time.
RANGES = 256


def _margins(points: Sequence[float], accuracy: int) -> tuple[list[float], list[float]]:
    """Where to ask a sketch for the ends of the brackets; its rank error is one in ``accuracy``."""
    margin = 4.0 / accuracy
    return [max(0.0, p - margin) for p in points], [min(1.0, p + margin) for p in points]


def _place(v: Column, brackets: Sequence[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Is a value outside all brackets, and what it is filed under: itself, or the bracket below its gap.

    All values of a gap become one line, placed after the bracket below it (or first, with a null floor).
    """
    inside, floor = F.lit(False), F.lit(None).cast("double")
    for low, high in brackets:
        inside = inside | ((v >= low) & (v <= high))
        floor = F.greatest(floor, F.when(v > high, high))
    return ~inside, F.when(inside, v).otherwise(floor)


def _through(groups: Sequence[str]) -> Column:
    order = Window.partitionBy(*groups).orderBy(F.col("_v").asc_nulls_first(), "_gap")
    return F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))


def _covers(rank: Column) -> Column:
    return (F.col("_through") - F.col("_n") <= rank) & (rank < F.col("_through"))


def _narrowed(counted: DataFrame, groups: Sequence[str], points: Sequence[float], most: int) -> DataFrame:
    """Merge lines that cannot hold a wanted rank until no group has more than ``most`` lines.

    Each round cuts the lines of a group at sketched quantiles of its distinct values into ``RANGES`` ranges,
    adds up each, and keeps the lines of the few ranges in which a wanted rank lies; the ranges between
    them become one line.  Distinct values fall into ranges of nearly equal numbers whatever their
    distribution, so a round leaves a small share of them.  The driver learns one number a round.
    """
    most = max(most, 6 * len(points) + 2)  # the wanted ranks' own lines and the gaps between them always stay
    ranks = [f((F.col("_total") - 1) * F.lit(p)) for p in points for f in (F.floor, F.ceil)]
    while True:
        counted = written(counted, "quantiles")
        lines = counted.groupBy(*groups).agg(F.count(F.lit(1)).alias("_lines")).agg(F.max("_lines").alias("n")).first().n or 0
        if lines <= most:
            return counted
        edges = counted.groupBy(*groups).agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], 20 * RANGES).alias("_edges"))
        cell = F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(F.size(F.filter("_edges", lambda e: e <= F.col("_v"))))
        placed = join_null_safe(counted, edges, groups).withColumn("_cell", cell)
        sums = placed.groupBy(*groups, "_total", "_cell").agg(F.sum("_n").alias("_n"), F.max("_v").alias("_top"))
        order = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)  # over ranges, not values
        wanted = reduce(or_, [_covers(rank) for rank in ranks])
        judged = sums.withColumn("_through", F.sum("_n").over(order)).withColumn("_wanted", wanted)
        judged = judged.withColumn("_before", F.sum(F.col("_wanted").cast("int")).over(order))
        passed = judged.where(~F.col("_wanted")).groupBy(*groups, "_total", "_before").agg(F.max("_top").alias("_v"), F.sum("_n").alias("_n")).select(
            *groups, "_total", F.lit(True).alias("_gap"), "_v", "_n"
        )
        kept = join_null_safe(placed, judged.where("_wanted").select(*groups, "_cell"), [*groups, "_cell"], "inner")
        counted = kept.select(*groups, "_total", "_gap", "_v", "_n").unionByName(passed)


def _resolved(counted: DataFrame, groups: Sequence[str], points: Sequence[float]) -> DataFrame:
    """The quantiles of each group from its lines ``_v, _gap, _n`` and its ``_total``."""
    ranked = counted.withColumn("_through", _through(groups))

    def at(rank: Column) -> Column:
        covers = _covers(rank) & ~F.col("_gap")
        # A rank the brackets miss is an error, never a silent null.
        return F.coalesce(F.max(F.when(covers, F.col("_v"))), F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy")))

    measures = []
    for i, p in enumerate(points):
        rank = (F.col("_total") - 1) * F.lit(p)
        measures += [at(F.floor(rank)).alias(f"_below{i}"), at(F.ceil(rank)).alias(f"_above{i}"), F.max(rank - F.floor(rank)).alias(f"_part{i}")]
    found = ranked.groupBy(*groups).agg(*measures)
    lines = [
        F.struct(F.lit(p).alias("p"), (F.col(f"_below{i}") + (F.col(f"_above{i}") - F.col(f"_below{i}")) * F.col(f"_part{i}")).alias("quantile"))
        for i, p in enumerate(points)
    ]
    return found.select(*groups, F.explode(F.array(*lines)).alias("_q")).select(*groups, "_q.*")


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float], accuracy: int = 2_000,
    most: int = MOST_VALUES,
) -> DataFrame:
    """Exact interpolated quantiles per group, without gathering a group's values in one place.

    A sketch with bounded memory first brackets each quantile.  A second pass counts what lies below
    a bracket and keeps only the distinct values inside it (some thousandths of the rows) with
    their counts; where these may be more than ``most`` they are narrowed by counting ranges.  Ranks are
    then resolved among ``most`` values at most.
    """
    data = df.select(*groups, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    if not groups:
        data, groups = data.withColumn("_all", F.lit(0)), ["_all"]
    groups, points = list(groups), [float(p) for p in probabilities]
    low_points, high_points = _margins(points, accuracy)
    sketch = written(data.groupBy(*groups).agg(
        F.count("_v").alias("_total"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", low_points + high_points, accuracy).alias("_edges"),
    ), "sketch")
    largest = sketch.agg(F.max("_total")).first()[0] or 0
    # Neighbouring ranks of a small group lie further apart than the margin: keep all of its values.
    small = F.col("_total") <= accuracy

    def bracket(edges: Sequence[float], offset: int, limit: float, extreme: str) -> list[Column]:
        return [
            F.col(extreme) if at == limit else F.when(small, F.col(extreme)).otherwise(F.col("_edges")[offset + i])
            for i, at in enumerate(edges)
        ]

    lows, highs = bracket(low_points, 0, 0.0, "_min"), bracket(high_points, len(points), 1.0, "_max")
    brackets = sketch.select(
        *groups, "_total", *[c.alias(f"_low{i}") for i, c in enumerate(lows)], *[c.alias(f"_high{i}") for i, c in enumerate(highs)]
    )
    gap, filed = _place(F.col("_v"), [(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in range(len(points))])
    # The brackets are one row per group; the optimizer sees their size and broadcasts them if small.
    counted = join_null_safe(data, brackets, groups, "inner").groupBy(*groups, "_total", gap.alias("_gap"), filed.alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if _inside_at_most(largest, len(points), accuracy) > most:
        counted = _narrowed(counted, groups, points, most)
    found = _resolved(counted, groups, points)
    return found.drop("_all")


def _inside_at_most(rows: int, points: int, accuracy: int) -> float:
    """Rows of a group that can lie inside brackets: each spans twice the margin and the sketch's error at both ends."""
    return min(rows, max(accuracy, rows * points * 10.0 / accuracy)) + points + 1


def describe(df: DataFrame, columns: Sequence[str], accuracy: int = 2_000, most: int = MOST_VALUES) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row per column.

    One pass takes all statistics and sketches of all columns side by side, a second counts the values
    inside the brackets.  What the driver holds between them is a few numbers per column.
    """
    points = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    low_points, high_points = _margins(list(points), accuracy)
    doubles = df.select(*[F.col(name).cast("double").alias(f"c{i}") for i, name in enumerate(columns)])
    measures = []
    for i in range(len(columns)):
        value = F.col(f"c{i}")
        known = F.when(~F.isnan(value), value)
        measures += [F.struct(
            F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
            F.max(value).alias("max"), F.count(known).alias("total"), F.min(known).alias("low"), F.max(known).alias("high"),
            F.percentile_approx(known, low_points + high_points, accuracy).alias("edges"),
        ).alias(f"s{i}")]
    stats = doubles.agg(*measures).first()
    entries, basic = [], []
    for i, name in enumerate(columns):
        s = stats[f"s{i}"].asDict()
        edges, value = s.pop("edges"), F.col(f"c{i}")
        basic.append((name, *[s[k] for k in ("count", "mean", "std", "min", "max")], s["total"]))
        if not s["total"]:
            continue
        pairs = [(s["low"], s["high"])] if s["total"] <= accuracy else list(zip(edges[: len(points)], edges[len(points):]))
        gap, filed = _place(value, [(F.lit(low), F.lit(high)) for low, high in pairs])
        entries.append(F.when(value.isNotNull() & ~F.isnan(value), F.struct(
            F.lit(name).alias("column"), F.lit(s["total"]).cast("long").alias("_total"), gap.alias("_gap"), filed.alias("_v")
        )))
    frame = df.sparkSession.createDataFrame(basic, "column string, count long, mean double, std double, min double, max double, total long").drop("total")
    names = list(points.values())
    if not entries:
        return frame.withColumns({name: F.lit(None).cast("double") for name in names}).select("column", "count", "mean", "std", "min", *names, "max")
    placed = doubles.select(F.explode(F.array_compact(F.array(*entries))).alias("r")).select("r.*")
    counted = placed.groupBy("column", "_total", "_gap", "_v").agg(F.count(F.lit(1)).alias("_n"))
    if _inside_at_most(max(b[-1] for b in basic), len(points), accuracy) > most:
        counted = _narrowed(counted, ["column"], list(points), most)
    quartiles = _resolved(counted, ["column"], list(points)).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for p, name in points.items()]
    )
    return frame.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the last bin is closed, empty bins stay."""
    values = df.select(F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    extent = values.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("e"))
    # The extent is one row, used as a scalar in every expression.
    located = values.withColumn("_e", extent.scalar())
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / F.lit(bins)
    bin_no = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("_v") - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    counts = located.groupBy(bin_no.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin")).withColumn("_e", extent.scalar())
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("bin_start"), (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def positive_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Bins over positive values only, as needed before a logarithmic axis."""
    return histogram(df.where(F.col(column) > 0), column, bins)


# --- profiles -----------------------------------------------------------------------------------


def profile(df: DataFrame) -> DataFrame:
    """Type, nulls and exact distinct values of every column, over all rows.

    Rows are turned into (column, value) pairs and counted per pair before the shuffle, so neither a
    frequent value nor a wide table gathers in one task.
    """
    kinds = dict(df.dtypes)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("value")) for name in df.columns
    ])).alias("r")).select("r.*")
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    kind = F.element_at(F.create_map(*[F.lit(x) for item in kinds.items() for x in item]), F.col("column"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    ).withColumn("type", kind)


def mixed_type_check(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """How many values of a text column are numbers, words, or missing."""
    number, words = C.split_mixed(F.col(column))
    return df.groupBy(*by).agg(
        F.count(number).alias("n_numeric"), F.count(words).alias("n_text"),
        F.count_if(F.col(column).isNull()).alias("n_null"),
    )


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of several tables as one frame."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def preview(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*[F.asc_nulls_last(name) for name in order]).limit(rows)
