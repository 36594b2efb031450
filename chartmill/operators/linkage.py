"""Links between tables: orphans, coverage, repaired ids, attributes, as-of and interval lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartmill.functions.columns import epoch_micros, flag_pattern
from chartmill.operators import timeline
from chartmill.operators.skew import any_null, hot_keys, join_attributes


def _key_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key: joins on keys start from this, so a frequent key is one row."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def orphan_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of left with no match in right, and the rows they carry."""
    return _key_counts(left, key, "n_rows").join(right.select(key).distinct(), key, "left_anti")


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys and rows of left find a match in right."""
    there = right.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_match", F.lit(True))
    joined = _key_counts(left, key).join(there, key, "left")
    matched = F.count("_match")
    return joined.agg(
        F.count(F.lit(1)).alias("n_keys"),
        matched.alias("matched_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_match"), F.col("n"))), F.lit(0)).alias("matched_rows"),
        (matched * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("matched_percent"),
    )


def entity_footprint(pairs: DataFrame, tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows each table holds for the given key tuples; zero everywhere marks a phantom.

    Rows with other keys are left behind before anything is counted.
    """
    keys = list(keys)
    wanted = pairs.select(*keys).distinct()
    tagged = None
    for name, df in tables.items():
        counts = df.select(*keys).join(wanted, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_table", F.lit(name))
        tagged = counts if tagged is None else tagged.unionByName(counts)
    spread = tagged.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("_table") == name, F.col("_n"))).alias(name) for name in tables]
    )
    filled = wanted.join(spread, keys, "left").fillna(0, list(tables))
    total = F.lit(0)
    for name in tables:
        total = total + F.col(name)
    return filled.withColumn("total_rows", total.cast("bigint")).withColumn("is_phantom", F.col("total_rows") == 0)


def subset_copy(facts: DataFrame, pairs: DataFrame, entity: str, fact: Sequence[str], a: str = "a", b: str = "b") -> DataFrame:
    """For each (a, b): is the set of a's facts contained in b's, and strictly?

    Facts are matched on (entity, fact), so an entity with very many facts spreads by fact.
    """
    fact = list(fact)
    known = facts.select(entity, *fact).distinct()
    size = known.groupBy(entity).agg(F.count(F.lit(1)).alias("_size"))
    pairs = pairs.select(a, b).distinct()
    known_a = known.withColumnRenamed(entity, a)
    of_a = join_attributes(known_a, pairs, [a], "inner", hot_keys(known_a, [a]))
    in_b = known.withColumnRenamed(entity, b).withColumn("_shared", F.lit(1))
    on = [of_a[b] == in_b[b]] + [of_a[name].eqNullSafe(in_b[name]) for name in fact]
    matched = of_a.join(in_b, on, "left").select(of_a[a], of_a[b], "_shared")
    shared = matched.groupBy(a, b).agg(F.count(F.lit(1)).alias("facts_a"), F.count("_shared").alias("facts_shared"))
    sized = pairs.join(shared, [a, b], "left").join(size.withColumnRenamed(entity, b), b, "left")
    out = sized.select(
        a, b, *[F.coalesce(name, F.lit(0)).alias(name) for name in ("facts_a", "facts_shared")],
        F.coalesce("_size", F.lit(0)).alias("facts_b"),
    )
    subset = (F.col("facts_shared") == F.col("facts_a")) & (F.col("facts_a") > 0)
    return out.withColumn("is_subset", subset).withColumn(
        "is_strict_subset", subset & (F.col("facts_b") > F.col("facts_a"))
    )


def magnitude_buckets(number: Column, digits: Column) -> Column:
    """A whole number's digits as ``<mantissa of so many digits>e<exponent>``, rounded half up, in every way it is written.

    Worked out on the text, so that ids beyond the precision of a double keep every digit.  Where rounding
    carries into a new digit, some writers move the exponent (9996 is 1.00E+04) and some do not (10.00E+03).
    """
    text = F.regexp_replace(number, "^0+", "")
    kept = F.rpad(F.substring(text, F.lit(1), digits), digits, F.lit("0")).cast("decimal(38,0)")
    upwards = F.coalesce(F.substring(text, digits + 1, F.lit(1)) >= "5", F.lit(False))
    mantissa = F.when(upwards, kept + 1).otherwise(kept).cast("string")
    carried = F.length(mantissa) > digits
    exponent = F.length(text) - F.when(carried, 0).otherwise(1)
    moved = F.when(text != "", F.concat_ws("e", F.substring(mantissa, F.lit(1), digits), exponent.cast("string")))
    return F.when(carried, F.array(moved, F.concat_ws("e", mantissa, (exponent - 1).cast("string")))).otherwise(F.array(moved))


def mangled_bucket(text: Column) -> Column:
    """The same for an id already written in scientific notation, at its own precision."""
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^([0-9.]+)[Ee]", 1), r"\.", "")
    exponent = F.regexp_extract(text, r"[Ee]\+?(-?[0-9]+)$", 1).try_cast("int")
    return F.concat_ws("e", mantissa, exponent.cast("string"))


def mangled_digits(text: Column) -> Column:
    """To how many digits a mangled id was rounded: in ``10.00E+07`` the first two are one that carried."""
    shown = F.length(F.split(mangled_bucket(text), "e")[0])
    return F.when(text.rlike(r"^10\.?0*[Ee]"), shown - 1).otherwise(shown)


def repair_ids(df: DataFrame, column: str, lookup: DataFrame, full_id: str) -> DataFrame:
    """Replace ids mangled into scientific notation by full decimal ids, only where one full id fits.

    Each full id is entered once per number of mantissa digits that some mangled form has, and the lookup is reduced to one row per such bucket before the join.  A bucket with several full ids is
    ambiguous and never used, because a false merge of two entities leaves no trace.
    """
    full = lookup.where(F.col(full_id).rlike(r"^[0-9]+$")).select(F.col(full_id).alias("_id")).distinct()
    damaged = F.coalesce(flag_pattern(F.col(column)), F.lit(False))
    in_use = df.where(damaged).agg(F.collect_set(mangled_digits(F.col(column))).alias("_in_use")).scalar()
    rendered = full.withColumn("_digits", F.explode(in_use))
    unique = (
        rendered.withColumn("_bucket", F.explode(magnitude_buckets(F.col("_id"), F.col("_digits"))))
        .withColumn("_bucket", F.concat_ws(":", F.col("_digits").cast("string"), "_bucket"))
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_candidates"), F.min("_id").alias("_full"))
    )
    bucket = mangled_bucket(F.col(column))
    mangled = df.where(damaged).select(column).distinct().withColumn(
        "_bucket", F.concat_ws(":", mangled_digits(F.col(column)).cast("string"), bucket)
    )
    fixes = mangled.join(unique, "_bucket", "left").select(
        column, "_full", F.coalesce("_candidates", F.lit(0)).alias("_candidates")
    )
    broken = df.where(damaged)
    repaired = join_attributes(broken, fixes, [column], "left", hot_keys(broken, [column]))
    status = (
        F.when(F.col("_candidates") == 1, "repaired").when(F.col("_candidates") == 0, "unmatched").otherwise("ambiguous")
    )
    fixed = repaired.select(
        *df.columns, F.when(F.col("_candidates") == 1, F.col("_full")).alias("repaired_id"), status.alias("repair_status")
    )
    intact = df.where(~damaged).select(
        *df.columns, F.col(column).alias("repaired_id"), F.lit("intact").alias("repair_status")
    )
    return intact.unionByName(fixed)


def attach_attributes(
    facts: DataFrame, encounters: DataFrame, key: str, attributes: Sequence[str],
    not_unique: Column | None = None, hot: DataFrame | None = None,
) -> DataFrame:
    """Bring encounter attributes to facts by key.

    Encounters flagged as not unique on the key are left out of the lookup, and so is any key that
    several of the others still share: a fact is never multiplied, and where the encounter is not
    certain its attributes are null.  ``hot`` may name hot keys of the facts to be salted.
    """
    usable = encounters if not_unique is None else encounters.where(~not_unique)
    rows = usable.select(key, *attributes).groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(name).alias(name) for name in attributes]
    )
    return join_attributes(facts, rows.where("_rows = 1").drop("_rows"), [key], "left", hot)


def as_of(
    refs: DataFrame, series: DataFrame, keys: Sequence[str], ref_time: str, ts: str, value: str, name: str,
    strictly_before: bool = True, **cutting,
) -> DataFrame:
    """For each reference row the last measure before (or at) its time.

    Both sides are merged into one timeline and the latest value is carried along it.  No pair of
    reference and measure is ever formed, whatever their number per entity.  Of several measures at
    the same instant the largest counts.  A reference without a key or a time finds nothing.
    """
    keys = list(keys)
    rank = 0 if strictly_before else 2
    unknown = any_null(keys)
    left = refs.where(~unknown).select(
        *keys, F.col(ref_time).alias("_t"), F.lit(rank).alias("_side"), F.lit(None).cast(dict(series.dtypes)[value]).alias("_value"),
        F.struct(*[F.col(c) for c in refs.columns]).alias("_row"),
    )
    right = series.where(~unknown & F.col(value).isNotNull() & F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.col(value).alias("_value"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
    )
    merged = left.unionByName(right)
    known = timeline.last_known(merged, keys, ["_t", "_side", "_value"], "_value", "_asof", **cutting)
    found = known.where(F.col("_row").isNotNull()).select(
        "_row.*", F.when(F.col("_t").isNotNull(), F.col("_asof")).alias(name)
    )
    return found.unionByName(refs.where(unknown).withColumn(name, F.lit(None).cast(dict(series.dtypes)[value])))


def interval_join(
    facts: DataFrame, intervals: DataFrame, key: str, ts: str, start: str, stop: str, slice_seconds: int = timeline.DAY
) -> DataFrame:
    """Facts lying inside [start, stop] of an interval of the same key.

    Both sides are cut into time slices and joined on (key, slice): a key with very many facts is
    spread over its slices, and a fact only meets intervals that touch its slice.  Slices come in
    levels, each four times as long as the one below; an interval uses the lowest level on which it
    touches two slices at most, however long it is, and a fact is entered on each level in use.
    """
    step = slice_seconds * 1_000_000
    length = epoch_micros(F.col(stop)) - epoch_micros(F.col(start))
    level = F.greatest(F.ceil(F.log(4.0, F.greatest(length, F.lit(1)) / step)), F.lit(0)).cast("int")

    def slice_at(time: str) -> Column:
        return F.floor(epoch_micros(F.col(time)) / (F.lit(step) * F.pow(F.lit(4.0), F.col("_level"))))

    valid = F.col(start).isNotNull() & F.col(stop).isNotNull() & (F.col(start) <= F.col(stop))
    leveled = intervals.where(valid).withColumn("_level", level)
    in_use = leveled.agg(F.collect_set("_level").alias("levels")).scalar()
    pieces = leveled.withColumn("_slice", F.explode(F.sequence(slice_at(start), slice_at(stop))))
    entered = facts.where(F.col(ts).isNotNull()).withColumn("_level", F.explode(in_use)).withColumn("_slice", slice_at(ts))
    met = entered.join(pieces, [key, "_level", "_slice"])
    return met.where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(stop))).drop("_slice", "_level")


def linkage_stats(encounters: DataFrame, entity: str, encounter: str) -> DataFrame:
    """Encounters per entity: mean, maximum, share of entities and encounters that are repeated."""
    pairs = encounters.where(F.col(entity).isNotNull()).groupBy(entity, encounter).agg(F.count(F.lit(1)).alias("_n"))
    per_entity = pairs.groupBy(entity).agg(F.count(encounter).alias("n"))
    repeat = F.col("n") > 1
    return per_entity.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("n").alias("n_encounters"),
        F.avg("n").alias("mean_encounters"),
        F.max("n").alias("max_encounters"),
        F.count_if(repeat).alias("repeat_entities"),
        (F.count_if(repeat) / F.count(F.lit(1))).alias("repeat_share"),
        F.sum(F.when(repeat, F.col("n")).otherwise(0)).alias("encounters_of_repeat"),
    )


def split_bucket(entity: Column, buckets: int = 100) -> Column:
    """A stable bucket of an entity, the same on every engine: first 8 hex digits of its MD5."""
    digits = F.conv(F.substring(F.md5(entity.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digits, F.lit(buckets))


def grouped_split(df: DataFrame, entity: str, test_percent: int = 20, exclude: Column | None = None) -> DataFrame:
    """Assign whole entities to train or test; rows whose entity cannot be trusted go to ``excluded``."""
    bucket = split_bucket(F.col(entity))
    side = F.when(bucket < test_percent, "test").otherwise("train")
    untrusted = F.col(entity).isNull() if exclude is None else (F.col(entity).isNull() | exclude)
    return df.withColumn("split", F.when(untrusted, "excluded").otherwise(side))


