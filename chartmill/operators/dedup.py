"""De-duplication that keeps multiplicity, and audits of duplicates.

Every grouping here combines rows before they are shuffled and keeps constant state per key, so one
key holding a large share of the rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.functions.columns import apart, differs, extremes
from chartmill.operators import timeline
from chartmill.operators.skew import any_null, join_null_safe

COUNT = "n_occurrences"


def collapse_count(df: DataFrame, keys: Sequence[str] | None = None, name: str = COUNT) -> DataFrame:
    """One row per distinct key tuple, nulls grouping together, with the number of rows behind it."""
    return df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias(name))


def collapse_collect(df: DataFrame, keys: Sequence[str], varying: str, list_name: str, flag: str) -> DataFrame:
    """Like collapse_count, with the sorted distinct values of one varying category.

    A null value is kept as the last list element; the flag counts non-null values only.  Rows first
    collapse by hash on the whole tuple; only one row per category is left for the list, which is
    bounded by the number of categories.
    """
    counted = df.groupBy(*keys, varying).agg(F.count(F.lit(1)).alias("_n"))
    grouped = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(varying)).alias("_values"),
        F.max(F.col(varying).isNull()).alias("_null_seen"),
        F.sum("_n").alias(COUNT),
    )
    null_element = F.array(F.lit(None).cast(dict(df.dtypes)[varying]))
    listed = F.when(F.col("_null_seen"), F.concat("_values", null_element)).otherwise(F.col("_values"))
    return grouped.select(*keys, listed.alias(list_name), (F.size("_values") > 1).alias(flag), COUNT)


def merge_counts(published: DataFrame, arrived: DataFrame, keys: Sequence[str], lists: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Two collapsed frames as one: what collapsing the rows behind both would give.

    Counts of a key add up.  ``lists`` names the list columns of :func:`collapse_collect` with their flags:
    lists are united, a null staying last, and the flag follows from the united list.
    """
    both = published.unionByName(arrived)
    merged = both.groupBy(*keys).agg(
        F.sum(COUNT).alias(COUNT), *[F.array_distinct(F.flatten(F.collect_list(name))).alias(name) for name, _ in lists]
    )
    for name, flag in lists:
        known = F.sort_array(F.array_compact(name))
        missing = F.filter(name, lambda value: value.isNull())
        merged = merged.withColumn(flag, F.size(known) > 1).withColumn(name, F.concat(known, missing))
    return merged.select(*published.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group in a total order, nulls last; what the order leaves open the other columns decide.

    Asking for the first of a numbering lets every task drop all but one row of a group before the shuffle,
    so a group of any size arrives as one row per task.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    first = Window.partitionBy(*keys).orderBy(*[F.col(name).asc_nulls_last() for name in [*order, *rest]])
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def classify_duplicates(df: DataFrame, keys: Sequence[str], entity: str, attributes: Sequence[str]) -> DataFrame:
    """Resolve rows sharing a key that should be unique.

    Exact copies collapse first.  Then, for a key with several rows:

    * several entities with different attributes: a collision, all kept and flagged;
    * several entities with equal attributes: one entity written in several ways, the first is kept
      and carries the multiplicity of all;
    * one entity (or none known) with different attributes: a real conflict, all kept and flagged.

    The table is read and collapsed once.  "More than one value" is decided over the collapsed rows by the
    smallest and the largest of two 64-bit hashes, which is constant state of fixed width per key.  Only
    the keys that turn out to be ambiguous meet the collapsed rows again, and only among the rows of
    an entity written in several ways is the first one looked for.  Adaptive execution splits a hot key.
    """
    keys = list(keys)
    rows = collapse_count(df, [*keys, entity, *attributes])
    several, alike = extremes([entity], F.col(entity).isNotNull()), extremes(attributes)
    per_key = rows.groupBy(*keys).agg(
        F.sum(COUNT).alias("_total"), F.sum(F.when(F.col(entity).isNotNull(), F.col(COUNT))).alias("_known"),
        *[c.alias(f"_e{i}") for i, c in enumerate(several)], *[c.alias(f"_a{i}") for i, c in enumerate(alike)],
    )
    several_entities, facts_differ = apart("_e", len(several)), apart("_a", len(alike))
    some_unknown = (F.col("_known") > 0) & (F.col("_known") < F.col("_total"))
    # A missing key is no key: its rows stay as they are.
    kind = F.when(any_null(keys), F.lit(None)).when(several_entities & facts_differ, "collision").when(several_entities, "same").otherwise("conflict")
    ambiguous = per_key.where(several_entities | some_unknown | facts_differ).select(*keys, "_total", kind.alias("_class"))
    # Null-safe joins, and conditions on the class alone, leave all uses of the collapsed rows alike, so that they are made once.
    tagged = join_null_safe(rows, ambiguous, keys)
    kept = tagged.where(F.coalesce(F.col("_class") != "same", F.lit(True)))
    first = keep_first(tagged.where("_class = 'same'"), keys, [entity]).withColumn(COUNT, F.col("_total"))
    return kept.unionByName(first).select(
        *keys, entity, *attributes,
        F.coalesce(F.col("_class") == "collision", F.lit(False)).alias("is_collision"),
        F.coalesce(F.col("_class") == "conflict", F.lit(False)).alias("is_conflict"), COUNT,
    )


# --- audits -------------------------------------------------------------------------------------


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many groups there are of each size."""
    return collapse_count(df, keys, "group_size").groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"))


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows in groups larger than one, such groups, their largest and median size.

    The median is taken over the histogram of sizes, which is short whatever the number of groups.
    """
    sizes = group_sizes(df, keys)
    larger = F.col("group_size") > 1
    weight = F.when(larger, F.col("n_groups")).otherwise(F.lit(0))
    return sizes.agg(
        F.sum(F.col("group_size") * F.col("n_groups")).alias("n_rows"),
        F.sum("n_groups").alias("n_groups"),
        F.sum(F.col("group_size") * weight).alias("rows_in_duplicates"),
        F.sum(weight).alias("duplicate_groups"),
        F.max(F.when(larger, F.col("group_size"))).alias("max_group"),
        F.percentile(F.when(larger, F.col("group_size")), F.lit(0.5), weight).alias("median_group"),
    )


def key_divergence(df: DataFrame, narrow: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    """Would a narrow key merge rows that differ?  One row per ignored column and one for any of them."""
    flags = {name: F.max(F.col(f"_{name}").cast("int")) for name in ignored}
    kinds = dict(df.dtypes)
    groups = df.groupBy(*narrow).agg(
        F.count(F.lit(1)).alias("_n"), *[differs(name, kinds[name]).alias(f"_{name}") for name in ignored]
    ).where("_n > 1")
    any_of = F.greatest(*[F.col(f"_{name}") for name in ignored]) if len(flags) > 1 else F.col(f"_{ignored[0]}")
    totals = groups.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(any_of).alias("any"),
        *[F.count_if(f"_{name}").alias(f"d_{name}") for name in ignored],
    )
    lines = [F.struct(F.lit(name).alias("column"), F.col(f"d_{name}").alias("diverging_groups"), "groups") for name in ignored]
    lines.append(F.struct(F.lit("any").alias("column"), F.col("any").alias("diverging_groups"), "groups"))
    return totals.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def merge_impact(df: DataFrame, keys: Sequence[str], cleaned: Mapping[str, Column]) -> DataFrame:
    """Distinct full keys before and after a cleaning step, and how many keys it merges.

    Counting each column on its own would overstate merges: only the full tuple decides.
    """
    before = collapse_count(df, keys, "_n")
    renamed = before.select("_n", *[cleaned.get(name, F.col(name)).alias(name) for name in keys])
    after = renamed.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_variants"))
    return after.agg(
        F.sum("_n").alias("n_rows"),
        F.sum("_variants").alias("keys_before"),
        F.count(F.lit(1)).alias("keys_after"),
        F.sum(F.col("_variants") - 1).alias("keys_merged"),
    )


def pairing_report(df: DataFrame, keys: Sequence[str], varying: str) -> DataFrame:
    """Which categories occur together within collapsed groups, and how often."""
    lists = collapse_collect(df, keys, varying, "categories", "several").where("several")
    return lists.groupBy("categories").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum(COUNT).alias("n_rows")
    )


def duplication_by_category(df: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Share of rows lying in duplicate groups, per category (the category must be part of the key)."""
    groups = collapse_count(df, keys)
    in_groups = F.when(F.col(COUNT) > 1, F.col(COUNT)).otherwise(F.lit(0))
    return groups.groupBy(category).agg(
        F.sum(COUNT).alias("n_rows"),
        F.sum(in_groups).alias("duplicated_rows"),
        (F.sum(in_groups) / F.sum(COUNT)).alias("duplicated_share"),
    )


def duplicate_blocks(
    df: DataFrame, keys: Sequence[str], label: str, order: Sequence[str], **cutting
) -> DataFrame:
    """Runs of consecutive rows with the same label within a timeline: start, end, length."""
    ts = order[0]
    marked = timeline.runs(df.select(*keys, label, *order), keys, label, order, **cutting)
    return marked.groupBy(*keys, "run", label).agg(
        F.min(ts).alias("block_start"), F.max(ts).alias("block_end"), F.count(F.lit(1)).alias("block_length")
    )


def simultaneous_events(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Moments (key tuples) at which several distinct items were recorded."""
    items = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("_n"))
    return items.groupBy(*keys).agg(
        F.count(item).alias("n_items"), F.sum("_n").alias("n_rows")
    ).where("n_items > 1")


def multiplicity_vs_activity(
    facts: DataFrame, encounters: DataFrame, entity: str, keys: Sequence[str], encounter: str
) -> DataFrame:
    """Duplicate ratio of an entity's facts set against its number of encounters."""
    collapsed = collapse_count(facts, keys)
    per_entity = collapsed.groupBy(entity).agg(
        F.sum(COUNT).alias("_rows"), F.count(F.lit(1)).alias("_distinct")
    )
    activity = encounters.groupBy(entity, encounter).agg(F.lit(1).alias("_one")).groupBy(entity).agg(
        F.count(encounter).alias("n_encounters")
    )
    joined = per_entity.join(activity, entity)
    return joined.groupBy("n_encounters").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("_rows").alias("n_rows"),
        F.sum("_distinct").alias("n_distinct"),
        (F.sum("_rows") / F.sum("_distinct")).alias("duplicate_ratio"),
    )
