"""Joins of a fact table with one-row-per-key attributes when a few keys hold much of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

# A key below this many rows fits one task without trouble; a hot key is split into parts of this size.
HOT_KEY_ROWS = 1_000_000

PARTS = "_parts"
ANY_SALT = 2**30


def heaviest(counts: DataFrame, keys: Sequence[str], n: str, min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The keys of a key-count frame above ``min_rows``, and into how many parts each should be split."""
    return counts.where(F.col(n) > min_rows).select(*keys, F.ceil(F.col(n) / min_rows).cast("int").alias(PARTS))


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Find hot keys: one pass over the key columns only, counted before the shuffle."""
    return heaviest(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, "_n", min_rows)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(key).isNull() for key in keys])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys of the same name, a null key being equal to another."""
    theirs = {key: f"_right_{key}" for key in keys}
    on = reduce(and_, [F.col(key).eqNullSafe(F.col(theirs[key])) for key in keys])
    return left.join(right.withColumnsRenamed(theirs), on, how).drop(*theirs.values())


def join_attributes(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """Join facts with a lookup that has one row per key (``how``: inner or left).

    Facts of a hot key get one of several salts, in proportion to their number, and the lookup row of
    that key is repeated for each, so the key is joined by many tasks.  The salt mixes the row's
    content with the number of its input partition: exact copies spread too, and a recomputed task
    assigns the same salts again.  Facts without a key match nothing and spread over any number of
    tasks.  Without ``hot`` this is a plain join, which adaptive execution splits where it is skewed.
    """
    keys = list(keys)
    if hot is None:
        return facts.join(lookup, keys, how)
    marks = hot.select(*keys, PARTS)
    spread = F.xxhash64(*facts.columns) + F.spark_partition_id()
    parts = F.when(any_null(keys), F.lit(ANY_SALT)).otherwise(F.coalesce(PARTS, F.lit(1)))
    salted_facts = facts.join(marks, keys, "left").withColumn("_salt", F.pmod(spread, parts).cast("int")).drop(PARTS)
    repeats = F.sequence(F.lit(0), F.coalesce(PARTS, F.lit(1)) - 1)
    salted_lookup = lookup.join(marks, keys, "left").withColumn("_salt", F.explode(repeats)).drop(PARTS)
    return salted_facts.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")
