"""A look at raw exports before anything is loaded: columns, parts, values of mixed type.  All rows are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartmill.config import CleaningRules
from chartmill.operators import aggregate, clean
from chartmill.schemas import BRONZE
from chartmill.sources import text

NOTE = "table STRING, about STRING, measure STRING, value STRING"


def audit(spark: SparkSession, source_dir: str, rules: CleaningRules = CleaningRules(), tables: tuple[str, ...] = tuple(BRONZE)) -> DataFrame:
    """Findings about each table's export as (table, about, measure, value).

    Per column the nulls and distinct values, per part its rows and bytes, and for a column of mixed
    type how many values are numbers, words and missing.
    """
    found = [_notes(spark, table, f"{source_dir}/{BRONZE[table].source}", rules) for table in tables]
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], NOTE))


def _long(df: DataFrame, table: str, about: str) -> DataFrame:
    measures = [name for name in df.columns if name != about]
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).cast("string").alias("value")) for name in measures]))
    return df.select(F.lit(table).alias("table"), F.col(about).alias("about"), pairs.alias("_m")).select("table", "about", "_m.*")


def _notes(spark: SparkSession, table: str, paths: str, rules: CleaningRules) -> DataFrame:
    spec = BRONZE[table]
    raw = text.read_csv_parts(spark, paths).drop(text.CORRUPT, text.SOURCE_FILE)
    raw = clean.null_out_tokens(raw, rules.null_tokens)
    notes = [
        _long(aggregate.profile(raw).drop("type"), table, "column"),
        _long(text.part_stats(spark, paths).select(text.SOURCE_FILE, "rows", "bytes"), table, text.SOURCE_FILE),
    ]
    if spec.split_value:
        mixed = aggregate.mixed_type_check(raw, spec.split_value)
        notes.append(_long(mixed.withColumn("column", F.lit(spec.split_value)), table, "column"))
    return reduce(DataFrame.unionByName, notes)
