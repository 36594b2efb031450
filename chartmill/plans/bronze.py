"""CSV exports to bronze tables: typed, with provenance, resumable per source file."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chartmill.config import CleaningRules, Layout
from chartmill.operators import clean
from chartmill.schemas import BRONZE
from chartmill.sources import store, text

log = logging.getLogger(__name__)

# Small tables first, the largest last.
ORDER = tuple(BRONZE)


def to_bronze(raw: DataFrame, table: str, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Turn text columns into the declared bronze schema, followed by the flag of malformed records if there is one."""
    spec = BRONZE[table]
    df = clean.drop_if_present(clean.rename(raw, spec.rename), spec.drop)
    marks = [name for name in (text.SOURCE_FILE, text.MALFORMED) if name in df.columns]
    texts = [name for name in df.columns if name not in marks]
    kept = clean.null_out_tokens(df.select(*[F.col(f"`{name}`") for name in [*texts, *marks]]), rules.null_tokens)
    if spec.split_value and spec.split_value in kept.columns:
        kept = clean.split_mixed_value(kept, spec.split_value)
    typed = clean.coerce_to_schema(kept, spec.columns, rules.timestamp_formats)
    flag = [T.StructField(text.MALFORMED, T.BooleanType())] if text.MALFORMED in marks else []
    return clean.conform(clean.stamp_provenance(typed), T.StructType([*spec.schema.fields, *flag]))


def pending_parts(spark: SparkSession, layout: Layout, table: str, paths: str | list[str]) -> list[tuple[str, str]]:
    """(name, path) of the source files not yet loaded completely, in the order of their numbers.

    Only names are read to the driver: one row per source file.
    """
    done = store.current_loads(spark, layout, table).where(F.col("status") == "done").select(
        F.col(text.SOURCE_FILE).alias("listed_name")
    )
    waiting = text.list_parts(spark, paths).join(done, "listed_name", "left_anti")
    rows = waiting.orderBy(F.asc_nulls_first("part_number"), "listed_name").collect()
    return [(row.listed_name, row.listed_path) for row in rows]


def load_parts(
    spark: SparkSession, layout: Layout, table: str, parts: list[tuple[str, str]], rules: CleaningRules = CleaningRules()
) -> str:
    """Load a batch of source files as one job and record the outcome of each in the ledger.

    A file in which no line leaves a quote open is split among tasks; any other is parsed as a whole,
    since its records may span lines.  Raises :class:`store.IncompleteLoad` if the records of a file
    and the rows stored from it differ in number, or a record has the wrong number of fields.
    """
    paths = [path for _, path in parts]
    load_id = store.new_id()
    lines = text.line_stats(spark, paths).collect()  # one row per file of the batch
    torn = {row[text.SOURCE_FILE] for row in lines if row.torn_lines}
    raw = reduce(DataFrame.unionByName, [
        text.read_csv_parts(spark, some, multi_line)
        for multi_line in (False, True) if (some := [path for name, path in parts if (name in torn) == multi_line])
    ])
    store.write_load(to_bronze(text.flag_malformed(raw), table, rules), layout, table, load_id)

    # Per file: records of the source, rows now stored, physical lines.  Where a record is a line, the
    # records are counted apart from the CSV reader; else they are what it stored.  Of the rows stored
    # only the flag is read.
    stored = store.read_load(spark, layout, table, [load_id], text.MALFORMED).groupBy(text.SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("ingested_rows"), F.count_if(text.MALFORMED).alias("malformed_rows")
    )
    known = [(row[text.SOURCE_FILE], row.physical_lines, None if row.torn_lines else row.filled_lines) for row in lines]
    counted = spark.createDataFrame([(name, True) for name, _ in parts], f"{text.SOURCE_FILE} STRING, listed BOOLEAN")
    for counts in (
        stored, spark.createDataFrame(known, f"{text.SOURCE_FILE} STRING, physical_lines BIGINT, filled_lines BIGINT")
    ):
        counted = counted.unionByName(counts, allowMissingColumns=True)
    counted = counted.groupBy(text.SOURCE_FILE).agg(
        F.coalesce(F.max("listed"), F.lit(False)).alias("listed"), F.max("physical_lines").alias("physical_lines"),
        F.coalesce(F.max("filled_lines"), F.max("ingested_rows"), F.lit(0)).alias("source_rows"),
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in ("ingested_rows", "malformed_rows")],
    )
    match = F.col("listed") & (F.col("source_rows") == F.col("ingested_rows")) & (F.col("malformed_rows") == 0)
    entries = counted.select(
        F.lit(table).alias("table"), text.SOURCE_FILE, F.lit(load_id).alias("load_id"),
        F.when(match, "done").otherwise("mismatch").alias("status"),
        "source_rows", "ingested_rows", "malformed_rows", "physical_lines", match.alias("row_match"), store.now_ntz().alias("finished_at"),
    )
    store.append(entries.coalesce(1), layout.ledger("loads"))
    store.require_complete(spark, layout, table, load_id)
    return load_id


def ingest(
    spark: SparkSession, layout: Layout, table: str, paths: str | list[str], rules: CleaningRules = CleaningRules(),
    batch_files: int = 1000,
) -> int:
    """Load every source file not yet done; returns how many were loaded.  A rerun adds nothing."""
    waiting = pending_parts(spark, layout, table, paths)
    if not waiting:
        log.info("%s: every source file is loaded", table)
    for at in range(0, len(waiting), batch_files):
        load_parts(spark, layout, table, waiting[at:at + batch_files], rules)
    return len(waiting)


def ingest_all(
    spark: SparkSession, layout: Layout, source_dir: str, rules: CleaningRules = CleaningRules(),
    tables: tuple[str, ...] = ORDER,
) -> dict[str, int]:
    """Load the chosen tables in fixed order and stop at the first failure."""
    store.ensure_namespaces(spark, layout)
    loaded = {}
    for table in tables:
        spark.sparkContext.setJobGroup(f"bronze.{table}", f"load bronze.{table}")
        loaded[table] = ingest(spark, layout, table, f"{source_dir}/{BRONZE[table].source}", rules)
    return loaded
