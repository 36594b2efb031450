"""Versioned tables: immutable loads and builds, published by appending to a ledger.

A bronze load writes ``bronze/<table>/_load=<id>/_source_file=<file>/[<year>=..]`` and a silver build
writes ``silver/<table>/_build=<id>/[<year>=..]``.  Nothing is ever overwritten: readers see exactly
the loads and the build the ledger names, so a failed or repeated job can neither duplicate nor hide
rows, and a check that fails leaves the published version as it was.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructType

from chartmill.config import Layout
from chartmill.schemas import BRONZE, PROVENANCE_DDL, silver_partition, silver_schema
from chartmill.sources.text import SOURCE_FILE

log = logging.getLogger(__name__)

LAYERS = ("bronze", "silver")



class IncompleteLoad(RuntimeError):
    """Source and table disagree; nothing may be built on such a load."""


LOADS_DDL = """table STRING, _source_file STRING, load_id STRING, status STRING, source_rows BIGINT,
    ingested_rows BIGINT, malformed_rows BIGINT, physical_lines BIGINT, row_match BOOLEAN, finished_at TIMESTAMP_NTZ"""
# Which loads went into a build, and the digest of the rules it was made by.
SOURCES_DDL = "table STRING, build_id STRING, load_id STRING, _source_file STRING, rules STRING"
BUILDS_DDL = "table STRING, build_id STRING, schema_json STRING, partition_column STRING, published_at TIMESTAMP_NTZ"


def now_ntz():
    return F.current_timestamp().cast("timestamp_ntz")


def new_id() -> str:
    return uuid.uuid4().hex


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on whatever file system it names?"""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, layout: Layout, name: str, ddl: str) -> DataFrame:
    path = layout.ledger(name)
    if not path_exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def load_history(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Ledger entries of a bronze table; ``is_current`` marks the latest one of each source file."""
    entries = read_ledger(spark, layout, "loads", LOADS_DDL).where(F.col("table") == table)
    newest = Window.partitionBy(SOURCE_FILE).orderBy(F.desc("finished_at"), F.desc("load_id"))
    return entries.withColumn("is_current", F.row_number().over(newest) == 1)


def current_loads(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return load_history(spark, layout, table).where("is_current").drop("is_current")


def require_complete(spark: SparkSession, layout: Layout, table: str, load_id: str | None = None) -> int:
    """Records the current loads of a table hold according to their sources; raises if one is not done.

    With ``load_id`` only that load is looked at.
    """
    loads = current_loads(spark, layout, table)
    loads = loads if load_id is None else loads.where(F.col("load_id") == load_id)
    bad = F.col("status") != "done"
    row = loads.agg(
        F.count_if(bad).alias("n_bad"), F.min(F.when(bad, F.col(SOURCE_FILE))).alias("first_bad"),
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("n_rows"),
    ).first()
    if row.n_bad:
        raise IncompleteLoad(f"bronze.{table}: {row.n_bad} source files do not agree with what was loaded, the first is {row.first_bad}")
    return row.n_rows


def quoted(path: str) -> str:
    """A path as a SQL text literal."""
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_namespaces(spark: SparkSession, layout: Layout, layers: tuple[str, ...] = LAYERS) -> None:
    """One database per layer, located under the layout's root."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION {quoted(f'{layout.root}/_catalog/{layer}')}")


def with_year(df: DataFrame, year_of: tuple[str, str] | None) -> DataFrame:
    """Add the partition column holding the year of a timestamp."""
    if year_of is None:
        return df
    ts, name = year_of
    return df.withColumn(name, F.year(ts))


def rebalanced(df: DataFrame, year_of: tuple[str, str] | None, *folders: str) -> DataFrame:
    """Rows of a year, and of further folders, meet in tasks of even size, so the files of a folder do not grow with the tasks."""
    return df if year_of is None else df.hint("rebalance", *folders, F.col(year_of[1]))


# --- bronze -------------------------------------------------------------------------------------


def write_load(df: DataFrame, layout: Layout, table: str, load_id: str) -> str:
    """Write one load in a single job, laid out by source file and, where declared, by year."""
    year_of = BRONZE[table].year_of
    folders = [SOURCE_FILE] + ([year_of[1]] if year_of else [])
    path = f"{layout.table('bronze', table)}/_load={load_id}"
    rebalanced(with_year(df, year_of), year_of, SOURCE_FILE).write.mode("errorifexists").partitionBy(*folders).parquet(path)
    return path


def read_load(spark: SparkSession, layout: Layout, table: str, load_ids: list[str], *flags: str) -> DataFrame:
    """Rows of the given loads, with the declared columns plus partition columns, and stored flags if asked for."""
    spec = BRONZE[table]
    year = f", {spec.year_of[1]} INT" if spec.year_of else ""
    asked = "".join(f", {name} BOOLEAN" for name in flags)
    ddl = f"{spec.ddl}, {PROVENANCE_DDL}{asked}, _load STRING{year}"
    base = layout.table("bronze", table)
    if not load_ids:
        return spark.createDataFrame([], ddl)
    paths = [f"{base}/_load={load_id}" for load_id in load_ids]
    return spark.read.schema(ddl).option("basePath", base).parquet(*paths)


def scan_bronze(spark: SparkSession, layout: Layout, table: str, accept: tuple[str, ...] = ("done",)) -> DataFrame:
    """Exactly the rows of the current load of each source file.

    The ledger (one short row per loaded file) is read to the driver, so that everything becomes a
    list of folders and a predicate on folder names: no join, and superseded files are never opened.
    """
    history = load_history(spark, layout, table).select(
        "load_id", SOURCE_FILE, (F.col("is_current") & F.col("status").isin(list(accept))).alias("wanted")
    ).collect()
    load_ids = sorted({row.load_id for row in history if row.wanted})
    superseded: dict[str, list[str]] = {}
    for row in history:
        if row.load_id in load_ids and not row.wanted:
            superseded.setdefault(row.load_id, []).append(row[SOURCE_FILE])
    rows = read_load(spark, layout, table, load_ids)
    for load_id, files in superseded.items():
        rows = rows.where(~((F.col("_load") == load_id) & F.col(SOURCE_FILE).isin(files)))
    keep = BRONZE[table].schema.names + ([BRONZE[table].year_of[1]] if BRONZE[table].year_of else [])
    return rows.select(*keep)


# --- silver -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Build:
    """A written but not yet published version of a silver table."""

    table: str
    build_id: str
    path: str


def write_build(df: DataFrame, layout: Layout, table: str) -> Build:
    """Write a full recompute next to the published version; executors write their own partitions."""
    build_id = new_id()
    path = f"{layout.table('silver', table)}/_build={build_id}"
    ordered = df.select(*silver_schema(table).names)
    year_of = silver_partition(table)
    writer = rebalanced(with_year(ordered, year_of), year_of).write.mode("errorifexists")
    if year_of:
        writer = writer.partitionBy(year_of[1])
    writer.parquet(path)
    return Build(table, build_id, path)


def read_build(spark: SparkSession, build: Build) -> DataFrame:
    year_of = silver_partition(build.table)
    schema = StructType(list(silver_schema(build.table).fields))
    if year_of:
        schema = schema.add(year_of[1], IntegerType())
    return spark.read.schema(schema).parquet(build.path)


def create_if_absent(spark: SparkSession, name: str, schema: StructType, path: str, partition: str | None = None) -> bool:
    """Register files as an external table unless the name is taken; the present entry is not examined."""
    if spark.catalog.tableExists(name):
        return False
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folders = ""
    if partition:
        fields += f", `{partition}` int"
        folders = f"PARTITIONED BY (`{partition}`)"
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet {folders} LOCATION {quoted(path)}")
    return True


def ensure_table(spark: SparkSession, layer: str, table: str, schema: StructType, path: str, partition: str | None) -> str:
    """Point the catalog at a version; recreate the entry when schema or partitioning changed.

    Returns what was done.  Only metadata is touched: the table is external.
    """
    name = f"{layer}.{table}"
    if create_if_absent(spark, name, schema, path, partition):
        action = "created"
    else:
        wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        have = [(c.name, c.dataType) for c in spark.catalog.listColumns(name) if not c.isPartition]
        have_partition = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        changed = {"schema": have != wanted, "partitioning": have_partition != ([partition] if partition else [])}
        drift = ", ".join(what for what, differs in changed.items() if differs)
        if drift:
            log.warning("%s: %s differs from the declared one, recreating", name, drift)
            spark.sql(f"DROP TABLE {name}")
            create_if_absent(spark, name, schema, path, partition)
            action = f"recreated: {drift}"
        else:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(path)}")
            action = "relocated"
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return action


def note_sources(spark: SparkSession, layout: Layout, build: Build, rules: str) -> None:
    """Remember what a build was made from; called before it is published, so no published build lacks it."""
    loads = current_loads(spark, layout, build.table).select(
        "table", F.lit(build.build_id).alias("build_id"), "load_id", SOURCE_FILE, F.lit(rules).alias("rules")
    )
    append(loads.coalesce(1), layout.ledger("build_sources"))


def arrivals(spark: SparkSession, layout: Layout, table: str, rules: str) -> tuple[Build, list[tuple[str, str]]] | None:
    """The published build and the (load, file) pairs that came after it.

    None if the build cannot be continued: there is none, a file in it was loaded anew, or its rules
    were others.  Like every look at the ledger this takes one short row per source file.
    """
    build = current_builds(spark, layout).get(table)
    if build is None:
        return None
    noted = read_ledger(spark, layout, "build_sources", SOURCES_DDL).where((F.col("table") == table) & (F.col("build_id") == build.build_id))
    held = {(row.load_id, row[SOURCE_FILE]): row.rules for row in noted.collect()}
    current = {(row.load_id, row[SOURCE_FILE]) for row in current_loads(spark, layout, table).select("load_id", SOURCE_FILE).collect()}
    if not held or set(held) - current or set(held.values()) != {rules}:
        return None
    return build, sorted(current - set(held))


def scan_arrivals(spark: SparkSession, layout: Layout, table: str, new: list[tuple[str, str]]) -> DataFrame:
    """The rows of some (load, file) pairs: only their folders are opened."""
    rows = read_load(spark, layout, table, sorted({load for load, _ in new}))
    files: dict[str, list[str]] = {}
    for load, file in new:
        files.setdefault(load, []).append(file)
    wanted = F.lit(False)
    for load, names in files.items():
        wanted = wanted | ((F.col("_load") == load) & F.col(SOURCE_FILE).isin(names))
    return rows.where(wanted).select(*BRONZE[table].schema.names)


def publish(spark: SparkSession, layout: Layout, build: Build) -> str:
    """Make a checked build the current version of its table."""
    year_of = silver_partition(build.table)
    partition = year_of[1] if year_of else None
    entry = [(build.table, build.build_id, silver_schema(build.table).json(), partition)]
    row = spark.createDataFrame(entry, "table STRING, build_id STRING, schema_json STRING, partition_column STRING")
    append(row.withColumn("published_at", now_ntz()).coalesce(1), layout.ledger("builds"))
    return ensure_table(spark, "silver", build.table, silver_schema(build.table), build.path, partition)


def current_builds(spark: SparkSession, layout: Layout) -> dict[str, Build]:
    """The published build of each silver table (one ledger row per table)."""
    entries = read_ledger(spark, layout, "builds", BUILDS_DDL)
    newest = entries.groupBy("table").agg(F.max_by("build_id", F.struct("published_at", "build_id")).alias("build_id"))
    return {
        row.table: Build(row.table, row.build_id, f"{layout.table('silver', row.table)}/_build={row.build_id}")
        for row in newest.collect()
    }


def scan_silver(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Exactly the files of the published version."""
    builds = current_builds(spark, layout)
    if table not in builds:
        raise LookupError(f"silver table {table} is not built")
    return read_build(spark, builds[table])


def attach(spark: SparkSession, layout: Layout) -> list[str]:
    """Register every published silver table in the catalog of a new session."""
    ensure_namespaces(spark, layout)
    names = []
    for table, build in sorted(current_builds(spark, layout).items()):
        year_of = silver_partition(table)
        ensure_table(spark, "silver", table, silver_schema(table), build.path, year_of[1] if year_of else None)
        names.append(f"silver.{table}")
    return names
