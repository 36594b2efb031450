"""Independent re-check of the published silver layer: nothing is taken over from the build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartmill.config import CleaningRules, Layout
from chartmill.operators import quality
from chartmill.plans.silver import BUILDERS, build_rules
from chartmill.schemas import silver_partition
from chartmill.sources import store


def expect_partitioning(df: DataFrame, table: str) -> DataFrame:
    """The published files are laid out by the year column the table declares."""
    year_of = silver_partition(table)
    rule = "partitioned by year" if year_of else "not partitioned"
    years = [] if year_of is None else [name for name, kind in df.dtypes if name == year_of[1] and kind == "int"]
    # Counted on the executors, one row comes back: files grow with the table.
    outside = 0 if year_of is None else df.select(F.input_file_name().alias("f")).where(~F.col("f").contains(f"/{year_of[1]}=")).limit(1).count()
    ok = not outside and (year_of is None or len(years) == 1)
    return quality.outcome(df.sparkSession, table, rule, "PASS" if ok else "FAIL", ",".join(years) or "none")


def verify_layer(
    spark: SparkSession, layout: Layout, rules: CleaningRules = CleaningRules(), tables: tuple[str, ...] = tuple(BUILDERS),
    extra: dict[str, list[quality.Rule]] | None = None,
) -> DataFrame:
    """Every rule of every table as rows (table_name, rule, status, detail); unbuilt tables are skipped."""
    built = store.current_builds(spark, layout)
    results = []
    for table in tables:
        if table not in built:
            results.append(quality.outcome(spark, table, "built", "SKIP", "not built yet"))
            continue
        bronze_rows = store.scan_bronze(spark, layout, table, accept=("done", "mismatch")).count()
        loads = store.current_loads(spark, layout, table).agg(
            F.count_if(F.col("status") != "done").alias("n_bad"), F.coalesce(F.sum("source_rows"), F.lit(0)).alias("n_rows")
        ).first()
        complete = loads.n_bad == 0 and loads.n_rows == bronze_rows
        detail = f"{loads.n_bad} files not done, {loads.n_rows} source rows, {bronze_rows} stored"
        results.append(quality.outcome(spark, table, "every source row is stored", "PASS" if complete else "FAIL", detail))
        silver = store.read_build(spark, built[table])
        checks = build_rules(table, bronze_rows, rules) + (extra or {}).get(table, [])
        results.append(quality.evaluate(silver, table, checks))
        results.append(expect_partitioning(silver, table))
    return reduce(DataFrame.unionByName, results)


def failed(results: DataFrame) -> bool:
    return not results.where("status = 'FAIL'").isEmpty()
