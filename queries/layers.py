"""Whole layers: loads, builds, checks and arrivals, over order lines written as a CSV export of results."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from chartmill.config import CleaningRules, Expectation, Layout
from chartmill.operators import dedup, quality
from chartmill.plans import bronze, silver, verify
from chartmill.schemas import BRONZE
from chartmill.session import scratch_dir
from chartmill.sources import scans, store, text
from chartmill.streaming.parts import incremental_parts
from queries.base import query
from queries.silver import _SIMPLE, _counted_sql, _oracle_bronze, borrowed_catalog, bronze_rows

LABS = "patient_labs"
_LABS_SQL = f"SELECT * FROM ({_oracle_bronze(LABS)})"


def dealt(rows, files, exactly):
    """Rows in so many parts, or more unless ``exactly``: those of the scan, so that no row moves, if these are enough."""
    parts = rows.coalesce(files) if exactly else rows
    used = parts.select(F.spark_partition_id().alias("part")).distinct().count()
    return parts if used >= files else rows.repartition(files)


def export(read, spark, layout, files=4, exactly=False):
    """The rows as CSV files in one folder, so many at least; returns the pattern that names them."""
    back = {new: old for old, new in BRONZE[LABS].rename.items()}
    rows = bronze_rows(read, spark, LABS).withColumnsRenamed(back)
    folder = f"{layout.root}/csv"
    dealt(rows, files, exactly).write.option("header", True).option("escape", '"').csv(folder)
    return f"{folder}/*.csv"


@contextmanager
def built(read, spark, rules=CleaningRules()):
    """A lake holding one table, loaded and built; the catalog is left as it was."""
    layout = Layout(scratch_dir(spark, "layer"))
    with borrowed_catalog(spark, layout, LABS):
        bronze.ingest(spark, layout, LABS, export(read, spark, layout), rules)
        silver.build_all(spark, layout, rules, (LABS,))
        yield layout


@query("run_layer", _counted_sql(LABS, *_SIMPLE[LABS]))
def run_layer(read, spark):
    with built(read, spark) as layout:
        return store.scan_silver(spark, layout, LABS).drop(silver.BUILD_STAMP, "collection_year")


@query("update_layer", _counted_sql(LABS, *_SIMPLE[LABS]))
def update_layer(read, spark):
    """Files arriving in three lots: each time only the new ones are read and their counts are added."""
    layout = Layout(scratch_dir(spark, "update"))
    with borrowed_catalog(spark, layout, LABS):
        store.ensure_namespaces(spark, layout)
        pattern = export(read, spark, layout, files=3)
        waiting = bronze.pending_parts(spark, layout, LABS, pattern)
        for lot in filter(None, (waiting[k::3] for k in range(3))):
            bronze.load_parts(spark, layout, LABS, lot)
            silver.update(spark, layout, LABS)
        return store.scan_silver(spark, layout, LABS).drop(silver.BUILD_STAMP, "collection_year")


@query("merge_counts", """
    SELECT l_suppkey, array_to_string(list_sort(array_agg(DISTINCT l_returnflag)), ',') AS flags, count(DISTINCT l_returnflag) > 1 AS several,
           count(*) AS n_occurrences
    FROM lineitem GROUP BY l_suppkey""")
def merge_counts(read, spark):
    """Lists and counts of two halves of the lines, collapsed apart, against those of the whole."""
    lines = read("lineitem")
    halves = [dedup.collapse_collect(lines.where(F.col("l_orderkey") % 2 == k), ["l_suppkey"], "l_returnflag", "flags", "several") for k in (0, 1)]
    merged = dedup.merge_counts(*halves, ["l_suppkey"], [("flags", "several")])
    return merged.withColumn("flags", F.array_join("flags", ","))


@query("stamp_build_time", f"SELECT count(*) AS n_rows, count(*) AS n_stamped, 1 AS n_stamps FROM ({_counted_sql(LABS, *_SIMPLE[LABS])})")
def stamp_build_time(read, spark):
    """Every row of a build carries the one moment it was built."""
    rows = silver.refine(bronze_rows(read, spark, LABS), LABS)
    stamp = F.col(silver.BUILD_STAMP)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(stamp).alias("n_stamped"), F.count_distinct(stamp).cast("int").alias("n_stamps"))


@query("verify_published", f"""
    WITH s AS ({_counted_sql(LABS, *_SIMPLE[LABS])}), n AS (SELECT count(*) AS rows, (SELECT count(*) FROM ({_LABS_SQL})) AS source FROM s)
    SELECT 'rows wrong' AS rule, 'FAIL' AS status FROM n UNION ALL SELECT 'rows right', 'PASS' UNION ALL SELECT 'multiplicity', 'PASS'
    UNION ALL SELECT 'distinct wrong', 'FAIL' UNION ALL SELECT 'every source row is stored', 'PASS' UNION ALL SELECT 'partitioned by year', 'PASS'
    UNION ALL SELECT 'above', 'PASS' UNION ALL SELECT 'not larger', 'PASS'""")
def verify_published(read, spark):
    """The published table against the expectations of a site, some of which it does not meet."""
    n = silver.refine(bronze_rows(read, spark, LABS), LABS).count()
    with built(read, spark) as layout:
        extra = [quality.Rule("rows right", quality.expect_rows(n).measure, quality.expect_rows(n).holds)]
        rules = CleaningRules(expected={LABS: Expectation(rows=n + 1, distinct_key=("LOG_ID", 0), rows_above=0)})
        found = verify.verify_layer(spark, layout, rules, (LABS,), {LABS: extra})
    rule = F.col("rule")
    short = (
        F.when(rule.startswith("rows = "), "rows wrong").when(rule.startswith("distinct"), "distinct wrong")
        .when(rule.startswith("sum("), "multiplicity").when(rule.startswith("rows within"), "above").when(rule.startswith("rows <="), "not larger").otherwise(rule)
    )
    return found.select(short.alias("rule"), "status")


@query("layout_by_year", """
    SELECT 'labs' AS kind, 'PASS' AS status UNION ALL SELECT 'flat copy', 'FAIL' UNION ALL SELECT 'history', 'PASS'""")
def layout_by_year(read, spark):
    """A table laid out by year, the same rows in one folder, and a table that has no year."""
    layout = Layout(scratch_dir(spark, "years"))
    rows = silver.refine(bronze_rows(read, spark, LABS), LABS)
    by_year = store.read_build(spark, store.write_build(rows, layout, LABS))
    flat = f"{layout.root}/flat"
    by_year.write.parquet(flat)
    history = silver.refine(bronze_rows(read, spark, "patient_history"), "patient_history")
    checks = {"labs": (by_year, LABS), "flat copy": (spark.read.parquet(flat), LABS), "history": (history, "patient_history")}
    found = [verify.expect_partitioning(df, table).withColumn("kind", F.lit(kind)) for kind, (df, table) in checks.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("kind", "status")


@query("reconcile_source", f"SELECT count(*) AS source_rows, count(*) AS ingested_rows, count(*) AS table_rows, true AS matches FROM ({_LABS_SQL})")
def reconcile_source(read, spark):
    """Rows now in bronze against what the ledger noted while loading four files or more."""
    layout = Layout(scratch_dir(spark, "reconcile"))
    bronze.ingest(spark, layout, LABS, export(read, spark, layout))
    per_file = quality.reconcile_source(store.scan_bronze(spark, layout, LABS), store.current_loads(spark, layout, LABS))
    return per_file.agg(
        *[F.sum(name).alias(name) for name in ("source_rows", "ingested_rows", "table_rows")], F.bool_and("matches").alias("matches")
    )


@query("ingest_multiline", """
    SELECT event_type AS Lab_Name, count(*) AS n_rows, count(*) FILTER (event_id % 3 = 0) AS n_breaks, sum(length(note)) AS characters,
           'done' AS status
    FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'low,' || chr(10) || '"or" high ' || event_id ELSE 'plain ' || event_id END AS note FROM events)
    GROUP BY event_type""")
def ingest_multiline(read, spark):
    """Quoted line breaks in a table whose files are otherwise split among tasks."""
    layout = Layout(scratch_dir(spark, "multiline"))
    note = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('low,\n"or" high '), "event_id")).otherwise(F.concat(F.lit("plain "), "event_id"))
    values = {
        "LOG_ID": F.col("event_id").cast("string"), "MRN": F.col("user_id").cast("string"), "ENC_TYPE_NM": F.lit("visit"),
        "Lab Code": F.lit("x"), "Lab Name": F.col("event_type"), "Observation Value": F.col("value").cast("string"),
        "Measurement Units": F.lit("u"), "Reference Range": note, "Abnormal Flag": F.lit("N"),
        "Collection Datetime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }
    folder = f"{layout.root}/csv"
    read("events").select(*[column.alias(name) for name, column in values.items()]).repartition(3).write.option("header", True).option("escape", '"').csv(folder)
    bronze.ingest(spark, layout, LABS, f"{folder}/*.csv")
    status = store.current_loads(spark, layout, LABS).agg(F.max("status").alias("s")).scalar()
    return store.scan_bronze(spark, layout, LABS).groupBy("Lab_Name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("Reference_Range").contains("\n")).alias("n_breaks"),
        F.sum(F.length("Reference_Range")).alias("characters"),
    ).withColumn("status", status)


@query("part_stats", "SELECT count(*) AS n_rows, 4 AS n_files, true AS sized FROM lineitem")
def part_stats(read, spark):
    layout = Layout(scratch_dir(spark, "parts"))
    stats = text.part_stats(spark, export(read, spark, layout, exactly=True), multi_line=False)
    return stats.agg(F.sum("rows").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_files"), F.bool_and(F.col("bytes") > 0).alias("sized"))


@query("incremental_parts", "SELECT 4 AS first_files, 4 AS all_files, count(*) AS n_rows FROM lineitem")
def incremental_arrivals(read, spark):
    """Parts found by a stream; a second run finds nothing new."""
    layout = Layout(scratch_dir(spark, "arrivals"))
    export(read, spark, layout, exactly=True)
    files = []
    for _ in range(2):
        run = incremental_parts(spark, layout, LABS, f"{layout.root}/csv", "*.csv", f"{layout.root}/state")
        run.awaitTermination()
        files.append(store.current_loads(spark, layout, LABS).count())
    return store.scan_bronze(spark, layout, LABS).agg(
        F.lit(files[0]).alias("first_files"), F.lit(files[1]).alias("all_files"), F.count(F.lit(1)).alias("n_rows")
    )


@query("project_with_aliases", "SELECT o_orderkey AS visit, o_totalprice / 100 AS hundreds FROM orders")
def project_with_aliases(read, spark):
    scans.register_views(spark, {"orders": read("orders")}, "p_")
    return spark.table("p_orders").select(F.col("o_orderkey").alias("visit"), (F.col("o_totalprice") / 100).alias("hundreds"))


_FACTS = "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL"


@query("expectations", f"""
    WITH c AS ({_FACTS}), m AS (SELECT count(*) AS r, count(DISTINCT l_orderkey) AS d, max(n) AS x, count(*) FILTER (n = 2) AS pairs,
                                       count(*) FILTER (l_linenumber = 1) AS firsts FROM c)
    SELECT 'rows' AS rule, true AS expected_status, r AS got FROM m UNION ALL SELECT 'rows off by one', false, r FROM m
    UNION ALL SELECT 'distinct', true, d FROM m UNION ALL SELECT 'distinct off by one', false, d FROM m
    UNION ALL SELECT 'paired', pairs % 2 = 0, pairs FROM m UNION ALL SELECT 'odd', false, 1 FROM m
    UNION ALL SELECT 'group', true, x FROM m UNION ALL SELECT 'group off by one', false, x FROM m
    UNION ALL SELECT 'separate', true, firsts FROM m UNION ALL SELECT 'separate off by one', false, firsts FROM m""")
def expectations(read, spark):
    """Each kind of rule with a value it meets and one it does not."""
    rows = read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_occurrences"))
    rows = rows.withColumn("twice", F.col("n_occurrences") == 2)
    firsts = F.col("l_linenumber") == 1
    known = rows.agg(
        F.count(F.lit(1)).alias("r"), F.count_distinct("l_orderkey").alias("d"), F.max("n_occurrences").alias("x"), F.count_if(firsts).alias("f")
    ).first()
    one = rows.agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("k")).first().k
    lone = (F.col("l_orderkey") == one.l_orderkey) & (F.col("l_linenumber") == one.l_linenumber)
    rules = {
        "rows": quality.expect_rows(known.r), "rows off by one": quality.expect_rows(known.r + 1),
        "distinct": quality.expect_distinct("l_orderkey", known.d), "distinct off by one": quality.expect_distinct("l_orderkey", known.d + 1),
        "paired": quality.expect_paired("twice"), "odd": quality.Rule("odd", F.count_if(lone), quality.expect_paired("twice").holds),
        "group": quality.expect_group("largest", F.lit(True), known.x), "group off by one": quality.expect_group("largest", F.lit(True), known.x + 1),
        "separate": quality.expect_separate("firsts", firsts, known.f), "separate off by one": quality.expect_separate("firsts", firsts, known.f + 1),
    }
    named = [quality.Rule(name, rule.measure, rule.holds) for name, rule in rules.items()]
    found = quality.evaluate(rows, "lines", named)
    return found.select("rule", (F.col("status") == "PASS").alias("expected_status"), F.regexp_extract("detail", r"\d+", 0).cast("bigint").alias("got"))
