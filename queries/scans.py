"""Scans, counts, previews, and the round trip through versioned tables."""

from pyspark.sql import functions as F

from chartmill.config import Layout
from chartmill.operators import aggregate
from chartmill.plans import bronze
from chartmill.session import scratch_dir
from chartmill.sources import scans, store
from queries.base import query


@query("scan_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_columns(read, spark):
    return scans.scan_columns(read("lineitem"), ["l_orderkey", "l_quantity"])


@query("scan_time_range_month", """
    SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def scan_time_range_month(read, spark):
    return scans.scan_time_range(read("orders"), "o_orderdate", *scans.month_bounds(1997, 12))


@query("scan_time_range", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def scan_time_range(read, spark):
    """Over a copy laid out by year, so that the year predicate prunes folders."""
    path = scratch_dir(spark, "orders-by-year")
    store.with_year(read("orders"), ("o_orderdate", "order_year")).write.partitionBy("order_year").parquet(path)
    (lo, _), (_, hi) = scans.month_bounds(1996), scans.month_bounds(1997)
    kept = scans.scan_time_range(spark.read.parquet(path), "o_orderdate", lo, hi, "order_year")
    return scans.scan_columns(kept, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("register_views", """
    SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def register_views(read, spark):
    scans.register_views(spark, {"customer": read("customer"), "nation": read("nation")}, "v_")
    return spark.sql("SELECT n_name, count(*) AS n FROM v_customer JOIN v_nation ON c_nationkey = n_nationkey GROUP BY n_name")


COUNTED = ["customer", "orders", "lineitem", "events", "documents"]


@query("union_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in COUNTED))
def union_counts(read, spark):
    return aggregate.union_counts({name: read(name) for name in COUNTED})


@query("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def preview(read, spark):
    return aggregate.preview(read("orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 25)


@query("ingest_roundtrip", """
    SELECT CAST(user_id AS STRING) AS LOG_ID, event_type AS EVENT_DISPLAY_NAME, count(*) AS n_rows,
           max(date_trunc('second', ts)) AS last_time, 1 AS loads
    FROM events GROUP BY 1, 2""")
def ingest_roundtrip(read, spark):
    """Events written as CSV parts, loaded, and loaded again: the second run adds nothing."""
    layout = Layout(scratch_dir(spark, "roundtrip"))
    source = f"{layout.root}/csv"
    texts = read("events").select(
        F.col("user_id").cast("string").alias("LOG_ID"), F.col("user_id").cast("string").alias("MRN"),
        F.col("event_type").alias("EVENT_DISPLAY_NAME"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("EVENT_TIME"),
        F.concat(F.lit('said "ok",\n'), "props").alias("NOTE_TEXT"),
    )
    texts.write.option("header", True).option("escape", '"').csv(source)
    loads = 0
    for _ in range(2):
        loads += 1 if bronze.ingest(spark, layout, "patient_procedure_events", f"{source}/*.csv") else 0
    rows = store.scan_bronze(spark, layout, "patient_procedure_events")
    return rows.groupBy("LOG_ID", "EVENT_DISPLAY_NAME").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("EVENT_TIME").alias("last_time"), F.lit(loads).alias("loads")
    )
