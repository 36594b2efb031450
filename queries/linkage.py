"""Links between tables."""

from pyspark.sql import functions as F

from chartmill.operators import linkage
from queries.base import query


@query("orphan_keys", "SELECT doc_id, count(*) AS n_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1")
def orphan_keys(read, spark):
    return linkage.orphan_keys(read("documents").select("doc_id"), read("labels").select("doc_id"), "doc_id")


def _coverage_sql(left, lkey, right, rkey):
    return f"""
    SELECT '{left}' AS tbl, count(*) AS n_keys, count(*) FILTER (m) AS matched_keys, CAST(sum(n) AS BIGINT) AS n_rows,
           CAST(coalesce(sum(n) FILTER (m), 0) AS BIGINT) AS matched_rows,
           round(count(*) FILTER (m) * 100.0 / count(*), 6) AS matched_percent
    FROM (SELECT {lkey} AS k, count(*) AS n, k IN (SELECT {rkey} FROM {right}) AS m FROM {left} GROUP BY 1)"""


@query("key_coverage", _coverage_sql("documents", "doc_id", "labels", "doc_id") + " UNION ALL "
       + _coverage_sql("lineitem", "l_partkey", "part", "p_partkey"))
def key_coverage(read, spark):
    documents = linkage.key_coverage(read("documents"), read("labels"), "doc_id").withColumn("tbl", F.lit("documents"))
    parts = read("part").select(F.col("p_partkey").alias("l_partkey"))
    lines = linkage.key_coverage(read("lineitem"), parts, "l_partkey").withColumn("tbl", F.lit("lineitem"))
    return documents.unionByName(lines).withColumn("matched_percent", F.round("matched_percent", 6))


@query("entity_footprint", """
    WITH p AS (SELECT DISTINCT s_suppkey, s_nationkey AS l_linenumber FROM supplier),
    a AS (SELECT l_suppkey AS s_suppkey, l_linenumber, count(*) AS a FROM lineitem GROUP BY ALL),
    b AS (SELECT l_suppkey AS s_suppkey, l_linenumber, count(*) AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT s_suppkey, l_linenumber, coalesce(a, 0) AS lines, coalesce(b, 0) AS returns, coalesce(a, 0) + coalesce(b, 0) AS total_rows,
           coalesce(a, 0) + coalesce(b, 0) = 0 AS is_phantom
    FROM p LEFT JOIN a USING (s_suppkey, l_linenumber) LEFT JOIN b USING (s_suppkey, l_linenumber)""")
def entity_footprint(read, spark):
    pairs = read("supplier").select("s_suppkey", F.col("s_nationkey").alias("l_linenumber"))
    lines = read("lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    return linkage.entity_footprint(
        pairs, {"lines": lines, "returns": lines.where("l_returnflag = 'R'")}, ["s_suppkey", "l_linenumber"]
    )


@query("subset_copy", """
    WITH f AS (SELECT DISTINCT c_nationkey AS e, c_mktsegment AS x, c_acctbal > 0 AS y FROM customer),
    p AS (SELECT n_nationkey AS a, n_regionkey AS b FROM nation WHERE n_nationkey <> n_regionkey),
    s AS (SELECT a, b, count(f.e) AS facts_a, count(g.e) AS facts_shared FROM p LEFT JOIN f ON f.e = a
          LEFT JOIN f g ON g.e = b AND g.x = f.x AND g.y = f.y GROUP BY a, b),
    z AS (SELECT s.*, (SELECT count(*) FROM f WHERE f.e = b) AS facts_b FROM s)
    SELECT a, b, facts_a, facts_shared, facts_b, facts_a > 0 AND facts_a = facts_shared AS is_subset,
           facts_a > 0 AND facts_a = facts_shared AND facts_b > facts_a AS is_strict_subset FROM z""")
def subset_copy(read, spark):
    facts = read("customer").select(F.col("c_nationkey").alias("e"), F.col("c_mktsegment").alias("x"), (F.col("c_acctbal") > 0).alias("y"))
    pairs = read("nation").where("n_nationkey <> n_regionkey").select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b"))
    return linkage.subset_copy(facts, pairs, "e", ["x", "y"])


# Keys made longer so that three digits of a mangled form are sometimes, not always, ambiguous.
_FULL = "CAST(c_custkey * 7919 + 1000003 AS STRING)"


@query("repair_ids", f"""
    WITH l AS (SELECT DISTINCT {_FULL} AS full_id FROM customer),
    m AS (SELECT s_suppkey, CASE WHEN s_nationkey > 12 THEN CAST(s_suppkey * 7919 + 1000003 AS STRING)
              ELSE printf('%d.%02d', m3 // 100, m3 % 100) || 'E+0' || ex END AS id, s_nationkey <= 12 AS damaged, m3, ex
          FROM (SELECT *, CAST(round((s_suppkey * 7919 + 1000003) / pow(10, ex - 2)) AS BIGINT) AS m3
                FROM (SELECT *, CAST(length(CAST(s_suppkey * 7919 + 1000003 AS STRING)) - 1 AS BIGINT) AS ex FROM supplier))),
    b AS (SELECT length(full_id) - 1 AS ex, CAST(round(CAST(full_id AS BIGINT) / pow(10, length(full_id) - 3)) AS BIGINT) AS m3, full_id FROM l),
    c AS (SELECT ex, m3, count(*) AS n, min(full_id) AS f FROM b GROUP BY ex, m3)
    SELECT s_suppkey, id, CASE WHEN NOT damaged THEN id WHEN n = 1 THEN f END AS repaired_id,
           CASE WHEN NOT damaged THEN 'intact' WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'repaired' ELSE 'ambiguous' END AS repair_status
    FROM m LEFT JOIN c USING (ex, m3)""")
def repair_ids(read, spark):
    number = F.col("s_suppkey") * 7919 + 1000003
    exponent = F.length(number.cast("string")) - 1
    mantissa = F.round(number / F.pow(F.lit(10.0), exponent - 2), 0).cast("bigint")
    mangled = F.concat(
        F.floor(mantissa / 100).cast("string"), F.lit("."), F.lpad((mantissa % 100).cast("string"), 2, "0"), F.lit("E+0"), exponent.cast("string")
    )
    damaged = read("supplier").select("s_suppkey", F.when(F.col("s_nationkey") > 12, number.cast("string")).otherwise(mangled).alias("id"))
    full = read("customer").select((F.col("c_custkey") * 7919 + 1000003).cast("string").alias("full_id"))
    return linkage.repair_ids(damaged, "id", full, "full_id")


@query("attach_attributes", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority, year(o_orderdate) AS order_year
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey""")
def attach_attributes(read, spark):
    orders = read("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("bigint").alias("order_year")
    )
    joined = linkage.attach_attributes(
        read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), orders, "l_orderkey", ["o_orderpriority", "order_year"],
        not_unique=F.col("o_orderstatus") == "P",
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority", "order_year")


@query("as_of_features", """
    WITH r AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
    SELECT event_id, r.user_id, r.ts, arg_max(s.value, (s.ts, s.value)) AS last_view
    FROM r LEFT JOIN s ON s.user_id = r.user_id AND s.ts < r.ts GROUP BY ALL""")
def as_of_features(read, spark):
    events = read("events")
    refs = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    series = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen"), "value")
    return linkage.as_of(refs, series, ["user_id"], "ts", "seen", "value", "last_view")


@query("interval_join", """
    WITH w AS (SELECT user_id, min(ts) AS start_ts, min(ts) + INTERVAL 3 DAY AS stop_ts FROM events WHERE event_type = 'signup' GROUP BY user_id)
    SELECT event_id, e.user_id, ts, start_ts, stop_ts FROM events e JOIN w ON e.user_id = w.user_id AND ts BETWEEN start_ts AND stop_ts""")
def interval_join(read, spark):
    events = read("events")
    return linkage.interval_join(
        events.select("event_id", "user_id", "ts"), _signup_windows(events, 3), "user_id", "ts", "start_ts", "stop_ts"
    )


def _signup_windows(events, days):
    first = events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("start_ts"))
    return first.withColumn("stop_ts", F.col("start_ts") + F.expr(f"INTERVAL '{days}' DAY"))


@query("linkage_stats", """
    WITH e AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1)
    SELECT count(*) AS n_entities, CAST(sum(n) AS BIGINT) AS n_encounters, round(avg(n), 6) AS mean_encounters, max(n) AS max_encounters,
           count(*) FILTER (n > 1) AS repeat_entities, round(count(*) FILTER (n > 1) / count(*), 9) AS repeat_share,
           CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS encounters_of_repeat FROM e""")
def linkage_stats(read, spark):
    stats = linkage.linkage_stats(read("orders"), "o_custkey", "o_orderkey")
    return stats.withColumns({"mean_encounters": F.round("mean_encounters", 6), "repeat_share": F.round("repeat_share", 9)})


@query("grouped_split", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'excluded'
           WHEN CAST('0x' || substr(md5(CAST(o_custkey AS STRING)), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split
    FROM orders""")
def grouped_split(read, spark):
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return linkage.grouped_split(orders, "o_custkey", 20, F.col("o_orderstatus") == "P").drop("o_orderstatus")
