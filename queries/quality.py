"""Checks and findings about columns."""

from pyspark.sql import functions as F

from chartmill.functions import columns as C
from chartmill.operators import dedup, quality
from queries.base import query

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("reconcile_multiplicity", """
    SELECT (SELECT count(*) FROM lineitem) AS bronze_rows, (SELECT count(*) FROM lineitem) AS summed,
           (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS silver_rows, true AS matches""")
def reconcile_multiplicity(read, spark):
    lines = read("lineitem")
    return quality.reconcile_multiplicity(lines, dedup.collapse_count(lines, LINE_KEY))


@query("verify_layer", """
    WITH c AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
    m AS (SELECT count(*) AS r, CAST(sum(n) AS BIGINT) AS s, count(DISTINCT l_orderkey) AS d, max(n) AS x,
                 count(*) FILTER (n = 2) AS pairs, (SELECT count(*) FROM lineitem) AS b FROM c)
    SELECT * FROM (
      SELECT 'rows within bounds' AS rule, CASE WHEN r > 0 AND r < 1000000000000 THEN 'PASS' ELSE 'FAIL' END AS status, 'got ' || r AS detail FROM m
      UNION ALL SELECT 'distinct keys', CASE WHEN d <= r THEN 'PASS' ELSE 'FAIL' END, 'got ' || d FROM m
      UNION ALL SELECT 'multiplicity set', 'PASS', 'got 0' FROM m
      UNION ALL SELECT 'largest group', CASE WHEN x > 1 THEN 'PASS' ELSE 'FAIL' END, 'got ' || x FROM m
      UNION ALL SELECT 'pairs', CASE WHEN pairs % 2 = 0 THEN 'PASS' ELSE 'FAIL' END, 'got ' || pairs FROM m
      UNION ALL SELECT 'absent: zero multiplicity', 'PASS', 'got 0' FROM m
      UNION ALL SELECT 'sum', CASE WHEN s > 0 THEN 'PASS' ELSE 'FAIL' END, 'got ' || s FROM m)""")
def verify_layer(read, spark):
    """All rules of a table from one aggregate."""
    collapsed = dedup.collapse_count(read("lineitem"), LINE_KEY)
    n = F.count(F.lit(1))
    rules = [
        quality.Rule("rows within bounds", n, quality.rows_between(0, 1_000_000_000_000).holds),
        quality.Rule("distinct keys", F.count_distinct("l_orderkey"), lambda v: v <= F.col("m0")),
        quality.Rule("multiplicity set", quality.expect_nonnull("n_occurrences").measure, lambda v: v == 0),
        quality.Rule("largest group", F.max("n_occurrences"), lambda v: v > 1),
        quality.Rule("pairs", F.count_if(F.col("n_occurrences") == 2), lambda v: v % 2 == 0),
        quality.expect_absent("zero multiplicity", F.col("n_occurrences") < 1),
        quality.Rule("sum", F.sum("n_occurrences"), lambda v: v > 0),
    ]
    return quality.evaluate(collapsed, "lineitem", rules).drop("table_name")


def _ship_times(read):
    return read("lineitem").join(read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left")


@query("temporal_integrity", """
    SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_shipdate < o_orderdate) AS end_before_start,
           count(*) FILTER (l_shipdate = o_orderdate) AS same_time, count(*) FILTER (o_orderdate IS NULL) AS no_start,
           count(*) FILTER (l_shipdate IS NULL) AS no_end
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag""")
def temporal_integrity(read, spark):
    return quality.temporal_integrity(_ship_times(read), "o_orderdate", "l_shipdate", ["l_returnflag"])


@query("derived_equals", """
    SELECT lang, count(*) AS n, count(*) FILTER (n_chars = length(text)) AS n_equal,
           count(*) FILTER (n_chars <> length(text)) AS n_different
    FROM documents GROUP BY lang""")
def derived_equals(read, spark):
    return quality.derived_equals(read("documents"), "n_chars", F.length("text").cast("bigint"), ["lang"])


@query("derived_days", """
    SELECT count(*) AS n, count(*) FILTER (d IS NOT DISTINCT FROM date_diff('day', o_orderdate, l_shipdate)) AS n_equal,
           count(*) FILTER (d IS DISTINCT FROM date_diff('day', o_orderdate, l_shipdate)) AS n_different
    FROM (SELECT *, CASE WHEN l_quantity > 25 THEN date_diff('day', o_orderdate, l_shipdate) ELSE l_linenumber END AS d
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)""")
def derived_days(read, spark):
    days = C.days_between(F.col("o_orderdate"), F.col("l_shipdate"))
    stated = F.when(F.col("l_quantity") > 25, days).otherwise(F.col("l_linenumber"))
    return quality.derived_equals(_ship_times(read).withColumn("days", stated), "days", days)


@query("mutually_exclusive", """
    SELECT event_type, count(*) FILTER (value > 10 AND value < 30) AS both, count(*) FILTER (value <= 10 AND value >= 30) AS neither,
           count(*) FILTER (value >= 30) AS only_first, count(*) FILTER (value <= 10) AS only_second
    FROM events GROUP BY event_type""")
def mutually_exclusive(read, spark):
    high, low = F.when(F.col("value") > 10, F.col("value")), F.when(F.col("value") < 30, F.col("value"))
    return quality.mutually_exclusive(read("events"), high, low, ["event_type"])


@query("code_label_consistency", """
    WITH p AS (SELECT p_brand AS code, p_type AS label, count(*) AS n FROM part GROUP BY ALL)
    SELECT 'code' AS side, code AS value, count(*) AS n_variants, CAST(sum(n) AS BIGINT) AS n_rows FROM p GROUP BY code HAVING count(*) > 1
    UNION ALL SELECT 'label', label, count(*), CAST(sum(n) AS BIGINT) FROM p GROUP BY label HAVING count(*) > 1""")
def code_label_consistency(read, spark):
    return quality.code_label_consistency(read("part"), "p_brand", "p_type")


@query("whitespace_variants", """
    SELECT folded, count(*) AS n_variants, CAST(sum(n) AS BIGINT) AS n_rows FROM (
      SELECT lower(trim(v)) AS folded, v, count(*) AS n FROM (
        SELECT CASE WHEN c_acctbal < 0 THEN c_mktsegment || ' ' WHEN c_acctbal > 5000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS v
        FROM customer) GROUP BY ALL) GROUP BY folded HAVING count(*) > 1""")
def whitespace_variants(read, spark):
    text = (
        F.when(F.col("c_acctbal") < 0, F.concat("c_mktsegment", F.lit(" ")))
        .when(F.col("c_acctbal") > 5000, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    )
    return quality.whitespace_variants(read("customer").select(text.alias("segment")), "segment")


@query("range_outliers", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < -900 OR c_acctbal > 9900")
def range_outliers(read, spark):
    return quality.range_outliers(read("customer").select("c_custkey", "c_acctbal"), "c_acctbal", -900, 9900)


@query("id_format_census", """
    WITH i AS (
      SELECT 'customer' AS tbl, CASE c_mktsegment WHEN 'MACHINERY' THEN c_custkey || 'E+15' WHEN 'FURNITURE' THEN c_name
             ELSE substr(md5(CAST(c_custkey AS STRING)), 1, 16) END AS id FROM customer
      UNION ALL SELECT 'orders', substr(md5(CAST(o_custkey AS STRING)), 1, 16) FROM orders)
    SELECT tbl AS "table", CASE WHEN regexp_matches(id, '^[0-9a-f]{16}$') THEN 'hex16' WHEN regexp_matches(id, '[Ee][+-]') THEN 'scientific'
           ELSE 'other' END AS format, count(*) AS n_rows, count(DISTINCT id) AS n_distinct,
           count(DISTINCT CASE WHEN NOT regexp_matches(id, '[A-Za-z]') THEN id END) AS n_without_letters
    FROM i GROUP BY 1, 2""")
def id_format_census(read, spark):
    def hashed(name):
        return F.substring(F.md5(F.col(name).cast("string")), 1, 16)

    segment = F.col("c_mktsegment")
    written = (
        F.when(segment == "MACHINERY", F.concat(F.col("c_custkey").cast("string"), F.lit("E+15")))
        .when(segment == "FURNITURE", F.col("c_name")).otherwise(hashed("c_custkey"))
    )
    return quality.id_format_census({
        "customer": (read("customer").select(written.alias("id")), "id"),
        "orders": (read("orders").select(hashed("o_custkey").alias("id")), "id"),
    })


@query("code_validity", """
    SELECT p_type, count(*) AS n, count(*) FILTER (regexp_matches(p_size || '-' || p_partkey, '^\\d+-\\d$')) AS n_true,
           round(avg(CAST(regexp_matches(p_size || '-' || p_partkey, '^\\d+-\\d$') AS INT)), 9) AS rate
    FROM part GROUP BY p_type""")
def code_validity(read, spark):
    code = F.concat_ws("-", F.col("p_size").cast("string"), F.col("p_partkey").cast("string"))
    found = quality.code_validity(read("part").withColumn("code", code), "code", C.LOINC, ["p_type"])
    return found.withColumn("rate", F.round("rate", 9))
