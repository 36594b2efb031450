"""Aggregations, distributions and profiles."""

from pyspark.sql import functions as F

from chartmill.functions import columns as C
from chartmill.operators import aggregate
from queries.base import query


@query("totals", """
    SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents,
           count(*) FILTER (o_totalprice > 250000) AS large, max(o_orderdate) AS latest
    FROM orders GROUP BY o_orderstatus""")
def totals(read, spark):
    return aggregate.totals(read("orders"), {
        "n": F.count(F.lit(1)), "customers": F.count_distinct("o_custkey"),
        "cents": F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")),
        "large": F.count_if(F.col("o_totalprice") > 250000), "latest": F.max("o_orderdate"),
    }, ["o_orderstatus"])


@query("distinct_tuples", """
    SELECT l_returnflag, count(DISTINCT (l_partkey, CASE WHEN l_quantity > 25 THEN l_suppkey END)) AS tuples
    FROM lineitem GROUP BY l_returnflag""")
def distinct_tuples(read, spark):
    """Distinct tuples in which a null field is a value."""
    pair = F.struct("l_partkey", F.when(F.col("l_quantity") > 25, F.col("l_suppkey")))
    return aggregate.totals(read("lineitem"), {"tuples": F.count_distinct(pair)}, ["l_returnflag"])


@query("summary_by_group", """
    SELECT user_id, event_type, count(value) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
           arg_max(value, (ts, value)) AS last
    FROM events WHERE value IS NOT NULL AND event_type IN ('click', 'view', 'purchase')
      AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY user_id, event_type""")
def summary_by_group(read, spark):
    from chartmill.sources.scans import month_bounds, scan_time_range

    wanted = read("events").where(F.col("event_type").isin("click", "view", "purchase"))
    wanted = scan_time_range(wanted, "ts", *month_bounds(2024, 1))
    return aggregate.summary_by_group(wanted, ["user_id", "event_type"], "value", "ts").withColumn("mean", F.round("mean", 6))


@query("top_groups", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def top_groups(read, spark):
    return aggregate.top_groups(read("events"), ["event_type"])


def _describe_sql(table, columns):
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
               min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
               round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM {table}""" for c in columns)


@query("describe", _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def describe(read, spark):
    result = aggregate.describe(read("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    rounded = {name: F.round(name, 4) for name in ("mean", "std")} | {name: F.round(name, 6) for name in ("q25", "q50", "q75")}
    return result.withColumns(rounded)


@query("exact_quantiles", """
    SELECT o_orderstatus, p, round(quantile_cont(o_totalprice, [0.01, 0.5, 0.99])[i], 6) AS quantile FROM orders,
      (VALUES (1, CAST(0.01 AS DOUBLE)), (2, CAST(0.5 AS DOUBLE)), (3, CAST(0.99 AS DOUBLE))) v(i, p) GROUP BY o_orderstatus, i, p""")
def exact_quantiles(read, spark):
    found = aggregate.exact_quantiles(read("orders"), ["o_orderstatus"], "o_totalprice", [0.01, 0.5, 0.99])
    return found.withColumn("quantile", F.round("quantile", 6))


def _histogram_sql(table, column, bins, where="true"):
    return f"""
    WITH v AS (SELECT CAST({column} AS DOUBLE) AS v FROM {table} WHERE {where}),
    e AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS w FROM v),
    c AS (SELECT least(CAST(floor((v - lo) / w) AS BIGINT), {bins - 1}) AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT CAST(b AS BIGINT) AS bin, round(lo + b * w, 6) AS bin_start, round(lo + (b + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n
    FROM range({bins}) r(b) CROSS JOIN e LEFT JOIN c ON c.bin = b"""


def _rounded(bins):
    return bins.withColumns({"bin_start": F.round("bin_start", 6), "bin_end": F.round("bin_end", 6)})


@query("histogram", _histogram_sql("orders", "o_totalprice", 40))
def histogram(read, spark):
    return _rounded(aggregate.histogram(read("orders"), "o_totalprice", 40))


@query("histogram_positive", _histogram_sql("customer", "c_acctbal", 60, "c_acctbal > 0"))
def histogram_positive(read, spark):
    return _rounded(aggregate.positive_histogram(read("customer"), "c_acctbal", 60))


@query("rate_by_year", """
    SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_true,
           round(avg(CAST(o_orderstatus = 'F' AS INT)), 9) AS rate
    FROM orders GROUP BY 1""")
def rate_by_year(read, spark):
    rates = aggregate.rate_by_year(read("orders"), "o_orderdate", F.col("o_orderstatus") == "F")
    return rates.withColumn("rate", F.round("rate", 9))


@query("null_rate_by", """
    SELECT lang, count(*) AS n, count(*) FILTER (quality IS NULL) AS n_null, round(avg(CAST(quality IS NULL AS INT)), 9) AS null_rate
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def null_rate_by(read, spark):
    labelled = read("documents").select("doc_id", "lang").join(read("labels"), "doc_id", "left")
    return aggregate.null_rate_by(labelled, "lang", "quality").withColumn("null_rate", F.round("null_rate", 9))


@query("null_sentinel_share", """
    SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_quantity > 48) AS n_true, round(avg(CAST(l_quantity > 48 AS INT)), 9) AS rate,
           CASE WHEN avg(CAST(l_quantity > 48 AS INT)) >= 0.99 THEN 'all' WHEN avg(CAST(l_quantity > 48 AS INT)) = 0 THEN 'none'
                WHEN avg(CAST(l_quantity > 48 AS INT)) < 0.04 THEN 'minority' ELSE 'mixed' END AS band
    FROM lineitem GROUP BY l_suppkey""")
def null_sentinel_share(read, spark):
    marked = read("lineitem").withColumn("v", F.when(F.col("l_quantity") > 48, F.lit(C.LAB_SENTINEL)).otherwise(F.col("l_quantity")))
    shares = aggregate.sentinel_share(marked, "l_suppkey", C.flag_sentinel(F.col("v")), minority=0.04)
    return shares.withColumn("rate", F.round("rate", 9))


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query("profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct,
    '{kind}' AS type FROM orders""" for c, kind in ORDER_TYPES.items()))
def profile(read, spark):
    return aggregate.profile(read("orders"))


@query("mixed_type_check", """
    SELECT event_type, count(*) AS n_numeric, count(*) AS n_text, CAST(0 AS BIGINT) AS n_null FROM events GROUP BY event_type""")
def mixed_type_check(read, spark):
    events = read("events")
    mixed = events.select("event_type", F.col("value").cast("string").alias("v")).unionByName(events.select("event_type", F.col("props").alias("v")))
    return aggregate.mixed_type_check(mixed, "v", ["event_type"])
