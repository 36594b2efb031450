"""De-duplication and duplicate audits."""

from pyspark.sql import functions as F

from chartmill.operators import aggregate, dedup
from queries.base import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("collapse_count", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_occurrences
    FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def collapse_count(read, spark):
    return dedup.collapse_count(read("lineitem"), LINE_KEY)


@query("collapse_count_text", """
    SELECT md5(trim(text)) AS text_md5, count(*) AS n_occurrences FROM documents GROUP BY trim(text)""")
def collapse_count_text(read, spark):
    df = read("documents").select(F.trim("text").alias("text"))
    return dedup.collapse_count(df, ["text"]).select(F.md5("text").alias("text_md5"), "n_occurrences")


@query("collapse_collect", """
    SELECT md5(text) AS text_md5, array_to_string(list_sort(array_agg(DISTINCT source)), ',') AS sources,
           count(DISTINCT source) > 1 AS several_sources, count(*) AS n_occurrences
    FROM documents GROUP BY text""")
def collapse_collect(read, spark):
    lists = dedup.collapse_collect(read("documents"), ["text"], "source", "sources", "several_sources")
    return lists.select(
        F.md5("text").alias("text_md5"), F.array_join("sources", ",").alias("sources"), "several_sources", "n_occurrences"
    )


def _classify_sql(keys, entity, attributes):
    k, a = ", ".join(keys), ", ".join(attributes)
    return f"""
    WITH r AS (SELECT {k}, {entity}, {a}, count(*) AS n_occurrences FROM lineitem GROUP BY ALL),
    t AS (SELECT *, count(*) OVER w AS n, sum(n_occurrences) OVER w AS total FROM r WINDOW w AS (PARTITION BY {k})),
    g AS (SELECT {k}, count(DISTINCT {entity}) AS e, count(DISTINCT ({a})) AS d, min({entity}) AS first_entity
          FROM r GROUP BY {k})
    SELECT {', '.join('t.' + c for c in [*keys, entity, *attributes])},
           (n > 1 AND e > 1 AND d > 1) AS is_collision, (n > 1 AND e <= 1) AS is_conflict,
           CAST(CASE WHEN n > 1 AND e > 1 AND d = 1 THEN total ELSE n_occurrences END AS BIGINT) AS n_occurrences
    FROM t JOIN g USING ({k})
    WHERE NOT (n > 1 AND e > 1 AND d = 1) OR t.{entity} = g.first_entity"""


@query("classify_duplicates", _classify_sql(LINE_KEY, "l_partkey", LINE_REST))
def classify_duplicates(read, spark):
    return dedup.classify_duplicates(read("lineitem"), LINE_KEY, "l_partkey", LINE_REST)


@query("classify_duplicates_few_attributes", _classify_sql(LINE_KEY, "l_returnflag", ["l_linestatus"]))
def classify_duplicates_few_attributes(read, spark):
    """Few attribute values, so that every class of duplicate occurs."""
    return dedup.classify_duplicates(read("lineitem"), LINE_KEY, "l_returnflag", ["l_linestatus"])


@query("keep_first", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate NULLS LAST, l_linenumber NULLS LAST,
        l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST,
        l_discount NULLS LAST, l_tax NULLS LAST, l_returnflag NULLS LAST, l_linestatus NULLS LAST) AS rn
      FROM lineitem) WHERE rn = 1""")
def keep_first(read, spark):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    return dedup.keep_first(read("lineitem"), ["l_orderkey"], order)


@query("distinct_rows", """
    SELECT DISTINCT lower(trim(lang)) AS lang, source FROM documents""")
def distinct_rows(read, spark):
    return read("documents").select(F.lower(F.trim("lang")).alias("lang"), "source").distinct()


def _audit_sql(name, table, keys):
    return f"""
    SELECT '{name}' AS table_name, CAST(sum(s) AS BIGINT) AS n_rows, count(*) AS n_groups,
           CAST(sum(CASE WHEN s > 1 THEN s ELSE 0 END) AS BIGINT) AS rows_in_duplicates,
           count(*) FILTER (s > 1) AS duplicate_groups, max(s) FILTER (s > 1) AS max_group,
           CAST(median(s) FILTER (s > 1) AS DOUBLE) AS median_group
    FROM (SELECT count(*) AS s FROM {table} GROUP BY {keys})"""


@query("duplicate_audit", _audit_sql("lineitem", "lineitem", "l_orderkey, l_linenumber")
       + " UNION ALL " + _audit_sql("documents", "documents", "text"))
def duplicate_audit(read, spark):
    lines = dedup.duplicate_audit(read("lineitem"), LINE_KEY).withColumn("table_name", F.lit("lineitem"))
    texts = dedup.duplicate_audit(read("documents"), ["text"]).withColumn("table_name", F.lit("documents"))
    return lines.unionByName(texts)


@query("group_sizes", """
    SELECT group_size, count(*) AS n_groups FROM (
      SELECT count(*) AS group_size FROM lineitem GROUP BY l_orderkey) GROUP BY group_size""")
def group_sizes(read, spark):
    return dedup.group_sizes(read("lineitem"), ["l_orderkey"])


def _divergence_sql():
    flag = "count(DISTINCT {0}) + CAST(count({0}) < count(*) AND count({0}) > 0 AS INT) > 1 AS f_{0}"
    columns = ["l_partkey", *LINE_REST]
    flags = ", ".join(flag.format(c) for c in columns)
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (f_{c}) AS diverging_groups, count(*) AS groups FROM g" for c in columns]
    some = " OR ".join(f"f_{c}" for c in columns)
    parts.append(f"SELECT 'any' AS \"column\", count(*) FILTER ({some}) AS diverging_groups, count(*) AS groups FROM g")
    return (f"WITH g AS (SELECT l_orderkey, l_linenumber, {flags} FROM lineitem GROUP BY l_orderkey, l_linenumber "
            "HAVING count(*) > 1) " + " UNION ALL ".join(parts))


@query("key_divergence", _divergence_sql())
def key_divergence(read, spark):
    return dedup.key_divergence(read("lineitem"), LINE_KEY, ["l_partkey", *LINE_REST])


_IMPACT = "SELECT '{0}' AS table_name, (SELECT count(*) FROM {0}) AS n_rows, b AS keys_before, a AS keys_after, b - a AS keys_merged " \
    "FROM (SELECT count(DISTINCT ({1})) AS b, count(DISTINCT ({2})) AS a FROM {0})"


@query("merge_impact", _IMPACT.format("part", "p_name, p_type, p_size", "split_part(p_name, ' ', 2), p_type, p_size") + " UNION ALL "
       + _IMPACT.format("customer", "c_nationkey, c_mktsegment", "c_nationkey, lower(trim(c_mktsegment))"))
def merge_impact(read, spark):
    parts = dedup.merge_impact(read("part"), ["p_name", "p_type", "p_size"], {"p_name": F.split_part("p_name", F.lit(" "), F.lit(2))})
    customers = dedup.merge_impact(
        read("customer"), ["c_nationkey", "c_mktsegment"], {"c_mktsegment": F.lower(F.trim("c_mktsegment"))}
    )
    return parts.withColumn("table_name", F.lit("part")).unionByName(customers.withColumn("table_name", F.lit("customer")))


@query("pairing_report", """
    SELECT categories, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM (
      SELECT array_to_string(list_sort(array_agg(DISTINCT source)), '+') AS categories, count(*) AS n
      FROM documents GROUP BY text HAVING count(DISTINCT source) > 1) GROUP BY categories""")
def pairing_report(read, spark):
    report = dedup.pairing_report(read("documents"), ["text"], "source")
    return report.withColumn("categories", F.array_join("categories", "+"))


@query("duplication_by_category", """
    SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n_rows,
           CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicated_rows,
           round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n), 9) AS duplicated_share
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_returnflag""")
def duplication_by_category(read, spark):
    report = dedup.duplication_by_category(read("lineitem"), [*LINE_KEY, "l_returnflag"], "l_returnflag")
    return report.withColumn("duplicated_share", F.round("duplicated_share", 9))


@query("duplicate_blocks", """
    WITH s AS (SELECT *, CAST(event_type IS DISTINCT FROM lag(event_type) OVER w AS INT) AS st FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM s)
    SELECT user_id, CAST(run AS BIGINT) AS run, event_type, min(ts) AS block_start, max(ts) AS block_end,
           count(*) AS block_length
    FROM r GROUP BY user_id, run, event_type""")
def duplicate_blocks(read, spark):
    return dedup.duplicate_blocks(read("events"), ["user_id"], "event_type", ["ts", "event_id"])


@query("simultaneous_events", """
    SELECT o_orderdate, o_orderpriority, count(DISTINCT o_custkey) AS n_items, count(*) AS n_rows
    FROM orders GROUP BY o_orderdate, o_orderpriority HAVING count(DISTINCT o_custkey) > 1""")
def simultaneous_events(read, spark):
    return dedup.simultaneous_events(read("orders"), ["o_orderdate", "o_orderpriority"], "o_custkey")


@query("multiplicity_vs_activity", """
    WITH f AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
    p AS (SELECT o_custkey, sum(n) AS r, count(*) AS d FROM f GROUP BY o_custkey),
    a AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS n_encounters FROM orders GROUP BY o_custkey)
    SELECT n_encounters, count(*) AS n_entities, CAST(sum(r) AS BIGINT) AS n_rows, CAST(sum(d) AS BIGINT) AS n_distinct,
           round(sum(r) / sum(d), 9) AS duplicate_ratio
    FROM p JOIN a USING (o_custkey) GROUP BY n_encounters""")
def multiplicity_vs_activity(read, spark):
    orders = read("orders")
    report = dedup.multiplicity_vs_activity(
        orders, orders, "o_custkey", ["o_custkey", "o_orderstatus", "o_orderpriority"], "o_orderkey"
    )
    return report.withColumn("duplicate_ratio", F.round("duplicate_ratio", 9))


@query("safe_total", """
    SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total, count(*) AS n_facts
    FROM (SELECT DISTINCT l_suppkey, l_partkey, l_quantity, l_returnflag FROM lineitem) GROUP BY l_suppkey""")
def safe_total(read, spark):
    facts = dedup.collapse_count(read("lineitem"), ["l_suppkey", "l_partkey", "l_quantity", "l_returnflag"])
    return aggregate.safe_total(facts, ["l_suppkey"], "l_quantity").withColumn("total", F.col("total").cast("bigint"))
