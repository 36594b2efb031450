"""Typing and cleaning rules, applied to values derived from the test tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampNTZType

from chartmill.functions import columns as C
from chartmill.operators import clean
from queries.base import query


@query("split_mixed_value", """
    SELECT event_type, count(num) AS n_numeric, count(txt) AS n_text, count(*) AS n_rows,
           CAST(sum(round(num * 100)) AS BIGINT) AS hundredths
    FROM (SELECT event_type, value AS num, NULL AS txt FROM events
          UNION ALL SELECT event_type, NULL, event_type FROM events
          UNION ALL SELECT event_type, NULL, NULL FROM events)
    GROUP BY event_type""")
def split_mixed_value(read, spark):
    events = read("events")
    mixed = events.select("event_type", F.col("value").cast("string").alias("MEAS_VALUE"))
    mixed = mixed.unionByName(events.select("event_type", F.col("event_type").alias("MEAS_VALUE")))
    mixed = mixed.unionByName(events.select("event_type", F.lit("NaN").alias("MEAS_VALUE")))
    split = clean.split_mixed_value(clean.null_out_tokens(mixed, ["NaN"]), "MEAS_VALUE")
    return split.groupBy("event_type").agg(
        F.count("MEAS_VALUE_NUM").alias("n_numeric"), F.count("MEAS_VALUE_TXT").alias("n_text"),
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("MEAS_VALUE_NUM") * 100).cast("bigint")).alias("hundredths"),
    )


PRICES = (
    StructType().add("o_orderkey", LongType()).add("price", DoubleType()).add("whole", LongType())
    .add("at", TimestampNTZType()).add("status", StringType())
)


def _price_texts(read):
    """Order prices as text, spoilt in ways that depend on status and priority."""
    orders, status, priority = read("orders"), F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("o_orderkey"),
        F.when(status == "F", F.concat(price, F.lit("d"))).when(status == "O", F.concat(F.lit(" +"), price)).otherwise("NaN").alias("price"),
        F.when(status == "F", F.col("o_custkey").cast("string")).when(status == "O", price).otherwise("x").alias("whole"),
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "M/d/yyyy"))
        .when(priority == "2-HIGH", F.lit("0 NULL")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("at"),
        status.alias("status"),
    )


@query("coerce_to_schema", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS price,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey
                WHEN o_orderstatus = 'O' AND o_totalprice = floor(o_totalprice) THEN CAST(o_totalprice AS BIGINT) END AS whole,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate END AS at, o_orderstatus AS status
    FROM orders""")
def coerce_to_schema(read, spark):
    texts = clean.null_out_tokens(_price_texts(read), ["NaN"])
    return clean.coerce_to_schema(texts, PRICES, ["M/d/yyyy"])


@query("rejected_values", """
    SELECT * FROM (VALUES ('o_orderkey'), ('price'), ('whole'), ('at')) v("column"),
    LATERAL (SELECT CASE v."column" WHEN 'price' THEN count(*) FILTER (o_orderstatus <> 'P') ELSE count(*) END AS n_text,
        CASE v."column" WHEN 'o_orderkey' THEN 0
             WHEN 'price' THEN count(*) FILTER (o_orderstatus = 'F')
             WHEN 'whole' THEN count(*) FILTER (o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_totalprice <> floor(o_totalprice)))
             ELSE count(*) FILTER (o_orderpriority = '2-HIGH') END AS n_rejected FROM orders)""")
def rejected_values(read, spark):
    return clean.rejected_values(clean.null_out_tokens(_price_texts(read), ["NaN"]), PRICES, ["M/d/yyyy"])


@query("conform", """
    SELECT CAST(c_custkey AS STRING) AS MRN, c_name AS diagnosis_code, CAST(NULL AS STRING) AS dx_name FROM customer""")
def conform(read, spark):
    schema = StructType.fromDDL("MRN STRING NOT NULL, diagnosis_code STRING, dx_name STRING")
    raw = clean.rename(read("customer"), {"c_custkey": "mrn", "c_name": "diagnosis_code"})
    return clean.conform(clean.unify_key_case(clean.drop_if_present(raw, ["Unnamed: 0", "c_acctbal"])), schema)


@query("trim_columns", """
    SELECT trim(seg) AS segment, trim(name) AS name, count(*) AS n FROM (
      SELECT '  ' || c_mktsegment || ' ' AS seg, chr(9) || c_mktsegment || ' ' AS name FROM customer) GROUP BY ALL""")
def trim_columns(read, spark):
    padded = read("customer").select(
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("segment"), F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")).alias("name")
    )
    return clean.trim_columns(padded, ["segment", "name"]).groupBy("segment", "name").agg(F.count(F.lit(1)).alias("n"))


@query("parse_feet_inches", """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN floor(p_size / 12) * 12.0 + p_size % 12
                           WHEN p_type = 'LARGE' THEN floor(p_size / 12) * 12.0 + p_size % 12 + 0.5 END AS height_in
    FROM part""")
def parse_feet_inches(read, spark):
    feet = F.floor(F.col("p_size") / 12).cast("string")
    inches = (F.col("p_size") % 12).cast("string")
    text = (
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.concat(F.lit(" "), feet, F.lit("' "), inches, F.lit(" ")))
        .when(F.col("p_type") == "LARGE", F.concat(feet, F.lit("' "), inches, F.lit(".5")))
        .otherwise(F.concat(feet, F.lit("'"), inches, F.lit('"')))
    )
    return read("part").select("p_partkey", C.parse_feet_inches(text).alias("height_in"))


UNIT_TEXT = {"click": "cmH20", "view": "l/min ", "purchase": "ml", "error": " mL", "signup": ',",4"'}


@query("normalize_units", """
    SELECT CASE event_type WHEN 'click' THEN 'cmH2O' WHEN 'view' THEN 'L/min' WHEN 'purchase' THEN 'mL' WHEN 'error' THEN 'mL' END AS unit,
           count(*) AS n FROM events GROUP BY 1""")
def normalize_units(read, spark):
    text = C.first_match([(F.col("event_type") == kind, unit) for kind, unit in UNIT_TEXT.items()])
    return read("events").select(C.normalize_units(text).alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))


@query("map_values", """
    SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4-NONE' ELSE o_orderpriority END AS priority, count(*) AS n
    FROM orders GROUP BY 1""")
def map_values(read, spark):
    padded = F.concat("o_orderpriority", F.lit(" "))
    mapped = C.map_values(padded, {"4-NOT SPECIFIED": "4-NONE"})
    return read("orders").groupBy(mapped.alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("convert_units", """
    SELECT p_partkey, round(p_retailprice * 0.0283495, 9) AS weight_kg FROM part""")
def convert_units(read, spark):
    return read("part").select("p_partkey", F.round(C.ounces_to_kg(F.col("p_retailprice")), 9).alias("weight_kg"))


@query("flag_capped", """
    SELECT capped, count(*) AS n FROM (
      SELECT CASE WHEN p_size < 45 THEN p_size = 40 END AS capped FROM part) GROUP BY capped""")
def flag_capped(read, spark):
    known = F.when(F.col("p_size") < 45, F.col("p_size"))
    return read("part").groupBy(C.flag_capped(known, 40).alias("capped")).agg(F.count(F.lit(1)).alias("n"))


@query("flag_pattern", """
    SELECT c_custkey, regexp_matches(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey || 'E+15' ELSE c_name END, '[Ee][+-]') AS mangled
    FROM customer""")
def flag_pattern(read, spark):
    text = F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.col("c_custkey").cast("string"), F.lit("E+15"))).otherwise(F.col("c_name"))
    return read("customer").select("c_custkey", C.flag_pattern(text).alias("mangled"))


@query("null_out", """
    SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') THEN c_acctbal END AS c_acctbal FROM customer""")
def null_out(read, spark):
    balance = C.null_out(F.col("c_acctbal"), F.col("c_mktsegment"), ["MACHINERY", "FURNITURE"])
    return read("customer").select("c_custkey", balance.alias("c_acctbal"))


@query("null_sentinel", """
    SELECT event_type, count(*) FILTER (v = 9999999.0) AS n_sentinel, round(avg(CASE WHEN v <> 9999999.0 THEN v END), 6) AS mean_value
    FROM (SELECT event_type, CASE WHEN value > 20 THEN 9999999.0 ELSE value END AS v FROM events) GROUP BY event_type""")
def null_sentinel(read, spark):
    marked = read("events").withColumn("v", F.when(F.col("value") > 20, F.lit(C.LAB_SENTINEL)).otherwise(F.col("value")))
    return marked.groupBy("event_type").agg(
        F.count_if(C.flag_sentinel(F.col("v"))).alias("n_sentinel"), F.round(F.avg(C.null_sentinel(F.col("v"))), 6).alias("mean_value")
    )


@query("null_placeholder_code", """
    SELECT c_mktsegment, count(CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1 END) AS n_codes, count(*) AS n
    FROM customer GROUP BY c_mktsegment""")
def null_placeholder_code(read, spark):
    code = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(C.PLACEHOLDER_CODE)).otherwise(F.col("c_mktsegment"))
    return read("customer").groupBy("c_mktsegment").agg(
        F.count(C.null_placeholder_code(code)).alias("n_codes"), F.count(F.lit(1)).alias("n")
    )


@query("strip_prefix", """
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1""")
def strip_prefix(read, spark):
    text = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("0 "), "o_orderstatus")).otherwise(F.col("o_orderstatus"))
    return read("orders").groupBy(C.strip_prefix(text).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("classify_code", """
    SELECT system, count(*) AS n FROM (
      SELECT CASE WHEN regexp_matches(code, '^[0-9]{5}$') THEN 'CPT' WHEN regexp_matches(code, '^[0-9]{4}T$') THEN 'CPT III'
                  WHEN regexp_matches(code, '^[A-V][0-9]{4}$') THEN 'HCPCS II'
                  WHEN regexp_matches(code, '^[0-9A-HJ-NP-Z]{7}$') THEN 'ICD-10-PCS'
                  WHEN regexp_matches(code, '^[A-Z][0-9][0-9AB](\\.[0-9A-Z]{1,4})?$') THEN 'ICD-10-CM' ELSE 'other' END AS system
      FROM (SELECT upper(CASE p_type WHEN 'ECONOMY' THEN lpad(CAST(p_partkey AS STRING), 5, '1')
                   WHEN 'SMALL' THEN lpad(CAST(p_size AS STRING), 4, '0') || 't' WHEN 'LARGE' THEN 'j' || lpad(CAST(p_size AS STRING), 4, '0')
                   WHEN 'MEDIUM' THEN 'E' || lpad(CAST(p_size AS STRING), 2, '1') || '.' || p_size
                   WHEN 'STANDARD' THEN '0HDAX' || lpad(CAST(p_size AS STRING), 2, 'Z') ELSE p_brand END) AS code FROM part))
    GROUP BY system""")
def classify_code(read, spark):
    size, kind = F.col("p_size").cast("string"), F.col("p_type")
    code = (
        F.when(kind == "ECONOMY", F.lpad(F.col("p_partkey").cast("string"), 5, "1"))
        .when(kind == "SMALL", F.concat(F.lpad(size, 4, "0"), F.lit("t")))
        .when(kind == "LARGE", F.concat(F.lit("j"), F.lpad(size, 4, "0")))
        .when(kind == "MEDIUM", F.concat(F.lit("E"), F.lpad(size, 2, "1"), F.lit("."), size))
        .when(kind == "STANDARD", F.concat(F.lit("0HDAX"), F.lpad(size, 2, "Z")))
        .otherwise(F.col("p_brand"))
    )
    return read("part").groupBy(C.classify_code(code).alias("system")).agg(F.count(F.lit(1)).alias("n"))


@query("drop_rows", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE NOT ((o_orderstatus = 'F' AND o_orderpriority = '5-LOW') OR (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
      OR (o_orderstatus = 'P' AND o_orderpriority = 'none'))""")
def drop_rows(read, spark):
    """The last listed pair does not exist and removes nothing."""
    listed = [("F", "5-LOW"), ("O", "1-URGENT"), ("P", "none")]
    orders = read("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean.drop_rows(orders, listed, ["o_orderstatus", "o_orderpriority"])


@query("drop_rows_by_table", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def drop_rows_by_table(read, spark):
    bad = read("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return read("orders").select("o_orderkey", "o_custkey").join(bad, "o_custkey", "left_anti")


@query("drop_constant_columns", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def drop_constant_columns(read, spark):
    df = read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return clean.drop_constant_columns(df.withColumns({"enc": F.lit("Hospital Encounter"), "empty": F.lit(None).cast("string")}))


@query("drop_truncated_rows", """
    SELECT o_orderstatus AS code, o_orderstatus || '-Final Diagnosis' AS label, count(*) AS n
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') GROUP BY 1, 2""")
def drop_truncated_rows(read, spark):
    """Records cut off in mid-word: label shortened and every dependent column empty."""
    cut = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    records = read("orders").select(
        F.col("o_orderstatus").alias("code"),
        F.when(cut, F.concat("o_orderstatus", F.lit("-Final Di"))).otherwise(F.concat("o_orderstatus", F.lit("-Final Diagnosis"))).alias("label"),
        F.when(~cut, F.col("o_orderpriority")).alias("name"), F.when(~cut, F.col("o_totalprice")).alias("price"),
    )
    return clean.drop_truncated_rows(records, "code", "label", ["name", "price"]).groupBy("code", "label").agg(F.count(F.lit(1)).alias("n"))
