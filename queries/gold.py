"""Labels and features."""

from pyspark.sql import functions as F

from chartmill.operators import aggregate, gold, running
from queries.base import query
from queries.linkage import _signup_windows


@query("real_complications", """
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' GROUP BY 1""")
def real_complications(read, spark):
    kept = gold.real_complications(read("orders"), "o_orderpriority", "o_orderstatus", "5-LOW", "F")
    return aggregate.top_groups(kept, ["o_orderpriority"])


@query("label_from_code", "SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent FROM orders")
def label_from_code(read, spark):
    labelled = gold.label_from_code(read("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"], "urgent")
    return labelled.select("o_orderkey", "urgent")


@query("composite_label", """
    SELECT o_orderkey, count(l_orderkey) > 0 AS any_class, coalesce(bool_or(l_returnflag = 'A'), false) AS "is_A",
           coalesce(bool_or(l_returnflag = 'R'), false) AS "is_R"
    FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'N') ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def composite_label(read, spark):
    lines = gold.real_complications(read("lineitem"), "l_returnflag", "l_linestatus", "N", "F").withColumnRenamed("l_orderkey", "o_orderkey")
    return gold.composite_label(read("orders").select("o_orderkey"), lines, "o_orderkey", "l_returnflag", ["A", "R"])


@query("rise_label", """
    WITH w AS (SELECT user_id, min(ts) AS start_ts, min(ts) + INTERVAL 3 DAY AS stop_ts FROM events WHERE event_type = 'signup' GROUP BY user_id),
    j AS (SELECT w.user_id, arg_max(value, (ts, value)) FILTER (ts < start_ts) AS baseline,
                 max(value) FILTER (ts > stop_ts AND ts <= stop_ts + INTERVAL 2 DAY) AS peak
          FROM w LEFT JOIN events USING (user_id) GROUP BY w.user_id)
    SELECT *, CASE WHEN peak - baseline >= 5.0 OR peak >= baseline * 1.5 THEN true
                   WHEN peak IS NULL OR baseline IS NULL THEN NULL ELSE false END AS risen FROM j""")
def rise_label(read, spark):
    events = read("events").select("user_id", "ts", "value")
    windows = _signup_windows(read("events"), 3)
    return gold.rise_label(events, windows, "user_id", "ts", "value", "start_ts", "stop_ts", 2 * 86400, 5.0, 1.5).drop("start_ts", "stop_ts")


@query("breach_ahead", """
    WITH s AS (SELECT user_id, ts, event_id, value, CASE WHEN value > 30 THEN epoch_us(ts) END AS b, epoch_us(ts) AS t FROM events),
    n AS (SELECT *, min(b) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nb FROM s)
    SELECT event_id, user_id, ts, value, coalesce(nb - t <= 7200000000, false) AS breach_ahead FROM n""")
def breach_ahead(read, spark):
    readings = read("events").select("event_id", "user_id", "ts", "value")
    return gold.threshold_breach_ahead(readings, ["user_id"], "ts", "value", 30.0, 7200, below=False).drop("next_breach")


@query("repeat_event", """
    SELECT o_orderkey, o_custkey, o_orderdate, n IS NOT NULL AS returns, date_diff('day', o_orderdate, n) AS days_to_next
    FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)""")
def repeat_event(read, spark):
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return gold.repeat_event(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("history_features", """
    SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER w - 1 AS prior_events,
           date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS days_since_previous
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def history_features(read, spark):
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return gold.history_features(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("leakage_window", """
    WITH c AS (SELECT user_id, min(ts) AS cutoff FROM events WHERE event_type = 'purchase' GROUP BY 1),
    f AS (SELECT e.user_id, count(*) AS n_before, CAST(sum(round(value * 100)) AS BIGINT) AS hundredths, max(ts) AS last_ts
          FROM events e JOIN c USING (user_id) WHERE ts < cutoff GROUP BY 1)
    SELECT * FROM c LEFT JOIN f USING (user_id)""")
def leakage_window(read, spark):
    events = read("events")
    cutoffs = events.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("cutoff"))
    measures = {
        "n_before": running.count(), "hundredths": running.total(F.round(F.col("value") * 100).cast("bigint")),
        "last_ts": running.greatest(F.col("ts")),
    }
    return gold.leakage_window(events.select("user_id", "ts", "value"), cutoffs, "user_id", "ts", "cutoff", measures)


@query("phase_fallback", """
    SELECT phase, count(*) AS n FROM (
      SELECT coalesce(CASE WHEN event_type = 'click' THEN 'INTRA-OP' END,
             CASE WHEN ts < start_ts THEN 'PRE-OP' WHEN ts > stop_ts THEN 'POST-OP' WHEN ts BETWEEN start_ts AND stop_ts THEN 'INTRA-OP' END) AS phase
      FROM events LEFT JOIN (SELECT user_id, min(ts) AS start_ts, min(ts) + INTERVAL 5 DAY AS stop_ts FROM events WHERE event_type = 'signup'
                             GROUP BY user_id) USING (user_id)) GROUP BY phase""")
def phase_fallback(read, spark):
    from chartmill.operators.linkage import attach_attributes

    timed = attach_attributes(
        read("events").select("user_id", "ts", "event_type"), _signup_windows(read("events"), 5), "user_id", ["start_ts", "stop_ts"]
    )
    recorded = F.when(F.col("event_type") == "click", F.lit("INTRA-OP"))
    phase = gold.phase_fallback(recorded, F.col("ts"), F.col("start_ts"), F.col("stop_ts"))
    return timed.groupBy(phase.alias("phase")).agg(F.count(F.lit(1)).alias("n"))


@query("wide_features", """
    SELECT user_id, """ + ", ".join(
    f"count(value) FILTER (event_type = '{t}') AS {t}_n, max(value) FILTER (event_type = '{t}') AS {t}_max, "
    f"arg_max(value, (ts, value)) FILTER (event_type = '{t}') AS {t}_last" for t in ("click", "view")) + """
    FROM events GROUP BY user_id""")
def wide_features(read, spark):
    summary = aggregate.summary_by_group(read("events"), ["user_id", "event_type"], "value", "ts")
    wide = gold.wide_features(summary, ["user_id"], "event_type", ["click", "view"], ["n", "max", "last"])
    return wide.fillna(0, ["click_n", "view_n"])


@query("exposure_flag", """
    WITH w AS (SELECT user_id, min(ts) AS start_ts, min(ts) + INTERVAL 2 DAY AS stop_ts FROM events WHERE event_type = 'signup' GROUP BY user_id)
    SELECT w.user_id, start_ts, stop_ts, coalesce(bool_or(event_type = 'purchase'), false) AS exposed_purchase,
           coalesce(bool_or(event_type = 'error'), false) AS exposed_error
    FROM w LEFT JOIN events e ON e.user_id = w.user_id AND ts BETWEEN start_ts AND stop_ts GROUP BY ALL""")
def exposure_flag(read, spark):
    events = read("events")
    return gold.exposure_flag(
        _signup_windows(events, 2), events, "user_id", "ts", "start_ts", "stop_ts", ["purchase", "error"], "event_type"
    )


@query("attributable", """
    WITH f AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
    e AS (SELECT l_suppkey AS k, count(DISTINCT l_returnflag) AS m FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.08 GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS n_facts, CAST(coalesce(sum(n) FILTER (m = 1), 0) AS BIGINT) AS attributable_facts,
           count(*) FILTER (m = 1) AS single_encounter_entities,
           round(coalesce(sum(n) FILTER (m = 1), 0) / sum(n), 9) AS attributable_share FROM f LEFT JOIN e USING (k)""")
def attributable(read, spark):
    lines = read("lineitem")
    encounters = lines.where("l_quantity > 49 AND l_discount > 0.08").select("l_suppkey", "l_returnflag")
    share = gold.attributable(lines.select("l_suppkey"), encounters, "l_suppkey", "l_returnflag")
    return share.withColumn("attributable_share", F.round("attributable_share", 9))
