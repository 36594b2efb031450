"""Checkpoint sequences; one encounter is a user's day."""

from pyspark.sql import functions as F

from chartmill.operators import events as ev
from queries.base import query

TYPES = ["signup", "view", "click", "purchase"]
KEYS = ["user_id", "day"]

_PIVOT = """p AS (SELECT user_id, CAST(ts AS DATE) AS day, {} FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase')
    GROUP BY 1, 2)""".format(", ".join(f"min(ts) FILTER (event_type = '{t}') AS {t}" for t in TYPES))
_STEPS = list(zip(TYPES[:-1], TYPES[1:]))


def _pivot(read):
    days = read("events").withColumn("day", F.to_date("ts"))
    return ev.first_occurrence_pivot(days, KEYS, "event_type", "ts", TYPES)


@query("first_occurrence_pivot", f"WITH {_PIVOT} SELECT CAST(day AS STRING) AS day, * EXCLUDE (day) FROM p")
def first_occurrence_pivot(read, spark):
    return _pivot(read).withColumn("day", F.col("day").cast("string"))


@query("step_gaps", f"WITH {_PIVOT}, " + "g AS (" + " UNION ALL ".join(
    f"SELECT {i} AS step_no, '{a} -> {b}' AS step, (epoch_us({b}) - epoch_us({a})) / 60000000.0 AS m FROM p"
    for i, (a, b) in enumerate(_STEPS, start=1)) + """)
    SELECT step_no, step, count(m) AS n, round(median(m), 6) AS median_minutes, round(avg(m), 6) AS mean_minutes FROM g
    WHERE m IS NOT NULL GROUP BY step_no, step""")
def step_gaps(read, spark):
    gaps = ev.step_gaps(_pivot(read), TYPES)
    return gaps.withColumns({name: F.round(name, 6) for name in ("median_minutes", "mean_minutes")})


_CHAIN = " AND ".join(f"{a} <= {b}" for a, b in _STEPS)
_COMPLETE = " AND ".join(f"{t} IS NOT NULL" for t in TYPES)


@query("order_violations", f"WITH {_PIVOT} " + " UNION ALL ".join(
    [f"""SELECT 0 AS step_no, 'complete chain' AS step, count(*) FILTER ({_COMPLETE}) AS n, count(*) FILTER ({_COMPLETE} AND NOT ({_CHAIN})) AS violations,
    round(1.0 - violations / nullif(n, 0), 9) AS share_in_order FROM p"""]
    + [f"""SELECT {i}, '{a} -> {b}', count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, count(*) FILTER ({b} < {a}) AS v,
    round(1.0 - v / nullif(n, 0), 9) FROM p""" for i, (a, b) in enumerate(_STEPS, start=1)]))
def order_violations(read, spark):
    return ev.order_violations(_pivot(read), TYPES).withColumn("share_in_order", F.round("share_in_order", 9))


@query("violation_rate_by", f"""WITH {_PIVOT}
    SELECT CAST(dayofweek(day) + 1 AS INT) AS weekday, count(*) FILTER (view IS NOT NULL AND click IS NOT NULL) AS n,
           count(*) FILTER (click < view) AS n_true,
           round(count(*) FILTER (click < view) / nullif(count(*) FILTER (view IS NOT NULL AND click IS NOT NULL), 0), 9) AS rate
    FROM p GROUP BY 1""")
def violation_rate_by(read, spark):
    pivot = _pivot(read).withColumn("weekday", F.dayofweek("day"))
    return ev.violation_rate_by(pivot, "view", "click", ["weekday"]).withColumn("rate", F.round("rate", 9))


@query("repeated_checkpoints", """
    SELECT event_type, count(*) AS n, count(*) FILTER (t > 1) AS n_true, round(avg(CAST(t > 1 AS INT)), 9) AS rate
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(DISTINCT ts) AS t FROM events GROUP BY ALL) GROUP BY event_type""")
def repeated_checkpoints(read, spark):
    days = read("events").withColumn("day", F.to_date("ts"))
    return ev.repeated_checkpoints(days, KEYS, "event_type", "ts").withColumn("rate", F.round("rate", 9))


@query("relative_order", """
    WITH p AS (SELECT o_custkey, min(o_orderdate) FILTER (o_orderstatus = 'F') AS f, min(o_orderdate) FILTER (o_orderstatus = 'O') AS o
               FROM orders GROUP BY 1),
    b AS (SELECT * FROM p WHERE f IS NOT NULL AND o IS NOT NULL)
    SELECT count(*) AS n, count(*) FILTER (o = f) AS n_equal, count(*) FILTER (o > f) AS n_after, count(*) FILTER (o < f) AS n_before,
           round(count(*) FILTER (o = f) / count(*), 9) AS share_equal, round(count(*) FILTER (o > f) / count(*), 9) AS share_after,
           round(count(*) FILTER (o < f) / count(*), 9) AS share_before FROM b""")
def relative_order(read, spark):
    pivot = ev.first_occurrence_pivot(read("orders"), ["o_custkey"], "o_orderstatus", "o_orderdate", ["F", "O"])
    shares = ev.relative_order(pivot, "F", "O")
    return shares.withColumns({name: F.round(name, 9) for name in ("share_equal", "share_after", "share_before")})


@query("exclude_autoclosed", """
    WITH p AS (SELECT o_custkey, min(o_orderdate) FILTER (o_orderstatus = 'F') AS f, min(o_orderdate) FILTER (o_orderstatus = 'O') AS o
               FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1)
    SELECT * FROM p WHERE NOT coalesce(abs((epoch_us(o) - epoch_us(f)) / 60000000.0 - 43200) <= 14400, false)""")
def exclude_autoclosed(read, spark):
    """Gaps of about thirty days stand for the system's timeout."""
    pivot = ev.first_occurrence_pivot(read("orders"), ["o_custkey"], "o_orderstatus", "o_orderdate", ["F", "O"])
    kept = ev.exclude_autoclosed(pivot, "F", "O", minutes=43200.0, tolerance=14400.0)
    return kept.withColumnsRenamed({"F": "f", "O": "o"})


@query("exposure_actions", """
    SELECT CASE event_type WHEN 'purchase' THEN 'exposure' WHEN 'view' THEN 'logistics' WHEN 'click' THEN 'logistics' ELSE 'unclassified' END
           AS action_class, count(*) AS n FROM events GROUP BY 1""")
def exposure_actions(read, spark):
    classes = spark.createDataFrame([("purchase", "exposure"), ("view ", "logistics"), ("click", "logistics")], "action string, action_class string")
    return ev.exposure_actions(read("events"), "event_type", classes).groupBy("action_class").agg(F.count(F.lit(1)).alias("n"))


@query("case_duration", f"""WITH {_PIVOT}
    SELECT user_id, CAST(day AS STRING) AS day, (epoch_us(purchase) - epoch_us(signup)) / CAST(60000000 AS DOUBLE) AS whole_minutes,
           (epoch_us(click) - epoch_us(view)) / CAST(60000000 AS DOUBLE) AS browse_minutes FROM p""")
def case_duration(read, spark):
    timed = ev.case_duration(_pivot(read), {"whole": ("signup", "purchase"), "browse": ("view", "click")})
    return timed.select("user_id", F.col("day").cast("string").alias("day"), "whole_minutes", "browse_minutes")
