"""Timelines, lookups and labels over tables with missing and repeated keys, with and without cutting.

Each query runs twice, as if no key and as if nearly every key were hot, and the results must agree
with the same SQL.
"""

from pyspark.sql import functions as F

from chartmill.operators import dedup, gold, linkage, running, skew
from queries.base import query

_EVENTS = "e AS (SELECT event_id, ts, event_type, value, CASE WHEN user_id % 4 > 0 THEN user_id END AS who FROM events)"
# At most so many rows in a part: nearly every key is hot.
FEW = {"hot_rows": 2}


def events_of(read):
    who = F.when(F.col("user_id") % 4 > 0, F.col("user_id"))
    return read("events").select("event_id", "ts", "event_type", "value", who.alias("who"))


def both_ways(name, sql):
    """Register a query of one keyword argument, ``cutting``, at the default and at a small part size."""

    def register(function):
        query(name, sql)(lambda read, spark: function(read, {}))
        query(f"{name}_cut", sql)(lambda read, spark: function(read, FEW))
        return function

    return register


@both_ways("blocks_without_key", f"""
    WITH {_EVENTS}, s AS (SELECT *, CAST(event_type IS DISTINCT FROM lag(event_type) OVER w AS INT) AS st FROM e
                          WINDOW w AS (PARTITION BY who ORDER BY ts, event_id)),
    r AS (SELECT *, sum(st) OVER (PARTITION BY who ORDER BY ts, event_id) AS run FROM s)
    SELECT who, CAST(run AS BIGINT) AS run, event_type, min(ts) AS block_start, max(ts) AS block_end, count(*) AS block_length
    FROM r GROUP BY who, run, event_type""")
def blocks(read, cutting):
    return dedup.duplicate_blocks(events_of(read), ["who"], "event_type", ["ts", "event_id"], **cutting)


@both_ways("history_without_key", f"""
    WITH {_EVENTS} SELECT event_id, who, row_number() OVER w - 1 AS prior_events, date_diff('day', lag(ts) OVER w, ts) AS days_since_previous
    FROM e WINDOW w AS (PARTITION BY who ORDER BY ts, event_id)""")
def history(read, cutting):
    rows = gold.history_features(events_of(read).select("event_id", "who", "ts"), ["who"], ["ts", "event_id"], **cutting)
    return rows.drop("ts")


@both_ways("return_without_key", f"""
    WITH {_EVENTS} SELECT event_id, who, lead(ts) OVER w IS NOT NULL AS returns, date_diff('day', ts, lead(ts) OVER w) AS days_to_next
    FROM e WINDOW w AS (PARTITION BY who ORDER BY ts, event_id)""")
def returns(read, cutting):
    return gold.repeat_event(events_of(read).select("event_id", "who", "ts"), ["who"], ["ts", "event_id"], **cutting).drop("ts")


@both_ways("breach_without_key", f"""
    WITH {_EVENTS}, n AS (SELECT *, epoch_us(ts) AS t, min(CASE WHEN value > 30 THEN epoch_us(ts) END) OVER
                          (PARTITION BY who ORDER BY epoch_us(ts) RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nb FROM e)
    SELECT event_id, who, value, coalesce(nb - t <= 7200000000, false) AS breach_ahead FROM n""")
def breaches(read, cutting):
    rows = events_of(read).select("event_id", "who", "ts", "value")
    return gold.threshold_breach_ahead(rows, ["who"], "ts", "value", 30.0, 7200, below=False, **cutting).drop("next_breach", "ts")


@both_ways("as_of_without_key", f"""
    WITH {_EVENTS} SELECT r.event_id, r.who, arg_max(s.value, (s.ts, s.value)) AS last_view
    FROM e r LEFT JOIN e s ON s.event_type = 'view' AND s.who = r.who AND s.ts < r.ts WHERE r.event_type = 'purchase' GROUP BY ALL""")
def last_views(read, cutting):
    rows = events_of(read)
    refs = rows.where("event_type = 'purchase'").select("event_id", "who", "ts")
    series = rows.where("event_type = 'view'").select("who", F.col("ts").alias("seen"), "value")
    return linkage.as_of(refs, series, ["who"], "ts", "seen", "value", "last_view", **cutting).drop("ts")


_CUTS = "c AS (SELECT DISTINCT who, ts AS cutoff FROM e WHERE event_type = 'signup')"


def hot_of(facts, cutting):
    return skew.hot_keys(facts, ["who"], cutting["hot_rows"]) if cutting else None


@both_ways("leakage_repeated_key", f"""
    WITH {_EVENTS}, {_CUTS}
    SELECT who, cutoff, n_before, last_ts FROM c LEFT JOIN (
      SELECT c.who, cutoff, count(*) AS n_before, max(ts) AS last_ts FROM c JOIN e ON e.who = c.who AND ts < cutoff GROUP BY ALL) f USING (who, cutoff)""")
def leakage(read, cutting):
    rows = events_of(read)
    cuts = rows.where("event_type = 'signup'").select("who", F.col("ts").alias("cutoff")).distinct()
    measures = {"n_before": running.count(), "last_ts": running.greatest(F.col("ts"))}
    return gold.leakage_window(rows.select("who", "ts"), cuts, "who", "ts", "cutoff", measures, **cutting)


_HALVES = "h AS (SELECT user_id % 2 AS half, ts, value FROM events), c AS (SELECT DISTINCT user_id % 2 AS half, ts AS cutoff FROM events WHERE event_type = 'purchase')"


def halves(read):
    """Two entities with very many facts and cut-offs."""
    rows = read("events").select((F.col("user_id") % 2).alias("half"), "ts", "event_type", "value")
    cuts = rows.where("event_type = 'purchase'").select("half", F.col("ts").alias("cutoff")).distinct()
    return rows, cuts


@both_ways("leakage_many_cutoffs", f"""
    WITH {_HALVES}, u AS (
      SELECT half, ts, 1 AS side, value, NULL AS cutoff FROM h UNION ALL SELECT half, cutoff, 0, NULL, cutoff FROM c),
    r AS (SELECT half, cutoff, sum(side) OVER w AS n_before, max(value) OVER w AS greatest, min(value) OVER w AS least FROM u
          WINDOW w AS (PARTITION BY half ORDER BY ts, side ROWS UNBOUNDED PRECEDING))
    SELECT half, cutoff, CAST(nullif(n_before, 0) AS BIGINT) AS n_before, greatest, least FROM r WHERE cutoff IS NOT NULL""")
def many_cutoffs(read, cutting):
    rows, cuts = halves(read)
    value = F.col("value")
    measures = {"n_before": running.count(), "greatest": running.greatest(value), "least": running.least(value)}
    return gold.leakage_window(rows.select("half", "ts", "value"), cuts, "half", "ts", "cutoff", measures, **cutting)


@both_ways("exposure_many_windows", f"""
    WITH {_HALVES}, x AS (SELECT user_id % 2 AS half, ts, event_type FROM events)
    SELECT half, cutoff, EXISTS (FROM x WHERE x.half = c.half AND event_type = 'click' AND ts BETWEEN cutoff AND cutoff + INTERVAL 20 MINUTE) AS exposed_click,
      EXISTS (FROM x WHERE x.half = c.half AND event_type = 'signup' AND ts BETWEEN cutoff AND cutoff + INTERVAL 20 MINUTE) AS exposed_signup
    FROM c""")
def many_windows(read, cutting):
    rows, cuts = halves(read)
    windows = cuts.withColumn("until", F.col("cutoff") + F.expr("INTERVAL '20' MINUTE"))
    return gold.exposure_flag(windows, rows, "half", "ts", "cutoff", "until", ["click", "signup"], "event_type", **cutting).drop("until")


@both_ways("rise_repeated_key", f"""
    WITH {_EVENTS}, {_CUTS},
    j AS (SELECT c.who, cutoff AS start_ts, arg_max(value, (ts, value)) FILTER (ts < cutoff) AS baseline,
                 max(value) FILTER (ts > cutoff + INTERVAL 3 DAY AND ts <= cutoff + INTERVAL 5 DAY) AS peak
          FROM c LEFT JOIN e ON e.who = c.who GROUP BY ALL)
    SELECT *, CASE WHEN peak - baseline >= 5.0 OR peak >= baseline * 1.5 THEN true
                   WHEN peak IS NULL OR baseline IS NULL THEN NULL ELSE false END AS risen FROM j""")
def rises(read, cutting):
    rows = events_of(read)
    cases = rows.where("event_type = 'signup'").select("who", F.col("ts").alias("start_ts")).distinct()
    cases = cases.withColumn("stop_ts", F.col("start_ts") + F.expr("INTERVAL '3' DAY"))
    found = gold.rise_label(rows.select("who", "ts", "value"), cases, "who", "ts", "value", "start_ts", "stop_ts", 2 * 86400, 5.0, 1.5, **cutting)
    return found.drop("stop_ts")


@both_ways("attach_repeated_key", f"""
    WITH {_EVENTS}, v AS (SELECT who, min(event_id) AS first_signup FROM e WHERE event_type = 'signup' GROUP BY who HAVING count(*) = 1)
    SELECT event_id, e.who, first_signup FROM e LEFT JOIN v ON e.who = v.who""")
def attached(read, cutting):
    rows = events_of(read)
    signups = rows.where("event_type = 'signup'").select("who", F.col("event_id").alias("first_signup"))
    return linkage.attach_attributes(rows.select("event_id", "who"), signups, "who", ["first_signup"], hot=hot_of(rows, cutting))
