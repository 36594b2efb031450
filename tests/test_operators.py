"""Operators on tiny frames, against brute force where order or skew matters."""

import datetime as dt
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from chartmill import session
from chartmill.functions import columns as C
from chartmill.operators import aggregate, clean, dedup, events, gold, linkage, quality, running, skew, timeline
from chartmill.sources import scans
from queries import layers

T0 = dt.datetime(2020, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def values(df, *names):
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def one_column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row.v for row in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


# --- column rules -------------------------------------------------------------------------------


def test_to_double(spark):
    texts = ["98.6", " -1.5e3 ", ".5", "5.", "5d", "5f", "NSR", "", None, "NaN", "1_000", "1,5", "+7", "0 NULL", "0x10"]
    assert one_column(spark, texts, C.to_double) == [98.6, -1500.0, 0.5, 5.0, None, None, None, None, None, None, None, None, 7.0, None, None]
    assert one_column(spark, ["inf", "-Infinity"], C.to_double) == [float("inf"), float("-inf")]


def test_to_long(spark):
    texts = ["12", "12.0", "12.5", "x", "9007199254740993", "99999999999999999999", "1e3", " 7 ", None, "inf"]
    assert one_column(spark, texts, C.to_long) == [12, 12, None, None, 9007199254740993, None, 1000, 7, None, None]


def test_to_timestamp(spark):
    texts = ["2019-03-07 16:42:00", "2019-03-07", "3/7/19 6:05", "3/7/2019", "not", None, "2020-02-30"]
    got = one_column(spark, texts, lambda c: C.to_timestamp(c, ["M/d/yy H:mm", "M/d/yyyy", "M/d/yy"]))
    assert got == [dt.datetime(2019, 3, 7, 16, 42), dt.datetime(2019, 3, 7), dt.datetime(2019, 3, 7, 6, 5), dt.datetime(2019, 3, 7), None, None, None]


def test_heights(spark):
    texts = ["5' 10", " 5' 7.325 ", "5'10\"", "5' 10\"", "", None, "5'  10", "5' 10."]
    got = one_column(spark, texts, C.parse_feet_inches)
    assert got[0] == 70.0 and abs(got[1] - 67.325) < 1e-9 and got[2:] == [None] * 6


def test_units(spark):
    texts = ["cmH20", "cmH2O", "l/min", " ml ", "mL", ',",4"', "a,b", None, "mmHg "]
    assert one_column(spark, texts, C.normalize_units) == ["cmH2O", "cmH2O", "L/min", "mL", "mL", None, None, None, "mmHg"]


def test_code_shapes(spark):
    texts = ["99213", "0071T", "A4253", "g0108", "E11.649", "J45", "0QS604Z", "3E0T3CZ", "M17.11", "??", None, "414.01"]
    assert one_column(spark, texts, C.classify_code) == [
        "CPT", "CPT III", "HCPCS II", "HCPCS II", "ICD-10-CM", "ICD-10-CM", "ICD-10-PCS", "ICD-10-PCS", "ICD-10-CM", "other", None, "other"]


def test_small_text_rules(spark):
    assert one_column(spark, ["0 Dispensed", "Dispensed", "00 x", None], C.strip_prefix) == ["Dispensed", "Dispensed", "00 x", None]
    assert one_column(spark, ["IMO0001", "250", None], C.null_placeholder_code) == [None, "250", None]
    assert one_column(spark, ["NA", "", "nan", " NA", "x", None], lambda c: C.null_tokens(c, ["NA", "", "nan"])) == [None, None, None, " NA", "x", None]
    assert one_column(spark, ["00ab00ab00ab00ab", "6.13E+15", "x"], C.id_format) == ["hex16", "scientific", "other"]
    assert one_column(spark, ["a", "b", None], lambda c: C.map_values(c, {"a": "z"})) == ["z", "b", None]


def test_mixed_values_and_census(spark):
    df = spark.createDataFrame([("98.6",), ("NSR",), (None,), ("7",)], "v string")
    assert aggregate.mixed_type_check(df, "v").first().asDict() == {"n_numeric": 2, "n_text": 1, "n_null": 1}


# --- cleaning -----------------------------------------------------------------------------------


def test_drop_rows_ignores_nulls_and_takes_long_lists(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "k string, e string")
    assert values(clean.drop_rows(df, [("a", "x"), ("c", None)], ["k", "e"]), "k", "e") == [("a", None), ("b", "x")]
    assert clean.drop_rows(df, [(str(i), "x") for i in range(20_000)] + [("b", "x")], ["k", "e"]).count() == 2


def test_constant_and_truncated(spark):
    df = spark.createDataFrame([(1, "c", None, None), (2, "c", "x", None)], "a int, b string, m string, n string")
    assert clean.constant_columns(df) == ["b", "n"]
    rows = [(3, "Final Diagnosis", "x")] * 3 + [(3, "Final Di", None), (3, "Final Di", "x"), (3, "Finally", None), (4, "Final Di", None), (None, "Fin", None)]
    records = spark.createDataFrame(rows, "code int, label string, name string")
    kept = values(clean.drop_truncated_rows(records, "code", "label", ["name"]), "code", "label", "name")
    assert len(kept) == 7 and (3, "Final Di", None) not in kept and (4, "Final Di", None) in kept


# --- duplicates ---------------------------------------------------------------------------------


def brute_classes(rows):
    """rows: (key, entity, attribute) with copies."""
    groups = {}
    for row, n in Counter(rows).items():
        groups.setdefault(row[0], []).append((row, n))
    out = []
    for members in groups.values():
        entities = {r[1] for r, _ in members if r[1] is not None}
        facts = {r[2] for r, _ in members}
        several = len(members) > 1
        if several and len(entities) > 1 and len(facts) == 1:
            out.append((*min((r for r, _ in members if r[1] is not None), key=lambda r: r[1]), False, False, sum(n for _, n in members)))
            continue
        collision = several and len(entities) > 1
        out += [(*r, collision, several and not collision, n) for r, n in members]
    return out


def test_rows_without_a_key_stay_as_they_are(spark):
    df = spark.createDataFrame([(None, "p", 1), (None, "q", 1), (None, "q", 2), (1, "q", 5), (1, "p", 5), (1, None, 5)], "k int, e string, a int")
    got = dedup.classify_duplicates(df, ["k"], "e", ["a"]).collect()
    assert sorted((str(r.k), r.e, r.a, r.is_collision, r.is_conflict, r.n_occurrences) for r in got) == [
        ("1", "p", 5, False, False, 3), ("None", "p", 1, False, False, 1), ("None", "q", 1, False, False, 1), ("None", "q", 2, False, False, 1)]


def operators_of(df):
    """How often each operator occurs in the plan as it was run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return Counter(re.findall(r"[A-Z][A-Za-z]+", text))


def test_duplicates_are_classified_in_one_scan_by_hash(spark, tmp_path):
    spark.range(4000).selectExpr("id % 900 AS k", "concat('e', id % 7) AS e", "id % 5 AS a", "concat('b', id % 3) AS b").write.parquet(f"{tmp_path}/t")
    plan = operators_of(dedup.classify_duplicates(spark.read.parquet(f"{tmp_path}/t"), ["k"], "e", ["a", "b"]))
    assert plan["FileScan"] == 1 and not plan["SortAggregate"] and plan["ReusedExchange"] >= 1
    first = operators_of(dedup.keep_first(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["b", "a"]))
    assert first["WindowGroupLimit"] == 2 and not first["SortAggregate"] and first["Exchange"] == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["p", "q", None]), st.sampled_from([1, 2, None])), min_size=1, max_size=30))
def test_classify_duplicates(spark, rows):
    df = spark.createDataFrame(rows, "k int, e string, a int")
    got = dedup.classify_duplicates(df, ["k"], "e", ["a"]).collect()
    order = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted(brute_classes(rows), key=order)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), min_size=1, max_size=40), st.integers(1, 5))
def test_collapse_keeps_every_row_counted(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k int, v string").repartition(partitions)
    once = dedup.collapse_count(df, ["k", "v"])
    assert Counter({(r.k, r.v): r.n_occurrences for r in once.collect()}) == Counter(rows)
    again = dedup.collapse_count(once.drop("n_occurrences"), ["k", "v"])
    assert again.where("n_occurrences <> 1").isEmpty()
    assert quality.reconcile_multiplicity(df, once).first().matches


def test_keep_first_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (1, 5, None), (2, None, None)], "k int, a int, b string")
    assert values(dedup.keep_first(df, ["k"], ["a", "b"]), "k", "a", "b") == [(1, 5, "y"), (2, None, None)]
    assert values(dedup.keep_first(df, ["k"], ["a"]), "k", "a") == [(1, 5), (2, None)]


def test_audit_without_duplicates(spark):
    row = dedup.duplicate_audit(spark.range(5), ["id"]).first()
    assert (row.n_rows, row.rows_in_duplicates, row.duplicate_groups, row.max_group, row.median_group) == (5, 0, 0, None, None)


def test_divergence_counts_a_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 1), (2, "a", 1), (2, "b", 1), (3, None, 1), (3, None, 1)], "k int, c string, d int")
    got = {r.column: (r.diverging_groups, r.groups) for r in dedup.key_divergence(df, ["k"], ["c", "d"]).collect()}
    assert got == {"c": (2, 3), "d": (0, 3), "any": (2, 3)}


def test_dose_total_ignores_multiplicity(spark):
    df = spark.createDataFrame([("e", 5.0)] * 3 + [("e", 2.0)], "e string, dose double")
    assert aggregate.safe_total(dedup.collapse_count(df), ["e"], "dose").first().total == 7.0


def test_merge_impact_looks_at_the_full_key(spark):
    df = spark.createDataFrame([("p", "x"), ("q", "x "), ("q", "x"), ("r", "y")], "k string, v string")
    row = dedup.merge_impact(df, ["k", "v"], {"v": F.trim("v")}).first()
    assert (row.n_rows, row.keys_before, row.keys_after, row.keys_merged) == (4, 4, 3, 1)


# --- timelines ----------------------------------------------------------------------------------


def random_timeline(seed, n=200, entities=3):
    rng = random.Random(seed)
    return [
        (rng.randrange(entities), at(rng.choice([rng.randrange(600), rng.randrange(20), None])), i, rng.choice("abc"), rng.choice([None, rng.randrange(50)]))
        for i in range(n)
    ]


def ordered(rows, entity):
    return sorted((r for r in rows if r[0] == entity), key=lambda r: (r[1] is None, r[1] or T0, r[2]))


@pytest.mark.parametrize("seed, hot_rows", [(60, 1), (61, 7), (3600, 65), (3600, 1_000_000)])
def test_timeline_steps_match_brute_force(spark, seed, hot_rows):
    """All entities cut, some of them, none."""
    rows = random_timeline(seed) + [(None, at(5), 1000 + i, "a", i) for i in range(3)]
    cutting = {"hot_rows": hot_rows}
    df = spark.createDataFrame(rows, "e int, ts timestamp_ntz, id int, label string, v int").repartition(5)
    order = ["ts", "id"]
    previous = {r.id: r.p.id if r.p else None for r in timeline.neighbour(df, ["e"], order, ["id"], "p", **cutting).collect()}
    following = {r.id: r.p.id if r.p else None for r in timeline.neighbour(df, ["e"], order, ["id"], "p", True, **cutting).collect()}
    numbers = {r.id: r.position for r in timeline.position(df, ["e"], order, **cutting).collect()}
    known = {r.id: r.k for r in timeline.last_known(df, ["e"], order, "v", "k", **cutting).collect()}
    runs = {r.id: r.run for r in timeline.runs(df, ["e"], "label", order, **cutting).collect()}
    upcoming = {r.id: r.n for r in timeline.next_time(df, ["e"], "ts", F.col("label") == "a", "n", **cutting).collect()}
    assert len(previous) == len(numbers) == len(runs) == len(upcoming) == len(rows)
    for entity in [0, 1, 2, None]:
        line = ordered(rows, entity)
        last, run = None, 0
        for i, row in enumerate(line):
            assert previous[row[2]] == (line[i - 1][2] if i else None)
            assert following[row[2]] == (line[i + 1][2] if i + 1 < len(line) else None)
            assert numbers[row[2]] == i + 1
            last = row[4] if row[4] is not None else last
            assert known[row[2]] == last
            run += i == 0 or row[3] != line[i - 1][3]
            assert runs[row[2]] == run
            later = [r[1] for r in line if r[3] == "a" and r[1] is not None and row[1] is not None and r[1] > row[1]]
            if row[1] is not None:
                assert upcoming[row[2]] == (min(later) if later else None)


@pytest.mark.parametrize("strict", [True, False])
def test_as_of(spark, strict):
    rng = random.Random(5)
    refs = [(i, rng.randrange(2), at(rng.randrange(300))) for i in range(40)]
    series = [(rng.randrange(2), at(rng.randrange(300)), float(rng.randrange(9))) for _ in range(80)]
    got = {r.id: r.found for r in linkage.as_of(
        spark.createDataFrame(refs, "id int, e int, t timestamp_ntz"), spark.createDataFrame(series, "e int, ts timestamp_ntz, v double"),
        ["e"], "t", "ts", "v", "found", strict, hot_rows=10).collect()}
    assert len(got) == 40
    for i, e, t in refs:
        past = [(ts, v) for se, ts, v in series if se == e and (ts < t or (not strict and ts == t))]
        assert got[i] == (max(past)[1] if past else None)


def moments(n, seed, entities=2, span=300):
    rng = random.Random(seed)
    return [(i, rng.choice([*range(entities), None]), at(rng.choice([rng.randrange(span), None] + [rng.randrange(span)] * 8)), rng.choice([None, 1.0, 2.0, float(rng.randrange(50))])) for i in range(n)]


@pytest.mark.parametrize("strict, hot_rows", [(True, 1_000_000), (True, 3), (False, 3), (False, 40)])
def test_measures_until_a_moment(spark, strict, hot_rows):
    refs, facts = moments(60, 1), moments(150, 2)
    df = spark.createDataFrame(facts, "id int, e int, ts timestamp_ntz, v double").repartition(4)
    asked = spark.createDataFrame([r[:3] for r in refs] + [refs[0][:3]], "id int, e int, t timestamp_ntz")
    v, ts = F.col("v"), F.col("ts")
    measures = {
        "n": running.count(), "known": running.count(v), "total": running.total(v), "mean": running.mean(v), "least": running.least(v),
        "greatest": running.greatest(v), "latest": running.latest(v, ts), "earliest": running.earliest(v, ts),
    }
    found = running.until(asked, df, ["e"], "t", "ts", measures, strict, hot_rows=hot_rows).collect()
    assert sorted(r.id for r in found) == sorted([r[0] for r in refs] + [0])
    by_id = {r[0]: r for r in refs}
    for row in found:
        _, e, t, _ = by_id[row.id]
        past = [f for f in facts if None not in (e, t, f[2]) and f[1] == e and (f[2] < t or (not strict and f[2] == t))]
        known = [f for f in past if f[3] is not None]
        values = [f[3] for f in known]
        assert tuple(row)[3:] == (
            len(past) or None, len(known) if past else None, sum(values) if known else None, pytest.approx(sum(values) / len(values)) if known else None,
            min(values, default=None), max(values, default=None), max((f[2], f[3]) for f in known)[1] if known else None,
            min((f[2], f[3]) for f in known)[1] if known else None,
        )


@pytest.mark.parametrize("seconds, hot_rows", [(600, 1_000_000), (600, 4), (7200, 4), (60, 1)])
def test_greatest_within(spark, seconds, hot_rows):
    refs, facts = moments(60, 3), moments(150, 4)
    df = spark.createDataFrame(facts, "id int, e int, ts timestamp_ntz, v double").repartition(4)
    asked = spark.createDataFrame([r[:3] for r in refs] + [refs[0][:3]], "id int, e int, t timestamp_ntz")
    found = running.greatest_within(asked, df, ["e"], "t", "ts", "v", seconds, "peak", hot_rows=hot_rows).collect()
    assert sorted(r.id for r in found) == sorted([r[0] for r in refs] + [0])
    for row in found:
        e, t = row.e, row.t
        ahead = [f[3] for f in facts if None not in (e, t, f[2], f[3]) and f[1] == e and t < f[2] <= t + dt.timedelta(seconds=seconds)]
        assert row.peak == max(ahead, default=None)


def test_a_thousand_cutoffs_on_one_key(spark):
    facts = spark.range(3000).select(F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 1000).cast("timestamp_ntz").alias("ts"))
    cuts = spark.range(1000).select(F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 3000).cast("timestamp_ntz").alias("c"), (F.col("id") * 3).alias("n_true"))
    for hot_rows in (1_000_000, 100):
        plan = running.until(cuts, facts, ["k"], "c", "ts", {"n": running.count()}, hot_rows=hot_rows)
        assert plan.where("coalesce(n, 0) <> n_true").count() == 0 and plan.count() == 1000
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_slices_are_even_even_without_times(spark):
    """One entity whose rows have no time, or all the same: borders lie between the other columns of the order."""
    for time in ("NULL", "TIMESTAMP_NTZ'2020-01-01'"):
        df = spark.range(6000).selectExpr("1 AS e", f"cast({time} AS timestamp_ntz) AS ts", "id")
        sizes = [r[1] for r in timeline._cut(df, ["e"], ["ts", "id"], 500).groupBy(timeline.SLICE).count().collect()]
        assert len(sizes) == 12 and max(sizes) < 1000


def test_rows_are_not_joined_with_borders(spark):
    """A row is placed by looking borders up, not by meeting all borders of its entity in a join."""
    df = spark.range(100).selectExpr("id % 2 AS e", "id")
    plan = timeline._cut(df, ["e"], ["id"], 5)._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString() and "_borders" not in str(plan.output())


def test_divergence_of_fixed_width_columns_needs_no_hashes(spark):
    rows = [(1, 0.0, 1), (1, -0.0, None), (2, float("nan"), 4), (2, float("nan"), 4), (3, 1.0, 5), (3, 2.0, 5), (4, None, 6), (4, 1.0, 6), (5, 9.0, 9)]
    found = dedup.key_divergence(spark.createDataFrame(rows, "k int, x double, m long"), ["k"], ["x", "m"])
    assert {r.column: (r.diverging_groups, r.groups) for r in found.collect()} == {"x": (2, 4), "m": (1, 4), "any": (3, 4)}
    assert "xxhash64" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_splits_stay_small(spark):
    name, before = session.SPLIT, spark.conf.get(session.SPLIT)
    try:
        for given, kept in (("128m", str(16 << 20)), ("1m", "1m")):
            spark.conf.set(name, given)
            session.configure(spark)
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def test_export_moves_no_row_where_the_scan_has_parts_enough(spark):
    many, few = spark.range(0, 100, 1, 9), spark.range(0, 100, 1, 1)
    for rows, exactly, parts in ((many, True, 4), (many, False, 9), (few, True, 4), (few, False, 4)):
        out = layers.dealt(rows, 4, exactly)
        assert out.rdd.getNumPartitions() == parts
        assert ("Repartition 4, true" in out._jdf.queryExecution().optimizedPlan().toString()) == (rows is few)


def test_interval_join(spark):
    rng = random.Random(6)
    facts = [(i, rng.randrange(3), at(rng.randrange(5000))) for i in range(120)] + [(999, 0, None)]
    spans = [(rng.randrange(3), at(a), at(a + rng.randrange(-10, 4000))) for a in (rng.randrange(4000) for _ in range(12))] + [(0, None, at(9))]
    got = linkage.interval_join(
        spark.createDataFrame(facts, "id int, e int, ts timestamp_ntz"), spark.createDataFrame(spans, "e int, a timestamp_ntz, b timestamp_ntz"),
        "e", "ts", "a", "b", 3600)
    expected = sorted((i, a, b) for i, e, t in facts if t for se, a, b in spans if se == e and a and a <= t <= b)
    assert sorted((r.id, r.a, r.b) for r in got.collect()) == expected


# --- joins with hot keys ------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_plain_join(spark, how):
    rows = [(1, "copy")] * 50 + [(1, str(i)) for i in range(50)] + [(2, "x"), (3, "y"), (None, "z"), (None, "z")]
    facts = spark.createDataFrame(rows, "k int, v string").repartition(4)
    lookup = spark.createDataFrame([(1, "one"), (2, "two"), (9, "nine")], "k int, name string")
    hot = skew.hot_keys(facts, ["k"], min_rows=10)
    plain = Counter(tuple(r) for r in skew.join_attributes(facts, lookup, ["k"], how).select("k", "v", "name").collect())
    salted = skew.join_attributes(facts, lookup, ["k"], how, hot)
    assert Counter(tuple(r) for r in salted.select("k", "v", "name").collect()) == plain
    assert [r.k for r in hot.collect()] == [1]


def test_hot_key_is_spread(spark):
    facts = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    lookup = spark.createDataFrame([(1, "one")], "k int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.join_attributes(facts, lookup, ["k"], "left", skew.hot_keys(facts, ["k"], 100))
        counts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(counts) > 1 and max(row["count"] for row in counts) < 4000


def test_attach_leaves_ambiguous_encounters_out(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    encounters = spark.createDataFrame([("a", True, 1), ("a", True, 2), ("b", False, 3)], "k string, bad boolean, x int")
    got = linkage.attach_attributes(facts, encounters, "k", ["x"], F.col("bad"), hot=skew.hot_keys(facts.union(facts), ["k"], 1))
    assert values(got, "k", "x") == [("a", None), ("b", 3), ("c", None)]


def test_repair_ids(spark):
    full = spark.createDataFrame([("6130480000000001",), ("9040000000000000",), ("9041000000000000",), ("00ab00ab00ab00ab",), ("9996000000000000",)], "id string")
    damaged = spark.createDataFrame([("6.13E+15",), ("6.13048E+15",), ("9.04E+15",), ("1.45E+19",), ("1.00E+16",), ("plain",)], "m string")
    got = {r.m: (r.repaired_id, r.repair_status) for r in linkage.repair_ids(damaged, "m", full, "id").collect()}
    assert got == {
        "6.13E+15": ("6130480000000001", "repaired"), "6.13048E+15": ("6130480000000001", "repaired"), "9.04E+15": (None, "ambiguous"),
        "1.45E+19": (None, "unmatched"), "1.00E+16": ("9996000000000000", "repaired"), "plain": ("plain", "intact"),
    }


def test_footprint_and_subset(spark):
    pairs = spark.createDataFrame([("k", "real"), ("k", "ghost")], "k string, e string")
    labs = spark.createDataFrame([("k", "real")] * 3, "k string, e string")
    got = {r.e: (r.labs, r.meds, r.is_phantom) for r in linkage.entity_footprint(pairs, {"labs": labs, "meds": labs.limit(1)}, ["k", "e"]).collect()}
    assert got == {"real": (3, 1, False), "ghost": (0, 0, True)}
    facts = spark.createDataFrame([("g", "1"), ("g", None), ("r", "1"), ("r", None), ("r", "3"), ("g", "1")], "e string, f string")
    asked = spark.createDataFrame([("g", "r"), ("r", "g"), ("none", "r")], "a string, b string")
    got = {(r.a, r.b): (r.is_subset, r.is_strict_subset) for r in linkage.subset_copy(facts, asked, "e", ["f"]).collect()}
    assert got == {("g", "r"): (True, True), ("r", "g"): (False, False), ("none", "r"): (False, False)}


# --- distributions ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    data = [rng.lognormal(size=5000), rng.integers(0, 4, 5000).astype(float), rng.normal(size=7), np.array([3.5])][seed]
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,)], "v double").repartition(4)
    points = [0.0, 0.01, 0.25, 0.5, 0.501, 0.9, 1.0]
    got = {r.p: r.quantile for r in aggregate.exact_quantiles(df, [], "v", points, accuracy=200).collect()}
    assert len(got) == len(points)
    for p in points:
        assert got[p] == pytest.approx(np.quantile(data, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("most", [1_000, 40, 5_000])
def test_quantiles_among_few_values_at_a_time(spark, most, monkeypatch):
    """Far more distinct values than a task may see: narrowing leaves at most so many lines of a group."""
    seen = []
    resolve = aggregate._resolved

    def watched(counted, groups, points):
        seen.append(counted.groupBy(*groups).count().agg(F.max("count")).first()[0])
        return resolve(counted, groups, points)

    monkeypatch.setattr(aggregate, "_resolved", watched)
    rng = np.random.default_rng(most)
    data = {"normal": rng.normal(size=30_000), "wide": 10.0 ** rng.uniform(-300, 300, 20_000), "ties": rng.integers(0, 9, 5_000) * 1.0, None: rng.uniform(-1, 1, 700)}
    rows = [(g, float(v)) for g, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    points = [0.0, 0.01, 0.5, 0.9, 1.0]
    got = {(r.g, r.p): r.quantile for r in aggregate.exact_quantiles(df, ["g"], "v", points, accuracy=100, most=most).collect()}
    for g, values in data.items():
        for p in points:
            assert got[g, p] == pytest.approx(np.quantile(values, p), rel=1e-9), (g, p)
    assert seen[0] <= most
    row = aggregate.describe(df, ["v"], accuracy=100, most=most).first()
    everything = np.concatenate(list(data.values()))
    assert [row.q25, row.q50, row.q75] == pytest.approx(np.quantile(everything, [0.25, 0.5, 0.75]).tolist(), rel=1e-9)
    assert seen[1] <= most


def test_describe_of_little(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (4.0, None, 2.0)], "a double, b double, c double")
    got = {r.column: tuple(r)[1:] for r in aggregate.describe(df, ["a", "b", "c"]).collect()}
    assert got["a"][:2] == (2, 2.5) and got["a"][3:] == (1.0, 1.75, 2.5, 3.25, 4.0)
    assert got["b"] == (0, None, None, None, None, None, None, None) and got["c"][0] == 2 and got["c"][4:7] == (2.0, 2.0, 2.0)


def test_quantiles_of_many_groups(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r.g: r.quantile for r in aggregate.exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {g: 47.5 + g for g in range(5)}


def test_histogram_matches_numpy(spark):
    data = [float(x) for x in np.random.default_rng(1).integers(0, 1000, 500)] + [0.0, 1000.0]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "v double")
    rows = aggregate.histogram(df, "v", 16).orderBy("bin").collect()
    counts, edges = np.histogram(data, 16)
    assert [r.n for r in rows] == list(counts) and [r.bin_end for r in rows] == pytest.approx(list(edges[1:]))
    flat = aggregate.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r.n for r in flat] == [2, 0, 0, 0]


def test_sentinel_bands(spark):
    rows = [("all", 9999999.0)] * 5 + [("none", 1.0)] * 5 + [("few", 9999999.0)] + [("few", 2.0)] * 99 + [("half", 9999999.0), ("half", 3.0)]
    df = spark.createDataFrame(rows, "t string, v double")
    got = {r.t: r.band for r in aggregate.sentinel_share(df, "t", C.flag_sentinel(F.col("v"))).collect()}
    assert got == {"all": "all", "none": "none", "few": "minority", "half": "mixed"}


def test_numbers_keep_their_order_in_codes(spark):
    rng = random.Random(3)
    numbers = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(2000)]
    numbers += [s * m * 2.0**e for s in (1, -1) for e in range(-1074, 1024, 37) for m in (1.0, 1.5, 1.0 + 2**-52, 2.0 - 2**-52) if m * 2.0**min(e, 1022) < 2**1023]
    numbers += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 8.0, 1000.0, 0.1]
    numbers = [x for x in numbers if x == x]
    df = spark.createDataFrame([(x,) for x in numbers] + [(float("nan"),)], "v double").select("v", C.order_code(F.col("v")).alias("c"))
    for row in df.withColumn("back", C.from_order_code(F.col("c"))).collect():
        bits = struct.unpack("q", struct.pack("d", abs(row.v)))[0]
        assert row.v != row.v or row.c == (-bits if row.v < 0 else bits), row
        assert row.back == row.v or (row.back != row.back and row.v != row.v), row


def test_last_value_by_hash(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.randrange(6), at(rng.choice([None, *range(9)])), rng.choice([None, -0.5, 0.25, -1e300, 7.0, float(rng.randrange(9))])) for _ in range(300)] + [(9, None, 4.0), (9, None, -3.0)]
    spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double").withColumn("w", F.floor(F.col("v") % 1000)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for value, get in (("v", lambda v: v), ("w", lambda v: None if v is None else int(math.floor(math.fmod(v, 1000))))):
        summary = aggregate.summary_by_group(df, ["k"], value, "ts")
        assert not operators_of(summary)["SortAggregate"]
        for row in summary.collect():
            known = [(ts is not None, ts or T0, get(v)) for k, ts, v in rows if k == row.k and v is not None]
            assert (row.n, row.last) == (len(known), max(known)[2])


def test_last_value_tie(spark):
    df = spark.createDataFrame([("e", at(1), 5.0), ("e", at(2), 1.0), ("e", at(2), 3.0), ("e", at(3), None)], "e string, ts timestamp_ntz, v double")
    row = aggregate.summary_by_group(df, ["e"], "v", "ts").first()
    assert (row.n, row.min, row.max, row["last"]) == (3, 1.0, 5.0, 3.0)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a")], "x int, y string")
    assert {r.column: (r.type, r.n_null, r.n_distinct) for r in aggregate.profile(df).collect()} == {"x": ("int", 0, 2), "y": ("string", 1, 1)}


# --- sequences, labels --------------------------------------------------------------------------


def test_checkpoints(spark):
    steps = ["s", "i", "e"]
    rows = [("ok", "s", 0), ("ok", "i", 5), ("ok", "e", 9), ("swap", "s", 5), ("swap", "i", 0), ("swap", "e", 9), ("miss", "s", 0), ("miss", "e", 4),
            ("rep", "s", 0), ("rep", "s", 7), ("rep", "i", 3), ("rep", "e", 3), ("other", "zzz", 1)]
    df = spark.createDataFrame([(k, t, at(m)) for k, t, m in rows], "k string, t string, ts timestamp_ntz")
    pivot = events.first_occurrence_pivot(df, ["k"], "t", "ts", steps)
    assert pivot.count() == 4
    found = {r.step: (r.n, r.violations) for r in events.order_violations(pivot, steps).collect()}
    assert found == {"complete chain": (3, 1), "s -> i": (3, 1), "i -> e": (3, 0)}
    gaps = {r.step: (r.n, r.median_minutes) for r in events.step_gaps(pivot, steps).collect()}
    assert gaps == {"s -> i": (3, 3.0), "i -> e": (3, 4.0)}
    assert {r.t: r.n_true for r in events.repeated_checkpoints(df, ["k"], "t", "ts").collect()} == {"s": 1, "i": 0, "e": 0, "zzz": 0}
    assert events.relative_order(pivot, "i", "e").first().n_equal == 1
    closed = spark.createDataFrame([("x", at(0), at(10_080)), ("y", at(0), at(10_074)), ("z", at(0), at(100)), ("w", None, at(5))], "k string, s timestamp_ntz, e timestamp_ntz")
    assert {r.k for r in events.exclude_autoclosed(closed, "s", "e").collect()} == {"z", "w"}


def test_rise_and_window(spark):
    series = spark.createDataFrame([("a", at(0), 1.0), ("a", at(5), 1.0), ("a", at(5), 1.1), ("a", at(30), 1.6), ("a", at(9000), 9.0), ("b", at(0), 2.0)], "k string, ts timestamp_ntz, v double")
    cases = spark.createDataFrame([("a", at(10), at(20)), ("b", at(10), at(20)), ("c", at(10), at(20))], "k string, s timestamp_ntz, e timestamp_ntz")
    got = {r.k: (r.baseline, r.peak, r.risen) for r in gold.rise_label(series, cases, "k", "ts", "v", "s", "e", 3600, 0.3, 1.5, hot_rows=1).collect()}
    assert got == {"a": (1.1, 1.6, True), "b": (2.0, None, None), "c": (None, None, None)}
    seen = gold.leakage_window(series, cases.select("k", "s"), "k", "ts", "s", {"n": running.count()}, hot_rows=1)
    assert values(seen, "k", "n") == [("a", 3), ("b", 1), ("c", None)]


def test_repeated_keys_keep_to_their_own_times(spark):
    series = spark.createDataFrame([("a", at(0), 1.0), ("a", at(50), 5.0), ("a", at(70), 9.0), (None, at(0), 7.0)], "k string, ts timestamp_ntz, v double")
    cases = spark.createDataFrame([("a", at(10), at(20)), ("a", at(60), at(65)), (None, at(10), at(20))], "k string, s timestamp_ntz, e timestamp_ntz")
    cut = gold.leakage_window(series, cases.select("k", "s"), "k", "ts", "s", {"n": running.count()})
    assert sorted((r.k or "", r.s, r.n) for r in cut.collect()) == [("", at(10), None), ("a", at(10), 1), ("a", at(60), 2)]
    risen = gold.rise_label(series, cases, "k", "ts", "v", "s", "e", 3600, 0.3, 1.5)
    assert sorted((r.k or "", r.s, r.baseline, r.peak) for r in risen.collect()) == [("", at(10), None, None), ("a", at(10), 1.0, 9.0), ("a", at(60), 5.0, 9.0)]
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    encounters = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, x int")
    assert sorted((r.k or "", r.x) for r in linkage.attach_attributes(facts, encounters, "k", ["x"]).collect()) == [("", None), ("a", None), ("a", None), ("b", 3)]


def test_an_open_ended_interval_is_no_burden(spark):
    facts = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(90_000)), (3, "b", at(5)), (4, None, at(5))], "id int, k string, ts timestamp_ntz")
    spans = spark.createDataFrame(
        [("a", dt.datetime(1, 1, 2), dt.datetime(9999, 12, 31)), ("a", at(0), at(10)), ("b", at(6), dt.datetime(9999, 12, 31)), ("b", at(5), at(5)), (None, at(0), at(9))],
        "k string, s timestamp_ntz, e timestamp_ntz")
    met = linkage.interval_join(facts, spans, "k", "ts", "s", "e")
    assert sorted((r.id, r.e.year) for r in met.collect()) == [(1, T0.year), (1, 9999), (2, 9999), (3, T0.year)]


def test_as_of_without_a_key(spark):
    refs = spark.createDataFrame([(1, None, at(9)), (2, 1, at(9))], "id int, e int, t timestamp_ntz")
    series = spark.createDataFrame([(None, at(1), 5.0), (1, at(2), 6.0)], "e int, ts timestamp_ntz, v double")
    assert values(linkage.as_of(refs, series, ["e"], "t", "ts", "v", "found"), "id", "found") == [(1, None), (2, 6.0)]


def test_long_ids_are_repaired_by_their_digits(spark):
    full = spark.createDataFrame([("90071992547409931",), ("90071992547409949",), ("0012",)], "id string")
    damaged = spark.createDataFrame([("9.007199254740993E+16",), ("9.0071992547409949E+16",), ("1.2E+01",), ("1.200E+01",)], "m string")
    got = {r.m: r.repaired_id for r in linkage.repair_ids(damaged, "m", full, "id").collect()}
    assert got == {"9.007199254740993E+16": "90071992547409931", "9.0071992547409949E+16": "90071992547409949", "1.2E+01": "0012", "1.200E+01": "0012"}


def test_ids_rounded_up_to_ten(spark):
    """The mantissa carries but the exponent stays; ids of the next magnitude are not meant."""
    full = spark.createDataFrame([("99960000",), ("10000003",), ("100000003",), ("9999",)], "id string")
    damaged = spark.createDataFrame([("10.00E+07",), ("1.00E+08",), ("1.00E+07",), ("10.00E+03",), ("10.00E+05",)], "m string")
    got = {r.m: (r.repaired_id, r.repair_status) for r in linkage.repair_ids(damaged, "m", full, "id").collect()}
    assert got == {
        "10.00E+07": ("99960000", "repaired"), "1.00E+08": (None, "ambiguous"), "1.00E+07": ("10000003", "repaired"),
        "10.00E+03": ("9999", "repaired"), "10.00E+05": (None, "unmatched"),
    }


def test_split_keeps_entities_together(spark):
    df = spark.range(2000).select((F.col("id") % 100).alias("e"), "id")
    sides = linkage.grouped_split(df, "e", 30, F.col("e") == 7)
    assert sides.groupBy("e").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    assert {r[0] for r in sides.select("split").distinct().collect()} == {"train", "test", "excluded"}


def test_month_bounds():
    assert scans.month_bounds(2021, 12) == (dt.datetime(2021, 12, 1), dt.datetime(2022, 1, 1))
    assert scans.month_bounds(2021) == (dt.datetime(2021, 1, 1), dt.datetime(2022, 1, 1))


def test_rules(spark):
    df = spark.createDataFrame([("a", 1, True), ("b", 2, True), ("c", 3, False)], "k string, n_occurrences int, f boolean")
    good = [quality.expect_rows(3), quality.expect_distinct("k", 3), quality.expect_multiplicity(6), quality.expect_paired("f"),
            quality.rows_between(2, 4), quality.expect_absent("z", F.col("k") == "z"), quality.expect_group("b", F.col("k") == "b", 2)]
    assert len(quality.gate(quality.evaluate(df, "t", good))) == 7
    bad = [quality.expect_rows(4), quality.expect_paired("f"), quality.expect_group("z", F.col("k") == "z", 2), quality.rows_between(3, 9)]
    with pytest.raises(quality.GateError, match="rows = 4.*group z"):
        quality.gate(quality.evaluate(df, "t", bad))
    assert [r.status for r in quality.evaluate(df, "t", bad).collect()] == ["FAIL", "PASS", "FAIL", "FAIL"]
