"""Operators against brute force on small data, hot groups and null keys included."""

import math
import random
import statistics
import struct

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobstrata.operators import gaps as g
from jobstrata.operators.frequency import cumulative_share, frequency, histogram, top_k
from jobstrata.operators.items import demand, demand_by_group, item_coverage, top_items
from jobstrata.operators.market import (
    composition,
    median_by_group,
    numeric_center,
    numeric_summary,
    role_comparison,
    skill_premium,
)
from jobstrata.operators.profile import dominant_values, repeat_members, repeat_summary
from jobstrata.operators.quantiles import (
    approximate_quantiles,
    medians,
    order_key,
    quantiles,
    value_of,
)
from jobstrata.operators.ranking import best_per_group, hash_positions, largest_with_ties
from jobstrata.presets import postings as preset


def interpolated(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = math.floor(at), math.ceil(at)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("few_groups", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_quantiles_match_brute_force(spark, seed, few_groups):
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        # One group holds most rows, some values repeat, some groups are tiny.
        key = rng.choice(["hot"] * 20 + ["a", "b", None])
        x = rng.choice([rng.gauss(0, 1e6), float(rng.randint(-3, 3)), 150000.0, None])
        rows.append((key, x))
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {
        (r["k"], r["prob"]): (r["quantile"], r["n"])
        for r in quantiles(df, ["k"], {"x": F.col("x")}, probs, few_groups).collect()
    }
    for key in {k for k, _ in rows}:
        stated = [x for k, x in rows if k == key and x is not None]
        for p in probs:
            value, n = got[(key, p)]
            assert n == len(stated)
            assert value == pytest.approx(interpolated(stated, p), rel=1e-12, abs=1e-9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12), min_size=1, max_size=40))
def test_median_of_any_floats(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = medians(df, [], {"x": F.col("x")}).first()["x"]
    assert got == pytest.approx(statistics.median(values), rel=1e-9, abs=1e-6)


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1e-300, 0.1, 1 - 2**-53, 1.0, 1 + 2**-52, 2.0,
    2 - 2**-52, 3.0, 1e15, 2.0**53 - 1, 1e308, float.fromhex("0x1.fffffffffffffp+1023"), math.inf]


def test_order_keys_follow_the_doubles(spark):
    rng = random.Random(4)
    values = {s * x for x in EDGES for s in (1, -1)}
    values |= {struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)}
    values |= {2.0**e * f for e in range(-1074, 1024) for f in (1, 1 - 2**-53, 1 + 2**-52)}
    values = sorted(x for x in values if not math.isnan(x))
    df = spark.createDataFrame([(x,) for x in [*values, math.nan]], "x double")
    keyed = df.withColumn("key", order_key(F.col("x"))).withColumn("back", value_of(F.col("key"))).collect()
    for r in keyed[:-1]:
        assert r["back"] == r["x"]
        bits = struct.unpack("<q", struct.pack("<d", abs(r["x"])))[0]
        assert r["key"] == (-bits if r["x"] < 0 else bits)
    assert math.isnan(keyed[-1]["back"]) and keyed[-1]["key"] > max(r["key"] for r in keyed[:-1])


CROWDED = {
    "narrow": [i * 9e-12 for i in range(3000)],
    "times": [1.7e9 + i % 1000 for i in range(3000)],
    "nan": [1.0, 2.0, 3.0, math.nan],
    "infinite": [-math.inf, -1.0, 0.0, math.inf, math.inf],
    "all infinite": [math.inf, math.inf],
    "mixed": [math.nan, -math.inf, 1e-310, -1e-310, 1e300, 7.0, 7.0],
    "one": [-0.0],
}


@pytest.mark.parametrize("few_groups", [False, True])
def test_quantiles_equal_percentile_on_any_distribution(spark, few_groups):
    df = spark.createDataFrame([(k, x) for k, v in CROWDED.items() for x in v], "k string, x double")
    probs = [0.0, 0.3, 0.5, 0.75, 1.0]
    got = {(r["k"], r["prob"]): r["quantile"] for r in quantiles(df, ["k"], {"x": F.col("x")}, probs, few_groups).collect()}
    want = df.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()
    assert len(got) == len(CROWDED) * len(probs)
    for r in want:
        for p, q in zip(probs, r["q"]):
            assert got[r["k"], p] == pytest.approx(q, rel=1e-12, nan_ok=True), (r["k"], p)


@pytest.mark.parametrize("size", [50, 400])
def test_approximate_quantiles_keep_their_rank(spark, size):
    rng = random.Random(size)
    rows = [("hot" if i % 4 else "b", rng.choice([rng.gauss(0, 1), rng.expovariate(1e-9), 3.0])) for i in range(20000)]
    df = spark.createDataFrame([*rows, ("b", None), ("b", math.nan), ("none", None)], "k string, x double").repartition(7)
    found = approximate_quantiles(df, ["k"], {"x": F.col("x")}, [0.0, 0.1, 0.5, 0.9, 1.0], size).collect()
    assert {r["k"] for r in found} == {"hot", "b"} and len(found) == 10
    for r in found:
        values = [x for k, x in rows if k == r["k"]]
        assert r["n"] == len(values) and r["quantile"] in values
        low = sum(x < r["quantile"] for x in values) / len(values)
        high = sum(x <= r["quantile"] for x in values) / len(values)
        error = 1.5 * 2.3 / size**0.9
        assert low - error <= r["prob"] <= high + error


def test_medians_of_empty_input(spark):
    df = spark.createDataFrame([("a", None)], "k string, x double")
    assert medians(df, ["k"], {"x": F.col("x")}).collect() == []
    assert numeric_summary(df, F.col("x")).first()["n"] == 0


def test_numeric_summary_and_center(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 1.0, 5.0, 1.0, 9.0, None)], "x double")
    row = numeric_summary(df, F.col("x")).first()
    assert (row["n"], row["minimum"], row["median"], row["maximum"]) == (5, 1.0, 5.0, 9.0)
    assert row["mean"] == pytest.approx(4.2)
    assert row["share"] == pytest.approx(100 * 5 / 6, abs=1e-3)
    assert tuple(numeric_center(df, F.col("x")).first()) == (5, 5.0, 1.0)


def test_median_by_group_needs_support(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 1.0)], "k string, x double")
    assert [tuple(r) for r in median_by_group(df, "k", F.col("x")).collect()] == [("a", 10, 4.5)]


def test_frequency_shares_ranks_on_ties(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbccd"] + [(None,)], "v string")
    got = {r["value"]: (r["n"], r["rank"]) for r in frequency(df, F.col("v")).collect()}
    assert got == {"a": (3, 1), "b": (2, 2), "c": (2, 2), "d": (1, 4), None: (1, 4)}


def test_top_k_keeps_the_full_denominator(spark):
    df = spark.createDataFrame([(v,) for v in "aaaaabbbcc"], "v string")
    got = [tuple(r) for r in top_k(df, F.col("v"), 2, F.col("value") != "a").collect()]
    assert sorted(got) == [("b", 3, 30.0, 1), ("c", 2, 20.0, 2)]


def test_cumulative_share(spark):
    df = spark.createDataFrame([(v,) for v in "aaaabbbccd"], "v string")
    got = {r["value"]: r["running_share"] for r in cumulative_share(df, F.col("v"), 2).collect()}
    assert got == {"a": 40.0, "b": 70.0}


@pytest.mark.parametrize("values", [[1.0], [0.0, 13.0], [0.0, 14.0], [20000.0, 340555.0]])
def test_histogram_fits_its_bins(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = histogram(df, F.col("x")).collect()
    width = rows[0]["high"] - rows[0]["low"]
    assert sum(r["n"] for r in rows) == len(values)
    assert math.floor(max(values) / width) - math.floor(min(values) / width) + 1 <= 14
    assert all(any(r["low"] <= v < r["high"] for r in rows) for v in values)


def test_repeats_treat_null_keys_as_equal_but_uncounted(spark):
    rows = [("t", "acme", "x"), ("t", "acme", "y"), ("t", None, "x"), ("t", None, "x"), ("u", "b", "x")]
    df = spark.createDataFrame(rows, "title string, firm string, place string")
    assert tuple(repeat_summary(df, ["title", "firm"], "place").first()) == (4, 1, 1)
    members = repeat_members(df, ["title", "firm"])
    assert sorted((r["firm"] or "", r["group_size"]) for r in members.collect()) == [
        ("", 2),
        ("", 2),
        ("acme", 2),
        ("acme", 2),
    ]


def test_repeat_members_with_a_hot_key_and_many_cold_ones(spark):
    hot = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id"))
    cold = spark.range(4000).select((F.col("id") / 2).cast("int").cast("string").alias("k"), "id")
    single = spark.range(500).select(F.concat(F.lit("s"), F.col("id")).alias("k"), "id")
    members = repeat_members(hot.unionByName(cold).unionByName(single), ["k"])
    sizes = {r["group_size"]: r["n"] for r in members.groupBy("group_size").agg(F.count("*").alias("n")).collect()}
    assert sizes == {4000: 4000, 2: 4000}


def test_dominant_value_breaks_ties_by_label(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert tuple(dominant_values(df, {"v": F.col("v")}).first()) == ("v", "a", 2, 40.0)


def listed(spark):
    rows = [
        (1, "x", ["SQL", "SQL", "Python"], 100.0),
        (2, "x", ["SQL"], 200.0),
        (3, "y", [], 300.0),
        (4, "y", None, 400.0),
        (5, "y", ["SQL", None], None),
    ]
    return spark.createDataFrame(rows, "id int, role string, items array<string>, pay double")


def test_items_count_once_per_posting(spark):
    df, items = listed(spark), F.col("items")
    assert tuple(item_coverage(df, items).first()) == (5, 3, 2)
    assert [tuple(r) for r in top_items(df, items, 5).collect()] == [("SQL", 3, 60.0), ("Python", 1, 20.0)]
    got = {r["item"]: (r["postings"], r["share"]) for r in demand(df, items, ["SQL", "Rust"]).collect()}
    assert got == {"SQL": (3, 60.0), "Rust": (0, 0.0)}


def test_demand_by_group_covers_every_pair(spark):
    rows = demand_by_group(listed(spark), "role", F.col("items"), ["SQL", "Python"]).collect()
    got = {(r["role"], r["item"]): (r["postings"], r["group_postings"]) for r in rows}
    assert got == {
        ("x", "SQL"): (2, 2),
        ("x", "Python"): (1, 2),
        ("y", "SQL"): (1, 3),
        ("y", "Python"): (0, 3),
    }


def test_skill_premium_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (i, [s for s in "abc" if rng.random() < 0.4], rng.choice([None, float(rng.randint(1, 30))]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "id int, items array<string>, pay double")
    for r in skill_premium(df, "items", "pay").collect():
        having = [p for _, s, p in rows if p is not None and r["item"] in s]
        lacking = [p for _, s, p in rows if p is not None and r["item"] not in s]
        assert (r["n_with"], r["n_without"]) == (len(having), len(lacking))
        assert r["median_with"] == statistics.median(having)
        assert r["median_without"] == statistics.median(lacking)


def test_composition_against_the_whole(spark):
    rows = composition(listed(spark), "items", F.col("role") == "x").collect()
    got = {r["item"]: (r["postings"], r["share"], r["overall"]) for r in rows}
    assert got == {"SQL": (3, pytest.approx(66.6667), 40.0), "Python": (1, 100.0, 40.0)}


def test_role_comparison_has_own_denominators(spark):
    rows = [
        ("a", 10.0, 1.0, True),
        ("a", None, 5.0, False),
        ("a", 30.0, None, None),
        ("b", None, None, True),
    ]
    df = spark.createDataFrame(rows, "role string, pay double, years double, flex boolean")
    out = role_comparison(df, "role", F.col("pay"), F.col("years"), F.col("flex"), 2, overall=True)
    got = {r["role"]: r for r in out.collect()}
    assert (got["a"]["postings"], got["a"]["paid"], got["a"]["with_years"]) == (3, 2, 2)
    assert (got["a"]["median_pay"], got["a"]["median_years"], got["a"]["entry_share"]) == (20.0, 3.0, 50.0)
    assert (got["b"]["median_pay"], got["b"]["entry_share"], got["b"]["flexible_share"]) == (None, None, 100.0)
    assert (got[None]["postings"], got[None]["median_pay"], got[None]["flexible_share"]) == (4, 20.0, 50.0)


def test_hash_positions_are_dense_and_ignore_partitioning(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3 > 0).alias("label"))
    runs = []
    for parts, width in ((1, 1), (8, 1), (5, 3)):
        placed = hash_positions(df.repartition(parts), "label", "id", 7, width).collect()
        runs.append({r["id"]: (r["label"], r["position"], r["size"]) for r in placed})
    assert runs[0] == runs[1] == runs[2]
    for label, size in ((True, 2000), (False, 1000)):
        places = sorted(p for lab, p, s in runs[0].values() if lab == label)
        assert places == list(range(1, size + 1))


def test_best_and_largest_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 2)], "k string, v int")
    top = best_per_group(df, ["k"], [F.desc("v")], 2)
    assert sorted((r["k"], r["v"]) for r in top.collect()) == [("a", 3), ("a", 3), ("b", 2)]
    tied = largest_with_ties(df, ["k"], "v")
    assert sorted((r["k"], r["v"]) for r in tied.collect()) == [("a", 3), ("a", 3), ("b", 2)]


def test_target_uses_the_rounded_share_only_where_asked(spark):
    df = spark.createDataFrame([(19.96,)], "share double")
    tiers = (preset.TARGET_TIERS, preset.TARGET_BASE)
    row = df.select(
        g.target_level(F.round("share", 1), *tiers), g.target_level(F.col("share"), *tiers)
    ).first()
    assert tuple(row) == (4, 3)


@pytest.mark.parametrize(
    "cells, bins",
    [
        ([], 0),
        ([None, float("nan"), float("inf")], 0),
        ([7.0, 7.0], 1),
        ([0.0, 1e-9], 2),
        ([0.0, 1e18], 2),
        ([-3.0, 0.0, 4.0, 4.0], 3),
    ],
)
def test_histogram_fits_its_width_to_the_values(spark, cells, bins):
    df = spark.createDataFrame([(c,) for c in cells], "x double")
    out = histogram(df, F.col("x")).collect()
    stated = [c for c in cells if c is not None and abs(c) < float("inf")]
    assert len(out) == bins
    assert sum(r["n"] for r in out) == len(stated)
    for r in out:
        assert any(r["low"] <= c <= r["high"] for c in stated)
