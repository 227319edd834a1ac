"""Top lists over open domains against plain counting."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobstrata.operators import heavy


def listed(spark, values, k, **options):
    df = spark.createDataFrame([(v,) for v in values], "x string").repartition(5)
    rows = heavy.heavy_labels(df, F.col("x"), k, **options).collect()
    return [(r["value"], r["n"], r["share"], r["rank"]) for r in rows]


def by_hand(values, k):
    counts = Counter(v for v in values if v is not None)
    best = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
    return [
        (v, n, round(100 * n / len(values), 4), 1 + sum(m > n for _, m in best)) for v, n in best
    ]


@pytest.mark.parametrize("buckets", [1, 7, 1 << 14])
def test_skew_ties_nulls_and_empty_labels(spark, buckets):
    values = ["hot"] * 400 + ["warm"] * 90 + ["b"] * 30 + ["a"] * 30 + ["c"] * 30 + [""] * 30
    values += [f"rare{i}" for i in range(700)] + [None] * 50
    assert listed(spark, values, 4, buckets=buckets) == by_hand(values, 4)


def test_few_or_no_labels(spark):
    assert listed(spark, ["a", "b", "b", None], 5) == by_hand(["a", "b", "b", None], 5)
    assert listed(spark, [None, None], 3) == []
    assert listed(spark, [], 3) == []


def test_all_labels_alike(spark):
    values = [f"v{i:05d}" for i in range(3000)] * 2
    assert listed(spark, values, 3) == by_hand(values, 3)


def test_wrong_candidates_are_put_right(spark, monkeypatch):
    """The summary may name any labels: the proof finds the others."""
    wrong = F.array(F.lit("x1"), F.lit("x2"), F.lit("absent"))
    monkeypatch.setattr(heavy, "candidate_labels", lambda df, k: wrong)
    values = ["a"] * 50 + ["b"] * 40 + ["x1"] * 3 + ["x2"] * 2 + [f"z{i}" for i in range(100)]
    for k in (1, 2, 3):
        assert listed(spark, values, k, buckets=64) == by_hand(values, k)


def test_few_labels_are_counted_where_some_stand_out(spark):
    """With 200,000 distinct labels next to no bucket stays open, and none is shuffled whole."""
    i = F.col("id")
    value = F.when(i % 4 == 0, F.concat(F.lit("top"), (F.hash(i) % 5).cast("string")))
    df = spark.range(400_000).select(F.coalesce(value, (i % 250_000).cast("string")).alias("value"))
    counts = heavy.bucket_counts(df, 5)
    assert counts.count() <= heavy.BUCKETS + heavy.CANDIDATES * 5 + 1
    assert heavy.open_buckets(counts, 5).count() == 0
