"""Splits, features and fitted models on data with a planted signal."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from jobstrata.catalog import REGISTRY
from jobstrata.operators.features import (
    active_features,
    collapse_levels,
    feature_index,
    feature_vectors,
    median_label,
    one_hot,
    stratified_split,
)
from jobstrata.operators import forest
from jobstrata.operators.evaluate import binary_metrics, confusion
from jobstrata.plans import paymodel as pm
from jobstrata.presets import postings as preset


def panel(spark, n=600):
    """Pay rises with role and a skill; a third of the postings state none."""
    i = F.col("id")
    skilled = F.pmod(F.hash(i, F.lit(1)), F.lit(3)) == 0
    role = F.when(F.pmod(F.hash(i, F.lit(2)), F.lit(2)) == 0, "Data Scientist").otherwise("Data Analyst")
    noise = F.pmod(F.hash(i, F.lit(3)), F.lit(30000))
    pay = 80000 + F.when(role == "Data Scientist", 30000).otherwise(0) + F.when(skilled, 45000).otherwise(0) + noise
    return spark.range(n).select(
        i.alias("ID"),
        role.alias("role_family"),
        F.when(i % 2 == 0, "Remote").otherwise("Unknown").alias("REMOTE_TYPE_NAME"),
        F.concat(F.lit("State "), (i % 10).cast("string")).alias("state"),
        F.when(i % 4 > 0, "Bachelor's degree").alias("MAX_EDULEVELS_NAME"),
        F.when(skilled, F.array(F.lit("ML"), F.lit("SQL"))).otherwise(F.array(F.lit("SQL"))).alias("SKILLS_NAME"),
        F.when(i % 3 > 0, pay.cast("double")).alias("salary_midpoint"),
    )


def test_split_is_stratified_and_complete(spark):
    df = spark.range(591).select("id", (F.col("id") < 295).cast("int").alias("label"))
    rows = stratified_split(df, "label", "id", 0.25, 5, 688).collect()
    assert len(rows) == 591
    test = [r for r in rows if r["is_test"]]
    assert len(test) == 148 and sum(r["label"] for r in test) == 74
    sizes = {}
    for r in rows:
        assert (r["fold"] is None) == r["is_test"]
        if not r["is_test"]:
            sizes[(r["label"], r["fold"])] = sizes.get((r["label"], r["fold"]), 0) + 1
    assert len(sizes) == 10 and max(sizes.values()) - min(sizes.values()) <= 1


def test_median_label_is_strict(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3)] + [(None,)], "x double")
    assert sorted((r["x"], r["label"]) for r in median_label(df, "x").collect()) == [
        (1.0, 0),
        (2.0, 0),
        (2.0, 0),
        (3.0, 1),
    ]


def test_collapse_and_one_hot(spark):
    df = spark.createDataFrame([(v,) for v in ["a"] * 3 + ["b"] * 2 + ["c", "Unspecified"]], "s string")
    level = collapse_levels(df, "s", 1, "Unspecified", "Other state")
    collapsed = df.select(level.alias("state"))
    index = feature_index(collapsed, ["state"]).orderBy("feature").collect()
    assert [(r["feature"], r["name"]) for r in index] == list(
        enumerate(["state: Other state", "state: Unspecified", "state: a"])
    )
    columns = one_hot({"state": ["a", "Unspecified", "Other state"]})
    assert list(columns) == ["state: Other state", "state: Unspecified", "state: a"]
    rows = collapsed.select(*[c.alias(n) for n, c in columns.items()]).collect()
    assert all(sum(r) == 1.0 for r in rows)


def test_features_of_edge_cells(spark):
    rows = [(1, "b", "x", ["s", "s", None, "rare"]), (2, None, "x", None), (3, "a", None, []), (4, "", "y", ["t"])]
    df = spark.createDataFrame(rows, "id int, one string, two string, items array<string>")
    frequent = spark.createDataFrame([("t",), ("s",)], "item string")
    index = feature_index(df, ["one", "two"], frequent)
    names = {r["feature"]: r["name"] for r in index.collect()}
    assert names == dict(
        enumerate(["one: ", "one: a", "one: b", "two: x", "two: y", "skill: s", "skill: t"])
    )
    active = active_features(df, index, ["one", "two"], "items")
    got = feature_vectors(active, 7).orderBy("id").collect()
    assert [r["active"] for r in got] == [[2, 3, 5], [3], [1], [0, 4, 6]]
    assert [list(r["features"].indices) for r in got] == [r["active"] for r in got]
    assert {r["features"].size for r in got} == {7}
    none = feature_index(df.limit(0), ["one", "two"])
    assert none.count() == 0
    assert active_features(df, none, ["one", "two"]).where("size(active) > 0").isEmpty()


def test_a_hundred_thousand_levels(spark):
    """Numbers are dense and ordered, vectors hold them, and a fit ranks them by name."""
    n = 100_000
    city = F.when(F.col("id") % 3 > 0, F.format_string("c%06d", F.col("id") % n))
    sample = spark.range(2 * n).select(
        "id",
        (F.pmod(F.hash("id"), F.lit(10)) < F.when(F.col("id") % 2 == 0, 8).otherwise(2)).cast("int").alias("label"),
        city.alias("city"),
        (F.col("id") % 2).cast("string").alias("side"),
    )
    table = pm.feature_table(sample, "id", {"side": F.col("side"), "city": F.col("city")})
    kept = spark.range(2 * n).where("id % 3 > 0").select(F.col("id") % n).distinct().count()
    assert table.size == kept + 2
    ordered = table.index.agg(F.min("feature"), F.max("feature"), F.countDistinct("feature")).first()
    assert tuple(ordered) == (0, table.size - 1, table.size)
    in_order = table.index.where("block = 'city'").selectExpr(
        "feature - 2 - (rank() OVER (ORDER BY level) - 1) AS off").where("off <> 0")
    assert in_order.isEmpty()
    wrong = table.rows.join(sample.select("id", "city", "side"), "id").join(
        table.index.where("block = 'city'").select("feature", "level"),
        F.get("active", F.lit(1)) == F.col("feature"), "left"
    ).where("NOT city <=> level OR active[0] <> int(side)")
    assert wrong.isEmpty()
    weights = pm.coefficient_table(table, pm.fit_full(table), pm.Forest(
        None, spark.createDataFrame([], "round int, feature int, importance double")))
    assert weights.count() == table.size
    top = {r["feature"]: r["logistic_coefficient"] for r in weights.limit(2).collect()}
    assert set(top) == {"side: 0", "side: 1"} and top["side: 0"] > 0 > top["side: 1"]
    assert table.only("side").size == 2


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    assert tuple(binary_metrics(df).first()) == (2, 0.5, 0.0, 0.0, 0.0)
    assert [tuple(r) for r in confusion(df).collect()] == [(0, 1, 0), (1, 1, 0)]


@pytest.fixture(scope="module")
def table(spark):
    return pm.posting_features(panel(spark))


def test_feature_table(table):
    assert table.size == table.index.count() == 2 + 2 + 7 + 2 + 2
    last = table.index.orderBy("feature").collect()[-2:]
    assert [r["name"] for r in last] == ["skill: ML", "skill: SQL"]
    first = table.rows.first()
    assert first["features"].size == table.size
    assert table.rows.count() == 400


def test_models_find_the_planted_signal(table):
    compared = pm.compare_models(table, trees=10, depth=5)
    scores = {r["model"]: r for r in compared.collect()}
    base = scores["Majority-class baseline"]
    role = scores["Logistic, role family only"]
    full = scores["Logistic, all features"]
    forest = scores["Random forest, all features"]
    assert base["features"] == table.size and role["features"] == 2
    assert base["test_accuracy"] < role["test_accuracy"] < full["test_accuracy"]
    assert full["cv_accuracy_mean"] > 0.8 and forest["cv_accuracy_mean"] > 0.8
    assert base["test_f1"] == 0.0 or base["test_recall"] == 1.0
    best = pm.best_model(compared).first()
    assert best["test_accuracy"] == max(r["test_accuracy"] for r in scores.values())


def test_coefficients_point_the_right_way(table):
    weights = pm.coefficient_table(
        table, pm.fit_full(table), pm.fit_forest(table, 10, 5)
    )
    rows = {r["feature"]: r for r in weights.collect()}
    assert len(rows) == table.size
    assert rows["role: Data Scientist"]["logistic_coefficient"] > 0
    assert rows["role: Data Analyst"]["logistic_coefficient"] < 0
    assert rows["skill: ML"]["logistic_coefficient"] > 0
    assert sum(r["forest_importance"] for r in rows.values()) == pytest.approx(1.0)
    assert rows["skill: ML"]["weight_rank"] <= 3
    order = [r["absolute_coefficient"] for r in weights.collect()]
    assert order == sorted(order, reverse=True)


def test_preset_seed_gives_the_same_split_twice(spark):
    splits = [
        sorted(map(tuple, pm.posting_features(panel(spark).repartition(p)).rows.select("ID", "is_test", "fold").collect()))
        for p in (2, 7)
    ]
    assert splits[0] == splits[1]
    assert preset.SEED == 688


def test_registered_comparison_grows_the_preset_forest(spark):
    """500 trees of depth 30 for each of the six rounds, beside the other models."""
    scores = {r["model"]: r for r in REGISTRY["model_comparison"].run(spark, SMOKE_DIR).collect()}
    assert (preset.FOREST_TREES, preset.FOREST_DEPTH) == (500, 30)
    assert len(scores) == 4 and scores["Random forest, all features"]["test_accuracy"] > 0
    weights = REGISTRY["model_coefficients"].run(spark, SMOKE_DIR).collect()
    assert sum(r["forest_importance"] for r in weights) == pytest.approx(1.0)


def sets_of(seed=2, n=400, width=7):
    """Sets of features with counts; label 1 where features 1 and 2 differ, with some noise."""
    rng = np.random.default_rng(seed)
    sets = {}
    for _ in range(n):
        on = tuple(int(i) for i in np.flatnonzero(rng.random(width) < 0.5))
        label = ((1 in on) != (2 in on)) ^ (rng.random() < 0.05)
        counts = sets.setdefault(on, [0] * 8)
        counts[2 * int(rng.integers(0, 4)) + int(label)] += 1
    return sets


def plan_of(**given):
    return forest.ForestPlan(**{"trees": 20, "rounds": (-1, 0, 1, 2), "folds": 3, "depth": 30, "leaf": 2, "seed": 5, "features": 7} | given)


def grown(spark, sets, plan):
    df = spark.createDataFrame([(list(k), v) for k, v in sets.items()], "active array<int>, counts array<long>")
    shares, importance = forest.grow_forest(df, plan)
    return (
        {(tuple(r["active"]), r["round"]): r["share"] for r in shares.collect()},
        {(r["round"], r["feature"]): r["importance"] for r in importance.collect()},
    )


def tree_by_hand(sets, weights, plan, tree):
    """One tree grown node by node, with the same draws; (share of each set, gain by feature)."""
    shares, gains = {}, {}

    def gini(a, b):
        return 2 * a * b / (a + b) if a + b else 0.0

    def grow(members, heap, depth):
        w = [sum(weights[s][c] for s in members) for c in (0, 1)]
        best = None
        if min(w) > 0 and depth < plan.depth:
            varying = []
            for f in range(plan.features):
                one = [sum(weights[s][c] for s in members if f in s) for c in (0, 1)]
                if 0 < sum(one) < sum(w):
                    node = np.array([(tree << 40) | heap])
                    drawn = forest._mixed(forest._mixed(node + plan.seed) ^ np.uint64(f))[0]
                    varying.append((drawn, f, one))
            for _, f, one in sorted(varying)[: plan.tried]:
                zero = [w[0] - one[0], w[1] - one[1]]
                gain = gini(*w) - gini(*zero) - gini(*one)
                if min(sum(one), sum(zero)) >= plan.leaf and gain > 1e-9:
                    if best is None or (gain, -f) > (best[0], -best[1]):
                        best = (gain, f)
        if best is None:
            for s in members:
                shares[s] = w[1] / sum(w)
            return
        gains[best[1]] = gains.get(best[1], 0) + best[0]
        for side in (0, 1):
            grow([s for s in members if (best[1] in s) == side], 2 * heap + side, depth + 1)

    grow(list(sets), 1, 0)
    return shares, gains


def test_forest_by_hand(spark):
    sets, plan = sets_of(), plan_of()
    got, importance = grown(spark, sets, plan)
    ordered = sorted(sets)
    members = pa.array([[{"active": list(s), "counts": sets[s]} for s in ordered]],
        pa.list_(pa.struct([("active", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])))
    chunk = forest.Chunk(members[0], plan, 0)
    for i, left_out in enumerate(plan.rounds):
        total, gain = dict.fromkeys(ordered, 0.0), {}
        for tree in range(i * plan.trees, (i + 1) * plan.trees):
            weights = dict(zip(ordered, chunk.weights(tree).tolist()))
            shares, gains = tree_by_hand(ordered, weights, plan, tree)
            whole = sum(gains.values())
            for s in ordered:
                total[s] += shares[s] / plan.trees
            for f, g in gains.items():
                gain[f] = gain.get(f, 0) + g / whole
        for s in ordered:
            assert got[s, left_out] == pytest.approx(total[s], abs=1e-6)
        for f, g in gain.items():
            assert importance[left_out, f] == pytest.approx(g / sum(gain.values()))


def test_forest_by_levels_is_the_same(spark, monkeypatch):
    """Several chunks add up their counts level by level; weights do not depend on the chunks."""
    sets, plan = sets_of(n=150), plan_of(trees=4)

    def weights(self, tree):
        left_out = plan.rounds[tree // plan.trees]
        cells = [[2 * f + c for f in range(plan.folds) if f != left_out] for c in (0, 1)]
        return np.stack([self.counts[:, c].sum(1) for c in cells], 1)

    whole = grown_in_process(sets, plan, weights)
    monkeypatch.setattr(forest.Chunk, "weights", weights)
    growths = [forest.Growth(chunk, range(16)) for chunk in chunks_of(sets, plan, 3)]
    while True:
        parts = np.concatenate([g.histogram() for g in growths])
        total = forest._summed(parts["node"], parts["feature"], np.stack([parts["w0"], parts["w1"]], 1))
        splits = forest.chosen(total, plan)
        if not len(splits):
            break
        for g in growths:
            g.move(splits)
    for g in growths:
        for i, s in enumerate(g.chunk.sets):
            assert np.allclose(g.share[:, i], whole[s])


def chunks_of(sets, plan, n):
    kind = pa.list_(pa.struct([("active", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]))
    out = []
    for i in range(n):
        own = sorted(sets)[i::n]
        members = pa.array([[{"active": list(s), "counts": sets[s]} for s in own]], kind)
        out.append(forest.Chunk(members[0], plan, i))
        out[-1].sets = own
    return out


def grown_in_process(sets, plan, weights):
    chunk = chunks_of(sets, plan, 1)[0]
    shares = {s: [] for s in chunk.sets}
    chunk.weights = lambda tree: weights(chunk, tree)
    for tree in range(16):
        got, _ = tree_by_hand(chunk.sets, dict(zip(chunk.sets, chunk.weights(tree).tolist())), plan, tree)
        for s in chunk.sets:
            shares[s].append(got[s])
    return shares


def test_forest_of_many_chunks(spark, monkeypatch):
    """The level-wise jobs learn the planted rule and share out all importance."""
    monkeypatch.setattr(forest, "CHUNK_SETS", 30)
    sets, plan = sets_of(n=3000), plan_of(trees=30, rounds=(-1, 1))
    got, importance = grown(spark, sets, plan)
    assert set(got) == {(s, r) for s in sets for r in plan.rounds}
    right = [(got[s, -1] > 0.5) == ((1 in s) != (2 in s)) for s in sets]
    assert np.mean(right) > 0.9
    for r in plan.rounds:
        own = {f: g for (of, f), g in importance.items() if of == r}
        assert sum(own.values()) == pytest.approx(1.0)
        assert own[1] + own[2] > 0.6


def test_forest_of_nothing(spark):
    got, importance = grown(spark, {}, plan_of())
    assert got == {} and importance == {}
    got, importance = grown(spark, {(): [3, 1, 0, 0, 0, 0, 0, 0], (1,): [0] * 8}, plan_of(trees=200))
    assert importance == {} and got[(), -1] == pytest.approx(0.25, abs=0.06)
