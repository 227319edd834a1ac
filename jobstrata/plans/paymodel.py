"""Classifier of above-median pay with Spark ML, cross-validated and scored once.

Features are sparse vectors over 0/1 features, which a table numbers and names. They are
written to the checkpoint folder once; every fit reads them from there, so no fit goes
back to the raw rows and a lost executor costs only its own files' reread.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.functions.cells import or_label
from jobstrata.operators.evaluate import accuracy_error, binary_metrics
from jobstrata.operators.features import (
    active_features,
    collapse_levels,
    feature_index,
    feature_vectors,
    median_label,
    stratified_split,
)
from jobstrata.operators.forest import ForestPlan, feature_sets, grow_forest
from jobstrata.operators.items import frequent_items
from jobstrata.presets import postings as preset
from jobstrata.session import checkpointed


@dataclass(frozen=True)
class FeatureTable:
    """``key, label, is_test, fold, active, features``, and the table ``feature, block, level,
    name`` of what each of the ``size`` feature numbers means."""

    rows: DataFrame
    index: DataFrame
    size: int

    def only(self, block: str) -> FeatureTable:
        """The same rows with the features of one block, numbered from 0. Runs jobs."""
        own = self.index.filter(F.col("block") == block)
        first, size = own.agg(F.coalesce(F.min("feature"), F.lit(0)), F.count("*")).first()
        # a block's numbers follow each other
        inside = F.filter("active", lambda i: (i >= first) & (i < first + size))
        moved = F.transform(inside, lambda i: (i - first).cast("int"))
        rows = self.rows.drop("features").withColumn("active", moved)
        index = own.withColumn("feature", F.col("feature") - first)
        return FeatureTable(feature_vectors(rows, size), index, size)


def feature_table(
    sample: DataFrame,
    key: str,
    blocks: dict[str, Column],
    items: Column | None = None,
    item_threshold: float = preset.SKILL_THRESHOLD,
    test_share: float = preset.TEST_SHARE,
    folds: int = preset.FOLDS,
    seed: int = preset.SEED,
) -> FeatureTable:
    """One-hot every level of each block, add indicators of frequent items, split.

    Runs jobs when called: split, index and vectors are written as tables.
    """
    listed = F.array().cast("array<string>") if items is None else items
    cells = [c.cast("string").alias(b) for b, c in blocks.items()]
    base = sample.select(key, "label", listed.alias("items"), *cells)
    base = checkpointed(stratified_split(base, "label", key, test_share, folds, seed))
    frequent = None if items is None else frequent_items(base, F.col("items"), item_threshold)
    index = feature_index(base, list(blocks), frequent)
    active = active_features(base, index, list(blocks), None if items is None else "items")
    size = index.count()
    rows = active.select(key, "label", "is_test", "fold", "active")
    return FeatureTable(feature_vectors(rows, size), index, size)


def posting_features(panel: DataFrame, **options: object) -> FeatureTable:
    """The preset's features: role, arrangement, state, education, frequent skills."""
    sample = median_label(panel, "salary_midpoint")
    blocks = {
        "role": F.col("role_family"),
        "remote": F.col("REMOTE_TYPE_NAME"),
        "state": collapse_levels(
            sample, "state", preset.TOP_STATES, preset.STATE_UNRESOLVED, preset.OTHER_STATE
        ),
        "education": or_label(F.col("MAX_EDULEVELS_NAME"), preset.EDUCATION_MISSING),
    }
    return feature_table(sample, "ID", blocks, F.col("SKILLS_NAME"), **options)


def fit_logistic(train: DataFrame, n: int, c: float = 1.0) -> Model:
    """L2 logistic regression on standardised features.

    Spark scales inside the solver and applies the penalty on that scale, so the
    vectors stay sparse; centring would only move the unpenalised intercept.
    """
    return LogisticRegression(
        maxIter=preset.LOGISTIC_ITERATIONS,
        regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=0.0,
        standardization=True,
    ).fit(train)


@dataclass(frozen=True)
class Forest:
    """What the trees of some rounds say: ``active, round, share`` (mean share of label 1 of
    each set of features) and ``round, feature, importance``."""

    shares: DataFrame
    importance: DataFrame


def fit_forest(
    table: FeatureTable,
    trees: int = preset.FOREST_TREES,
    depth: int = preset.FOREST_DEPTH,
    folds: int = preset.FOLDS,
    rounds: Sequence[int] = (-1,),
    seed: int = preset.SEED,
) -> Forest:
    """Random forests for every round: the fold left out, or -1 for the whole training set.

    They are grown on the distinct feature sets and their class counts, see
    ``operators.forest``.
    """
    rows = table.rows.select("active", "fold", "label")
    plan = ForestPlan(trees, tuple(rounds), folds, depth, preset.FOREST_LEAF, seed, table.size)
    return Forest(*grow_forest(feature_sets(rows, folds), plan))


def training_set(table: FeatureTable) -> DataFrame:
    return table.rows.filter("not is_test")


def fit_full(table: FeatureTable) -> Model:
    """Logistic regression on the whole training set."""
    train = training_set(table)
    return fit_logistic(train, train.count())


def _round_of(rows: DataFrame) -> DataFrame:
    """Add ``round``: the fold that scores the row, -1 for the test set."""
    return rows.withColumn("round", F.when(F.col("is_test"), F.lit(-1)).otherwise(F.col("fold")))


def majority_predictions(rows: DataFrame, folds: int = preset.FOLDS) -> DataFrame:
    """``fold, label, prediction``: each row scored with the most common label of the
    training rows outside its own fold (of all of them for the test set)."""
    counts = rows.filter("not is_test").groupBy("fold", "label").agg(F.count("*").alias("n"))
    every = F.array(*[F.lit(f) for f in range(-1, folds)])
    constants = (
        counts.withColumn("round", F.explode(every))
        .filter(F.col("round") != F.col("fold"))
        .groupBy("round", "label")
        .agg(F.sum("n").alias("n"))
        .groupBy("round")
        .agg(F.min(F.struct((-F.col("n")).alias("neg"), "label"))["label"].alias("prediction"))
    )
    return (
        _round_of(rows)
        .join(F.broadcast(constants), "round")
        .select(F.col("round").alias("fold"), "label", F.col("prediction").cast("double"))
    )


def forest_predictions(
    table: FeatureTable,
    trees: int = preset.FOREST_TREES,
    depth: int = preset.FOREST_DEPTH,
    folds: int = preset.FOLDS,
) -> DataFrame:
    """The same for the forests of all rounds, which are grown together."""
    forest = fit_forest(table, trees, depth, folds, range(-1, folds))
    rows = _round_of(table.rows).select("active", "round", "label")
    said = (F.col("share") > 0.5).cast("double").alias("prediction")
    return rows.join(forest.shares, ["active", "round"]).select(F.col("round").alias("fold"), "label", said)


def logistic_predictions(
    table: FeatureTable, folds: int = preset.FOLDS, parallelism: int = 2
) -> DataFrame:
    """The same for logistic regressions, one for each round.

    Every round is a set of distributed jobs over the checkpointed features; a
    few rounds at a time keep the cluster busy while one waits for its driver.
    """
    rows = _round_of(table.rows)
    sizes = {
        r["fold"]: r["n"]
        for r in training_set(table).groupBy("fold").agg(F.count("*").alias("n")).collect()
    }
    total = sum(sizes.values())

    def one_round(held_out: int) -> Model:
        train = rows.filter((F.col("round") >= 0) & (F.col("round") != held_out))
        return fit_logistic(train, total - sizes.get(held_out, 0))

    rounds = range(-1, folds)
    with ThreadPool(parallelism) as pool:
        work = inheritable_thread_target(table.rows.sparkSession)(one_round)
        models = pool.map(work, rounds)
    scored = [
        model.transform(rows.filter(F.col("round") == r)).select(
            F.col("round").alias("fold"), "label", "prediction"
        )
        for r, model in zip(rounds, models)
    ]
    return reduce(DataFrame.unionByName, scored)


def compare_models(
    table: FeatureTable,
    role_block: str = "role",
    trees: int = preset.FOREST_TREES,
    depth: int = preset.FOREST_DEPTH,
    folds: int = preset.FOLDS,
    parallelism: int = 2,
) -> DataFrame:
    """Score the majority baseline, role-only and full logistic, and the forest.

    Each is cross-validated inside the training set and scored once on the test
    set. One row per model: fold mean and population deviation of accuracy, test
    metrics, the test accuracy's standard error, and the drop from
    cross-validation to test in standard errors.
    """
    roles = table.only(role_block)
    predictions = {
        "Majority-class baseline": (table, majority_predictions(table.rows, folds)),
        "Logistic, role family only": (roles, logistic_predictions(roles, folds, parallelism)),
        "Logistic, all features": (table, logistic_predictions(table, folds, parallelism)),
        "Random forest, all features": (table, forest_predictions(table, trees, depth, folds)),
    }
    labelled = [
        rows.withColumns({"model": F.lit(name), "features": F.lit(source.size)})
        for name, (source, rows) in predictions.items()
    ]
    return model_scores(reduce(DataFrame.unionByName, labelled))


def model_scores(predictions: DataFrame, digits: int = 4) -> DataFrame:
    """Per model from ``model, features, fold, label, prediction``; fold -1 is the test set."""
    per_fold = binary_metrics(predictions, ("model", "features", "fold"), digits=12)
    is_test = F.col("fold") == -1
    metrics = ("accuracy", "precision", "recall", "f1")
    return (
        per_fold.groupBy("model", "features")
        .agg(
            F.round(F.avg(F.when(~is_test, F.col("accuracy"))), digits).alias("cv_accuracy_mean"),
            F.round(F.stddev_pop(F.when(~is_test, F.col("accuracy"))), digits).alias(
                "cv_accuracy_sd"
            ),
            *[
                F.round(F.max(F.when(is_test, F.col(m))), digits).alias(f"test_{m}")
                for m in metrics
            ],
            F.max(F.when(is_test, F.col("n"))).alias("test_rows"),
        )
        .withColumn("test_error", accuracy_error(F.col("test_accuracy"), F.col("test_rows")))
        .withColumn(
            "drop_in_errors",
            F.try_divide(F.col("cv_accuracy_mean") - F.col("test_accuracy"), F.col("test_error")),
        )
    )


def best_model(scores: DataFrame, metric: str = "test_accuracy") -> DataFrame:
    return scores.orderBy(F.desc(metric), F.desc("model")).limit(1)


def coefficient_table(table: FeatureTable, logistic: Model, forest: Forest) -> DataFrame:
    """``feature, logistic_coefficient, forest_importance, absolute_coefficient`` and
    each feature's rank under either model, strongest coefficient first.

    Coefficients are on the standardised scale. One row per feature: names, coefficients
    and importances are tables joined on the feature's number. The coefficients come from the
    fitted model, which lives at the driver.
    """
    spark = table.rows.sparkSession
    spread = training_set(table).agg(Summarizer.std(F.col("features")).alias("std"))
    spread = spread.select(F.posexplode(vector_to_array("std")).alias("feature", "std"))
    weights = spark.createDataFrame(
        enumerate(map(float, logistic.coefficients.toArray())), "feature int, weight double"
    )
    names = table.index.select("feature", "name")
    importance = forest.importance.where("round = -1").select("feature", "importance")
    weighted = (
        names.join(weights, "feature")
        .join(spread, "feature")
        .join(importance, "feature", "left")
        .select(
            F.col("name").alias("feature"),
            (F.col("weight") * F.col("std")).alias("logistic_coefficient"),
            F.coalesce("importance", F.lit(0.0)).alias("forest_importance"),
        )
        .withColumn("absolute_coefficient", F.abs("logistic_coefficient"))
    )
    return rank_disagreement(weighted).orderBy(
        F.desc("absolute_coefficient"), F.asc("feature")
    )


def rank_disagreement(table: DataFrame) -> DataFrame:
    """Rank features by either model and by how far the two ranks lie apart."""
    by_weight = F.rank().over(Window.orderBy(F.desc("absolute_coefficient")))
    by_importance = F.rank().over(Window.orderBy(F.desc("forest_importance")))
    return table.withColumns(
        {"weight_rank": by_weight, "importance_rank": by_importance}
    ).withColumn("rank_gap", F.col("weight_rank") - F.col("importance_rank"))


def strongest(table: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` largest coefficients by size, from most negative to most positive."""
    return table.orderBy(F.desc("absolute_coefficient"), F.asc("feature")).limit(k).orderBy(
        "logistic_coefficient"
    )
