"""Labels, feature columns, splits and scores that SQL can follow exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.gaps import half_up
from jobstrata.catalog.inputs import SALES_SQL, SKILLS, VISITS_SQL, sales, visits
from jobstrata.catalog.registry import query
from jobstrata.operators.evaluate import binary_metrics, confusion
from jobstrata.operators.features import (
    active_features,
    class_balance,
    collapse_levels,
    feature_index,
    item_indicators,
    median_label,
    stratified_split,
)
from jobstrata.plans.paymodel import (
    best_model,
    majority_predictions,
    model_scores,
    rank_disagreement,
    strongest,
)
from jobstrata.presets import postings as preset

_LABEL_SQL = f"""{SALES_SQL}, stated AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS pay FROM sales),
labelled AS (SELECT stated.*, CAST(pay > (SELECT median(pay) FROM stated) AS INT) AS label
    FROM stated WHERE pay IS NOT NULL)"""


def labelled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return median_label(sales(spark, sf_dir).withColumn("pay", pay), "pay")


@query(f"WITH {_LABEL_SQL} SELECT o_orderkey, label FROM labelled")
def pay_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_sales(spark, sf_dir).select("o_orderkey", "label")


@query(
    f"""WITH {_LABEL_SQL} SELECT count(*) AS rows, count_if(label = 1) AS above, count_if(label = 0) AS at_or_below
    FROM labelled"""
)
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_balance(labelled_sales(spark, sf_dir), "label")


@query(
    f"""WITH {SALES_SQL}, top AS (SELECT n_name FROM sales WHERE n_name <> 'NATION_0' GROUP BY n_name
        ORDER BY count(*) DESC, n_name LIMIT 6)
    SELECT o_orderkey, CASE WHEN n_name IN (SELECT n_name FROM top) OR n_name = 'NATION_0' THEN n_name
        ELSE 'Other state' END AS level FROM sales"""
)
def collapsed_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir)
    level = collapse_levels(rows, "n_name", preset.TOP_STATES, "NATION_0", preset.OTHER_STATE)
    return rows.select("o_orderkey", level.alias("level"))


def _totals(df: DataFrame, columns: dict) -> DataFrame:
    """``feature, ones`` of 0/1 columns."""
    sums = df.agg(*[F.sum(c).alias(f"_{i}") for i, c in enumerate(columns.values())])
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("feature"), F.col(f"_{i}").alias("ones"))
                    for i, n in enumerate(columns)
                ]
            )
        )
    )


@query(
    f"""WITH {SALES_SQL} SELECT 'segment: ' || c_mktsegment AS feature, CAST(count(*) AS DOUBLE) AS ones FROM sales GROUP BY ALL
    UNION ALL SELECT 'priority: ' || o_orderpriority, CAST(count(*) AS DOUBLE) FROM sales GROUP BY ALL"""
)
def one_hot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir).select(
        F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority")
    )
    blocks = ["segment", "priority"]
    index = feature_index(rows, blocks)
    active = active_features(rows, index, blocks).select(F.explode("active").alias("feature"))
    ones = active.groupBy("feature").agg(F.count("*").cast("double").alias("ones"))
    return ones.join(index, "feature").select(F.col("name").alias("feature"), "ones")


@query(
    f"""WITH {VISITS_SQL}, used AS (SELECT unnest(items) AS item FROM visits)
    SELECT 'skill: ' || item AS feature, CAST(count(*) AS DOUBLE) AS ones FROM used GROUP BY item"""
)
def indicator_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(visits(spark, sf_dir), item_indicators("items", SKILLS))


_SPLIT_SQL = f"""{_LABEL_SQL}, placed AS (SELECT labelled.*, row_number() OVER (PARTITION BY label
        ORDER BY md5(o_orderkey || ':{preset.SEED}'), o_orderkey) AS place,
        ceil(count(*) OVER (PARTITION BY label) * {preset.TEST_SHARE}) AS held FROM labelled),
split AS (SELECT o_orderkey, label, o_orderpriority, place <= held AS is_test,
    CAST(CASE WHEN place > held THEN (place - held - 1) % {preset.FOLDS} END AS INT) AS fold FROM placed)"""


def split_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(
        labelled_sales(spark, sf_dir).select("o_orderkey", "label", "o_orderpriority"),
        "label",
        "o_orderkey",
        preset.TEST_SHARE,
        preset.FOLDS,
        preset.SEED,
    )


@query(f"WITH {_SPLIT_SQL} SELECT o_orderkey, label, is_test, fold FROM split")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sales(spark, sf_dir).select("o_orderkey", "label", "is_test", "fold")


@query(f"WITH {_SPLIT_SQL} SELECT label, is_test, fold, count(*) AS n FROM split GROUP BY ALL")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        split_sales(spark, sf_dir)
        .groupBy("label", "is_test", "fold")
        .agg(F.count("*").alias("n"))
    )


# A rule in place of a fitted model: urgent orders are predicted to lie above the median.
_RULE_SQL = f"""{_SPLIT_SQL}, predicted AS (SELECT label, is_test, fold,
    CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END AS prediction FROM split)"""


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sales(spark, sf_dir).withColumn(
        "prediction", F.when(F.col("o_orderpriority") < "3", 1).otherwise(0)
    )


_METRICS_SQL = """count(*) AS n, round(count_if(label = prediction) / count(*), 4) AS accuracy,
    round(coalesce(count_if(label = 1 AND prediction = 1) / nullif(count_if(prediction = 1), 0), 0), 4) AS precision,
    round(coalesce(count_if(label = 1 AND prediction = 1) / nullif(count_if(label = 1), 0), 0), 4) AS recall,
    round(coalesce(2 * count_if(label = 1 AND prediction = 1)
        / nullif(count_if(label = 1) + count_if(prediction = 1), 0), 0), 4) AS f1"""


@query(f"WITH {_RULE_SQL} SELECT {_METRICS_SQL} FROM predicted WHERE is_test")
def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_metrics(_predicted(spark, sf_dir).filter("is_test"))


@query(
    f"""WITH {_RULE_SQL} SELECT actual, count_if(label = actual AND prediction = 0) AS predicted_0,
    count_if(label = actual AND prediction = 1) AS predicted_1
    FROM (VALUES (0), (1)) t(actual), predicted WHERE is_test GROUP BY actual"""
)
def rule_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_predicted(spark, sf_dir).filter("is_test"))


_MAJORITY_SQL = f"""{_SPLIT_SQL}, constants AS (SELECT f.fold,
        (SELECT label FROM split s WHERE NOT s.is_test AND s.fold <> f.fold
            GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS prediction
        FROM (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS fold) f),
predicted AS (SELECT constants.fold, label, prediction FROM split JOIN constants
    ON constants.fold = CASE WHEN is_test THEN -1 ELSE split.fold END),
folds AS (SELECT fold, {_METRICS_SQL.replace(', 4)', ', 12)')} FROM predicted GROUP BY fold),
scores AS (SELECT 'Majority-class baseline' AS model, CAST(0 AS INT) AS features,
    round(avg(accuracy) FILTER (fold >= 0), 4) AS cv_accuracy_mean,
    round(stddev_pop(accuracy) FILTER (fold >= 0), 4) AS cv_accuracy_sd,
    round(max(accuracy) FILTER (fold < 0), 4) AS test_accuracy, round(max(precision) FILTER (fold < 0), 4) AS test_precision,
    round(max(recall) FILTER (fold < 0), 4) AS test_recall, round(max(f1) FILTER (fold < 0), 4) AS test_f1,
    max(n) FILTER (fold < 0) AS test_rows FROM folds)"""


@query(
    f"""WITH {_MAJORITY_SQL} SELECT scores.*, round(sqrt(test_accuracy * (1 - test_accuracy) / test_rows), 6) AS test_error,
    round((cv_accuracy_mean - test_accuracy) / sqrt(test_accuracy * (1 - test_accuracy) / test_rows), 6) AS drop_in_errors
    FROM scores"""
)
def majority_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline under cross-validation and on the test set."""
    predictions = majority_predictions(split_sales(spark, sf_dir)).withColumns(
        {"model": F.lit("Majority-class baseline"), "features": F.lit(0)}
    )
    return model_scores(predictions).withColumns(
        {c: F.round(c, 6) for c in ("test_error", "drop_in_errors")}
    )


_WEIGHTS_SQL = f"""{SALES_SQL}, overall AS (SELECT avg(o_totalprice) AS mean FROM sales),
weights AS (SELECT n_name AS feature, round(avg(o_totalprice) - max(mean), 4) AS logistic_coefficient,
    CAST(count(*) AS DOUBLE) AS forest_importance FROM sales, overall GROUP BY n_name)"""


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coefficient-like table: each nation's mean price against the mean, and its size."""
    rows = sales(spark, sf_dir)
    mean = rows.agg(F.avg("o_totalprice")).scalar()
    return (
        rows.groupBy(F.col("n_name").alias("feature"))
        .agg(
            F.avg("o_totalprice").alias("_mean"),
            F.count("*").cast("double").alias("forest_importance"),
        )
        .withColumn("logistic_coefficient", F.round(F.col("_mean") - mean, 4))
        .withColumn("absolute_coefficient", F.abs("logistic_coefficient"))
        .drop("_mean")
    )


@query(
    f"""WITH {_WEIGHTS_SQL} SELECT weights.*, abs(logistic_coefficient) AS absolute_coefficient,
    CAST(rank() OVER (ORDER BY abs(logistic_coefficient) DESC) AS INT) AS weight_rank,
    CAST(rank() OVER (ORDER BY forest_importance DESC) AS INT) AS importance_rank,
    CAST(weight_rank - importance_rank AS INT) AS rank_gap FROM weights"""
)
def rank_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_disagreement(_weights(spark, sf_dir))


@query(
    f"""WITH {_WEIGHTS_SQL} SELECT feature, logistic_coefficient FROM weights
    ORDER BY abs(logistic_coefficient) DESC, feature LIMIT 10"""
)
def strongest_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strongest(_weights(spark, sf_dir), 10).select("feature", "logistic_coefficient")


@query(
    f"""WITH {_SPLIT_SQL}, scored AS (SELECT o_orderpriority AS model, {half_up('avg(label)', 4)} AS test_accuracy
        FROM split GROUP BY o_orderpriority)
    SELECT * FROM scored ORDER BY test_accuracy DESC, model DESC LIMIT 1"""
)
def best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = (
        split_sales(spark, sf_dir)
        .groupBy(F.col("o_orderpriority").alias("model"))
        .agg(F.round(F.avg("label"), 4).alias("test_accuracy"))
    )
    return best_model(scored)
