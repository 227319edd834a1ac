"""Fitted classifiers. No SQL follows a fit, so these are checked by their quality in tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.features import _SPLIT_SQL, labelled_sales
from jobstrata.catalog.registry import query
from jobstrata.operators.evaluate import confusion
from jobstrata.operators.features import collapse_levels
from jobstrata.plans.paymodel import (
    FeatureTable,
    coefficient_table,
    compare_models,
    feature_table,
    fit_forest,
    fit_full,
)
from jobstrata.presets import postings as preset


def _table(spark: SparkSession, sf_dir: str) -> FeatureTable:
    sample = labelled_sales(spark, sf_dir)
    nation = collapse_levels(
        sample, "n_name", preset.TOP_STATES, "NATION_0", preset.OTHER_STATE
    )
    blocks = {
        "role": F.col("c_mktsegment"),
        "remote": F.col("o_orderpriority"),
        "state": nation,
        "year": F.year("day").cast("string"),
    }
    return feature_table(sample, "o_orderkey", blocks)


@query()
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    return table.rows.select("o_orderkey", "label", "is_test", "fold", "features")


@query(
    f"""WITH {_SPLIT_SQL}, top AS (SELECT n_name FROM labelled WHERE n_name <> 'NATION_0' GROUP BY n_name
        ORDER BY count(*) DESC, n_name LIMIT {preset.TOP_STATES}),
    blocks AS (SELECT o_orderkey, unnest(['role: ' || c_mktsegment, 'remote: ' || o_orderpriority,
        'state: ' || CASE WHEN n_name IN (SELECT n_name FROM top) OR n_name = 'NATION_0' THEN n_name
            ELSE '{preset.OTHER_STATE}' END,
        'year: ' || extract(YEAR FROM day)]) AS feature FROM labelled)
    SELECT o_orderkey, label, is_test, fold, feature, 1e0 AS value
    FROM split JOIN blocks USING (o_orderkey) WHERE feature IS NOT NULL"""
)
def feature_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vectors as a row for each posting and feature that is not zero."""
    table = _table(spark, sf_dir)
    names = table.index.select(F.col("feature").alias("number"), F.col("name").alias("feature"))
    value = F.get(vector_to_array("features"), F.col("number")).alias("value")
    split = ("o_orderkey", "label", "is_test", "fold")
    pairs = table.rows.withColumn("number", F.explode("active")).join(names, "number")
    return pairs.select(*split, "feature", value)


@query()
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_models(_table(spark, sf_dir))


@query()
def model_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    return coefficient_table(table, fit_full(table), fit_forest(table))


@query()
def logistic_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    return confusion(fit_full(table).transform(table.rows.filter("is_test")))
