"""Classification scores as aggregations over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def binary_metrics(
    predictions: DataFrame,
    by: tuple[str, ...] = (),
    actual: str = "label",
    predicted: str = "prediction",
    digits: int = 4,
) -> DataFrame:
    """``n, accuracy, precision, recall, f1``; an undefined ratio is 0."""
    hit, said = F.col(actual) == 1, F.col(predicted) == 1
    counts = predictions.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(hit & said).alias("tp"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(hit & ~said).alias("fn"),
        F.count_if(~hit & ~said).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        "n",
        F.round(_ratio(tp + tn, F.col("n")), digits).alias("accuracy"),
        F.round(_ratio(tp, tp + fp), digits).alias("precision"),
        F.round(_ratio(tp, tp + fn), digits).alias("recall"),
        F.round(_ratio(2 * tp, 2 * tp + fp + fn), digits).alias("f1"),
    )


def confusion(
    predictions: DataFrame, actual: str = "label", predicted: str = "prediction"
) -> DataFrame:
    """``actual, predicted_0, predicted_1`` with both actual classes always present."""
    counts = predictions.agg(
        *[
            F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"_{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"),
                        F.col(f"_{a}0").alias("predicted_0"),
                        F.col(f"_{a}1").alias("predicted_1"),
                    )
                    for a in (0, 1)
                ]
            )
        )
    )


def accuracy_error(accuracy: Column, n: Column) -> Column:
    """Standard error of an accuracy measured on ``n`` rows."""
    return F.sqrt(F.try_divide(accuracy * (1 - accuracy), n))
