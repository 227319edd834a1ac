"""Advertised pay of any period to one annual scale."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.functions.cells import number, relabel


@dataclass(frozen=True)
class PayRules:
    factors: Mapping[str, float]
    floor: float
    # Treat an upper bound below the lower one as not stated.
    strict_upper: bool = False


def annual_factor(period: Column, factors: Mapping[str, float]) -> Column:
    """Multiplier of a pay period; missing and unknown periods count as annual."""
    return relabel(F.lower(F.trim(period)), factors, F.lit(1.0))


def midpoint(low: Column, high: Column) -> Column:
    return F.coalesce((low + high) / 2, low)


def add_pay(
    df: DataFrame, low: str, high: str, period: str, rules: PayRules, out: tuple[str, str, str]
) -> DataFrame:
    """Add annual lower bound, upper bound and midpoint.

    The plausibility floor is tested on the lower bound alone and blanks both,
    so a row that states only an upper bound has no usable pay.
    """
    low_out, high_out, mid_out = out
    # One projection per step, so that no cell is parsed more than once.
    stated = df.withColumns(
        {
            "_factor": annual_factor(F.col(period), rules.factors),
            "_low": number(F.col(low)),
            "_high": number(F.col(high)),
        }
    )
    usable = F.col("_low") * F.col("_factor") >= rules.floor
    high_kept = usable & (F.col("_high") >= F.col("_low")) if rules.strict_upper else usable
    return (
        stated.withColumns(
            {
                low_out: F.when(usable, F.col("_low") * F.col("_factor")),
                high_out: F.when(high_kept, F.col("_high") * F.col("_factor")),
            }
        )
        .withColumn(mid_out, midpoint(F.col(low_out), F.col(high_out)))
        .drop("_factor", "_low", "_high")
    )
