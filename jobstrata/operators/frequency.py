"""Counts per label: shares, ranks, top lists, bands and level tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.functions.cells import band, share
from jobstrata.operators.joins import keep_together, same_keys


def label_counts(df: DataFrame, col: Column, stated: Column | None = None) -> DataFrame:
    """``value, n, denom``: rows per label, and how many of them count in the denominator."""
    denom = F.count("*") if stated is None else F.count_if(stated)
    counted = (
        df.withColumn("value", col)
        .groupBy("value")
        .agg(F.count("*").alias("n"), denom.alias("denom"))
    )
    return keep_together(counted, "n", "denom")


def frequency(
    df: DataFrame, col: Column, stated: Column | None = None, digits: int = 4
) -> DataFrame:
    """``value, n, share, rank``; equal counts share a rank.

    Ranks come from the table of distinct counts, which has at most about
    ``sqrt(2 * rows)`` rows however many labels there are, so the labels
    themselves are never ordered in one task.
    """
    counted = label_counts(df, col, stated)
    levels = counted.groupBy("n").agg(F.count("*").alias("labels"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = levels.select(
        "n", (1 + F.coalesce(F.sum("labels").over(above), F.lit(0))).alias("rank")
    )
    return (
        counted.join(F.broadcast(ranked), "n")
        .withColumn("share", share(F.col("n"), counted.agg(F.sum("denom")).scalar(), digits))
        .select("value", "n", "share", "rank")
    )


def top_k(
    df: DataFrame, col: Column, k: int, keep: Column | None = None, digits: int = 4
) -> DataFrame:
    """The ``k`` most frequent labels with their share of all rows and shared ranks.

    ``keep`` leaves labels out of the list but not out of the denominator. Ties
    at the cut are broken by label.
    """
    counted = label_counts(df, col, F.lit(True) if keep is None else keep)
    listed = counted.filter(F.col("denom") > 0)
    best = listed.orderBy(F.desc("n"), F.asc("value")).limit(k)
    return best.select(
        "value",
        "n",
        share(F.col("n"), counted.agg(F.sum("n")).scalar(), digits).alias("share"),
        F.rank().over(Window.orderBy(F.desc("n"))).cast("long").alias("rank"),
    )


def cumulative_share(df: DataFrame, col: Column, k: int, digits: int = 4) -> DataFrame:
    """Running share of the ``k`` most frequent labels, largest first."""
    counted = label_counts(df, col)
    best = counted.orderBy(F.desc("n"), F.asc("value")).limit(k)
    running = Window.orderBy(F.desc("n"), F.asc("value")).rowsBetween(Window.unboundedPreceding, 0)
    return best.select(
        "value",
        "n",
        share(F.sum("n").over(running), counted.agg(F.sum("n")).scalar(), digits).alias(
            "running_share"
        ),
    )


def level_table(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The fixed levels as a table with their position."""
    listed = F.posexplode(F.array(*[F.lit(level) for level in levels]))
    return df.sparkSession.range(1).select(listed.alias("pos", "value"))


def complete(counts: DataFrame, levels: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Every level in its fixed order; ``fill`` columns are 0 where a level is absent.

    The counts are matched to the levels by a join first, which leaves at most one
    row per level to broadcast. A filter on the label would be pushed into the
    scan and keep it from being shared with the total.
    """
    fixed = level_table(counts, levels)
    listed = same_keys(counts, F.broadcast(fixed.select("value")), ["value"])
    return same_keys(fixed, F.broadcast(listed), ["value"], "left").fillna(0, subset=list(fill))


def side_by_side(
    df: DataFrame, first: Column, second: Column, levels: Sequence[str]
) -> DataFrame:
    """``pos, value, first, second``: counts of two columns over one list of levels."""
    cells = F.array(
        F.struct(first.alias("value"), F.lit(1).alias("a"), F.lit(0).alias("b")),
        F.struct(second.alias("value"), F.lit(0).alias("a"), F.lit(1).alias("b")),
    )
    counts = (
        df.select(F.inline(cells))
        .filter(F.col("value").isin(list(levels)))
        .groupBy("value")
        .agg(F.sum("a").alias("first"), F.sum("b").alias("second"))
    )
    return complete(counts, levels, ["first", "second"])


def banded(
    df: DataFrame, col: Column, edges: Sequence[float], labels: Sequence[str], digits: int = 4
) -> DataFrame:
    """Right-closed bands in order, zero-filled, with their share of the stated values."""
    stated = df.select(col.alias("x")).filter(F.col("x").isNotNull())
    counted = label_counts(stated, band(F.col("x"), edges, labels))
    total = counted.agg(F.sum("n")).scalar()
    return complete(counted.select("value", "n"), labels, ["n"]).select(
        "pos", "value", "n", share(F.col("n"), total, digits).alias("share")
    )


def histogram(df: DataFrame, col: Column, bins: int = 14) -> DataFrame:
    """``bin, low, high, n`` with the smallest width of 1, 2 or 5 times a power of
    ten that needs at most ``bins`` (3 or more) bins; width 1 if all values are equal.

    Null, NaN and infinite values are left out; without values there are no rows."""
    x = col.cast("double")
    values = df.select(x.alias("x")).filter(F.abs(x) < float("inf"))
    low, high = F.min("x"), F.max("x")
    # a width below (high - low) / bins cannot do, ten times that always can
    least = F.floor(F.log10(high / bins - low / bins))
    tens = [F.pow(F.lit(10.0), least + e) for e in (0, 1, 2)]
    widths = F.array(*[m * ten for ten in tens for m in (1, 2, 5)])
    fitting = F.filter(widths, lambda w: F.floor(high / w) - F.floor(low / w) + 1 <= bins)
    width = values.agg(
        F.when(high > low, F.get(fitting, F.lit(0))).when(high == low, 1.0).alias("width")
    ).scalar()
    return (
        values.withColumn("width", width)
        .groupBy(F.floor(F.col("x") / F.col("width")).alias("bin"), "width")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.col("bin") * F.col("width")).alias("low"),
            ((F.col("bin") + 1) * F.col("width")).alias("high"),
            "n",
        )
    )
