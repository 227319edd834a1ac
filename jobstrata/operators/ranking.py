"""Orderings that hold at scale: hash positions, best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.operators.joins import same_keys
from jobstrata.session import checkpointed


def hash_positions(df: DataFrame, by: str, key: str, seed: int, width: int = 4) -> DataFrame:
    """Add ``position`` (1, 2, ...) of each row within its ``by`` label, and the label's ``size``.

    Rows are ordered by ``md5(key:seed)``, so the order depends on nothing but
    the key. A label may hold half of all rows, so the hash's leading ``width``
    hex digits spread it over tasks: counts per lead give each lead's offset,
    and only rows that share a lead are ordered together.
    """
    hashed = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    rows = df.withColumn("_hash", hashed).withColumn("_lead", F.substring("_hash", 1, width))
    leads = rows.groupBy(by, "_lead").agg(F.count("*").alias("_count"))
    earlier = Window.partitionBy(by).orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)
    offsets = leads.select(
        by,
        "_lead",
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_count").over(Window.partitionBy(by)).alias("size"),
    )
    inside = Window.partitionBy(by, "_lead").orderBy("_hash", key)
    return (
        same_keys(rows, F.broadcast(offsets), [by, "_lead"])
        .withColumn("position", F.col("_offset") + F.row_number().over(inside))
        .drop("_hash", "_lead", "_offset")
    )


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... in the given order, which should tell all rows apart.

    Runs a job when called: rows are sorted over ranges and written, and each range
    starts after the counted rows of those before it. No task sees more than a range.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ranges.withColumn("_id", F.monotonically_increasing_id()))
    # the id has the partition's number above its lower 33 bits
    rows = placed.withColumn("_range", F.shiftright("_id", 33))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_count"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_start"))
    inside = F.col("_id") - F.shiftleft("_range", 33)
    return (
        rows.join(F.broadcast(starts), "_range")  # a row for each range
        .withColumn(name, F.col("_start") + inside)
        .drop("_id", "_range", "_start")
    )


def best_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    Spark keeps only ``k`` rows per group before the shuffle for this shape of
    filter, so a hot group reaches its task already cut down.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= k)


def largest_with_ties(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Every row that holds its group's largest value."""
    top = df.groupBy(*by).agg(F.max(value).alias("_top"))
    return same_keys(df, top, by).filter(F.col(value) == F.col("_top")).drop("_top")
