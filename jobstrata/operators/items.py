"""Demand for listed items (skills), counted once per posting.

A posting's list is a set, so each posting counts an item at most once. Each
posting also contributes one marker row without an item, so one scan and one
shuffle give the item counts and their denominators. Markers are told apart by
an aggregate, not by a filter on the grouping key: Spark would push such a
filter into the scan, and the two halves could no longer share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.functions.cells import share
from jobstrata.operators.frequency import level_table
from jobstrata.operators.joins import keep_together, same_keys


def item_counts(df: DataFrame, items: Column) -> DataFrame:
    """``item, postings``."""
    return (
        df.select(F.explode(F.array_distinct(items)).alias("item"))
        .groupBy("item")
        .agg(F.count("*").alias("postings"))
    )


def with_marker(items: Column) -> Column:
    """The distinct items of a list after one null that stands for the posting itself."""
    marker = F.array(F.lit(None).cast("string"))
    return F.coalesce(F.concat(marker, F.array_except(items, marker)), marker)


def marked_counts(df: DataFrame, by: Sequence[str], items: Column) -> DataFrame:
    """``by, item, uses, postings, with_items``; the null item's row holds the
    group's postings and how many of them list anything, the others their uses."""
    is_marker = F.col("item").isNull()
    counted = (
        df.select(*by, (F.size(items) > 0).alias("listed"), F.explode(with_marker(items)).alias("item"))
        .groupBy(*by, "item")
        .agg(
            F.count_if(~is_marker).alias("uses"),
            F.count_if(is_marker).alias("postings"),
            F.count_if(is_marker & F.col("listed")).alias("with_items"),
        )
    )
    return keep_together(counted, "uses", "postings", "with_items")


def _used(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("uses") > 0)


def _total(marked: DataFrame) -> Column:
    return marked.agg(F.sum("postings")).scalar()


def item_coverage(df: DataFrame, items: Column) -> DataFrame:
    """One row: postings, postings with at least one item, distinct items."""
    return marked_counts(df, [], items).agg(
        F.sum("postings").alias("postings"),
        F.sum("with_items").alias("with_items"),
        F.count_if(F.col("uses") > 0).alias("distinct_items"),
    )


def item_shares(df: DataFrame, items: Column, digits: int = 1) -> DataFrame:
    """``item, postings, share`` with the share in percent of all postings."""
    marked = marked_counts(df, [], items)
    n = F.col("uses")
    return _used(marked).select(
        "item", n.alias("postings"), share(n, _total(marked), digits).alias("share")
    )


def top_items(
    df: DataFrame, items: Column, k: int, rated: DataFrame | None = None, digits: int = 1
) -> DataFrame:
    """The ``k`` most demanded items; with ``rated`` also whether each is on that list."""
    top = (
        item_shares(df, items, digits).orderBy(F.desc("postings"), F.asc("item")).limit(k)
    )
    return top if rated is None else flag_member(top, "item", rated)


def flag_member(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Add ``is_member``: whether the key occurs in the one-column table ``members``."""
    name = members.columns[0]
    known = members.select(F.col(name).alias(key)).distinct().withColumn("_known", F.lit(True))
    return (
        df.join(known, key, "left")
        .withColumn("is_member", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def demand(df: DataFrame, items: Column, skills: Sequence[str], digits: int = 1) -> DataFrame:
    """``item, postings, share`` for a given list; items nobody asks for count 0."""
    wanted = F.array_intersect(items, F.array(*[F.lit(s) for s in skills]))
    marked = marked_counts(df, [], wanted)
    counted = _used(marked).select("item", F.col("uses").alias("n"))
    listed = level_table(df, skills).select(F.col("value").alias("item"))
    n = F.coalesce("n", F.lit(0))
    return listed.join(F.broadcast(counted), "item", "left").select(
        "item", n.alias("postings"), share(n, _total(marked), digits).alias("share")
    )


def demand_for(skills: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Posting counts for a table of skills; absent means 0."""
    found = counts.select(F.col("item").alias(key), "postings")
    return skills.join(found, key, "left").fillna(0, subset=["postings"])


def demand_by_group(
    df: DataFrame, group: str, items: Column, skills: Sequence[str]
) -> DataFrame:
    """``group, item, postings, group_postings, share``: every group and every skill,
    the share in percent of the group's postings, not rounded."""
    wanted = F.array_intersect(items, F.array(*[F.lit(s) for s in skills]))
    marked = marked_counts(df, [group], wanted)
    groups = marked.filter(F.col("postings") > 0).select(
        group,
        F.col("postings").alias("group_postings"),
        F.explode(F.array(*[F.lit(s) for s in skills])).alias("item"),
    )
    counted = _used(marked).select(group, "item", F.col("uses").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return same_keys(groups, counted, [group, "item"], "left").select(
        group,
        "item",
        n.alias("postings"),
        "group_postings",
        F.try_divide(100.0 * n, F.col("group_postings")).alias("share"),
    )


def demand_matrix(long: DataFrame, group: str, groups: Sequence[str], digits: int = 1) -> DataFrame:
    """The grouped demand as a matrix: one row per item, one column per named group."""
    return long.groupBy("item").agg(
        F.sum("postings").alias("postings"),
        *[
            F.round(F.max(F.when(F.col(group) == g, F.col("share"))), digits).alias(g)
            for g in groups
        ],
    )


def frequent_items(df: DataFrame, items: Column, threshold: float) -> DataFrame:
    """Items on at least ``threshold`` of the rows. At most ``mean list length /
    threshold`` items can qualify, however large the data."""
    marked = marked_counts(df, [], items)
    n = F.col("uses")
    return _used(marked).filter(n >= threshold * _total(marked)).select("item", n.alias("postings"))
