"""Exact top lists over open domains, without a shuffled row for every distinct label.

A mergeable summary of frequent labels names candidates. One more read counts the candidates
and, by bucket of a label's hash, all other labels together. The k-th candidate's count is
then a bound: a label outside the candidates can only enter from a bucket whose other labels
reach it together. Labels of such buckets are counted one by one, in a third read; where there
is no such bucket, the list is proven without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.functions.cells import share
from jobstrata.session import stored

BUCKETS = 1 << 14
#: labels the summary tracks for each one listed, and candidates for each one listed
TRACKED, CANDIDATES = 64, 4


def candidate_labels(df: DataFrame, k: int) -> Column:
    """The labels of ``value`` that the summary takes for the most frequent (an array)."""
    wanted, tracked = CANDIDATES * k, TRACKED * k
    # a summary never gathers more than it tracks, however it is merged
    found = F.expr(f"approx_top_k(value, {wanted}, {tracked})")
    return df.filter(F.col("value").isNotNull()).agg(F.transform(found, lambda t: t["item"])).scalar()


def bucket_counts(df: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, value, n``, written as a table: a row for each candidate, and for each bucket
    of hashes one without a value for its other labels. Null labels are in bucket -1."""
    bucket = F.coalesce(
        F.when(F.col("value").isNotNull(), F.pmod(F.xxhash64("value"), F.lit(buckets))), F.lit(-1)
    )
    known = F.when(F.array_contains(candidate_labels(df, k), F.col("value")), F.col("value"))
    counted = df.select(bucket.alias("bucket"), known.alias("value"))
    return stored(counted.groupBy("bucket", "value").agg(F.count("*").alias("n")))


def open_buckets(counts: DataFrame, k: int) -> DataFrame:
    """``bucket`` of those whose other labels together reach the k-th candidate's count; all
    that have any where there are fewer than k candidates."""
    named = counts.filter(F.col("value").isNotNull())
    best = named.orderBy(F.desc("n"), F.asc("value")).limit(k)
    bound = best.agg(F.when(F.count("*") == k, F.min("n")).otherwise(0)).scalar()
    # a tie with the k-th may still win by its label
    rest = F.col("value").isNull() & (F.col("bucket") >= 0) & (F.col("n") >= bound)
    return counts.filter(rest).select("bucket")


def heavy_labels(df: DataFrame, col: Column, k: int, buckets: int = BUCKETS, digits: int = 4) -> DataFrame:
    """``value, n, share, rank``: the ``k`` most frequent labels, as ``top_k`` gives them.

    Null is no label but counts in the denominator; ties at the cut are broken by label. Runs
    two jobs when called. Shuffled are at most ``buckets + CANDIDATES * k`` rows a task, and
    then the labels of open buckets: few where some labels stand out, up to all of them where
    none does.
    """
    rows = df.select(col.alias("value"))
    counts = bucket_counts(rows, k, buckets)
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets)).alias("bucket")
    named = counts.filter(F.col("value").isNotNull()).select("value", "n")
    others = (
        rows.filter(F.col("value").isNotNull())
        .withColumn("bucket", bucket)
        .join(F.broadcast(open_buckets(counts, k)), "bucket", "left_semi")  # at most one row a bucket
        .groupBy("value")
        .agg(F.count("*").alias("n"))
        .join(F.broadcast(named.select("value")), "value", "left_anti")  # the candidates
    )
    best = named.unionByName(others).orderBy(F.desc("n"), F.asc("value")).limit(k)
    total = counts.agg(F.sum("n")).scalar()
    rank = F.rank().over(Window.orderBy(F.desc("n"))).cast("long")
    return best.select("value", "n", share(F.col("n"), total, digits).alias("share"), rank.alias("rank"))
