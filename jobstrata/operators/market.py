"""Pay and role summaries. Medians are exact; every measure has its own denominator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.functions.cells import share
from jobstrata.operators.items import with_marker
from jobstrata.operators.joins import keep_together, same_keys
from jobstrata.operators.quantiles import (
    KNOWN,
    bucket_counts,
    keyed,
    narrowed,
    quantiles,
    quantiles_of_counts,
    select_ranks,
    value_counts,
)


def numeric_summary(df: DataFrame, col: Column, digits: int = 4) -> DataFrame:
    """One row: usable rows, their share, min, median, mean, max.

    All of it comes from one table of value counts, so the rows are read once.
    """
    counted = value_counts(df, [], {"x": col, "rows": F.lit(0)})
    stated, c = F.col("measure") == "x", F.col("c")
    x = F.when(stated, F.col("x"))
    n = F.sum(F.when(stated, c))
    median = quantiles_of_counts(counted, ["measure"], [0.5])
    return counted.agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        share(F.coalesce(n, F.lit(0)), F.sum(F.when(~stated, c)), digits).alias("share"),
        F.min(x).alias("minimum"),
        F.try_divide(F.sum(x * c), n).alias("mean"),
        F.max(x).alias("maximum"),
    ).withColumn("median", median.agg(F.max(F.when(stated, F.col("quantile")))).scalar())


def numeric_center(df: DataFrame, col: Column) -> DataFrame:
    """One row: usable rows, median, and the most common value (smallest of ties)."""
    counted = value_counts(df, [], {"x": col})
    modal = counted.orderBy(F.desc("c"), F.asc("x")).limit(1)
    return quantiles_of_counts(counted, ["measure"], [0.5]).select(
        "n",
        F.col("quantile").alias("median"),
        modal.select("x").scalar().alias("mode"),
    )


def quantile_table(
    df: DataFrame, values: Mapping[str, Column], probs: Sequence[float]
) -> DataFrame:
    """``measure, prob, quantile, n``."""
    return quantiles(df, [], values, probs)


def median_by_group(
    df: DataFrame, group: str, value: Column, min_n: int = 10, few_groups: bool = False
) -> DataFrame:
    """``group, n, median`` of the groups that state at least ``min_n`` values."""
    return (
        quantiles(df, [group], {"x": value}, [0.5], few_groups)
        .filter(F.col("n") >= min_n)
        .select(group, "n", F.col("quantile").alias("median"))
    )


def share_of(df: DataFrame, flag: Column, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Share of rows for which the flag holds, overall or per group."""
    return df.groupBy(*by).agg(share(F.count_if(flag), F.count("*"), digits).alias("share"))


def subset_vs_all(df: DataFrame, subset: Column, value: Column) -> DataFrame:
    """One row: median and count of a subset beside those of all stated rows."""
    inside = F.when(subset, value)
    both = quantiles(df, [], {"subset": inside, "all": value}, [0.5])
    return both.agg(
        *[
            F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{label}")
            for m in ("subset", "all")
            for c, label in (("quantile", "median"), ("n", "n"))
        ]
    )


def role_comparison(
    df: DataFrame,
    role: str,
    pay: Column,
    years: Column,
    flexible: Column,
    entry_years: float,
    overall: bool = False,
    digits: int = 4,
) -> DataFrame:
    """Per role: postings, median pay, median years, entry share, flexible share.

    Pay and experience count only the postings that state them. ``overall`` adds
    a row with a null role for all postings together.
    """
    counted = value_counts(
        df.withColumn("role", F.col(role)),
        ["role"],
        {
            "pay": pay,
            "years": years,
            "flexible": F.coalesce(flexible, F.lit(False)).cast("double"),
        },
    ).withColumn("is_total", F.lit(0))
    if overall:
        together = counted.groupBy("measure", "key", "x").agg(F.sum("c").alias("c"))
        counted = counted.unionByName(
            together.withColumns({"role": F.lit(None).cast("string"), "is_total": F.lit(1)})
        )
    keys, c, x = ["role", "is_total"], F.col("c"), F.col("x")

    def total(measure: str, only: Column | None = None) -> Column:
        wanted = F.col("measure") == measure
        wanted = wanted if only is None else wanted & only
        return F.coalesce(F.sum(F.when(wanted, c)), F.lit(0))

    counts = counted.groupBy(*keys).agg(
        total("flexible").alias("postings"),
        total("pay").alias("paid"),
        total("years").alias("with_years"),
        share(total("years", x <= entry_years), total("years"), digits).alias("entry_share"),
        share(total("flexible", x == 1), total("flexible"), digits).alias("flexible_share"),
    )
    middle = quantiles_of_counts(counted, [*keys, "measure"], [0.5]).groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("measure") == m, F.col("quantile"))).alias(f"median_{m}")
            for m in ("pay", "years")
        ]
    )
    return same_keys(counts, middle, keys, "left")


def skill_premium(df: DataFrame, items: str, value: str) -> DataFrame:
    """``item, n_with, median_with, n_without, median_without, difference`` per listed item.

    ``items`` should hold only the items of interest (a bounded list). The rows without an
    item are never listed, and no value is listed once for each item: at every step of the
    selection an item's counts without it are those of all rows in a bucket minus those with
    it, first for all buckets of the leading bits, then only inside the buckets found.
    """
    paid = df.select(F.col(items).alias("items"), F.inline(keyed(F.col(value)))).filter(
        F.col("x").isNotNull()
    )
    is_marker = F.col("item").isNull()
    counted = (
        paid.select("key", F.explode(with_marker(F.col("items"))).alias("item"))
        .groupBy("key", "item")
        .agg(F.count_if(is_marker).alias("rows"), F.count_if(~is_marker).alias("c"))
    )
    counted = keep_together(counted, "rows", "c")
    everyone = counted.filter(F.col("rows") > 0).select("key", F.col("rows").alias("c"))
    having = counted.filter(F.col("c") > 0).select("item", "key", "c")
    wanted = having.agg(F.collect_set("item")).scalar()
    count_with = bucket_counts(having, ["item"], F.col("c"))

    def count_without(shift: int, found: DataFrame | None, taken: int) -> DataFrame:
        bucket = F.shiftright("key", shift).alias("bucket")
        if found is None:
            group, cells = ["item"], everyone.groupBy(bucket).agg(F.sum("c").alias("c"))
            cells = cells.withColumn("item", F.explode(wanted))
            with_it = having.groupBy("item", bucket).agg(F.sum("c").alias("c"))
        else:
            group = ["item", *KNOWN]
            cells = narrowed(everyone, found, [], taken, small=False)
            cells = cells.groupBy(*group, bucket).agg(F.sum("c").alias("c"))
            with_it = narrowed(having, found, ["item"], taken, small=False)
            with_it = with_it.groupBy(*group, bucket).agg(F.sum("c").alias("c"))
        return (
            cells.unionByName(with_it.withColumn("c", -F.col("c")))
            .groupBy(*group, "bucket")
            .agg(F.sum("c").alias("c"))
            .filter(F.col("c") > 0)
        )

    long = select_ranks(count_with, ["item"], [0.5]).withColumn("has", F.lit(True)).unionByName(
        select_ranks(count_without, ["item"], [0.5]).withColumn("has", F.lit(False))
    )
    return long.groupBy("item").agg(
        F.max(F.when(F.col("has"), F.col("n"))).alias("n_with"),
        F.max(F.when(F.col("has"), F.col("quantile"))).alias("median_with"),
        F.coalesce(F.max(F.when(~F.col("has"), F.col("n"))), F.lit(0)).alias("n_without"),
        F.max(F.when(~F.col("has"), F.col("quantile"))).alias("median_without"),
    ).withColumn("difference", F.col("median_with") - F.col("median_without"))


def composition(df: DataFrame, items: str, flag: Column, digits: int = 4) -> DataFrame:
    """``item, postings, share, overall``: how often a flag (a role, say) holds among
    the postings that list an item, beside how often it holds overall."""
    marked = with_marker(F.col(items))
    counted = (
        df.select(F.coalesce(flag, F.lit(False)).alias("flag"), F.explode(marked).alias("item"))
        .groupBy("item")
        .agg(
            F.count_if(F.col("item").isNull()).alias("rows"),
            F.count("*").alias("postings"),
            F.count_if("flag").alias("flagged"),
        )
    )
    shares = keep_together(counted, "rows", "postings", "flagged").withColumn(
        "share", share(F.col("flagged"), F.col("postings"), digits)
    )
    overall = shares.agg(F.max(F.when(F.col("rows") > 0, F.col("share")))).scalar()
    return (
        shares.filter(F.col("rows") == 0)
        .select("item", "postings", "share")
        .withColumn("overall", overall)
    )
