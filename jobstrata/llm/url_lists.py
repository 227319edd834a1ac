"""URL filters by a temporal list join.

A list is a log of dated entries (add, remove). Each entry's log becomes validity
intervals; every capture of a URL is then judged by the entries in force at its fetch
time, so an old capture keeps the verdict of its own day when a list changes later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = 32


def url_host(url: Column) -> Column:
    """The lower-case host of an http(s) URL, without user and port; empty when there is none."""
    return F.lower(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    )


def host_suffixes(host: Column) -> Column:
    """The host and each parent domain of two labels or more; nothing for an empty host."""
    labels = F.split(host, r"\.")
    many = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(many - 1, F.lit(1)))
    names = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, many), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(names)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, entry, valid_from, valid_to) from (list, entry, action, at).

    Of an entry's records at one time the removal wins. An ``add`` holds until the next
    record of the entry of any kind (a further ``add`` starts a new, adjoining interval)
    and for ever when there is none. Records with a null in any column are ignored, as
    are repeated ones.
    """
    log = (
        entries.dropna(subset=["list", "entry", "action", "at"])
        .groupBy("list", "entry", "at")
        .agg(F.max("action").alias("action"))  # "remove" sorts after "add"
    )
    later = Window.partitionBy("list", "entry").orderBy("at")
    return (
        log.withColumn("valid_to", F.lead("at").over(later))
        .where(F.col("action") == "add")
        .select("list", "entry", F.col("at").alias("valid_from"), "valid_to")
    )


def judged(
    captures: DataFrame,
    entries: DataFrame,
    key: str = "page_id",
    url: str = "url",
    at: str = "fetched",
) -> DataFrame:
    """One row per capture: ``key, host, <at>, n_allow, n_block, entry, verdict``.

    Entries name hosts or parent domains; ``list`` is "allow" or "block". The longest
    entry in force decides, "allow" before "block" at equal length; without one the
    verdict is "pass". ``entry`` is the deciding entry or null. A null or hostless URL
    and a null fetch time match nothing and pass. Repeated captures (same key, URL and
    time) are one capture. An empty table gives no rows; columns of other names are not
    read.

    A domain may hold a third of all captures, so its rows are dealt over ``SALT`` parts
    and its few intervals are repeated for each; the join stays an equality join and
    Spark broadcasts the list only below its own size limit.
    """
    seen = captures.select(
        F.col(key).alias("__key"),
        F.col(at).alias("__at"),
        F.col(url).alias("__url"),
        url_host(F.col(url)).alias("host"),
    )
    asked = (
        seen.where(F.col("__at").isNotNull())
        .groupBy("host", "__at")
        .agg(F.count("*").alias("__captures"))
        .select("host", "__at", F.explode(host_suffixes(F.col("host"))).alias("entry"))
        .withColumn("salt", F.pmod(F.xxhash64("host", "__at"), F.lit(SALT)).cast("int"))
    )
    spans = validity_intervals(entries).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    )
    hits = asked.join(spans, ["entry", "salt"]).where(
        (F.col("__at") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to")))
    )
    best = F.max(
        F.struct(
            F.length("entry").alias("size"), (F.col("list") == "allow").alias("allow"), "entry"
        )
    )
    verdicts = hits.groupBy("host", "__at").agg(
        F.count_if(F.col("list") == "allow").alias("n_allow"),
        F.count_if(F.col("list") == "block").alias("n_block"),
        best.alias("best"),
    )
    verdict = (
        F.when(F.col("best").isNull(), "pass")
        .when(F.col("best.allow"), "allow")
        .otherwise("block")
    )
    return (
        seen.distinct()
        .join(verdicts, ["host", "__at"], "left")
        .select(
            F.col("__key").alias(key),
            "host",
            F.col("__at").alias(at),
            F.coalesce("n_allow", F.lit(0)).alias("n_allow"),
            F.coalesce("n_block", F.lit(0)).alias("n_block"),
            F.col("best.entry").alias("entry"),
            verdict.alias("verdict"),
        )
    )
