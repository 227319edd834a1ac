"""Exact copies by progressive refinement: length, then a prefix hash, then a full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def repeated_prefixes(docs: DataFrame, text: str) -> DataFrame:
    """(length, prefix) keys that more than one row has, found in two narrowing scans.

    The first scan counts normalised lengths only. The second hashes the leading
    characters of rows whose length repeats. Both counts combine on the map side.
    """
    plain = normalised(F.col(text))
    lengths = (
        docs.select(F.length(plain).alias("length"))
        .groupBy("length")
        .count()
        .where("count > 1")
        .select("length")
    )
    leads = docs.select(
        F.length(plain).alias("length"),
        F.xxhash64(F.substring(plain, 1, PREFIX_CHARS)).alias("prefix"),
    )
    return (
        leads.join(lengths, "length", "left_semi")
        .groupBy("length", "prefix")
        .count()
        .where("count > 1")
        .select("length", "prefix")
    )


def exact_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest_all: bool = False
) -> DataFrame:
    """One row per input row: ``key, n_points, text_sha256, keep_id, group_size, kept``.

    Rows are equal when their texts agree after ASCII white space is deleted. The row
    with the most code points stays, then the smallest key; null keys sort last.
    Only rows whose (length, prefix) repeats are hashed whole, so ``text_sha256`` is
    null for the others unless ``digest_all`` asks for every digest; the digest is then
    taken in the scan and no text is shuffled. A text is never shuffled twice.

    Null text is empty; empty texts are equal to each other. ``kept`` compares keys: where
    rows repeat the key that stays, each of them is kept, and so are all null-key copies
    where no copy has a key. One row of a group stays only while keys are unique and not
    null. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    plain = normalised(F.col(text))
    rows = docs.select(
        F.col(key).alias("__key"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_points"),
        F.length(plain).alias("length"),
        F.xxhash64(F.substring(plain, 1, PREFIX_CHARS)).alias("prefix"),
        (F.sha2(plain.cast("binary"), 256) if digest_all else plain).alias("body"),
    )
    repeated = repeated_prefixes(docs, text).withColumn("again", F.lit(True))
    marked = rows.join(repeated, ["length", "prefix"], "left").select(
        "__key",
        "n_points",
        F.col("again").isNotNull().alias("again"),
        (
            F.col("body")
            if digest_all
            else F.when(F.col("again"), F.sha2(F.col("body").cast("binary"), 256))
        ).alias("text_sha256"),
        "length",
    )
    order = F.struct((-F.col("n_points")).alias("p"), F.col("__key").isNull().alias("z"), "__key")
    groups = (
        marked.where("again")
        .groupBy("length", "text_sha256")
        .agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    joined = marked.join(groups, ["length", "text_sha256"], "left").select(
        "__key",
        "n_points",
        "text_sha256",
        F.when(F.col("first").isNull(), F.col("__key"))
        .otherwise(F.col("first.__key"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
    )
    return joined.select(
        F.col("__key").alias(key),
        "n_points",
        "text_sha256",
        "keep_id",
        "group_size",
        F.col("__key").eqNullSafe(F.col("keep_id")).alias("kept"),
    )
