"""Bounded samples of labelled rows for fitting; everything else reads all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 20_000
FOLDS = 5


def fold_of(key) -> F.Column:
    """The key's fold: unsigned crc32 of its decimal text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FOLDS))


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, most: int = FIT_ROWS
) -> DataFrame:
    """(text, label) of at most ``most`` labelled training rows, those of the lowest hash.

    Fold 0 is held out and never read here. The chosen keys are at most ``most`` rows, a
    proven bound, so they are broadcast and the documents are filtered where they are
    read. Labels that are null are left out; a key with several labels counts with the
    greatest.
    """
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .where(fold_of(key) != 0)
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(most)
    )
    return docs.select(F.col(key).alias("__id"), F.coalesce(text, F.lit("")).alias("text")).join(
        F.broadcast(chosen), F.col("__id") == F.col("__key")
    ).select("text", "label")
