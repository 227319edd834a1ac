"""Labels, 0/1 features and deterministic stratified splits for the pay classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from jobstrata.operators.frequency import label_counts
from jobstrata.operators.quantiles import median_value
from jobstrata.operators.ranking import hash_positions, numbered
from jobstrata.session import stored

#: the block of list items
ITEM_BLOCK = "skill"


def median_label(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """Rows that state the value, labelled 1 when it lies strictly above their median."""
    stated = df.filter(F.col(value).isNotNull())
    return stated.withColumn(
        label, (F.col(value) > median_value(df, F.col(value))).cast("int")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(label) == 1).alias("above"),
        F.count_if(F.col(label) == 0).alias("at_or_below"),
    )


def collapse_levels(df: DataFrame, col: str, k: int, keep: str, other: str) -> Column:
    """The column with its ``k`` most frequent levels and ``keep`` as is, the rest ``other``."""
    counted = label_counts(df.filter(F.col(col) != keep), F.col(col))
    top = counted.orderBy(F.desc("n"), F.asc("value")).limit(k)
    named = top.agg(F.collect_list("value")).scalar()
    value = F.col(col)
    return F.when(F.array_contains(named, value) | (value == keep), value).otherwise(F.lit(other))


def feature_index(df: DataFrame, blocks: Sequence[str], items: DataFrame | None = None) -> DataFrame:
    """``feature, block, level, name``: a 0/1 feature for every level of every block column,
    numbered from 0 by block, then level; ``items`` (``item``) come last as block ``skill``.

    One pass over the rows; any number of levels. Null is no level. Runs jobs when called
    and writes the index as a table, so that later joins know its size.
    """
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.lit(b).alias("block"), F.col(b).alias("level"))
            for i, b in enumerate(blocks)
        ]
    )
    levels = df.select(F.inline(cells)).filter(F.col("level").isNotNull()).distinct()
    if items is not None:
        last = (F.lit(len(blocks)).alias("place"), F.lit(ITEM_BLOCK).alias("block"))
        levels = levels.union(items.select(*last, F.col("item").alias("level")))
    return stored(
        numbered(levels, ["place", "level"], "feature").select(
            F.col("feature").cast("int").alias("feature"),
            "block",
            "level",
            F.concat_ws(": ", "block", "level").alias("name"),
        )
    )


def active_features(
    df: DataFrame, index: DataFrame, blocks: Sequence[str], items: str | None = None
) -> DataFrame:
    """Add ``active``: the numbers of the row's features, ascending.

    A join of the index for each block column; Spark broadcasts it as long as it is small.
    Items are looked up in a map, so give only those of ``frequent_items``, whose number has
    a bound. Null cells, unknown levels and repeated items add nothing.
    """
    rows = df
    for i, block in enumerate(blocks):
        own = index.filter(F.col("block") == block)
        own = own.select(F.col("level").alias("_level"), F.col("feature").alias(f"_f{i}"))
        rows = rows.join(own, F.col(block) == F.col("_level"), "left").drop("_level")
    found = F.array_compact(F.array(*[F.col(f"_f{i}") for i in range(len(blocks))]))
    if items is not None:
        entries = F.collect_list(F.struct("level", "feature"))
        known = index.filter(F.col("block") == ITEM_BLOCK).agg(F.map_from_entries(entries)).scalar()
        listed = F.array_distinct(F.array_compact(F.coalesce(items, F.array().cast("array<string>"))))
        rows = rows.withColumns({"_known": known, "_listed": listed})
        places = F.transform("_listed", lambda x: F.try_element_at("_known", x))
        found = F.concat(found, F.array_compact(places))
    spent = [f"_f{i}" for i in range(len(blocks))] + ["_known", "_listed"]
    return rows.withColumn("active", F.array_sort(found)).drop(*spent)


def feature_vectors(df: DataFrame, size: int) -> DataFrame:
    """Add ``features``, the sparse vector of ``active``, by writing the rows as a table.

    A sparse vector is stored as kind, size, places and values, so the table is written in that
    layout and read as vectors.
    """
    ones = F.array_repeat(F.lit(1.0), F.size("active"))
    layout = (F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"))
    packed = F.struct(*layout, F.col("active").alias("indices"), ones.alias("values"))
    schema = StructType([*df.schema.fields, StructField("features", VectorUDT())])
    return stored(df.withColumn("features", packed), schema)


def one_hot(blocks: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """A 0/1 column ``block: level`` for every level of every block, none left out."""
    return {
        f"{block}: {level}": F.coalesce((F.col(block) == level).cast("double"), F.lit(0.0))
        for block, levels in blocks.items()
        for level in sorted(levels)
    }


def item_indicators(items: str, names: Sequence[str], block: str = ITEM_BLOCK) -> dict[str, Column]:
    return {
        f"{block}: {name}": F.coalesce(
            F.array_contains(items, name).cast("double"), F.lit(0.0)
        )
        for name in sorted(names)
    }


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float, folds: int, seed: int
) -> DataFrame:
    """Add ``is_test`` and ``fold``.

    Per class, the first ``ceil(size * test_share)`` rows in hash order are the
    test set; the rest deal themselves round robin to the folds (null in the
    test set). Nothing depends on how the rows are partitioned.
    """
    placed = hash_positions(df, label, key, seed)
    held_out = F.ceil(F.col("size") * test_share)
    after = F.col("position") - held_out
    return (
        placed.withColumn("is_test", after <= 0)
        .withColumn("fold", F.when(after > 0, F.pmod(after - 1, F.lit(folds))).cast("int"))
        .drop("position", "size")
    )
