"""Coverage, domain and duplicate checks. Each is one aggregation over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.functions.cells import filled, filled_list, share
from jobstrata.operators.frequency import frequency
from jobstrata.operators.joins import attach_group_size


def counts_long(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``field, n, total``: rows for which each predicate holds."""
    return df.agg(
        F.count("*").alias("total"),
        *[F.count_if(p).alias(f"_{i}") for i, p in enumerate(checks.values())],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("field"),
                        F.col(f"_{i}").alias("n"),
                        F.col("total").alias("total"),
                    )
                    for i, name in enumerate(checks)
                ]
            )
        )
    )


def domain_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    return counts_long(df, checks).select("field", "n")


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``field, filled``: non-blank cells per column."""
    return counts_long(df, {f: filled(F.col(f)) for f in fields}).select(
        "field", F.col("n").alias("filled")
    )


def list_coverage(df: DataFrame, fields: Sequence[str], digits: int = 4) -> DataFrame:
    """``field, filled, share``: list cells that hold something."""
    return counts_long(df, {f: filled_list(F.col(f)) for f in fields}).select(
        "field", F.col("n").alias("filled"), share(F.col("n"), F.col("total"), digits).alias("share")
    )


def missing_summary(df: DataFrame, checks: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """``field, populated, missing, coverage``; each field names its own meaning of populated."""
    return counts_long(df, checks).select(
        "field",
        F.col("n").alias("populated"),
        (F.col("total") - F.col("n")).alias("missing"),
        share(F.col("n"), F.col("total"), digits).alias("coverage"),
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """``position, column, type, non_null`` in schema order."""
    fields = df.schema.fields
    return df.agg(*[F.count(F.col(f.name)).alias(f"_{i}") for i, f in enumerate(fields)]).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col(f"_{i}").alias("non_null"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        )
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("postings"), F.countDistinct(key).alias("distinct_keys")).select(
        "postings", "distinct_keys", (F.col("postings") == F.col("distinct_keys")).alias("is_unique")
    )


def repeat_summary(df: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """Rows that share all keys with another row, the groups they form, and the
    groups spanning more than one ``spread`` value.

    Null keys count as equal for rows, but a group with a null key is not counted.
    """
    groups = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.countDistinct(spread).alias("places")
    )
    named = ~F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(
        keys[0]
    ).isNotNull()
    repeated = F.col("n") > 1
    return groups.agg(
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeat_rows"),
        F.count_if(repeated & named).alias("repeat_groups"),
        F.count_if(repeated & named & (F.col("places") > 1)).alias("spread_groups"),
    )


def repeat_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row that shares all keys with another row, with the group's size."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("group_size"))
    return attach_group_size(df, groups, keys, "group_size").filter(F.col("group_size") > 1)


def modal_value(df: DataFrame, col: Column) -> DataFrame:
    """One row ``value, n``: the most common stated value, the smallest of ties."""
    counted = df.groupBy(col.alias("value")).agg(F.count("*").alias("n"))
    return (
        counted.filter(F.col("value").isNotNull()).orderBy(F.desc("n"), F.asc("value")).limit(1)
    )


def dominant_values(df: DataFrame, fields: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """``field, value, n, share``: per field its most common value and that value's
    share of all rows, which exposes a default filled in by the source."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("field"), col.cast("string").alias("value"))
            for name, col in fields.items()
        ]
    )
    counted = df.select(F.inline(cells)).groupBy("field", "value").agg(F.count("*").alias("n"))
    return (
        counted.groupBy("field")
        .agg(
            F.min(
                F.when(
                    F.col("value").isNotNull(),
                    F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")),
                )
            ).alias("best"),
            F.sum("n").alias("total"),
        )
        .select(
            "field",
            F.col("best.value").alias("value"),
            (-F.col("best.neg")).alias("n"),
            share(-F.col("best.neg"), F.col("total"), digits).alias("share"),
        )
    )


def initial_letter_profile(df: DataFrame, items: str) -> DataFrame:
    """``initial, items``: distinct list items per upper-cased first letter."""
    return (
        df.select(F.explode(items).alias("item"))
        .distinct()
        .groupBy(F.upper(F.substring("item", 1, 1)).alias("initial"))
        .agg(F.count("*").alias("items"))
    )


def spelling_variants(df: DataFrame, name: str, key: Column) -> DataFrame:
    """``name_key, spellings, postings`` of the names written in more than one way."""
    return (
        df.groupBy(key.alias("name_key"))
        .agg(F.countDistinct(name).alias("spellings"), F.count(name).alias("postings"))
        .filter(F.col("spellings") > 1)
    )


def conditional_share(df: DataFrame, group: Column, flag: Column, digits: int = 4) -> DataFrame:
    """``value, n, share``: share of each group's rows for which the flag holds."""
    return df.groupBy(group.alias("value")).agg(
        F.count("*").alias("n"), share(F.count_if(flag), F.count("*"), digits).alias("share")
    )


def volume_by_code(df: DataFrame, code: str, rule: Column, small: int) -> DataFrame:
    """``code, postings, rank, is_small``: matching rows per code, largest first."""
    return frequency(df.filter(rule), F.col(code)).select(
        F.col("value").alias("code"),
        F.col("n").alias("postings"),
        "rank",
        (F.col("n") < small).alias("is_small"),
    )
