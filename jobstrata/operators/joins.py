"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 1000


def keep_together(counted: DataFrame, *counts: str) -> DataFrame:
    """Keep all of these counts in every branch that reads the table.

    Spark drops aggregates a branch does not use, and branches that keep
    different ones no longer share their scan and shuffle. A condition that
    always holds but names them all prevents that.
    """
    return counted.filter(reduce(and_, [F.col(c) >= 0 for c in counts]))


def same_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys where null equals null; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(and_, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])


def attach_group_size(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str
) -> DataFrame:
    """Give every row its group's columns without putting a hot group in one task.

    A group holding more than a thousandth of the rows is hot. There are fewer
    than a thousand of those, so they are broadcast; the rest joins as usual.
    """
    total = groups.agg(F.sum(size)).scalar()
    is_hot = F.col(size) * HOT_SHARE > total
    hot = F.broadcast(groups.filter(is_hot))
    on_hot = same_keys(rows, hot, keys)
    keys_hot = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    cold_rows = rows.join(
        F.broadcast(keys_hot),
        reduce(and_, [rows[k].eqNullSafe(keys_hot[f"_hot_{k}"]) for k in keys]),
        "left_anti",
    )
    return on_hot.unionByName(same_keys(cold_rows, groups.filter(~is_hot), keys))
