"""Sinks: panel, tables, build statistics, data dictionary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType


def _as_csv(df: DataFrame) -> DataFrame:
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: F.to_json(c) for c in lists}) if lists else df


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", key: str = "ID") -> None:
    """Write files ordered by key, within and across, so rebuilds come out the same.

    Range partitioning keeps every executor writing; no stage is a single task.
    """
    ordered = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    write_table(ordered, path, fmt)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        _as_csv(df).write.mode("overwrite").csv(path, header=True, escape='"')
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """One-row statistics as JSON."""
    stats.write.mode("overwrite").json(path)


def data_dictionary(df: DataFrame, notes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``position, variable, data_type, description, use`` for every column, in order."""
    rows = [
        (i, f.name, f.dataType.simpleString(), *notes.get(f.name, (None, None)))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, variable string, data_type string, description string, use string"
    )
