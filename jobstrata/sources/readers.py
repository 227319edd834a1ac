"""Readers with their checks: raw postings, panel, ratings."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TEXT, _NUMBER = StringType(), DoubleType()

RAW_SCHEMA = StructType(
    [
        StructField("ID", LongType()),
        StructField("TITLE_CLEAN", _TEXT),
        StructField("COMPANY_NAME", _TEXT),
        StructField("COMPANY_IS_STAFFING", BooleanType()),
        StructField("POSTED", _TEXT),
        StructField("LOCATION", _TEXT),
        StructField("STATE", _TEXT),
        StructField("STATE_NAME", _TEXT),
        StructField("COUNTY_NAME", _TEXT),
        StructField("MSA_NAME", _TEXT),
        StructField("REMOTE_TYPE_NAME", _TEXT),
        StructField("MIN_EDULEVELS_NAME", _TEXT),
        StructField("MAX_EDULEVELS_NAME", _TEXT),
        StructField("MIN_YEARS_EXPERIENCE", _TEXT),
        StructField("MAX_YEARS_EXPERIENCE", _TEXT),
        StructField("SALARY_FROM", _TEXT),
        StructField("SALARY_TO", _TEXT),
        StructField("ORIGINAL_PAY_PERIOD", _TEXT),
        StructField("ONET_NAME", _TEXT),
        StructField("SKILLS_NAME", _TEXT),
        StructField("SPECIALIZED_SKILLS_NAME", _TEXT),
        StructField("COMMON_SKILLS_NAME", _TEXT),
        StructField("SOFTWARE_SKILLS_NAME", _TEXT),
        StructField("NAICS_2022_4", _TEXT),
        StructField("NAICS_2022_6_NAME", _TEXT),
    ]
)

_SKILLS = ArrayType(StringType())
PANEL_SCHEMA = StructType(
    [
        StructField("ID", LongType()),
        StructField("TITLE_CLEAN", _TEXT),
        StructField("COMPANY_NAME", _TEXT),
        StructField("COMPANY_IS_STAFFING", BooleanType()),
        StructField("occupation_group", _TEXT),
        StructField("role_family", _TEXT),
        StructField("posted_date", DateType()),
        StructField("state", _TEXT),
        StructField("LOCATION", _TEXT),
        StructField("REMOTE_TYPE_NAME", _TEXT),
        StructField("MAX_EDULEVELS_NAME", _TEXT),
        StructField("MIN_EDULEVELS_NAME", _TEXT),
        StructField("min_years_experience", _NUMBER),
        StructField("max_years_experience", _NUMBER),
        StructField("salary_from_annual", _NUMBER),
        StructField("salary_to_annual", _NUMBER),
        StructField("salary_midpoint", _NUMBER),
        StructField("ORIGINAL_PAY_PERIOD", _TEXT),
        StructField("SKILLS_NAME", _SKILLS),
        StructField("SPECIALIZED_SKILLS_NAME", _SKILLS),
        StructField("NAICS_2022_4", _TEXT),
        StructField("NAICS_2022_6_NAME", _TEXT),
    ]
)


class SourceError(ValueError):
    """The source does not hold what the job was promised."""


def check_source(
    df: DataFrame, columns: Sequence[str], expected_files: int | None = None
) -> DataFrame:
    """Raise if a column is missing or the number of files is not the expected one."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SourceError(f"missing columns: {', '.join(missing)}")
    if expected_files is not None:
        found = len(df.inputFiles())
        if found != expected_files:
            raise SourceError(f"expected {expected_files} files, found {found}")
    return df


def schema_problems(
    spark: SparkSession, files: Sequence[str], wanted: StructType, parallelism: int = 8
) -> DataFrame:
    """``file, column, wanted, found``: where a Parquet file departs from the wanted columns and
    types; ``found`` is null for a column that is not there.

    Only footers are read, each in a task of its own by Spark's reader, so any path that
    Spark opens will do. Further columns, their order and nullability are not compared. The
    driver gets the schema of one file at a time and keeps the departures.
    """

    def departures(file: str) -> list[tuple]:
        found = {f.name: f.dataType.simpleString() for f in spark.read.parquet(file).schema}
        named = [(f.name, f.dataType.simpleString()) for f in wanted]
        return [(file, name, kind, found.get(name)) for name, kind in named if found.get(name) != kind]

    with ThreadPool(parallelism) as pool:
        work = inheritable_thread_target(spark)(departures)
        rows = [row for found in pool.imap(work, files) for row in found]
    return spark.createDataFrame(rows, "file string, column string, wanted string, found string")


def check_types(spark: SparkSession, files: Sequence[str], wanted: StructType) -> None:
    """Raise, naming files and columns, if a file lacks a column or has it in another type."""
    problems = schema_problems(spark, files, wanted).orderBy("file", "column").limit(20).collect()
    if problems:
        named = [
            f"{p['file']}: {p['column']} is {p['found'] or 'missing'}, not {p['wanted']}"
            for p in problems
        ]
        raise SourceError("; ".join(named))


def read_postings(
    spark: SparkSession, *paths: str, expected_files: int | None = None
) -> DataFrame:
    """Raw postings from Parquet; columns beyond those checked stay available.

    The number of files, and each file's columns and types, are checked before a row is read.
    """
    df = check_source(spark.read.parquet(*paths), [], expected_files)
    check_types(spark, df.inputFiles(), RAW_SCHEMA)
    return check_source(df, RAW_SCHEMA.fieldNames())


def source_inventory(df: DataFrame) -> DataFrame:
    """One row: files, columns, rows. Files without rows count; no column is read."""
    return df.agg(
        F.lit(len(df.inputFiles())).cast("long").alias("files"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.count("*").alias("rows"),
    )


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The panel with its types; a CSV export holds skill lists as JSON text."""
    if fmt == "parquet":
        return spark.read.schema(PANEL_SCHEMA).parquet(path)
    as_text = StructType(
        [
            StructField(f.name, _TEXT if f.dataType == _SKILLS else f.dataType)
            for f in PANEL_SCHEMA.fields
        ]
    )
    df = spark.read.schema(as_text).csv(path, header=True, escape='"', multiLine=True)
    lists = [f.name for f in PANEL_SCHEMA.fields if f.dataType == _SKILLS]
    return df.withColumns({c: F.from_json(c, _SKILLS) for c in lists})


def read_ratings(spark: SparkSession, path: str, people: Sequence[str]) -> DataFrame:
    """Wide ratings: skill, its name in the panel, one column per person, a note."""
    schema = StructType(
        [
            StructField("skill", _TEXT),
            StructField("panel_skill_name", _TEXT),
            *[StructField(p, IntegerType()) for p in people],
            StructField("rating_source", _TEXT),
        ]
    )
    return spark.read.schema(schema).csv(path, header=True, escape='"', enforceSchema=True)
