"""Funnel, recency window, whole panel, build statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.inputs import (
    CODE,
    EXCLUDE,
    FUNNEL_SQL,
    INCLUDE,
    RAW_SQL,
    ROLES,
    RULES,
    number_sql,
    pay_sql,
    raw_postings,
    sql_any,
    state_sql,
)
from jobstrata.catalog.registry import query, table
from jobstrata.functions.cells import day
from jobstrata.functions.pay import add_pay
from jobstrata.operators.funnel import code_is, compare_extracts, recent, title_has, title_lacks
from jobstrata.plans.panel import PAY, build_panel, build_stats, panel_funnel
from jobstrata.presets import postings as preset
from jobstrata.sources.readers import source_inventory

_COUNTS_SQL = """counts AS (SELECT count(*) AS c0, count_if(in_industry) AS c1,
    count_if(in_industry AND included) AS c2,
    count_if(in_industry AND included AND not_excluded) AS c3,
    (SELECT count(*) FROM panel_raw) AS c4 FROM {source})"""
_STEPS_SQL = """SELECT step_no, step, postings, round(100e0 * postings / c0, 2) AS share FROM (
    SELECT 0 AS step_no, 'raw' AS step, c0 AS postings, c0 FROM counts
    UNION ALL SELECT 1, 'industry', c1, c0 FROM counts
    UNION ALL SELECT 2, 'role_include', c2, c0 FROM counts
    UNION ALL SELECT 3, 'role_exclude', c3, c0 FROM counts
    UNION ALL SELECT 4, 'in_window', c4, c0 FROM counts)"""


@query(f"WITH {FUNNEL_SQL}, {_COUNTS_SQL.format(source='flagged')} {_STEPS_SQL}")
def funnel_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_funnel(RULES).table(raw_postings(spark, sf_dir))


def _filled(col: str) -> str:
    return f"trim({col}) <> ''"


def _stats_sql() -> str:
    fields = ", ".join(f"count_if({_filled(c)}) AS filled_{c}" for c in preset.COVERAGE_FIELDS)
    lists = ", ".join(
        f"count_if({_filled(c)} AND trim({c}) <> '[]') AS listed_{c}" for c in preset.LIST_FIELDS
    )
    years = number_sql("MIN_YEARS_EXPERIENCE")
    return f"""WITH {FUNNEL_SQL},
    of_raw AS (SELECT count(*) AS raw_postings, count_if(in_industry) AS industry_postings,
        count_if(in_industry AND broad) AS broad_matches,
        count_if(in_industry AND included) AS after_include,
        count_if(in_industry AND included AND not_excluded) AS after_exclude FROM flagged),
    of_matched AS (SELECT count_if(day IS NULL) AS undated, count_if(day < last_day - 365) AS before_window,
        max(last_day) AS window_end, max(last_day) - 365 AS window_start FROM matched, latest),
    of_panel AS (SELECT count(*) AS after_window, {fields}, {lists},
        count_if({years} = 0) AS experience_zero, count_if({years} > 20) AS experience_over_20
        FROM panel_raw)
    SELECT * FROM of_raw, of_matched, of_panel"""


@query(_stats_sql())
def build_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = build_stats(raw_postings(spark, sf_dir), RULES)
    return stats.select(
        *[c for c in stats.columns if not c.endswith("_coverage") and c != "source_columns"],
        *[F.col("field_coverage")[c].alias(f"filled_{c}") for c in preset.COVERAGE_FIELDS],
        *[F.col("skill_field_coverage")[c].alias(f"listed_{c}") for c in preset.LIST_FIELDS],
    ).drop("final_postings")


@query(
    _stats_sql().replace(
        "SELECT * FROM of_raw, of_matched, of_panel",
        """SELECT *, (SELECT CAST(len(json_keys(to_json(raw))) AS INT) FROM raw LIMIT 1) AS source_columns,
    after_window AS final_postings FROM of_raw, of_matched, of_panel""",
    )
)
def build_statistics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole row, its two maps as a column per key."""
    stats = build_stats(raw_postings(spark, sf_dir), RULES)
    return stats.select(
        *[c for c in stats.columns if not c.endswith("_coverage")],
        *[F.col("field_coverage")[c].alias(f"filled_{c}") for c in preset.COVERAGE_FIELDS],
        *[F.col("skill_field_coverage")[c].alias(f"listed_{c}") for c in preset.LIST_FIELDS],
    )


def _years_sql(col: str) -> str:
    years = number_sql(col)
    return f"CASE WHEN {years} BETWEEN {preset.YEARS_MIN} AND {preset.YEARS_MAX} THEN {years} END"


def _list_sql(col: str) -> str:
    parsed = f"list_sort(list_distinct(CASE WHEN starts_with({col}, '[') THEN CAST({col} AS JSON)::VARCHAR[] END))"
    return f"coalesce(array_to_string({parsed}, ','), '')"


_OCCUPATIONS = ", ".join(f"'{o}'" for o in preset.OCCUPATIONS_KEPT)
_ROLE_SQL = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(lower(TITLE_CLEAN), '{p}') THEN '{r}'" for p, r in ROLES)
    + " ELSE 'Other' END"
)
ARRANGEMENT_SQL = """CASE WHEN REMOTE_TYPE_NAME IS NULL OR trim(REMOTE_TYPE_NAME) = '' THEN 'Unknown'
    WHEN lower(REMOTE_TYPE_NAME) IN ('onsite', 'on-site') THEN 'On-site' ELSE REMOTE_TYPE_NAME END"""

PANEL_SQL = f"""{FUNNEL_SQL}, {pay_sql('panel_raw')}, panel AS (SELECT ID, TITLE_CLEAN, COMPANY_NAME,
    COMPANY_IS_STAFFING,
    CASE WHEN ONET_NAME IN ({_OCCUPATIONS}) THEN ONET_NAME ELSE 'Other' END AS occupation_group,
    {_ROLE_SQL} AS role_family, day AS posted_date,
    {state_sql('LOCATION', 'STATE', 'STATE_NAME')} AS state, LOCATION,
    {ARRANGEMENT_SQL} AS REMOTE_TYPE_NAME, MAX_EDULEVELS_NAME, MIN_EDULEVELS_NAME,
    {_years_sql('MIN_YEARS_EXPERIENCE')} AS min_years_experience,
    {_years_sql('MAX_YEARS_EXPERIENCE')} AS max_years_experience,
    low AS salary_from_annual, high AS salary_to_annual, mid AS salary_midpoint, ORIGINAL_PAY_PERIOD,
    {_list_sql('SKILLS_NAME')} AS SKILLS_NAME, {_list_sql('SPECIALIZED_SKILLS_NAME')} AS SPECIALIZED_SKILLS_NAME,
    NAICS_2022_4, NAICS_2022_6_NAME FROM paid)"""


@query(f"WITH {PANEL_SQL} SELECT * FROM panel")
def panel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = build_panel(raw_postings(spark, sf_dir), RULES)
    lists = ["SKILLS_NAME", "SPECIALIZED_SKILLS_NAME"]
    return panel.withColumns({c: F.array_join(F.array_sort(c), ",") for c in lists})


@query(
    f"""WITH {RAW_SQL} SELECT TITLE_CLEAN, count(*) AS postings FROM raw
    WHERE NAICS_2022_4 = '{CODE}' AND regexp_matches(TITLE_CLEAN, '{sql_any(INCLUDE)}')
    AND NOT regexp_matches(TITLE_CLEAN, '{sql_any(EXCLUDE)}') GROUP BY TITLE_CLEAN"""
)
def title_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("TITLE_CLEAN")
    return (
        raw_postings(spark, sf_dir)
        .filter(code_is(F.col("NAICS_2022_4"), CODE))
        .filter(title_has(title, INCLUDE) & title_lacks(title, EXCLUDE))
        .groupBy("TITLE_CLEAN")
        .agg(F.count("*").alias("postings"))
    )


@query(
    f"""WITH {RAW_SQL}, dated AS (SELECT TRY_CAST(POSTED AS DATE) AS posted_date, NAICS_2022_4 FROM raw)
    SELECT posted_date, count(*) AS postings FROM dated
    WHERE posted_date >= (SELECT max(posted_date) - 365 FROM dated) GROUP BY posted_date"""
)
def recency_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = raw_postings(spark, sf_dir).withColumn("posted_date", day(F.col("POSTED")))
    return (
        recent(dated, "posted_date", preset.WINDOW_DAYS)
        .groupBy("posted_date")
        .agg(F.count("*").alias("postings"))
    )


@query(
    f"""WITH {RAW_SQL}, {pay_sql('raw')} SELECT ORIGINAL_PAY_PERIOD AS period, count(*) AS postings,
    round(max(mid), 2) AS largest FROM paid WHERE mid IS NOT NULL GROUP BY period"""
)
def paid_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = add_pay(
        raw_postings(spark, sf_dir),
        "SALARY_FROM",
        "SALARY_TO",
        "ORIGINAL_PAY_PERIOD",
        PAY,
        ("low", "high", "mid"),
    )
    return (
        paid.filter(F.col("mid").isNotNull())
        .groupBy(F.col("ORIGINAL_PAY_PERIOD").alias("period"))
        .agg(F.count("*").alias("postings"), F.round(F.max("mid"), 2).alias("largest"))
    )


def _half_sql(status: str) -> str:
    half = FUNNEL_SQL.replace("FROM raw)", f"FROM raw WHERE l_linestatus = '{status}')")
    return f"(WITH {half}, {_COUNTS_SQL.format(source='flagged')} {_STEPS_SQL})"


@query(
    f"""SELECT coalesce(a.step, b.step) AS step, a.postings AS first, a.share AS first_share,
    b.postings AS second, b.share AS second_share
    FROM {_half_sql('F')} a FULL OUTER JOIN {_half_sql('O')} b ON a.step = b.step"""
)
def extract_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_postings(spark, sf_dir)
    return compare_extracts(panel_funnel(RULES), raw, F.col("l_linestatus"), "F", "O")


@query(
    """SELECT CAST(1 AS BIGINT) AS files, (SELECT count(*) FROM (DESCRIBE lineitem)) AS columns,
    count(*) AS rows FROM lineitem"""
)
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_inventory(table(spark, sf_dir, "lineitem"))
