"""Coverage, missing values, duplicates, defaults and other quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.funnels import PANEL_SQL
from jobstrata.catalog.inputs import (
    CODE,
    INCLUDE,
    RAW_COLUMNS,
    RAW_SQL,
    RULES,
    TOKENS_SQL,
    number_sql,
    pay_sql,
    raw_postings,
    sql_any,
    state_sql,
    token_lists,
)
from jobstrata.catalog.registry import query, table
from jobstrata.functions.cells import (
    canonical_label,
    keep_between,
    name_key,
    number,
    text_list,
)
from jobstrata.functions.pay import add_pay
from jobstrata.functions.places import state_of
from jobstrata.operators.funnel import title_has
from jobstrata.operators.market import numeric_center
from jobstrata.operators.profile import (
    conditional_share,
    domain_counts,
    dominant_values,
    field_coverage,
    initial_letter_profile,
    key_uniqueness,
    list_coverage,
    missing_summary,
    modal_value,
    repeat_members,
    repeat_summary,
    schema_profile,
    spelling_variants,
    volume_by_code,
)
from jobstrata.plans.baseline import market_tables
from jobstrata.plans.panel import PAY, PLACES, build_panel
from jobstrata.presets import postings as preset
from jobstrata.sources.writers import data_dictionary

_PAY_ARGS = ("SALARY_FROM", "SALARY_TO", "ORIGINAL_PAY_PERIOD")


def union_sql(rows: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT {r} FROM {source}" for r in rows)


@query(
    f"WITH {RAW_SQL} "
    + union_sql(
        [f"'{c}' AS field, count_if(trim({c}) <> '') AS filled" for c in preset.COVERAGE_FIELDS],
        "raw",
    )
)
def coverage_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_coverage(raw_postings(spark, sf_dir), preset.COVERAGE_FIELDS)


@query(
    f"WITH {RAW_SQL} "
    + union_sql(
        [
            f"'{c}' AS field, count_if(trim({c}) <> '' AND trim({c}) <> '[]') AS filled, "
            f"round(100e0 * count_if(trim({c}) <> '' AND trim({c}) <> '[]') / count(*), 4) AS share"
            for c in preset.LIST_FIELDS
        ],
        "raw",
    )
)
def coverage_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_coverage(raw_postings(spark, sf_dir), preset.LIST_FIELDS)


_YEARS = number_sql("MIN_YEARS_EXPERIENCE")


@query(
    f"WITH {RAW_SQL}, parsed AS (SELECT {_YEARS} AS low, {number_sql('MAX_YEARS_EXPERIENCE')} AS high FROM raw) "
    + union_sql(
        [
            "'zero' AS field, count_if(low = 0) AS n",
            "'over 20', count_if(low > 20)",
            "'max below min', count_if(high < low)",
        ],
        "parsed",
    )
)
def out_of_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = number(F.col("MIN_YEARS_EXPERIENCE"))
    high = number(F.col("MAX_YEARS_EXPERIENCE"))
    return domain_counts(
        raw_postings(spark, sf_dir),
        {"zero": low == 0, "over 20": low > preset.YEARS_MAX, "max below min": high < low},
    )


_STATE_SQL = state_sql("LOCATION", "STATE", "STATE_NAME")
_CHECKS_SQL = {
    "Job title": "TITLE_CLEAN IS NOT NULL",
    "Employer": "COMPANY_NAME IS NOT NULL",
    "Skills": "starts_with(SKILLS_NAME, '[') AND SKILLS_NAME <> '[]'",
    "Education": "MAX_EDULEVELS_NAME IS NOT NULL",
    "State": "found <> 'Unspecified'",
    "Arrangement": "trim(REMOTE_TYPE_NAME) <> ''",
    "Salary": "mid IS NOT NULL",
    "Experience": f"{_YEARS} BETWEEN 1 AND 20",
}


@query(
    f"WITH {RAW_SQL}, {pay_sql('raw')}, checked AS (SELECT paid.*, {_STATE_SQL} AS found FROM paid) "
    + union_sql(
        [
            f"'{f}' AS field, count_if({p}) AS populated, count(*) - count_if({p}) AS missing, "
            f"round(100e0 * count_if({p}) / count(*), 4) AS coverage"
            for f, p in _CHECKS_SQL.items()
        ],
        "checked",
    )
)
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = add_pay(raw_postings(spark, sf_dir), *_PAY_ARGS, PAY, ("low", "high", "mid"))
    found = state_of(F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), PLACES)
    arrangement = canonical_label(
        F.col("REMOTE_TYPE_NAME"), preset.ARRANGEMENT_SYNONYMS, preset.ARRANGEMENT_UNKNOWN
    )
    years = keep_between(
        number(F.col("MIN_YEARS_EXPERIENCE")), preset.YEARS_MIN, preset.YEARS_MAX
    )
    return missing_summary(
        paid,
        {
            "Job title": F.col("TITLE_CLEAN").isNotNull(),
            "Employer": F.col("COMPANY_NAME").isNotNull(),
            "Skills": F.size(text_list(F.col("SKILLS_NAME"))) > 0,
            "Education": F.col("MAX_EDULEVELS_NAME").isNotNull(),
            "State": found != preset.STATE_UNRESOLVED,
            "Arrangement": arrangement != preset.ARRANGEMENT_UNKNOWN,
            "Salary": F.col("mid").isNotNull(),
            "Experience": years.isNotNull(),
        },
    )


# The whole summary, read off the panel as the reference's table is.
_PANEL_CHECKS_SQL = {
    "Job title": "TITLE_CLEAN IS NOT NULL",
    "Employer": "COMPANY_NAME IS NOT NULL",
    "Role family": "role_family IS NOT NULL",
    "Posted date": "posted_date IS NOT NULL",
    "Skills": "SKILLS_NAME <> ''",
    "Highest education mentioned": "MAX_EDULEVELS_NAME IS NOT NULL",
    "State (derived)": f"state <> '{preset.STATE_UNRESOLVED}'",
    "Minimum education": "MIN_EDULEVELS_NAME IS NOT NULL",
    "Work arrangement": f"REMOTE_TYPE_NAME <> '{preset.ARRANGEMENT_UNKNOWN}'",
    "Salary midpoint": "salary_midpoint IS NOT NULL",
    "Minimum experience": "min_years_experience IS NOT NULL",
}


@query(
    f"WITH {PANEL_SQL} "
    + union_sql(
        [
            f"'{f}' AS field, count_if({p}) AS populated, count(*) - count_if({p}) AS missing, "
            f"round(100e0 * count_if({p}) / count(*), 4) AS coverage"
            for f, p in _PANEL_CHECKS_SQL.items()
        ],
        "panel",
    )
)
def panel_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_tables()["missing_values"](build_panel(raw_postings(spark, sf_dir), RULES))


_RAW_TYPES = {"ID": "bigint", "COMPANY_IS_STAFFING": "boolean"}
_PROFILED = [
    "ID",
    "TITLE_CLEAN",
    "COMPANY_NAME",
    "COMPANY_IS_STAFFING",
    "LOCATION",
    "STATE_NAME",
    "SKILLS_NAME",
    "NAICS_2022_4",
]


@query(
    f"WITH {RAW_SQL} "
    + union_sql(
        [
            f"CAST({i} AS INT) AS position, '{c}' AS \"column\", '{_RAW_TYPES.get(c, 'string')}' AS type, "
            f"count({c}) AS non_null"
            for i, c in enumerate(_PROFILED)
        ],
        "raw",
    )
)
def schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_profile(raw_postings(spark, sf_dir).select(*_PROFILED))


@query(
    f"WITH {RAW_SQL} "
    + union_sql(
        [
            f"CAST({i} AS INT) AS position, '{c}' AS \"column\", '{_RAW_TYPES.get(c, 'string')}' AS type, "
            f"count({c}) AS non_null"
            for i, c in enumerate(RAW_COLUMNS)
        ],
        "raw",
    )
)
def schema_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_profile(raw_postings(spark, sf_dir).select(*RAW_COLUMNS))


NOTES = {
    "o_orderkey": ("Order number", "Unique key"),
    "o_totalprice": ("Order total", "Measure of pay"),
}


@query(
    """WITH fields AS (SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS variable, column_type
        FROM (DESCRIBE orders))
    SELECT position, variable, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
        WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type,
    CASE variable WHEN 'o_orderkey' THEN 'Order number' WHEN 'o_totalprice' THEN 'Order total' END AS description,
    CASE variable WHEN 'o_orderkey' THEN 'Unique key' WHEN 'o_totalprice' THEN 'Measure of pay' END AS use,
    (SELECT count(o_orderkey) FROM orders) AS described_rows FROM fields"""
)
def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.agg(F.count("o_orderkey")).scalar()
    return data_dictionary(orders, NOTES).withColumn("described_rows", rows)


@query(
    """SELECT count(*) AS postings, count(DISTINCT o_orderkey) AS distinct_keys,
    count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders"""
)
def unique_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_uniqueness(table(spark, sf_dir, "orders"), "o_orderkey")


@query(
    """SELECT count(*) AS postings, count(DISTINCT l_orderkey) AS distinct_keys,
    count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem"""
)
def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_uniqueness(table(spark, sf_dir, "lineitem"), "l_orderkey")


# Priority is missing on some orders, so some repeat keys hold a null.
_REPEAT_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority",
    "extract(YEAR FROM o_orderdate) AS year",
    "o_orderstatus",
]
_REPEAT_SQL = f"keyed AS (SELECT {', '.join(_REPEAT_COLUMNS)} FROM orders)"
_KEYS = ["o_custkey", "priority", "year"]


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_REPEAT_COLUMNS)


@query(
    f"""WITH {_REPEAT_SQL}, groups AS (SELECT o_custkey, priority, year, count(*) AS n,
        count(DISTINCT o_orderstatus) AS places FROM keyed GROUP BY ALL)
    SELECT CAST(sum(n) FILTER (n > 1) AS BIGINT) AS repeat_rows,
    count_if(n > 1 AND priority IS NOT NULL) AS repeat_groups,
    count_if(n > 1 AND priority IS NOT NULL AND places > 1) AS spread_groups FROM groups"""
)
def repeat_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_summary(_keyed_orders(spark, sf_dir), _KEYS, "o_orderstatus")


@query(
    f"""WITH {_REPEAT_SQL} SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, priority, year) AS group_size
    FROM keyed QUALIFY group_size > 1"""
)
def repeat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_members(_keyed_orders(spark, sf_dir), _KEYS).select("o_orderkey", "group_size")


@query(
    """SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderpriority) AS group_size FROM orders"""
)
def repeat_rows_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with five keys that hold all rows between them."""
    orders = table(spark, sf_dir, "orders")
    return repeat_members(orders, ["o_orderpriority"]).select("o_orderkey", "group_size")


@query(
    f"WITH {RAW_SQL}, {pay_sql('raw')} "
    + union_sql(
        [
            "'filled' AS field, count_if(trim(SALARY_FROM) <> '') AS n",
            "'removed', count_if(trim(SALARY_FROM) <> '') - count(mid)",
            "'usable hourly', count_if(mid IS NOT NULL AND lower(trim(ORIGINAL_PAY_PERIOD)) = 'hourly')",
            "'usable monthly', count_if(mid IS NOT NULL AND lower(trim(ORIGINAL_PAY_PERIOD)) = 'monthly')",
        ],
        "paid",
    )
)
def removed_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = add_pay(raw_postings(spark, sf_dir), *_PAY_ARGS, PAY, ("low", "high", "mid"))
    given = F.coalesce(F.trim("SALARY_FROM") != "", F.lit(False))
    usable, period = F.col("mid").isNotNull(), F.lower(F.trim("ORIGINAL_PAY_PERIOD"))
    # A usable row is a filled one, so the difference of the counts is a count.
    return domain_counts(
        paid,
        {
            "filled": given,
            "removed": given & ~usable,
            "usable hourly": usable & (period == "hourly"),
            "usable monthly": usable & (period == "monthly"),
        },
    )


@query(
    f"""WITH {RAW_SQL}, parsed AS (SELECT {_YEARS} AS years FROM raw),
    stated AS (SELECT years FROM parsed WHERE years BETWEEN 1 AND 20)
    SELECT count(*) AS n, median(years) AS median,
    (SELECT years FROM stated GROUP BY years ORDER BY count(*) DESC, years LIMIT 1) AS mode FROM stated"""
)
def experience_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = keep_between(
        number(F.col("MIN_YEARS_EXPERIENCE")), preset.YEARS_MIN, preset.YEARS_MAX
    )
    return numeric_center(raw_postings(spark, sf_dir), years)


@query(
    """SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY value ORDER BY n DESC, value LIMIT 1"""
)
def most_common_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modal_value(table(spark, sf_dir, "orders"), F.col("o_orderpriority"))


@query(
    f"WITH {RAW_SQL} "
    + union_sql(
        [
            "'min stated' AS field, count(MIN_EDULEVELS_NAME) AS n",
            "'max stated', count(MAX_EDULEVELS_NAME)",
            "'associate minimum', count_if(MIN_EDULEVELS_NAME = 'Associate''s degree')",
            "'high school minimum', count_if(MIN_EDULEVELS_NAME = 'High school diploma or equivalent')",
        ],
        "raw",
    )
)
def education_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = F.col("MIN_EDULEVELS_NAME"), F.col("MAX_EDULEVELS_NAME")
    return domain_counts(
        raw_postings(spark, sf_dir),
        {
            "min stated": low.isNotNull(),
            "max stated": high.isNotNull(),
            "associate minimum": low == "Associate's degree",
            "high school minimum": low == "High school diploma or equivalent",
        },
    )


_DOMINANT = {
    "education": "MIN_EDULEVELS_NAME",
    "arrangement": "REMOTE_TYPE_NAME",
    "county": "COUNTY_NAME",
    "occupation": "ONET_NAME",
}


@query(
    f"WITH {RAW_SQL} "
    + " UNION ALL ".join(
        f"(SELECT '{f}' AS field, {c} AS value, count(*) AS n, "
        f"round(100e0 * count(*) / (SELECT count(*) FROM raw), 4) AS share FROM raw "
        f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, value LIMIT 1)"
        for f, c in _DOMINANT.items()
    )
)
def default_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dominant_values(
        raw_postings(spark, sf_dir), {f: F.col(c) for f, c in _DOMINANT.items()}
    )


@query(
    f"""WITH {TOKENS_SQL}, items AS (SELECT DISTINCT unnest(items) AS item FROM tokens)
    SELECT upper(substring(item, 1, 1)) AS initial, count(*) AS items FROM items GROUP BY initial"""
)
def initial_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_letter_profile(token_lists(spark, sf_dir), "items")


@query(
    f"""WITH {TOKENS_SQL}, items AS (SELECT DISTINCT unnest(items) AS item FROM tokens)
    SELECT count(*) AS distinct_items, count_if(upper(substring(item, 1, 1)) BETWEEN 'D' AND 'Z') AS from_d_to_z
    FROM items"""
)
def truncation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = initial_letter_profile(token_lists(spark, sf_dir), "items")
    late = F.col("initial").between("D", "Z")
    return letters.agg(
        F.sum("items").alias("distinct_items"),
        F.sum(F.when(late, F.col("items")).otherwise(0)).alias("from_d_to_z"),
    )


_OCCUPATIONS = ", ".join(f"'{o}'" for o in preset.OCCUPATIONS_KEPT)


@query(
    f"WITH {RAW_SQL}, placed AS (SELECT raw.*, {_STATE_SQL} AS found FROM raw) "
    + union_sql(
        [
            "'arrangement unknown' AS field, count_if(coalesce(trim(REMOTE_TYPE_NAME), '') = '') AS n",
            "'arrangement stated', count_if(trim(REMOTE_TYPE_NAME) <> '')",
            "'located', count_if(found <> 'Unspecified')",
            "'unspecified', count_if(found = 'Unspecified')",
            "'capital district', count_if(found = 'District of Columbia')",
            f"'other occupation', count_if(ONET_NAME IS NULL OR ONET_NAME NOT IN ({_OCCUPATIONS}))",
        ],
        "placed",
    )
)
def sentinel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_postings(spark, sf_dir)
    arrangement = canonical_label(
        F.col("REMOTE_TYPE_NAME"), preset.ARRANGEMENT_SYNONYMS, preset.ARRANGEMENT_UNKNOWN
    )
    labelled = raw.select(
        arrangement.alias("arrangement"),
        state_of(F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), PLACES).alias("found"),
        F.coalesce(F.col("ONET_NAME").isin(preset.OCCUPATIONS_KEPT), F.lit(False)).alias("kept"),
    )
    return domain_counts(
        labelled,
        {
            "arrangement unknown": F.col("arrangement") == preset.ARRANGEMENT_UNKNOWN,
            "arrangement stated": F.col("arrangement") != preset.ARRANGEMENT_UNKNOWN,
            "located": F.col("found") != preset.STATE_UNRESOLVED,
            "unspecified": F.col("found") == preset.STATE_UNRESOLVED,
            "capital district": F.col("found") == preset.CAPITAL_LABEL,
            "other occupation": ~F.col("kept"),
        },
    )


@query(
    f"""WITH {RAW_SQL}, keyed AS (SELECT COMPANY_NAME, regexp_replace(regexp_replace(lower(COMPANY_NAME),
        '[^a-z0-9]', '', 'g'), '(llc|inc|corp|corporation|ltd)$', '') AS name_key FROM raw)
    SELECT name_key, count(DISTINCT COMPANY_NAME) AS spellings, count(COMPANY_NAME) AS postings
    FROM keyed GROUP BY name_key HAVING spellings > 1"""
)
def company_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = name_key(F.col("COMPANY_NAME"), preset.COMPANY_SUFFIX)
    return spelling_variants(raw_postings(spark, sf_dir), "COMPANY_NAME", key)


@query(
    f"""WITH {RAW_SQL}, parsed AS (SELECT TITLE_CLEAN, {_YEARS} AS years FROM raw)
    SELECT CASE WHEN years = 0 THEN 'zero' ELSE 'one or more' END AS value, count(*) AS n,
    round(100e0 * count_if(regexp_matches(TITLE_CLEAN, '(?i)large|old')) / count(*), 4) AS share
    FROM parsed WHERE years = 0 OR years >= 1 GROUP BY value"""
)
def suspicious_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = number(F.col("MIN_YEARS_EXPERIENCE"))
    senior = F.col("TITLE_CLEAN").rlike("(?i)large|old")
    return conditional_share(
        raw_postings(spark, sf_dir).filter((years == 0) | (years >= 1)),
        F.when(years == 0, "zero").otherwise("one or more"),
        senior,
    )


@query(
    f"""WITH volumes AS (SELECT p_brand AS code, count(*) AS postings FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE regexp_matches(p_name, '{sql_any(INCLUDE)}') GROUP BY code)
    SELECT code, postings, rank() OVER (ORDER BY postings DESC) AS rank, postings < 1200 AS is_small FROM volumes"""
)
def code_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return volume_by_code(rows, "p_brand", title_has(F.col("p_name"), INCLUDE), 1200)


@query(
    f"WITH {RAW_SQL}, {pay_sql('raw')}, audited AS (SELECT paid.*, {_STATE_SQL} AS found FROM paid WHERE mid IS NOT NULL "
    f"AND NAICS_2022_4 = '{CODE}') "
    + union_sql(
        [
            f"'experience stated' AS field, count_if({_YEARS} BETWEEN 1 AND 20) AS populated, "
            f"count(*) - count_if({_YEARS} BETWEEN 1 AND 20) AS missing, "
            f"round(100e0 * count_if({_YEARS} BETWEEN 1 AND 20) / count(*), 4) AS coverage",
            "'staffing', count_if(COMPANY_IS_STAFFING), count(*) - count_if(COMPANY_IS_STAFFING), "
            "round(100e0 * count_if(COMPANY_IS_STAFFING) / count(*), 4)",
            "'state', count_if(found <> 'Unspecified'), count_if(found = 'Unspecified'), "
            "round(100e0 * count_if(found <> 'Unspecified') / count(*), 4)",
        ],
        "audited",
    )
)
def model_field_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = add_pay(raw_postings(spark, sf_dir), *_PAY_ARGS, PAY, ("low", "high", "mid"))
    found = state_of(F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), PLACES)
    years = keep_between(
        number(F.col("MIN_YEARS_EXPERIENCE")), preset.YEARS_MIN, preset.YEARS_MAX
    )
    return missing_summary(
        paid.filter(F.col("mid").isNotNull() & (F.col("NAICS_2022_4") == CODE)),
        {
            "experience stated": years.isNotNull(),
            "staffing": F.col("COMPANY_IS_STAFFING"),
            "state": found != preset.STATE_UNRESOLVED,
        },
    )
