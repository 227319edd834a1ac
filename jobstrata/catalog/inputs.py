"""Inputs shaped like postings, derived from the given tables.

Each derived column is one SQL expression that Spark and DuckDB both read, so a
query and its counterpart start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.registry import table
from jobstrata.plans.panel import PanelRules
from jobstrata.presets import postings as preset

# Raw postings: one per lineitem, with the dirt a scraped extract has.
RAW_COLUMNS = {
    "ID": "l_orderkey",
    "TITLE_CLEAN": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE p_name END",
    "COMPANY_NAME": (
        "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN concat(p_name, ', LLC') "
        "WHEN p_partkey % 3 = 1 THEN upper(p_name) ELSE p_name END"
    ),
    "COMPANY_IS_STAFFING": "p_size > 45",
    "POSTED": (
        "CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 AND l_tax = 0 THEN 'unknown' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END"
    ),
    "LOCATION": (
        "CASE l_suppkey % 12 WHEN 0 THEN 'Washington, DC' "
        "WHEN 1 THEN '1331 Pennsylvania Avenue NW, Washington, D.C.' "
        "WHEN 2 THEN 'Charleston, West Virginia' WHEN 3 THEN 'Fayetteville, Arkansas' "
        "WHEN 4 THEN 'Kansas City, MO' WHEN 5 THEN 'Plano, TX, USA' WHEN 6 THEN 'Austin, TX' "
        "WHEN 7 THEN 'texas' WHEN 8 THEN 'Remote, United States' WHEN 9 THEN 'Sunnyvale' "
        "WHEN 10 THEN 'Paris, UK; London' ELSE NULL END"
    ),
    "STATE": (
        "CASE l_partkey % 6 WHEN 0 THEN 'ca' WHEN 1 THEN '' WHEN 2 THEN '  ' "
        "WHEN 3 THEN 'New York' WHEN 4 THEN 'Ontario' ELSE NULL END"
    ),
    "STATE_NAME": (
        "CASE l_partkey % 7 WHEN 0 THEN 'Remote' WHEN 1 THEN ' tx ' WHEN 2 THEN 'Ohio' "
        "WHEN 3 THEN 'United States' ELSE NULL END"
    ),
    "COUNTY_NAME": "CASE WHEN l_suppkey % 20 = 0 THEN 'Kings' ELSE ' ' END",
    "MSA_NAME": "CASE WHEN l_suppkey % 10 = 0 THEN 'Metro' ELSE NULL END",
    "REMOTE_TYPE_NAME": (
        "CASE l_linenumber WHEN 1 THEN 'Remote' WHEN 2 THEN 'Hybrid' WHEN 3 THEN 'Onsite' "
        "WHEN 4 THEN 'ON-SITE' WHEN 5 THEN '' WHEN 6 THEN ' ' ELSE NULL END"
    ),
    "MIN_EDULEVELS_NAME": (
        "CASE p_size % 5 WHEN 0 THEN 'High school diploma or equivalent' "
        "WHEN 1 THEN 'Associate''s degree' WHEN 2 THEN 'Bachelor''s degree' ELSE NULL END"
    ),
    "MAX_EDULEVELS_NAME": (
        "CASE p_size % 4 WHEN 0 THEN 'Bachelor''s degree' WHEN 1 THEN 'Master''s degree' "
        "WHEN 2 THEN 'Doctoral or professional degree' ELSE NULL END"
    ),
    "MIN_YEARS_EXPERIENCE": (
        "CASE WHEN l_tax = 0 THEN '' WHEN l_tax = 0.01 THEN 'n/a' "
        "ELSE CAST(CAST(l_quantity - 1 AS INT) AS STRING) END"
    ),
    "MAX_YEARS_EXPERIENCE": (
        "CASE WHEN l_tax = 0 THEN ' ' ELSE CAST(CAST(l_quantity + l_linenumber AS INT) AS STRING) END"
    ),
    "SALARY_FROM": (
        "CASE WHEN l_discount = 0 THEN '' WHEN l_discount = 0.01 THEN '0.00' "
        "WHEN l_discount = 0.02 THEN 'competitive' "
        "WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS DECIMAL(18, 2)) AS STRING) "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING) END"
    ),
    "SALARY_TO": (
        "CASE WHEN l_discount = 0.03 THEN NULL WHEN l_discount = 0.04 THEN '0' "
        "WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS DECIMAL(18, 2)) * "
        "CAST(1 + l_tax AS DECIMAL(4, 2)) AS STRING) "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(1 + l_tax AS DECIMAL(4, 2)) AS STRING) END"
    ),
    "ORIGINAL_PAY_PERIOD": (
        "CASE WHEN l_returnflag = 'A' THEN ' Hourly' WHEN l_returnflag = 'N' AND l_linestatus = 'F' "
        "THEN 'monthly' WHEN l_returnflag = 'N' THEN 'per project' ELSE '' END"
    ),
    "ONET_NAME": (
        "CASE p_size % 6 WHEN 0 THEN 'Data Scientists' WHEN 1 THEN 'Database Architects' "
        "WHEN 2 THEN 'Management Analysts' WHEN 3 THEN 'Business Intelligence Analysts' "
        "WHEN 4 THEN 'Statisticians' ELSE NULL END"
    ),
    "SKILLS_NAME": (
        "CASE l_linenumber WHEN 5 THEN '[]' WHEN 6 THEN 'none' WHEN 7 THEN NULL "
        "ELSE concat('[\"', p_brand, '\",\"', p_type, '\",\"', p_brand, '\"]') END"
    ),
    "SPECIALIZED_SKILLS_NAME": (
        "CASE l_linenumber WHEN 4 THEN ' [] ' WHEN 3 THEN '' ELSE concat('[\"', p_type, '\"]') END"
    ),
    "COMMON_SKILLS_NAME": "CASE WHEN l_linenumber < 4 THEN '[]' ELSE concat('[\"', p_name, '\"]') END",
    "SOFTWARE_SKILLS_NAME": "CASE WHEN p_size % 2 = 0 THEN '' ELSE concat('[\"', p_brand, '\"]') END",
    "NAICS_2022_4": "p_type",
    "NAICS_2022_6_NAME": "concat(p_type, ' goods')",
}

RAW_SQL = (
    "raw AS (SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in RAW_COLUMNS.items())
    + ", l_linestatus, l_partkey, l_suppkey, l_linenumber"
    + " FROM lineitem JOIN part ON l_partkey = p_partkey)"
)

CODE = "PROMO"
INCLUDE = ["widget", "plate", "ring", "gear"]
EXCLUDE = ["hot ", "old"]
BROAD = ["ring", "gear", "gizmo", "rod"]
ROLES = [("ring|gear", "Moving"), ("widget", "Widget"), ("blue", "Blue")]
RULES = PanelRules(code=CODE, include=INCLUDE, exclude=EXCLUDE, broad=BROAD, roles=ROLES)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.selectExpr(
        *[f"{expr} AS {name}" for name, expr in RAW_COLUMNS.items()],
        "l_linestatus",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
    )


def sql_any(patterns: list[str]) -> str:
    return "(?i)" + "|".join(patterns)


FUNNEL_SQL = f"""{RAW_SQL}, flagged AS (
    SELECT raw.*, TRY_CAST(POSTED AS DATE) AS day,
        NAICS_2022_4 = '{CODE}' AS in_industry,
        regexp_matches(TITLE_CLEAN, '{sql_any(INCLUDE)}') AS included,
        NOT regexp_matches(TITLE_CLEAN, '{sql_any(EXCLUDE)}') AS not_excluded,
        regexp_matches(TITLE_CLEAN, '{sql_any(BROAD)}') AS broad
    FROM raw),
matched AS (SELECT * FROM flagged WHERE in_industry AND included AND not_excluded),
latest AS (SELECT max(day) AS last_day FROM matched),
panel_raw AS (SELECT matched.* FROM matched, latest WHERE day >= last_day - 365)"""


def state_sql(text: str, state: str, state_name: str, validate: bool = False) -> str:
    """The state cascade as one CASE, before codes are turned into names."""
    names = "|".join(preset.STATES.values())
    listed = ", ".join(f"'{n}'" for n in preset.STATES.values())
    codes = ", ".join(f"'{c}'" for c in preset.STATES)
    code = f"regexp_extract({text}, '{preset.CODE_IN_TEXT}', 1)"
    code_ok, state_ok = f"{code} <> ''", f"trim({state}) <> ''"
    if validate:
        code_ok = f"{code} IN ({listed}, {codes})"
        state_ok = f"({state} IN ({listed}) OR upper({state}) IN ({codes}))"
    cities = " ".join(
        f"WHEN regexp_matches({text}, '(?i){p}') THEN '{s}'" for p, s in preset.CITY_RULES
    )
    found = f"""CASE WHEN regexp_matches({text}, '{preset.CAPITAL_PATTERN}') THEN '{preset.CAPITAL_LABEL}'
        WHEN regexp_extract({text}, '({names})', 1) <> '' THEN regexp_extract({text}, '({names})', 1)
        WHEN {code_ok} THEN {code}
        WHEN {state_ok} THEN {state}
        WHEN {state_name} IN ({listed}) OR upper(trim({state_name})) IN ({codes}) THEN trim({state_name})
        {cities} ELSE '{preset.STATE_UNRESOLVED}' END"""
    named = ", ".join(f"'{c}': '{n}'" for c, n in preset.STATES.items())
    return f"coalesce(MAP {{{named}}}[upper({found})], {found})"


def number_sql(col: str) -> str:
    return f"CASE WHEN trim({col}) <> '' THEN TRY_CAST({col} AS DOUBLE) END"


FACTOR_SQL = (
    "CASE lower(trim(ORIGINAL_PAY_PERIOD)) "
    + " ".join(f"WHEN '{p}' THEN {f}e0" for p, f in preset.PERIOD_FACTORS.items())
    + " ELSE 1e0 END"
)


def pay_sql(source: str) -> str:
    """CTEs that add low, high and mid to the rows of ``source`` as ``paid``."""
    return f"""annual AS (SELECT {source}.*, {number_sql('SALARY_FROM')} * {FACTOR_SQL} AS low_any,
        {number_sql('SALARY_TO')} * {FACTOR_SQL} AS high_any FROM {source}),
    bounded AS (SELECT annual.*, CASE WHEN low_any >= {preset.PAY_FLOOR} THEN low_any END AS low,
        CASE WHEN low_any >= {preset.PAY_FLOOR} THEN high_any END AS high FROM annual),
    paid AS (SELECT bounded.*, coalesce((low + high) / 2, low) AS mid FROM bounded)"""


# Distinct tokens of a document's whole text.
TOKENS_SQL = """tokens AS (SELECT doc_id, lang, source, n_chars,
    list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda t: t <> '')) AS items
    FROM documents)"""


def token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_chars, items``; an item may be listed more than once."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("items"),
    )


# One posting per user and day; its role is the type of the day's first event.
VISITS_SQL = """uses AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type,
    'skill ' || CAST(CAST(floor(sqrt(CAST(json_extract_string(props, '$.k') AS DOUBLE))) AS INT) AS VARCHAR) AS item
    FROM events),
visits AS (SELECT user_id, day, min_by(event_type, (ts, event_id)) AS role, list_distinct(list(item)) AS items
    FROM uses GROUP BY user_id, day)"""
SKILLS = [f"skill {i}" for i in range(10)]


def uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("day"),
        "ts",
        "event_id",
        "event_type",
        F.concat(F.lit("skill "), F.floor(F.sqrt(k)).cast("string")).alias("item"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, day, role, items``; the item domain has ten values, so the sets stay small."""
    return (
        uses(spark, sf_dir)
        .groupBy("user_id", "day")
        .agg(
            F.min_by("event_type", F.struct("ts", "event_id")).alias("role"),
            F.collect_set("item").alias("items"),
        )
    )


# Orders with their customer's segment and nation.
SALES_SQL = """sales AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice,
    CAST(o_orderdate AS DATE) AS day, c_mktsegment, n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            "o_orderpriority",
            "o_orderstatus",
            "o_totalprice",
            F.col("o_orderdate").cast("date").alias("day"),
            "c_mktsegment",
            "n_name",
        )
    )
