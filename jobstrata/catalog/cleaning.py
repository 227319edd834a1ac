"""Cleaning projections, each shown on columns that hold the dirt it handles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.funnels import ARRANGEMENT_SQL
from jobstrata.catalog.inputs import (
    RAW_SQL,
    ROLES,
    TOKENS_SQL,
    pay_sql,
    raw_postings,
    state_sql,
    token_lists,
)
from jobstrata.catalog.registry import query, table
from jobstrata.functions.cells import (
    band,
    canonical_label,
    first_match,
    has_item,
    keep_between,
    keep_labels,
    name_key,
    number,
    or_label,
    relabel,
    text_list,
    url_like,
)
from jobstrata.functions.pay import add_pay
from jobstrata.functions.places import PlaceRules, nationwide, state_of
from jobstrata.plans.panel import PAY, PLACES
from jobstrata.presets import postings as preset

# The same cascade with the languages of a web page in place of states.
LANGUAGES = {"EN": "English", "FR": "French", "DE": "German", "ES": "Spanish"}
PAGE_RULES = PlaceRules(
    capital_pattern="(?i)spam-farm",
    capital_label="Spam",
    names=["French", "German"],
    code_in_text='<html lang="(fr|de)"',
    codes=LANGUAGES,
    cities=[("/en/[0-9]+\\?page", "English paged"), ("cheap", "Cheap")],
    unresolved="Unspecified",
)


@query(
    """WITH cells AS (SELECT page_id, url, html,
        regexp_extract(url, '/(en|fr)/', 1) AS path, regexp_extract(url, '([a-z]+)\\.example', 1) AS host
        FROM pages),
    found AS (SELECT page_id, CASE WHEN regexp_matches(url || ' ' || html, '(?i)spam-farm') THEN 'Spam'
        WHEN regexp_extract(url || ' ' || html, '(French|German)', 1) <> ''
            THEN regexp_extract(url || ' ' || html, '(French|German)', 1)
        WHEN regexp_extract(url || ' ' || html, '<html lang="(fr|de)"', 1) <> ''
            THEN regexp_extract(url || ' ' || html, '<html lang="(fr|de)"', 1)
        WHEN page_id % 3 = 0 AND trim(path) <> '' THEN path
        WHEN host IN ('French', 'German') OR upper(trim(host)) IN ('EN', 'FR', 'DE', 'ES') THEN trim(host)
        WHEN regexp_matches(url || ' ' || html, '(?i)/en/[0-9]+\\?page') THEN 'English paged'
        WHEN regexp_matches(url || ' ' || html, '(?i)cheap') THEN 'Cheap' ELSE 'Unspecified' END AS raw FROM cells)
    SELECT page_id, CASE upper(raw) WHEN 'EN' THEN 'English' WHEN 'FR' THEN 'French'
        WHEN 'DE' THEN 'German' WHEN 'ES' THEN 'Spanish' ELSE raw END AS label FROM found"""
)
def label_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 3 == 0, F.regexp_extract("url", "/(en|fr)/", 1))
    host = F.regexp_extract("url", r"([a-z]+)\.example", 1)
    text = F.concat_ws(" ", "url", "html")
    return table(spark, sf_dir, "pages").select(
        "page_id", state_of(text, path, host, PAGE_RULES).alias("label")
    )


def _places_sql(validate: bool) -> str:
    state = state_sql("LOCATION", "STATE", "STATE_NAME", validate)
    return f"""WITH {RAW_SQL}, placed AS (SELECT LOCATION, STATE AS given, STATE_NAME AS given_name,
        {state} AS found FROM raw)
    SELECT LOCATION AS location, given, given_name, found, count(*) AS postings
    FROM placed GROUP BY ALL"""


def _places(spark: SparkSession, sf_dir: str, rules: PlaceRules) -> DataFrame:
    found = state_of(F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), rules)
    return (
        raw_postings(spark, sf_dir)
        .select(
            F.col("LOCATION").alias("location"),
            F.col("STATE").alias("given"),
            F.col("STATE_NAME").alias("given_name"),
            found.alias("found"),
        )
        .groupBy("location", "given", "given_name", "found")
        .agg(F.count("*").alias("postings"))
    )


@query(_places_sql(False))
def state_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir, PLACES)


@query(_places_sql(True))
def state_cascade_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir, replace(PLACES, validate=True))


_PAY_ARGS = ("SALARY_FROM", "SALARY_TO", "ORIGINAL_PAY_PERIOD")


@query(
    f"""WITH {RAW_SQL}, {pay_sql('raw')}
    SELECT ID AS id, l_linenumber AS line, l_partkey AS part, low, high, mid FROM paid"""
)
def pay_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = add_pay(raw_postings(spark, sf_dir), *_PAY_ARGS, PAY, ("low", "high", "mid"))
    return paid.select(
        F.col("ID").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        "low",
        "high",
        "mid",
    )


@query(
    f"""WITH {RAW_SQL}, {pay_sql('raw')}, strict AS (SELECT ORIGINAL_PAY_PERIOD AS period, low,
        CASE WHEN high >= low THEN high END AS high FROM paid)
    SELECT period, count(low) AS with_low, count(high) AS with_high,
        max(coalesce((low + high) / 2, low)) AS largest FROM strict GROUP BY period"""
)
def pay_strict_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = replace(PAY, strict_upper=True)
    paid = add_pay(raw_postings(spark, sf_dir), *_PAY_ARGS, rules, ("low", "high", "mid"))
    return paid.groupBy(F.col("ORIGINAL_PAY_PERIOD").alias("period")).agg(
        F.count("low").alias("with_low"),
        F.count("high").alias("with_high"),
        F.max("mid").alias("largest"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority
        ELSE 'Other' END AS kept FROM orders"""
)
def occupation_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_labels(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])
    return table(spark, sf_dir, "orders").select("o_orderkey", kept.alias("kept"))


@query(
    f"""WITH {RAW_SQL} SELECT REMOTE_TYPE_NAME AS given, {ARRANGEMENT_SQL} AS label,
    count(*) AS postings FROM raw GROUP BY ALL"""
)
def arrangement_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.col("REMOTE_TYPE_NAME")
    label = canonical_label(given, preset.ARRANGEMENT_SYNONYMS, preset.ARRANGEMENT_UNKNOWN)
    return (
        raw_postings(spark, sf_dir)
        .select(given.alias("given"), label.alias("label"))
        .groupBy("given", "label")
        .agg(F.count("*").alias("postings"))
    )


@query(
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS label,
    count(*) AS n FROM orders GROUP BY ALL"""
)
def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = relabel(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"})
    return table(spark, sf_dir, "orders").groupBy(label.alias("label")).agg(
        F.count("*").alias("n")
    )


_PART_ROLE_SQL = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(lower(p_name), '{p}') THEN '{r}'" for p, r in ROLES)
    + " ELSE 'Other' END"
)


@query(f"SELECT p_partkey, {_PART_ROLE_SQL} AS role FROM part")
def role_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", first_match(F.col("p_name"), ROLES, "Other").alias("role")
    )


@query(
    f"""WITH {RAW_SQL}, parsed AS (SELECT MIN_YEARS_EXPERIENCE AS given,
        CASE WHEN trim(MIN_YEARS_EXPERIENCE) <> '' THEN TRY_CAST(MIN_YEARS_EXPERIENCE AS DOUBLE) END AS years
        FROM raw)
    SELECT given, CASE WHEN years BETWEEN 1 AND 20 THEN years END AS kept, count(*) AS postings
    FROM parsed GROUP BY ALL"""
)
def years_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.col("MIN_YEARS_EXPERIENCE")
    kept = keep_between(number(given), preset.YEARS_MIN, preset.YEARS_MAX)
    return (
        raw_postings(spark, sf_dir)
        .select(given.alias("given"), kept.alias("kept"))
        .groupBy("given", "kept")
        .agg(F.count("*").alias("postings"))
    )


@query(
    f"""WITH {TOKENS_SQL} SELECT doc_id, CAST(len(items) AS INT) AS items,
    array_to_string(list_sort(items), ' ') AS listed FROM tokens"""
)
def list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = token_lists(spark, sf_dir).select(
        "doc_id", text_list(F.to_json("items")).alias("items")
    )
    return parsed.select(
        "doc_id",
        F.size("items").alias("items"),
        F.array_join(F.array_sort("items"), " ").alias("listed"),
    )


@query(
    f"""WITH {RAW_SQL} SELECT SKILLS_NAME AS given, CAST(coalesce(len(list_distinct(
        CASE WHEN starts_with(SKILLS_NAME, '[') THEN CAST(SKILLS_NAME AS JSON)::VARCHAR[] END)), 0) AS INT) AS items,
    count(*) AS postings FROM raw GROUP BY ALL"""
)
def list_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.col("SKILLS_NAME")
    return (
        raw_postings(spark, sf_dir)
        .select(given.alias("given"), F.size(text_list(given)).alias("items"))
        .groupBy("given", "items")
        .agg(F.count("*").alias("postings"))
    )


_COMPANY_SQL = """CASE p_partkey % 4 WHEN 0 THEN p_name || ', LLC' WHEN 1 THEN upper(p_name)
    WHEN 2 THEN p_name || ' Inc LLC' ELSE p_name END"""


@query(
    f"""WITH named AS (SELECT p_partkey, {_COMPANY_SQL} AS company FROM part)
    SELECT p_partkey, company, regexp_replace(regexp_replace(lower(company), '[^a-z0-9]', '', 'g'),
        '(llc|inc|corp|corporation|ltd)$', '') AS name_key FROM named"""
)
def company_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_COMPANY_SQL} AS company")
    return named.withColumn("name_key", name_key(F.col("company"), preset.COMPANY_SUFFIX))


@query(
    r"""SELECT page_id, regexp_matches(url, '(?i)\.(?:com|net|org)|oraclecloud|myworkday') AS url_like,
    regexp_matches(regexp_replace(url, '^https?://', ''), '(?i)cheap|oraclecloud|myworkday') AS listed_host
    FROM pages"""
)
def url_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        url_like(F.col("url"), preset.URL_LIKE).alias("url_like"),
        host.rlike("(?i)cheap|oraclecloud|myworkday").alias("listed_host"),
    )


@query(
    rf"""WITH {RAW_SQL}, placed AS (SELECT LOCATION, {state_sql('LOCATION', 'STATE', 'STATE_NAME')} AS found FROM raw)
    SELECT coalesce(LOCATION, '') AS location, count(*) AS postings,
    count_if(regexp_matches(coalesce(LOCATION, ''), '(?i)remote|united states|\bUSA?\b')) AS nationwide
    FROM placed WHERE found = 'Unspecified' GROUP BY ALL"""
)
def national_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state_of(F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), PLACES)
    location = or_label(F.col("LOCATION"), "")
    return (
        raw_postings(spark, sf_dir)
        .filter(found == preset.STATE_UNRESOLVED)
        .groupBy(location.alias("location"))
        .agg(
            F.count("*").alias("postings"),
            F.count_if(nationwide(F.col("LOCATION"), preset.NATIONAL)).alias("nationwide"),
        )
    )


@query(
    f"""WITH {TOKENS_SQL} SELECT doc_id, list_contains(items, 'the') AS has_the,
    list_contains(items, 'und') AS has_und FROM tokens"""
)
def item_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lists(spark, sf_dir).select(
        "doc_id",
        has_item(F.col("items"), "the").alias("has_the"),
        has_item(F.col("items"), "und").alias("has_und"),
    )


@query(
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Not stated') AS label
    FROM orders"""
)
def default_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", or_label(status, "Not stated").alias("label")
    )


@query(
    """SELECT l_quantity AS quantity, CASE WHEN l_quantity <= 0 THEN NULL WHEN l_quantity <= 2 THEN '1-2 years'
        WHEN l_quantity <= 4 THEN '3-4 years' WHEN l_quantity <= 7 THEN '5-7 years'
        WHEN l_quantity <= 10 THEN '8-10 years' WHEN l_quantity <= 100 THEN 'More than 10' END AS label,
    count(*) AS n FROM lineitem GROUP BY ALL"""
)
def band_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band(F.col("l_quantity"), preset.YEARS_EDGES, preset.YEARS_LABELS)
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_quantity").alias("quantity"), label.alias("label")
    ).agg(F.count("*").alias("n"))
