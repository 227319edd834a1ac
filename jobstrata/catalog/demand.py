"""Item counts, coverage, demand by list and by group, target levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobstrata.catalog.inputs import SKILLS, TOKENS_SQL, VISITS_SQL, token_lists, visits
from jobstrata.catalog.registry import query, table
from jobstrata.operators.gaps import target_level
from jobstrata.operators.heavy import heavy_labels
from jobstrata.operators.items import (
    demand,
    demand_by_group,
    demand_for,
    demand_matrix,
    flag_member,
    frequent_items,
    item_counts,
    item_coverage,
    top_items,
)
from jobstrata.presets import postings as preset

_ITEMS_SQL = f"{TOKENS_SQL}, pairs AS (SELECT doc_id, unnest(items) AS item FROM tokens)"


@query(f"WITH {_ITEMS_SQL} SELECT item, count(*) AS postings FROM pairs GROUP BY item")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_counts(token_lists(spark, sf_dir), F.col("items"))


@query(
    f"""WITH {_ITEMS_SQL} SELECT (SELECT count(*) FROM tokens) AS postings,
    (SELECT count_if(len(items) > 0) FROM tokens) AS with_items, count(DISTINCT item) AS distinct_items FROM pairs"""
)
def token_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_coverage(token_lists(spark, sf_dir), F.col("items"))


def _top_sql(k: int) -> str:
    return f"""top AS (SELECT item, count(*) AS postings,
        round(100e0 * postings / (SELECT count(*) FROM documents), 1) AS share
        FROM pairs GROUP BY item ORDER BY postings DESC, item LIMIT {k})"""


@query(f"WITH {_ITEMS_SQL}, {_top_sql(10)} SELECT * FROM top")
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_items(token_lists(spark, sf_dir), F.col("items"), 10)


@query(
    f"""WITH {_ITEMS_SQL}, {_top_sql(20)} SELECT top.*,
    item IN (SELECT DISTINCT event_type FROM events UNION SELECT lower(regexp_extract(text, '[A-Za-z]+')) FROM benchmark)
    AS is_member FROM top"""
)
def top_tokens_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each frequent token opens a benchmark passage, as a stand-in for a rated list."""
    opening = table(spark, sf_dir, "benchmark").select(
        F.lower(F.regexp_extract("text", "[A-Za-z]+", 0)).alias("word")
    )
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("word"))
    return top_items(token_lists(spark, sf_dir), F.col("items"), 20, rated=opening.unionByName(types))


@query(
    f"""WITH {_ITEMS_SQL}, openings AS (SELECT DISTINCT lower(regexp_extract(text, '[A-Za-z]+')) AS word FROM benchmark),
    counted AS (SELECT item AS word, count(*) AS postings FROM pairs GROUP BY item)
    SELECT word, coalesce(postings, 0) AS postings FROM openings LEFT JOIN counted USING (word)"""
)
def demand_for_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    openings = (
        table(spark, sf_dir, "benchmark")
        .select(F.lower(F.regexp_extract("text", "[A-Za-z]+", 0)).alias("word"))
        .distinct()
    )
    return demand_for(openings, "word", item_counts(token_lists(spark, sf_dir), F.col("items")))


@query(
    """SELECT o_custkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS is_member,
    count(*) AS orders FROM orders GROUP BY ALL"""
)
def member_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    )
    builders = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select("c_custkey")
    )
    return flag_member(counted, "o_custkey", builders)


_ASKED = [*SKILLS, "skill 99"]
_LISTED_SQL = (
    "listed AS (SELECT unnest([" + ", ".join(f"'{s}'" for s in _ASKED) + "]) AS item)"
)
_VISIT_ITEMS_SQL = f"{VISITS_SQL}, {_LISTED_SQL}, used AS (SELECT role, unnest(items) AS item FROM visits)"


@query(
    f"""WITH {_VISIT_ITEMS_SQL}, counted AS (SELECT item, count(*) AS n FROM used GROUP BY item)
    SELECT item, coalesce(n, 0) AS postings,
    round(100e0 * coalesce(n, 0) / (SELECT count(*) FROM visits), 1) AS share FROM listed LEFT JOIN counted USING (item)"""
)
def skill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand(visits(spark, sf_dir), F.col("items"), _ASKED)


_BY_ROLE_SQL = f"""{_VISIT_ITEMS_SQL}, totals AS (SELECT role, count(*) AS group_postings FROM visits GROUP BY role),
counted AS (SELECT role, item, count(*) AS n FROM used GROUP BY ALL),
by_role AS (SELECT role, item, coalesce(n, 0) AS postings, group_postings,
    100e0 * coalesce(n, 0) / group_postings AS share
    FROM totals CROSS JOIN listed LEFT JOIN counted USING (role, item))"""


@query(
    f"""WITH {_BY_ROLE_SQL} SELECT role, item, postings, group_postings, round(share, 4) AS share,
    CASE WHEN share >= 20 THEN 4 WHEN share >= 10 THEN 3 ELSE 2 END AS target FROM by_role"""
)
def skill_demand_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = demand_by_group(visits(spark, sf_dir), "role", F.col("items"), _ASKED)
    target = target_level(F.col("share"), preset.TARGET_TIERS, preset.TARGET_BASE)
    return long.withColumn("target", target).withColumn("share", F.round("share", 4))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    f"""WITH {_BY_ROLE_SQL} SELECT item, CAST(sum(postings) AS BIGINT) AS postings,
    {', '.join(f"round(max(share) FILTER (role = '{t}'), 1) AS {t}" for t in _TYPES)} FROM by_role GROUP BY item"""
)
def skill_demand_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = demand_by_group(visits(spark, sf_dir), "role", F.col("items"), _ASKED)
    return demand_matrix(long, "role", _TYPES)


@query(
    f"""WITH {_VISIT_ITEMS_SQL}, counted AS (SELECT item, count(*) AS n FROM used GROUP BY item),
    shares AS (SELECT item, round(100e0 * n / (SELECT count(*) FROM visits), 1) AS share FROM counted)
    SELECT item, share, CASE WHEN share >= 20 THEN 4 WHEN share >= 10 THEN 3 ELSE 2 END AS target FROM shares"""
)
def target_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = demand(visits(spark, sf_dir), F.col("items"), SKILLS)
    target = target_level(F.col("share"), preset.TARGET_TIERS, preset.TARGET_BASE)
    return asked.select("item", "share", target.alias("target"))


@query(
    f"""WITH {_ITEMS_SQL} SELECT item, count(*) AS postings FROM pairs GROUP BY item
    HAVING postings >= 0.05 * (SELECT count(*) FROM documents)"""
)
def frequent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent_items(token_lists(spark, sf_dir), F.col("items"), preset.SKILL_THRESHOLD)


@query(
    f"WITH {_ITEMS_SQL} SELECT lang, count(DISTINCT item) AS items FROM pairs JOIN tokens USING (doc_id) GROUP BY lang"
)
def distinct_items_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        token_lists(spark, sf_dir)
        .select("lang", F.explode("items").alias("item"))
        .groupBy("lang")
        .agg(F.countDistinct("item").alias("items"))
    )


@query(
    """WITH words AS (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents),
    counted AS (SELECT word AS value, count(*) AS n FROM words WHERE word <> '' GROUP BY word)
    SELECT value, n, round(100e0 * n / (SELECT sum(n) FROM counted), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM counted ORDER BY n DESC, value LIMIT 20"""
)
def heavy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words of all documents, an open domain."""
    words = F.split(F.lower("text"), "[^a-z]+")
    rows = table(spark, sf_dir, "documents").select(F.explode(words).alias("word"))
    return heavy_labels(rows.filter("word <> ''"), F.col("word"), 20)


@query(
    """WITH counted AS (SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY l_partkey)
    SELECT value, n, round(100e0 * n / (SELECT sum(n) FROM counted), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM counted ORDER BY n DESC, value LIMIT 10"""
)
def heavy_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most ordered parts: labels of nearly even counts, so most buckets stay open."""
    return heavy_labels(table(spark, sf_dir, "lineitem"), F.col("l_partkey"), 10)
