"""Frequencies, quantiles, bands, level tables, role comparison and premiums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobstrata.catalog.funnels import PANEL_SQL
from jobstrata.catalog.inputs import (
    RULES,
    SALES_SQL,
    TOKENS_SQL,
    raw_postings,
    sales,
    token_lists,
)
from jobstrata.catalog.registry import query, table
from jobstrata.functions.cells import or_label
from jobstrata.operators.frequency import (
    banded,
    complete,
    cumulative_share,
    frequency,
    histogram,
    side_by_side,
    top_k,
)
from jobstrata.operators.items import frequent_items
from jobstrata.operators.market import (
    composition,
    median_by_group,
    numeric_summary,
    quantile_table,
    role_comparison,
    share_of,
    skill_premium,
    subset_vs_all,
)
from jobstrata.operators.joins import same_keys
from jobstrata.operators.quantiles import approximate_quantiles, median_value
from jobstrata.plans.baseline import market_tables
from jobstrata.plans.panel import build_panel
from jobstrata.presets import postings as preset


def _stated() -> Column:
    return F.col("o_orderstatus") != "P"



@query(
    """SELECT o_orderpriority AS value, count(*) AS n, round(100e0 * n / (SELECT count(*) FROM orders), 4) AS share,
    rank() OVER (ORDER BY n DESC) AS rank FROM orders GROUP BY value"""
)
def priority_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(table(spark, sf_dir, "orders"), F.col("o_orderpriority"))


@query(
    """SELECT o_custkey AS value, count(*) AS n, round(100e0 * n / (SELECT count(*) FROM orders), 4) AS share,
    rank() OVER (ORDER BY n DESC) AS rank FROM orders GROUP BY value"""
)
def customer_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open domain with many ties: ranks come from the distinct counts."""
    return frequency(table(spark, sf_dir, "orders"), F.col("o_custkey"))


@query(
    """SELECT count(*) FILTER (o_orderstatus <> 'P') AS n,
    round(100e0 * n / count(*), 4) AS share, min(o_totalprice) FILTER (o_orderstatus <> 'P') AS minimum,
    round(avg(o_totalprice) FILTER (o_orderstatus <> 'P'), 4) AS mean,
    max(o_totalprice) FILTER (o_orderstatus <> 'P') AS maximum,
    round(median(o_totalprice) FILTER (o_orderstatus <> 'P'), 4) AS median FROM orders"""
)
def price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.when(_stated(), F.col("o_totalprice"))
    summary = numeric_summary(table(spark, sf_dir, "orders"), stated)
    return summary.withColumns({c: F.round(c, 4) for c in ("mean", "median")})


@query(
    " UNION ALL ".join(
        f"SELECT '{m}' AS measure, {p} AS prob, round(quantile_cont({c}, {p}), 4) AS quantile, count({c}) AS n "
        "FROM lineitem"
        for m, c in [("price", "l_extendedprice"), ("quantity", "l_quantity")]
        for p in ("0.25e0", "0.5e0", "0.75e0")
    )
)
def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity")}
    return quantile_table(table(spark, sf_dir, "lineitem"), values, [0.25, 0.5, 0.75]).withColumn(
        "quantile", F.round("quantile", 4)
    )


_WIDTHS_SQL = ", ".join(f"{m}e{e}" for e in range(-6, 16) for m in (1, 2, 5))


@query(
    f"""WITH span AS (SELECT list_filter([{_WIDTHS_SQL}],
        lambda w: floor(hi / w) - floor(lo / w) + 1 <= 14)[1] AS width
        FROM (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)),
    binned AS (SELECT CAST(floor(o_totalprice / width) AS BIGINT) AS bin, width FROM orders, span)
    SELECT bin, bin * width AS low, (bin + 1) * width AS high, count(*) AS n,
    (SELECT round(median(o_totalprice), 4) FROM orders) AS median FROM binned GROUP BY bin, width"""
)
def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, price = table(spark, sf_dir, "orders"), F.col("o_totalprice")
    return histogram(orders, price).withColumn("median", F.round(median_value(orders, price), 4))


@query(
    f"""WITH {SALES_SQL}, counted AS (SELECT n_name AS value, count(*) AS n FROM sales GROUP BY value)
    SELECT value, n, round(100e0 * n / (SELECT sum(n) FROM counted), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM counted WHERE value <> 'NATION_0' ORDER BY n DESC, value LIMIT 10"""
)
def leading_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(sales(spark, sf_dir), F.col("n_name"), 10, F.col("value") != "NATION_0")


_ORDER = ["5-LOW", "1-URGENT", "0-NEVER", "2-HIGH"]
_ORDER_SQL = "levels AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{v}')" for i, v in enumerate(_ORDER)
) + ") t(pos, value))"


@query(
    f"""WITH {_ORDER_SQL}, counted AS (SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY value)
    SELECT pos, levels.value, coalesce(n, 0) AS n,
    coalesce(round(100e0 * n / (SELECT count(*) FROM orders), 4), 0) AS share
    FROM levels LEFT JOIN counted USING (value)"""
)
def fixed_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = frequency(table(spark, sf_dir, "orders"), F.col("o_orderpriority"))
    return complete(counted.select("value", "n", "share"), _ORDER, ["n", "share"])


@query(
    """SELECT o_orderstatus AS value, count(*) AS n,
    round(100e0 * n / (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'), 4) AS share,
    rank() OVER (ORDER BY n DESC) AS rank FROM orders WHERE o_orderstatus <> 'P' GROUP BY value"""
)
def share_of_stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(_stated())
    return frequency(orders, F.col("o_orderstatus"))


@query(
    """SELECT o_orderpriority AS value, count(*) AS n,
    round(100e0 * n / (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'), 4) AS share,
    rank() OVER (ORDER BY n DESC) AS rank FROM orders GROUP BY value"""
)
def share_of_denominator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over all rows, shares against the rows a predicate names."""
    return frequency(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), stated=_stated())


@query(
    """WITH named AS (SELECT coalesce(CASE WHEN o_custkey % 10 > 0 THEN 'c' || o_custkey END, 'Unknown employer') AS value
        FROM orders), counted AS (SELECT value, count(*) AS n FROM named GROUP BY value)
    SELECT value, n, round(100e0 * n / (SELECT sum(n) FROM counted), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM counted ORDER BY n DESC, value LIMIT 10"""
)
def top_employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("o_custkey") % 10 > 0, F.concat(F.lit("c"), F.col("o_custkey")))
    return top_k(table(spark, sf_dir, "orders"), or_label(name, preset.EMPLOYER_MISSING), 10)


@query(
    f"""WITH {SALES_SQL} SELECT n_name, count(o_totalprice) FILTER (o_orderstatus <> 'P') AS n,
    round(median(o_totalprice) FILTER (o_orderstatus <> 'P'), 4) AS median
    FROM sales GROUP BY n_name HAVING n >= 400"""
)
def median_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.when(_stated(), F.col("o_totalprice"))
    return median_by_group(sales(spark, sf_dir), "n_name", stated, 400, few_groups=True).withColumn(
        "median", F.round("median", 4)
    )


@query(
    """SELECT o_custkey, count(*) AS n, round(median(o_totalprice), 4) AS median FROM orders
    GROUP BY o_custkey HAVING n >= 10"""
)
def median_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small groups."""
    orders = table(spark, sf_dir, "orders")
    return median_by_group(orders, "o_custkey", F.col("o_totalprice")).withColumn(
        "median", F.round("median", 4)
    )


_BAND_SQL = "levels AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{v}')" for i, v in enumerate(preset.YEARS_LABELS)
) + ") t(pos, value))"


@query(
    f"""WITH {_BAND_SQL}, stated AS (SELECT l_quantity AS x FROM lineitem WHERE l_quantity BETWEEN 1 AND 20),
    counted AS (SELECT CASE WHEN x <= 2 THEN '1-2 years' WHEN x <= 4 THEN '3-4 years' WHEN x <= 7 THEN '5-7 years'
        WHEN x <= 10 THEN '8-10 years' ELSE 'More than 10' END AS value, count(*) AS n FROM stated GROUP BY value)
    SELECT pos, levels.value, coalesce(n, 0) AS n, round(100e0 * coalesce(n, 0) / (SELECT count(*) FROM stated), 4) AS share
    FROM levels LEFT JOIN counted USING (value)"""
)
def experience_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    kept = F.when(quantity.between(preset.YEARS_MIN, preset.YEARS_MAX), quantity)
    lines = table(spark, sf_dir, "lineitem")
    return banded(lines, kept, preset.YEARS_EDGES, preset.YEARS_LABELS)


@query(
    f"""WITH {_ORDER_SQL}, both_sides AS (
        SELECT o_orderpriority AS value, 1 AS a, 0 AS b FROM orders
        UNION ALL SELECT CASE o_orderstatus WHEN 'P' THEN '5-LOW' WHEN 'F' THEN '2-HIGH' ELSE '9-NONE' END, 0, 1 FROM orders),
    counted AS (SELECT value, sum(a) AS a, sum(b) AS b FROM both_sides GROUP BY value)
    SELECT pos, levels.value, CAST(coalesce(a, 0) AS BIGINT) AS first, CAST(coalesce(b, 0) AS BIGINT) AS second
    FROM levels LEFT JOIN counted USING (value)"""
)
def two_columns_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    second = F.when(status == "P", "5-LOW").when(status == "F", "2-HIGH").otherwise("9-NONE")
    orders = table(spark, sf_dir, "orders")
    return side_by_side(orders, F.col("o_orderpriority"), second, _ORDER)


@query(
    """SELECT coalesce(CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END, 'Not specified') AS value,
    count(*) AS n, round(100e0 * n / (SELECT count(*) FROM orders), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM orders GROUP BY value"""
)
def frequency_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders")
    return frequency(orders, or_label(given, preset.EDUCATION_MISSING))


@query(
    f"""WITH {SALES_SQL} SELECT c_mktsegment,
    round(100e0 * count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) / count(*), 4) AS share
    FROM sales GROUP BY c_mktsegment"""
)
def flexible_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return share_of(sales(spark, sf_dir), flag, ["c_mktsegment"])


def _role_sql(group: str, key: str) -> str:
    return f"""SELECT {key} AS role, count(*) AS postings, count(pay) AS paid, count(years) AS with_years,
    round(100e0 * count_if(years <= 2) / count(years), 4) AS entry_share,
    round(100e0 * count_if(flexible) / count(*), 4) AS flexible_share,
    round(median(pay), 4) AS median_pay, median(years) AS median_years,
    CAST({0 if group else 1} AS INT) AS is_total FROM measured {group}"""


@query(
    f"""WITH {SALES_SQL}, measured AS (SELECT c_mktsegment AS role,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS pay,
        CASE WHEN o_totalprice < 300000 THEN floor(o_totalprice / 50000) END AS years,
        o_orderpriority IN ('1-URGENT', '2-HIGH') AS flexible FROM sales)
    {_role_sql('GROUP BY role', 'role')} UNION ALL {_role_sql('', 'NULL')}"""
)
def role_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    years = F.when(price < 300000, F.floor(price / 50000).cast("double"))
    return role_comparison(
        sales(spark, sf_dir),
        "c_mktsegment",
        F.when(_stated(), price),
        years,
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
        preset.ENTRY_YEARS,
        overall=True,
    ).withColumn("median_pay", F.round("median_pay", 4))


@query(
    f"""WITH {SALES_SQL} SELECT round(median(o_totalprice) FILTER (n_name = 'NATION_3'), 4) AS subset_median,
    count(o_totalprice) FILTER (n_name = 'NATION_3') AS subset_n, round(median(o_totalprice), 4) AS all_median,
    count(o_totalprice) AS all_n FROM sales"""
)
def nation_against_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = subset_vs_all(sales(spark, sf_dir), F.col("n_name") == "NATION_3", F.col("o_totalprice"))
    return both.withColumns({c: F.round(c, 4) for c in ("subset_median", "all_median")})


@query(
    """SELECT o_orderpriority, count(*) AS n, round(median(o_totalprice), 4) AS median FROM orders
    WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""
)
def median_by_arrangement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(_stated())
    return median_by_group(
        orders, "o_orderpriority", F.col("o_totalprice"), 1, few_groups=True
    ).withColumn(
        "median", F.round("median", 4)
    )


_PREMIUM_SHARE = 0.3


@query(
    f"""WITH {TOKENS_SQL}, kept AS (SELECT item FROM (SELECT unnest(items) AS item FROM tokens) GROUP BY item
        HAVING count(*) >= {_PREMIUM_SHARE} * (SELECT count(*) FROM documents)),
    pairs AS (SELECT item, n_chars, list_contains(items, item) AS has FROM tokens, kept)
    SELECT item, count_if(has) AS n_with, median(n_chars) FILTER (has) AS median_with,
    count_if(NOT has) AS n_without, median(n_chars) FILTER (NOT has) AS median_without,
    median_with - median_without AS difference FROM pairs GROUP BY item"""
)
def item_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = token_lists(spark, sf_dir)
    frequent = frequent_items(docs, F.col("items"), _PREMIUM_SHARE)
    wanted = frequent.agg(F.collect_list("item")).scalar()
    return skill_premium(
        docs.select(F.array_intersect("items", wanted).alias("items"), "n_chars"),
        "items",
        "n_chars",
    )


@query(
    f"""WITH {TOKENS_SQL}, wanted AS (SELECT unnest(['the', 'und', 'les', 'ing', 'que']) AS item),
    pairs AS (SELECT item, lang = 'en' AS flag FROM tokens JOIN wanted ON list_contains(items, item))
    SELECT item, count(*) AS postings, round(100e0 * count_if(flag) / count(*), 4) AS share,
    (SELECT round(100e0 * count_if(lang = 'en') / count(*), 4) FROM documents) AS overall FROM pairs GROUP BY item"""
)
def item_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.array(*[F.lit(w) for w in ("the", "und", "les", "ing", "que")])
    docs = token_lists(spark, sf_dir).select(
        "lang", F.array_intersect("items", wanted).alias("items")
    )
    return composition(docs, "items", F.col("lang") == "en")


@query(
    """WITH counted AS (SELECT source AS value, count(*) AS n FROM documents GROUP BY value)
    SELECT value, n, round(100e0 * sum(n) OVER (ORDER BY n DESC, value ROWS UNBOUNDED PRECEDING)
        / (SELECT sum(n) FROM counted), 4) AS running_share FROM counted ORDER BY n DESC, value LIMIT 5"""
)
def running_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_share(table(spark, sf_dir, "documents"), F.col("source"), 5)


_SKETCH_SIZE = 400


@query(
    """WITH p AS (SELECT unnest([0e0, 0.25, 0.5, 0.75, 1e0]) AS prob)
    SELECT c_mktsegment, prob, count(o_totalprice) AS n, true AS within
    FROM orders JOIN customer ON o_custkey = c_custkey, p GROUP BY c_mktsegment, prob"""
)
def approximate_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles from sketches, each with whether its exact rank is within the error stated."""
    rows = sales(spark, sf_dir)
    price, by = F.col("o_totalprice"), ["c_mktsegment"]
    found = approximate_quantiles(rows, by, {"x": price}, [0.0, 0.25, 0.5, 0.75, 1.0], _SKETCH_SIZE)
    asked = found.groupBy(*by).agg(F.collect_list(F.struct("prob", "quantile")).alias("asked"))
    # five values a segment, and the segments are a closed list
    met = same_keys(rows.select(*by, price.alias("x")), F.broadcast(asked), by)
    each = met.select(*by, "x", F.inline("asked"))
    ranks = each.groupBy(*by, "prob").agg(
        F.count("x").alias("n"),
        (F.count_if(F.col("x") < F.col("quantile")) / F.count("x")).alias("below"),
        (F.count_if(F.col("x") <= F.col("quantile")) / F.count("x")).alias("upto"),
    )
    error = 2.3 / _SKETCH_SIZE**0.9
    within = (F.col("below") - error <= F.col("prob")) & (F.col("prob") <= F.col("upto") + error)
    return ranks.select(*by, "prob", "n", within.alias("within"))


# The same tables read off the whole cleaned panel.


def _panel_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return market_tables()[name](build_panel(raw_postings(spark, sf_dir), RULES))


@query(
    f"""WITH {PANEL_SQL} SELECT REMOTE_TYPE_NAME, count(*) AS n, round(median(salary_midpoint), 4) AS median
    FROM panel WHERE salary_midpoint IS NOT NULL GROUP BY REMOTE_TYPE_NAME"""
)
def panel_pay_by_arrangement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_table(spark, sf_dir, "median_pay_by_arrangement").withColumn(
        "median", F.round("median", 4)
    )


@query(
    f"""WITH {PANEL_SQL}, counted AS (SELECT state AS value, count(*) AS n FROM panel GROUP BY value)
    SELECT value, n, round(100e0 * n / (SELECT sum(n) FROM counted), 4) AS share, rank() OVER (ORDER BY n DESC) AS rank
    FROM counted WHERE value <> 'Unspecified' ORDER BY n DESC, value LIMIT 10"""
)
def panel_leading_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_table(spark, sf_dir, "leading_states")


@query(
    f"""WITH {PANEL_SQL}, measured AS (SELECT role_family AS role, salary_midpoint AS pay, min_years_experience AS years,
        REMOTE_TYPE_NAME IN ('Remote', 'Hybrid') AS flexible FROM panel)
    {_role_sql('GROUP BY role', 'role')} UNION ALL {_role_sql('', 'NULL')}"""
)
def panel_role_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_table(spark, sf_dir, "role_comparison").withColumn(
        "median_pay", F.round("median_pay", 4)
    )
