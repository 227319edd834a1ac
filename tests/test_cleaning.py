"""Hand-written rows for every cleaning rule."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from jobstrata.functions import cells
from jobstrata.functions.pay import add_pay
from jobstrata.functions.places import nationwide, state_of
from jobstrata.operators.funnel import title_has, title_lacks
from jobstrata.plans.panel import PAY, PLACES
from jobstrata.presets import postings as preset


def column(spark, values, expr, kind="string"):
    """Apply an expression to one value per row and return the results in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["out"] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "location, state, state_name, expected",
    [
        ("Washington, DC", None, None, "District of Columbia"),
        ("1331 Pennsylvania Avenue NW, Washington, DC", None, None, "District of Columbia"),
        ("Washington, District of Columbia", None, None, "District of Columbia"),
        ("Seattle, Washington", None, None, "Washington"),
        ("Charleston, West Virginia", None, None, "West Virginia"),
        ("Fayetteville, Arkansas", None, None, "Arkansas"),
        ("Kansas City, MO", None, None, "Kansas"),
        ("texas", None, None, "Unspecified"),
        ("Plano, TX, USA", None, None, "Texas"),
        ("Austin, TX", "", None, "Texas"),
        ("Austin, TX", "ny", None, "New York"),
        ("Sunnyvale", None, None, "California"),
        ("Springfield", "ca", None, "California"),
        ("Springfield", "  ", "Remote", "Unspecified"),
        ("Springfield", None, " tx ", "Texas"),
        ("Springfield", None, "Ohio", "Ohio"),
        ("Paris, UK; London", None, None, "UK"),
        (None, None, None, "Unspecified"),
    ],
)
def test_state_cascade(spark, location, state, state_name, expected):
    df = spark.createDataFrame([(location, state, state_name)], "l string, s string, n string")
    found = df.select(state_of(F.col("l"), F.col("s"), F.col("n"), PLACES)).first()[0]
    assert found == expected


def test_state_cascade_can_validate_codes(spark):
    strict = replace(PLACES, validate=True)
    df = spark.createDataFrame(
        [("Paris, UK; London", "Ontario", None), ("Plano, TX, USA", None, None)],
        "l string, s string, n string",
    )
    found = df.select(state_of(F.col("l"), F.col("s"), F.col("n"), strict)).collect()
    assert [r[0] for r in found] == ["Unspecified", "Texas"]


def test_first_of_is_leftmost_then_listed_order(spark):
    pattern = cells.first_of(["New", "New York", "York", "Kansas", "Arkansas"])
    got = column(
        spark,
        ["in New York", "old York", "Arkansas", "nowhere"],
        lambda v: F.regexp_extract(v, pattern, 1),
    )
    assert got == ["New", "York", "Arkansas", ""]


@pytest.mark.parametrize(
    "low, high, period, expected",
    [
        ("50", "60", "hourly", (104000.0, 124800.0, 114400.0)),
        ("50", "60", " HOURLY", (104000.0, 124800.0, 114400.0)),
        ("500", None, "daily", (130000.0, None, 130000.0)),
        ("2000", "", "weekly", (104000.0, None, 104000.0)),
        ("9000", None, "monthly", (108000.0, None, 108000.0)),
        ("90000", "100000", None, (90000.0, 100000.0, 95000.0)),
        ("90000", "100000", "per project", (90000.0, 100000.0, 95000.0)),
        ("0.00", "90000", "annual", (None, None, None)),
        ("19999", None, "annual", (None, None, None)),
        ("20000", None, "annual", (20000.0, None, 20000.0)),
        (None, "90000", "annual", (None, None, None)),
        ("100000", "0", "annual", (100000.0, 0.0, 50000.0)),
        ("abc", "90000", "annual", (None, None, None)),
    ],
)
def test_pay(spark, low, high, period, expected):
    df = spark.createDataFrame([(low, high, period)], "low string, high string, period string")
    paid = add_pay(df, "low", "high", "period", PAY, ("a", "b", "m"))
    assert tuple(paid.select("a", "b", "m").first()) == expected


def test_strict_upper_drops_an_upper_bound_below_the_lower(spark):
    df = spark.createDataFrame([("100000", "0", None)], "low string, high string, period string")
    paid = add_pay(df, "low", "high", "period", replace(PAY, strict_upper=True), ("a", "b", "m"))
    assert tuple(paid.select("a", "b", "m").first()) == (100000.0, None, 100000.0)


def test_arrangement(spark):
    given = [None, "", " ", "Onsite", "ON-SITE", "Hybrid", "Unknown"]
    got = column(
        spark, given, lambda v: cells.canonical_label(v, preset.ARRANGEMENT_SYNONYMS, "Unknown")
    )
    assert got == ["Unknown"] * 3 + ["On-site"] * 2 + ["Hybrid", "Unknown"]


def test_role_family_takes_the_first_rule(spark):
    titles = ["Data Analyst / Data Engineer", "BI Analyst", "Reporting Analyst", "Lead Data Scientist"]
    got = column(spark, titles, lambda v: cells.first_match(v, preset.ROLE_RULES, "Other"))
    assert got == ["Data Engineer", "Business Intelligence", "Data Analyst", "Data Scientist"]


def test_title_rules(spark):
    titles = ["QA Data Analyst", "Data Analyst QA", "Network Data Engineer", None, "DATA SCIENTIST"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    kept = df.filter(
        title_has(F.col("t"), preset.TITLE_INCLUDE) & title_lacks(F.col("t"), preset.TITLE_EXCLUDE)
    )
    assert sorted(r["t"] for r in kept.collect()) == ["DATA SCIENTIST", "Data Analyst QA"]


def test_years(spark):
    given = ["0", "0.5", "1", "20", "20.5", "21", "", None, "n/a"]
    got = column(spark, given, lambda v: cells.keep_between(cells.number(v), 1, 20))
    assert got == [None, None, 1.0, 20.0, None, None, None, None, None]


def test_lists(spark):
    given = ['["a","a"]', None, "", "x", "[]", "[broken"]
    assert column(spark, given, cells.text_list) == [["a"], [], [], [], [], []]


def test_dates(spark):
    given = ["2026-09-10", "", "soon", None]
    assert column(spark, given, cells.day) == [dt.date(2026, 9, 10), None, None, None]


def test_name_key_drops_one_suffix(spark):
    given = ["Acme, LLC", "acme llc", "ACME", "Acme Inc LLC", None]
    got = column(spark, given, lambda v: cells.name_key(v, preset.COMPANY_SUFFIX))
    assert got == ["acme", "acme", "acme", "acmeinc", None]


def test_band_edges_are_right_closed(spark):
    got = column(
        spark,
        [0.0, 1.0, 2.0, 2.5, 4.0, 10.0, 10.5, 100.0, 101.0, None],
        lambda v: cells.band(v, preset.YEARS_EDGES, preset.YEARS_LABELS),
        "double",
    )
    a, b, _, d, e = preset.YEARS_LABELS
    assert got == [None, a, a, b, b, d, e, e, None, None]


def test_relabel_passes_unknown_values_through(spark):
    got = column(spark, ["a", "b", None], lambda v: cells.relabel(v, {"a": "A"}))
    assert got == ["A", "b", None]


def test_national_and_url_patterns(spark):
    got = column(spark, ["Remote, US", "USA", "Causal", "US"], lambda v: v.rlike(preset.NATIONAL))
    assert got == [True, True, False, True]
    got = column(spark, ["acme.com", "Acme", "x.oraclecloud"], lambda v: v.rlike(preset.URL_LIKE))
    assert got == [True, False, True]


def test_only_plain_decimal_text_is_a_number(spark):
    given = ["NaN", "Infinity", "-inf", "5d", "5f", "1,000", "", None, " 7 ", "-.5", "1.5E3", "2."]
    want = [None] * 8 + [7.0, -0.5, 1500.0, 2.0]
    assert column(spark, given, cells.number) == want


def test_null_items_leave_a_list(spark):
    assert column(spark, ['["a",null,"a"]', "[null]"], cells.text_list) == [["a"], []]


def test_flags_of_cells(spark):
    df = spark.createDataFrame(
        [("Remote, United States", "acme.com", ["SQL", None]), ("Boise", "Acme", []), ("", "", None), (None, None, [None])],
        "place string, name string, items array<string>",
    )
    rows = df.select(
        nationwide(F.col("place"), preset.NATIONAL), cells.url_like(F.col("name"), preset.URL_LIKE), cells.has_item(F.col("items"), "SQL")
    ).collect()
    assert [tuple(r) for r in rows] == [(True, True, True), (False, False, False), (False, False, False), (False, None, False)]
