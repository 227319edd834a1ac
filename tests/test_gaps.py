"""The published gap table, replayed from ratings and demand with invented names."""

import pytest
from pyspark.sql import functions as F

from jobstrata.operators import gaps as g
from jobstrata.plans.skills import skill_report
from jobstrata.presets import postings as preset

TEAM = ["Ada", "Bo", "Cy"]

# FIXED VALUES: skill, demand in percent, the three ratings.
RATED = [
    ("SQL", 61.8, 1, 2, 3),
    ("Python", 62.5, 1, 1, 3),
    ("Data Pipelines", 21.7, 1, 1, 2),
    ("Machine Learning", 19.3, 2, 2, 2),
    ("Tableau", 15.6, 3, 1, 5),
    ("Data Quality", 14.2, 3, 2, 5),
    ("Business Requirements", 10.2, 3, 4, 5),
    ("Power BI", 11.2, 3, 1, 5),
    ("Databricks", 11.1, 1, 1, 3),
    ("Microsoft Excel", 9.4, 4, 2, 5),
    ("Data Analysis", 8.9, 4, 4, 5),
    ("Data Modeling", 8.4, 3, 1, 4),
    ("Verbal Communication", 7.5, 5, 4, 4),
    ("Business Analysis", 5.8, 4, 3, 4),
    ("Statistical Modeling", 6.4, 2, 1, 2),
    ("Data Visualization", 5.7, 3, 1, 5),
]
# FIXED VALUES: skill, demand, target, average rating, gaps, average gap, priority.
EXPECTED = [
    ("Python", 62.5, 4, 1.67, 3, 3, 1, 2.33, 1.46),
    ("SQL", 61.8, 4, 2.0, 3, 2, 1, 2.0, 1.24),
    ("Data Pipelines", 21.7, 4, 1.33, 3, 3, 2, 2.67, 0.58),
    ("Machine Learning", 19.3, 3, 2.0, 1, 1, 1, 1.0, 0.19),
    ("Databricks", 11.1, 3, 1.67, 2, 2, 0, 1.33, 0.15),
    ("Tableau", 15.6, 3, 3.0, 0, 2, 0, 0.67, 0.1),
    ("Power BI", 11.2, 3, 3.0, 0, 2, 0, 0.67, 0.08),
    ("Data Quality", 14.2, 3, 3.33, 0, 1, 0, 0.33, 0.05),
    ("Data Modeling", 8.4, 2, 2.67, 0, 1, 0, 0.33, 0.03),
    ("Statistical Modeling", 6.4, 2, 1.67, 0, 1, 0, 0.33, 0.02),
    ("Data Visualization", 5.7, 2, 3.0, 0, 1, 0, 0.33, 0.02),
    ("Business Requirements", 10.2, 3, 4.0, 0, 0, 0, 0.0, 0.0),
    ("Microsoft Excel", 9.4, 2, 3.67, 0, 0, 0, 0.0, 0.0),
    ("Data Analysis", 8.9, 2, 4.33, 0, 0, 0, 0.0, 0.0),
    ("Verbal Communication", 7.5, 2, 4.33, 0, 0, 0, 0.0, 0.0),
    ("Business Analysis", 5.8, 2, 3.67, 0, 0, 0, 0.0, 0.0),
]


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [(s, *r) for s, _, *r in RATED], "skill string, Ada int, Bo int, Cy int"
    )


@pytest.fixture
def gap_rows(spark, wide):
    demand = spark.createDataFrame([(s, d) for s, d, *_ in RATED], "skill string, share double")
    with_targets = g.targets(demand, preset.TARGET_TIERS, preset.TARGET_BASE)
    return g.gaps(g.ratings_long(wide, ["skill"], TEAM), with_targets)


def test_published_gap_table(gap_rows):
    table = g.by_priority(g.gap_table(gap_rows, TEAM, F.bround))
    columns = ["skill", "share", "target", "average_rating", *[f"{p}_gap" for p in TEAM]]
    rows = table.select(*columns, "average_gap", "priority").collect()
    assert [tuple(r) for r in rows] == EXPECTED


def test_findings(gap_rows):
    table = g.gap_table(gap_rows, TEAM, F.bround)
    assert [r["skill"] for r in g.top_priorities(table).collect()] == ["Python", "SQL", "Data Pipelines"]
    assert {r["skill"] for r in g.skills_met(gap_rows).collect()} == {e[0] for e in EXPECTED[-5:]}
    levels = {r["candidate"]: r["levels"] for r in g.levels_to_close(gap_rows).collect()}
    assert levels == {p: sum(e[4 + i] for e in EXPECTED) for i, p in enumerate(TEAM)}


def test_unrated_skills_give_no_gap_but_are_pending(spark):
    wide = spark.createDataFrame([("SQL", 1, None), ("R", None, None)], "skill string, Ada int, Bo int")
    rated = g.ratings_long(wide, ["skill"], ["Ada", "Bo"])
    demand = spark.createDataFrame([("SQL", 50.0), ("R", 50.0)], "skill string, share double")
    rows = g.gaps(rated, g.targets(demand, preset.TARGET_TIERS, preset.TARGET_BASE)).collect()
    assert [(r["candidate"], r["skill"], r["gap"]) for r in rows] == [("Ada", "SQL", 3)]
    waiting = {r["candidate"]: r["skills"] for r in g.pending(rated).collect()}
    assert waiting == {"Ada": "R", "Bo": "R, SQL"}


def test_report_end_to_end(spark):
    panel = spark.createDataFrame(
        [("Data Analyst", ["SQL", "Excel"])] * 6
        + [("Data Engineer", ["SQL (core)", "Excel"])] * 3
        + [("Data Engineer", [])],
        "role_family string, SKILLS_NAME array<string>",
    )
    ratings = spark.createDataFrame(
        [("Spreadsheets", "Excel", 2, 5), ("Query", "SQL", 3, None)],
        "skill string, panel_skill_name string, Ada int, Bo int",
    )
    report = skill_report(panel, ratings, ["Ada", "Bo"], {"Ada": ["Data Engineer"], "Bo": ["Data Analyst"]})
    table = {r["skill"]: r for r in report["gap_table"].collect()}
    assert (table["Spreadsheets"]["share"], table["Spreadsheets"]["target"]) == (90.0, 4)
    assert (table["Query"]["share"], table["Query"]["Bo_gap"]) == (60.0, None)
    # Nobody asks a data engineer for SQL, so only the spreadsheet gap is left for Ada.
    assert [tuple(r) for r in report["role_gaps"].collect()] == [("Ada", "Spreadsheets", 75.0, 2, 4, 2)]
    assert [tuple(r) for r in report["pending"].collect()] == [("Bo", "Query")]
    helped = {r["skill"]: (r["members"], r["strongest"]) for r in report["peer_names"].collect()}
    assert helped == {"Spreadsheets": ("Ada", "Bo (5)"), "Query": ("Ada", "Ada (3)")}
    assert {r["skill"] for r in report["top_priorities"].collect()} == {"Spreadsheets", "Query"}


def test_role_gaps_pool_the_roles_of_a_candidate(spark):
    by_role = spark.createDataFrame(
        [("x", "SQL", 1, 10), ("y", "SQL", 5, 10)],
        "role string, item string, postings long, group_postings long",
    )
    ratings = spark.createDataFrame([("Ada", "SQL", 1)], "candidate string, skill string, rating int")
    roles = spark.createDataFrame([("Ada", "x"), ("Ada", "y")], "candidate string, role string")
    row = g.role_gaps(by_role, ratings, roles, preset.TARGET_TIERS, preset.TARGET_BASE).first()
    assert tuple(row) == ("Ada", "SQL", 30.0, 1, 4, 3)


def test_role_sets_are_summed_once(spark):
    """Candidates with equal sets share a row; repeated and unknown roles change nothing."""
    by_role = spark.createDataFrame(
        [("x", "SQL", 1, 10), ("y", "SQL", 5, 10), ("x", "ML", 9, 10)],
        "role string, item string, postings long, group_postings long",
    )
    roles = spark.createDataFrame(
        [("Ada", "x"), ("Ada", "y"), ("Bo", "y"), ("Bo", "x"), ("Bo", "x"), ("Cy", "y"), ("Di", None), ("Di", "z")],
        "candidate string, role string",
    )
    sets = roles.groupBy("candidate").agg(F.sort_array(F.collect_set("role")).alias("roles"))
    summed = {(tuple(r["roles"]), r["skill"]): r["role_share"] for r in g.demand_by_role_set(sets, by_role).collect()}
    assert summed == {(("x", "y"), "SQL"): 30.0, (("x", "y"), "ML"): 90.0, (("y",), "SQL"): 50.0}
    ratings = spark.createDataFrame(
        [("Ada", "SQL", 1), ("Bo", "SQL", 1), ("Bo", "ML", None), ("Cy", "SQL", 5), ("Di", "SQL", 1)],
        "candidate string, skill string, rating int",
    )
    short = g.role_gaps(by_role, ratings, roles, preset.TARGET_TIERS, preset.TARGET_BASE).collect()
    assert {(r["candidate"], r["skill"], r["role_share"]) for r in short} == {("Ada", "SQL", 30.0), ("Bo", "SQL", 30.0)}


def test_peer_rows(spark):
    ratings = spark.createDataFrame(
        [("Ada", "SQL", 1), ("Bo", "SQL", 4), ("Cy", "SQL", 4), ("Di", "SQL", None), ("Ada", "ML", 5)],
        "candidate string, skill string, rating int",
    )
    open_gaps = spark.createDataFrame([("SQL", "Ada", 3)], "skill string, candidate string, gap int")
    rows = {tuple(r) for r in g.peer_rows(open_gaps, ratings).collect()}
    assert rows == {("SQL", "gap", "Ada", 3), ("SQL", "strongest", "Bo", 4), ("SQL", "strongest", "Cy", 4)}
