"""The raw-to-panel job on hand-written postings, and every sink read back."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobstrata.plans.baseline import market_tables
from jobstrata.plans.panel import build_panel, build_stats, panel_funnel, PanelRules, run_panel_job
from jobstrata.operators.funnel import compare_extracts, compare_funnels
from jobstrata.presets import postings as preset
from jobstrata.sources.readers import (
    PANEL_SCHEMA,
    RAW_SCHEMA,
    SourceError,
    check_source,
    read_panel,
    read_postings,
    read_ratings,
    schema_problems,
    source_inventory,
)
from jobstrata.sources.writers import data_dictionary, write_panel, write_table

LATEST = dt.date(2026, 9, 10)


def posting(i, title="Data Analyst", code="5415", posted=str(LATEST), **more):
    row = dict.fromkeys(RAW_SCHEMA.fieldNames())
    return row | {"ID": i, "TITLE_CLEAN": title, "NAICS_2022_4": code, "POSTED": posted} | more


def raw(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], RAW_SCHEMA)


@pytest.fixture
def sample(spark):
    back = lambda days: str(LATEST - dt.timedelta(days=days))
    return raw(
        spark,
        [
            posting(9, SKILLS_NAME='["SQL","SQL"]', SALARY_FROM="50", ORIGINAL_PAY_PERIOD="hourly"),
            posting(2, posted=back(365), LOCATION="Austin, TX", MIN_YEARS_EXPERIENCE="0"),
            posting(3, posted=back(366)),
            posting(4, posted=""),
            posting(5, posted="not a date"),
            posting(6, title="QA Data Analyst"),
            posting(7, title="Chef", posted="2030-01-01"),
            posting(8, code="9999", posted="2031-01-01"),
            posting(1, title=None),
            posting(10, title="Data Engineer", MIN_YEARS_EXPERIENCE="21", SKILLS_NAME="[]"),
            posting(11, title="Security analyst"),
        ],
    )


def test_funnel_counts(sample):
    row = panel_funnel(PanelRules()).counts(sample).first()
    assert (row["raw"], row["industry"]) == (11, 10)
    assert (row["role_include"], row["role_exclude"], row["in_window"]) == (7, 6, 3)
    assert (row["undated"], row["before_window"]) == (2, 1)
    assert row["role_exclude"] == row["undated"] + row["before_window"] + row["in_window"]
    assert row["window_end"] == LATEST
    assert row["window_start"] == LATEST - dt.timedelta(days=365)
    assert row["broad_matches"] == 8


def test_funnel_only_narrows(sample):
    table = panel_funnel(PanelRules()).table(sample).orderBy("step_no").collect()
    counts = [r["postings"] for r in table]
    assert counts == sorted(counts, reverse=True)
    assert table[0]["share"] == 100.0


def test_funnel_ignores_partitioning(sample):
    tables = [
        sorted(map(tuple, panel_funnel(PanelRules()).table(df).collect()))
        for df in (sample, sample.repartition(7), sample.coalesce(1))
    ]
    assert tables[0] == tables[1] == tables[2]


def test_panel_rows(sample):
    panel = build_panel(sample)
    assert panel.columns == preset.PANEL_COLUMNS
    rows = {r["ID"]: r for r in panel.collect()}
    assert set(rows) == {9, 2, 10}
    assert rows[9]["salary_midpoint"] == 104000.0
    assert rows[9]["SKILLS_NAME"] == ["SQL"]
    assert rows[9]["state"] == "Unspecified"
    assert rows[2]["state"] == "Texas"
    assert rows[2]["min_years_experience"] is None
    assert rows[10]["role_family"] == "Data Engineer"
    assert rows[10]["occupation_group"] == "Other"
    assert rows[10]["REMOTE_TYPE_NAME"] == "Unknown"


def test_build_statistics(sample):
    stats = build_stats(sample).first()
    assert stats["final_postings"] == 3
    assert stats["field_coverage"]["SALARY_FROM"] == 1
    assert stats["field_coverage"]["MIN_YEARS_EXPERIENCE"] == 2
    assert stats["skill_field_coverage"]["SKILLS_NAME"] == 1
    assert (stats["experience_zero"], stats["experience_over_20"]) == (1, 1)


def test_empty_source(spark):
    row = panel_funnel(PanelRules()).counts(raw(spark, [posting(1, code="0")]).filter("ID = 2")).first()
    assert row["window_end"] is None
    assert build_panel(raw(spark, [posting(1, posted=None)])).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_panel_job_round_trip(spark, sample, tmp_path, fmt):
    out = str(tmp_path / "out")
    run_panel_job(sample, out, fmt=fmt)
    again = read_panel(spark, f"{out}/panel", fmt)
    assert again.columns == preset.PANEL_COLUMNS
    assert [f.dataType for f in again.schema] == [f.dataType for f in PANEL_SCHEMA]
    assert sorted(map(str, again.collect())) == sorted(map(str, build_panel(sample).collect()))
    stats = json.loads(next(Path(f"{out}/stats").glob("part-*.json")).read_text())
    assert stats["final_postings"] == 3
    assert stats["window_end"] == str(LATEST)


def test_panel_files_are_ordered_by_key(spark, tmp_path):
    df = spark.range(0, 5000).select((F.lit(5000) - F.col("id")).alias("ID")).repartition(13)
    write_panel(df, str(tmp_path / "p"))
    files = sorted(str(f) for f in Path(tmp_path / "p").glob("part-*"))
    ids = [r["ID"] for f in files for r in spark.read.parquet(f).collect()]
    assert ids == sorted(ids) and len(ids) == 5000


def test_source_contract(spark, sample, tmp_path):
    path = str(tmp_path / "raw")
    sample.repartition(3).write.parquet(path)
    back = read_postings(spark, path, expected_files=3)
    assert tuple(source_inventory(back).first()) == (3, len(RAW_SCHEMA), 11)
    with pytest.raises(SourceError, match="expected 21 files, found 3"):
        read_postings(spark, path, expected_files=21)
    with pytest.raises(SourceError, match="missing columns: POSTED"):
        check_source(back.drop("POSTED"), RAW_SCHEMA.fieldNames())


def test_extracts_of_one_table_compare_as_two(sample):
    """Each extract has its own window; one without rows has nulls."""
    funnel = panel_funnel(PanelRules())
    half = F.when(F.col("ID") % 2 == 0, "even").otherwise("odd")
    tables = [funnel.table(sample.where(half == h)) for h in ("even", "odd")]
    want = sorted(map(tuple, compare_funnels(*tables).collect()))
    assert sorted(map(tuple, compare_extracts(funnel, sample, half, "even", "odd").collect())) == want
    alone = compare_extracts(funnel, sample, half, "even", "none").collect()
    assert sorted(r["step"] for r in alone) == sorted(w[0] for w in want)
    assert all(r["second"] is None for r in alone)
    assert compare_extracts(funnel, sample, half, "no", "none").count() == 0


def test_typed_source_contract(spark, sample, tmp_path):
    """Every file is held to the contract, named, and nothing but footers is read."""
    path = tmp_path / "raw"
    sample.coalesce(1).write.parquet(str(path / "a"))
    sample.withColumn("ID", F.col("ID").cast("string")).coalesce(1).write.parquet(str(path / "b"))
    sample.drop("POSTED").withColumn("more", F.lit(1)).coalesce(1).write.parquet(str(path / "c"))
    files = [str(f) for f in sorted(path.glob("*/part-*.parquet"))]
    found = schema_problems(spark, files, RAW_SCHEMA).orderBy("file").collect()
    assert [tuple(r)[1:] for r in found] == [("ID", "bigint", "string"), ("POSTED", "string", None)]
    assert [Path(r["file"]).parent.name for r in found] == ["b", "c"]
    assert schema_problems(spark, files[:1], RAW_SCHEMA).count() == 0
    with pytest.raises(SourceError, match=r"/b/part-.*: ID is string, not bigint"):
        read_postings(spark, *files[:2], expected_files=2)
    with pytest.raises(SourceError, match=r"/c/part-.*: POSTED is missing, not string"):
        read_postings(spark, files[0], files[2])
    assert read_postings(spark, files[0], expected_files=1).count() == 11


def test_inventory_counts_files_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (3, 0, 2, 0):
        spark.range(rows).coalesce(1).write.mode("append").parquet(path)
    assert tuple(source_inventory(spark.read.parquet(path)).first()) == (4, 1, 5)
    assert tuple(source_inventory(spark.range(2)).first()) == (0, 1, 2)


def test_ratings_and_tables_round_trip(spark, tmp_path):
    wide = spark.createDataFrame(
        [("SQL", "SQL (Programming Language)", 1, None, "same, skill")],
        "skill string, panel_skill_name string, Ada int, Bo int, rating_source string",
    )
    write_table(wide, str(tmp_path / "r"), "csv")
    assert read_ratings(spark, str(tmp_path / "r"), ["Ada", "Bo"]).collect() == wide.collect()


def test_data_dictionary(sample):
    notes = {"ID": ("Unique posting identifier", "Key")}
    rows = data_dictionary(build_panel(sample), notes).orderBy("position").collect()
    assert [r["variable"] for r in rows] == preset.PANEL_COLUMNS
    assert tuple(rows[0])[1:] == ("ID", "bigint", "Unique posting identifier", "Key")
    assert rows[6]["data_type"] == "date"


def test_every_market_table_runs(sample):
    panel = build_panel(sample)
    tables = {name: make(panel).collect() for name, make in market_tables().items()}
    assert sum(r["n"] for r in tables["role_families"]) == 3
    assert [r["n"] for r in sorted(tables["work_arrangement"], key=lambda r: r["pos"])] == [0, 0, 0, 3]
    assert round(sum(r["share"] for r in tables["role_families"]), 2) == 100.0
