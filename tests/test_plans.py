"""What the physical plans must keep doing: prune, push down, read once, stay in the JVM."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from jobstrata.catalog import REGISTRY
from jobstrata.plans.panel import build_panel
from jobstrata.sources.readers import RAW_SCHEMA

SF = contract.SMOKE_DIR


def executed(df):
    """The final adaptive plan, without the initial one it replaced."""
    df.collect()
    kept, skipping = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :"))
        if "Initial Plan" in line:
            skipping = depth
        elif skipping is None or depth <= skipping:
            skipping = None
            kept.append(line)
    return "\n".join(kept)


@pytest.fixture
def raw(spark, tmp_path):
    extra = [F.lit("x").alias(f"unused_{i}") for i in range(5)]
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA if f.name != "ID"]
    spark.range(20).select(F.col("id").alias("ID"), *blank, *extra).write.parquet(str(tmp_path / "raw"))
    return spark.read.parquet(str(tmp_path / "raw"))


def test_panel_pushes_the_industry_code_and_prunes_columns(raw):
    plan = build_panel(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "unused_0" not in re.sub(r"Relation \[.*", "", plan)
    physical = build_panel(raw)._jdf.queryExecution().executedPlan()
    text = physical.toString()
    assert "EqualTo(NAICS_2022_4,5415)" in text
    assert "unused_" not in text


READ_ONCE = """funnel_steps build_statistics top_tokens token_coverage frequent_tokens
skill_demand skill_demand_by_role leading_nations top_employers experience_bands item_composition
price_summary role_table running_share median_by_customer""".split()


@pytest.mark.parametrize("name", READ_ONCE)
def test_rows_are_read_once(spark, name):
    """Every scan of a big table beyond the first must come from a reused exchange."""
    df = REGISTRY[name].run(spark, SF)
    plan = executed(df)
    stages = {}
    for line in plan.split("\n"):
        stage = re.search(r"ShuffleQueryStage (\d+)", line)
        if stage:
            current = stage.group(1)
        scan = re.search(r"FileScan parquet.*?/(lineitem|orders|events|documents)\.parquet", line)
        if scan:
            stages.setdefault(scan.group(1), set()).add(current)
    for table, found in stages.items():
        # The adaptive plan numbers a stage shared with a subquery the same way.
        assert len(found) == 1, f"{table} is scanned by stages {found}"


@pytest.mark.parametrize("name", ["panel_rows", "gap_summary", "item_premium", "split_rows", "repeat_rows"])
def test_no_python_and_no_cartesian_product(spark, name):
    plan = executed(REGISTRY[name].run(spark, SF))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_top_per_candidate_limits_before_the_shuffle(spark):
    plan = executed(REGISTRY["top_per_candidate"].run(spark, SF))
    assert "WindowGroupLimit" in plan
