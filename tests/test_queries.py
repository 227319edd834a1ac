"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from jobstrata.catalog import REGISTRY
from jobstrata.catalog.inputs import RAW_COLUMNS, raw_postings
from tests.oracle import connect, difference

SF = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_query_matches_sql(spark, con, name):
    problem, _ = difference(spark, con, name, SF)
    assert problem is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 5


def test_whole_summaries_are_registered(spark):
    """Eleven checks, every raw column, every feature and every statistic."""
    run = {n: q.run for n, q in REGISTRY.items()}
    assert run["panel_missing_values"](spark, SF).count() == 11
    profiled = [r["column"] for r in run["schema_counts_all"](spark, SF).collect()]
    assert profiled == list(RAW_COLUMNS)
    row = run["build_statistics_all"](spark, SF).first()
    assert row["source_columns"] == len(raw_postings(spark, SF).columns)
    assert row["final_postings"] == row["after_window"]
    rows = run["feature_rows"](spark, SF)
    pairs = run["feature_pairs"](spark, SF)
    ones = sum(r["features"].numNonzeros() for r in rows.collect())
    assert pairs.count() == ones == 4 * rows.count()
