"""The market tables read off a panel, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from jobstrata.functions.cells import name_key, or_label, relabel
from jobstrata.operators.frequency import (
    banded,
    complete,
    frequency,
    histogram,
    side_by_side,
    top_k,
)
from jobstrata.operators.market import median_by_group, numeric_summary, role_comparison
from jobstrata.operators.profile import missing_summary, repeat_summary, spelling_variants
from jobstrata.presets import postings as preset


def market_tables() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """A function per table from a panel to that table. Each is a small aggregation of
    its own, so hand them a panel read from Parquet rather than one still to be built."""
    pay, years = F.col("salary_midpoint"), F.col("min_years_experience")
    arrangement = or_label(F.col("REMOTE_TYPE_NAME"), preset.ARRANGEMENT_UNKNOWN)
    stated = F.col("REMOTE_TYPE_NAME") != preset.ARRANGEMENT_UNKNOWN
    segment = relabel(or_label(F.col("occupation_group"), "Other"), preset.OCCUPATION_DISPLAY)
    return {
        "job_volume": lambda panel: frequency(panel, segment),
        "salary_summary": lambda panel: numeric_summary(panel, pay),
        "salary_histogram": lambda panel: histogram(panel, pay),
        "leading_states": lambda panel: top_k(
            panel, F.col("state"), 10, F.col("value") != preset.STATE_UNRESOLVED
        ),
        "work_arrangement": lambda panel: complete(
            frequency(panel, arrangement), preset.ARRANGEMENT_ORDER, ["n", "share"]
        ),
        "work_arrangement_stated": lambda panel: frequency(panel.filter(stated), arrangement),
        "top_employers": lambda panel: top_k(
            panel, or_label(F.col("COMPANY_NAME"), preset.EMPLOYER_MISSING), 10
        ),
        "median_pay_by_segment": lambda panel: median_by_group(
            panel.withColumn("segment", segment), "segment", pay, few_groups=True
        ),
        "median_pay_by_arrangement": lambda panel: median_by_group(
            panel, "REMOTE_TYPE_NAME", pay, min_n=1
        ),
        "experience_bands": lambda panel: banded(panel, years, preset.YEARS_EDGES, preset.YEARS_LABELS),
        "education_levels": lambda panel: side_by_side(
            panel,
            F.col("MIN_EDULEVELS_NAME"),
            F.col("MAX_EDULEVELS_NAME"),
            preset.EDUCATION_LEVELS,
        ),
        "role_families": lambda panel: frequency(panel, F.col("role_family")),
        "role_comparison": lambda panel: role_comparison(
            panel,
            "role_family",
            pay,
            years,
            F.col("REMOTE_TYPE_NAME").isin(preset.FLEXIBLE_ARRANGEMENTS),
            preset.ENTRY_YEARS,
            overall=True,
        ),
        "missing_values": lambda panel: missing_summary(
            panel,
            {
                "Job title": F.col("TITLE_CLEAN").isNotNull(),
                "Employer": F.col("COMPANY_NAME").isNotNull(),
                "Role family": F.col("role_family").isNotNull(),
                "Posted date": F.col("posted_date").isNotNull(),
                "Skills": F.size("SKILLS_NAME") > 0,
                "Highest education mentioned": F.col("MAX_EDULEVELS_NAME").isNotNull(),
                "State (derived)": F.col("state") != preset.STATE_UNRESOLVED,
                "Minimum education": F.col("MIN_EDULEVELS_NAME").isNotNull(),
                "Work arrangement": stated,
                "Salary midpoint": pay.isNotNull(),
                "Minimum experience": years.isNotNull(),
            },
        ),
        "repeats": lambda panel: repeat_summary(panel, ["TITLE_CLEAN", "COMPANY_NAME", "posted_date"], "LOCATION"),
        "employer_spellings": lambda panel: spelling_variants(
            panel, "COMPANY_NAME", name_key(F.col("COMPANY_NAME"), preset.COMPANY_SUFFIX)
        ),
    }
