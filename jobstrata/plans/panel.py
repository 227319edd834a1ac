"""Raw postings to the analytical panel and its build statistics.

Two reads of the raw rows in all: one for the statistics (which also find the
latest date) and one for the panel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.functions.cells import (
    any_of,
    canonical_label,
    day,
    filled,
    filled_list,
    first_match,
    keep_between,
    keep_labels,
    number,
    text_list,
)
from jobstrata.functions.pay import PayRules, add_pay
from jobstrata.functions.places import PlaceRules, state_of
from jobstrata.operators.funnel import Funnel, code_is, title_has, title_lacks
from jobstrata.presets import postings as preset
from jobstrata.session import checkpointed
from jobstrata.sources.writers import write_panel, write_stats

PLACES = PlaceRules(
    capital_pattern=preset.CAPITAL_PATTERN,
    capital_label=preset.CAPITAL_LABEL,
    names=list(preset.STATES.values()),
    code_in_text=preset.CODE_IN_TEXT,
    codes=preset.STATES,
    cities=preset.CITY_RULES,
    unresolved=preset.STATE_UNRESOLVED,
)
PAY = PayRules(factors=preset.PERIOD_FACTORS, floor=preset.PAY_FLOOR)


@dataclass(frozen=True)
class PanelRules:
    """What selects and cleans a posting; the defaults are the postings preset."""

    code: str = preset.INDUSTRY_CODE
    include: Sequence[str] = field(default_factory=lambda: preset.TITLE_INCLUDE)
    exclude: Sequence[str] = field(default_factory=lambda: preset.TITLE_EXCLUDE)
    broad: Sequence[str] = field(default_factory=lambda: preset.TITLE_BROAD)
    days: int = preset.WINDOW_DAYS
    roles: Sequence[tuple[str, str]] = field(default_factory=lambda: preset.ROLE_RULES)
    occupations: Sequence[str] = field(default_factory=lambda: preset.OCCUPATIONS_KEPT)
    places: PlaceRules = PLACES
    pay: PayRules = PAY

    def with_changes(self, **changes: object) -> PanelRules:
        return replace(self, **changes)


def panel_funnel(rules: PanelRules) -> Funnel:
    title, in_industry = F.col("TITLE_CLEAN"), code_is(F.col("NAICS_2022_4"), rules.code)
    years = number(F.col("MIN_YEARS_EXPERIENCE"))
    in_panel: dict[str, Column] = {
        f"filled_{c}": filled(F.col(c)) for c in preset.COVERAGE_FIELDS
    }
    in_panel |= {f"listed_{c}": filled_list(F.col(c)) for c in preset.LIST_FIELDS}
    in_panel |= {"experience_zero": years == 0, "experience_over_20": years > preset.YEARS_MAX}
    return Funnel(
        steps=[
            ("industry", in_industry),
            ("role_include", title_has(title, rules.include)),
            ("role_exclude", title_lacks(title, rules.exclude)),
        ],
        date=day(F.col("POSTED")),
        days=rules.days,
        compared={"broad_matches": in_industry & title.rlike(any_of(rules.broad))},
        in_panel=in_panel,
    )


def build_stats(raw: DataFrame, rules: PanelRules | None = None) -> DataFrame:
    """One row of build statistics with the coverage counts as two maps."""
    counts = panel_funnel(rules or PanelRules()).counts(raw)

    def as_map(prefix: str, names: Sequence[str]) -> Column:
        return F.create_map(
            *[part for n in names for part in (F.lit(n), F.col(f"{prefix}_{n}"))]
        )

    return counts.select(
        F.lit(len(raw.columns)).alias("source_columns"),
        F.col("raw").alias("raw_postings"),
        F.col("industry").alias("industry_postings"),
        "broad_matches",
        F.col("role_include").alias("after_include"),
        F.col("role_exclude").alias("after_exclude"),
        "undated",
        "window_start",
        "window_end",
        F.col("in_window").alias("after_window"),
        "before_window",
        as_map("filled", preset.COVERAGE_FIELDS).alias("field_coverage"),
        as_map("listed", preset.LIST_FIELDS).alias("skill_field_coverage"),
        "experience_zero",
        "experience_over_20",
        F.col("in_window").alias("final_postings"),
    )


def clean_postings(df: DataFrame, rules: PanelRules) -> DataFrame:
    """The cleaning projections; row by row, no shuffle."""

    def years(name: str) -> Column:
        return keep_between(number(F.col(name)), preset.YEARS_MIN, preset.YEARS_MAX)

    cleaned = df.withColumns(
        {
            "state": state_of(
                F.col("LOCATION"), F.col("STATE"), F.col("STATE_NAME"), rules.places
            ),
            "occupation_group": keep_labels(F.col("ONET_NAME"), rules.occupations),
            "role_family": first_match(F.col("TITLE_CLEAN"), rules.roles, "Other"),
            "REMOTE_TYPE_NAME": canonical_label(
                F.col("REMOTE_TYPE_NAME"),
                preset.ARRANGEMENT_SYNONYMS,
                preset.ARRANGEMENT_UNKNOWN,
            ),
            "min_years_experience": years("MIN_YEARS_EXPERIENCE"),
            "max_years_experience": years("MAX_YEARS_EXPERIENCE"),
            "SKILLS_NAME": text_list(F.col("SKILLS_NAME")),
            "SPECIALIZED_SKILLS_NAME": text_list(F.col("SPECIALIZED_SKILLS_NAME")),
        }
    )
    return add_pay(
        cleaned,
        "SALARY_FROM",
        "SALARY_TO",
        "ORIGINAL_PAY_PERIOD",
        rules.pay,
        ("salary_from_annual", "salary_to_annual", "salary_midpoint"),
    )


def select_panel(df: DataFrame) -> DataFrame:
    return df.select(*preset.PANEL_COLUMNS)


def build_panel(
    raw: DataFrame, rules: PanelRules | None = None, latest: DataFrame | None = None
) -> DataFrame:
    """Funnel survivors, cleaned, with the published columns in order.

    ``latest`` is a one-cell table with the last date, if it is known already;
    otherwise finding it costs a pass over the raw rows.
    """
    rules = rules or PanelRules()
    kept = panel_funnel(rules).survivors(raw, latest=latest)
    return select_panel(clean_postings(kept, rules))


def run_panel_job(
    raw: DataFrame, out: str, rules: PanelRules | None = None, fmt: str = "parquet"
) -> None:
    """Write ``out/stats`` and ``out/panel``; the raw rows are read twice.

    The statistics carry the latest date into the panel pass. The panel, a small
    part of the raw rows, is checkpointed so that sampling it for the range
    sort does not read the raw rows again.
    """
    stats = build_stats(raw, rules)
    write_stats(stats, f"{out}/stats")
    saved = raw.sparkSession.read.schema(stats.schema).json(f"{out}/stats")
    panel = build_panel(raw, rules, latest=saved.select("window_end"))
    write_panel(checkpointed(panel), f"{out}/panel", fmt)
