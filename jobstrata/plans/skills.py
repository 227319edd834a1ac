"""Skill demand of a panel against the ratings of a team."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from jobstrata.operators import gaps as g
from jobstrata.operators.items import demand, demand_by_group
from jobstrata.presets import postings as preset


def skill_report(
    panel: DataFrame,
    wide_ratings: DataFrame,
    people: Sequence[str],
    roles: Mapping[str, Sequence[str]],
) -> dict[str, DataFrame]:
    """Gap table, findings, role gaps, priorities and peer help for one team.

    The rated list is a page-long table typed in by hand, so its skill names are
    read to the driver once and demand is counted for those names only.
    """
    spark = panel.sparkSession
    names = wide_ratings.select("skill", "panel_skill_name")
    listed = [r["panel_skill_name"] for r in names.select("panel_skill_name").collect()]
    items = F.col("SKILLS_NAME")
    asked = names.join(
        demand(panel, items, listed).withColumnRenamed("item", "panel_skill_name"),
        "panel_skill_name",
    )
    rated = g.ratings_long(wide_ratings, ["skill"], people)
    with_targets = g.targets(asked, preset.TARGET_TIERS, preset.TARGET_BASE)
    gap_rows = g.gaps(rated, with_targets)
    table = g.gap_table(gap_rows, people, F.bround)
    priorities = g.candidate_priorities(gap_rows, F.bround)

    by_role = (
        demand_by_group(panel, "role_family", items, listed)
        .withColumnRenamed("item", "panel_skill_name")
        .join(names, "panel_skill_name")
        .select(
            F.col("role_family").alias("role"),
            F.col("skill").alias("item"),
            "postings",
            "group_postings",
        )
    )
    targeted = spark.createDataFrame(
        [(person, role) for person, wanted in roles.items() for role in wanted],
        "candidate string, role string",
    )
    return {
        "gap_table": g.by_priority(table),
        "top_priorities": g.top_priorities(table),
        "skills_met": g.skills_met(gap_rows),
        "levels_to_close": g.levels_to_close(gap_rows),
        "rating_matrix": g.rating_matrix(rated, people),
        "role_gaps": g.role_gaps(
            by_role, rated, targeted, preset.TARGET_TIERS, preset.TARGET_BASE
        ),
        "priorities": priorities,
        "top_per_candidate": g.top_per_candidate(priorities),
        "pending": g.pending(rated),
        "peer_names": g.peer_names(priorities, rated),
    }
