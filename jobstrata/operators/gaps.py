"""Skill gaps of rated candidates against demand-based targets.

Ratings are long: ``candidate, skill, rating`` with a null rating for a skill
not rated yet. Demand is ``skill, share`` in percent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobstrata.operators.ranking import best_per_group, largest_with_ties


def target_level(share: Column, tiers: Sequence[tuple[float, int]], base: int) -> Column:
    """Level of the first tier the share reaches; tiers go from high to low."""
    level = F.lit(base)
    for least, value in reversed(tiers):
        level = F.when(share >= least, F.lit(value)).otherwise(level)
    return level


def ratings_long(wide: DataFrame, keys: Sequence[str], people: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(keys), list(people), "candidate", "rating")


def ratings_wide(long: DataFrame, keys: Sequence[str], people: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("candidate") == p, F.col("rating"))).alias(p) for p in people]
    )


def rating_matrix(long: DataFrame, people: Sequence[str], digits: int = 4) -> DataFrame:
    """``skill, mean_rating`` and one column per person, strongest skill first."""
    return (
        long.groupBy("skill")
        .agg(
            F.round(F.avg("rating"), digits).alias("mean_rating"),
            *[F.max(F.when(F.col("candidate") == p, F.col("rating"))).alias(p) for p in people],
        )
        .orderBy(F.desc("mean_rating"), F.asc("skill"))
    )


def targets(demand: DataFrame, tiers: Sequence[tuple[float, int]], base: int) -> DataFrame:
    return demand.withColumn("target", target_level(F.col("share"), tiers, base))


def gaps(ratings: DataFrame, with_targets: DataFrame) -> DataFrame:
    """``candidate, skill, rating, share, target, gap``; unrated skills give no row.

    Targets have one row per skill of the rated list they were made from; whether that is
    small enough to broadcast is left to Spark's check of its size.
    """
    return (
        ratings.filter(F.col("rating").isNotNull())
        .join(with_targets.select("skill", "share", "target"), "skill")
        .withColumn("gap", F.greatest(F.col("target") - F.col("rating"), F.lit(0)))
    )


def gap_table(
    gap_rows: DataFrame,
    people: Sequence[str] = (),
    rounding: Callable[[Column, int], Column] = F.round,
) -> DataFrame:
    """Per skill: demand, target, average rating, each named person's gap, average
    gap and priority (the rounded average gap weighted by demand)."""
    return (
        gap_rows.groupBy("skill", "share", "target")
        .agg(
            rounding(F.avg("rating"), 2).alias("average_rating"),
            *[
                F.max(F.when(F.col("candidate") == p, F.col("gap"))).alias(f"{p}_gap")
                for p in people
            ],
            rounding(F.avg("gap"), 2).alias("average_gap"),
        )
        .withColumn("priority", rounding(F.col("average_gap") * F.col("share") / 100, 2))
        .withColumn("falls_short", F.col("average_rating") < F.col("target"))
    )


def by_priority(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("priority"), F.desc("share"), F.asc("skill"))


def top_priorities(table: DataFrame, k: int = 3) -> DataFrame:
    return by_priority(table).limit(k).select("skill", "priority")


def skills_met(gap_rows: DataFrame) -> DataFrame:
    """Skills whose target every rated candidate meets."""
    return gap_rows.groupBy("skill").agg(F.max("gap").alias("_widest")).filter(
        F.col("_widest") == 0
    ).select("skill")


def levels_to_close(gap_rows: DataFrame) -> DataFrame:
    return gap_rows.groupBy("candidate").agg(F.sum("gap").alias("levels"))


def role_gaps(
    by_role: DataFrame,
    ratings: DataFrame,
    candidate_roles: DataFrame,
    tiers: Sequence[tuple[float, int]],
    base: int,
    digits: int = 1,
) -> DataFrame:
    """Skills in which a candidate falls short of the target of their own roles.

    ``by_role`` is ``role, item, postings, group_postings``. Demand is taken over
    the union of the candidate's roles (a repeated role counts once), and its share is not
    rounded before the target is read off. Many candidates share a set of roles, so demand
    is summed once for each distinct set and skill.
    """
    role_sets = candidate_roles.groupBy("candidate").agg(
        F.sort_array(F.collect_set("role")).alias("roles")
    )
    rated = ratings.filter(F.col("rating").isNotNull()).join(role_sets, "candidate")
    return (
        rated.join(demand_by_role_set(role_sets, by_role), ["roles", "skill"])
        .withColumn("target", target_level(F.col("role_share"), tiers, base))
        .filter(F.col("target") > F.col("rating"))
        .select(
            "candidate",
            "skill",
            F.round("role_share", digits).alias("role_share"),
            "rating",
            "target",
            (F.col("target") - F.col("rating")).alias("gap"),
        )
    )


def demand_by_role_set(role_sets: DataFrame, by_role: DataFrame) -> DataFrame:
    """``roles, skill, role_share``: the demand of each distinct set of roles as one group."""
    return (
        role_sets.select("roles")
        .distinct()
        .withColumn("role", F.explode("roles"))
        .join(by_role, "role")
        .groupBy("roles", F.col("item").alias("skill"))
        .agg((100.0 * F.sum("postings") / F.sum("group_postings")).alias("role_share"))
    )


def candidate_priorities(
    gap_rows: DataFrame, rounding: Callable[[Column, int], Column] = F.round
) -> DataFrame:
    """Each candidate's open gaps with priority, the gap itself weighted by demand."""
    return gap_rows.filter(F.col("gap") > 0).withColumn(
        "priority", rounding(F.col("gap") * F.col("share") / 100, 2)
    )


def top_per_candidate(priorities: DataFrame, k: int = 3) -> DataFrame:
    return best_per_group(priorities, ["candidate"], [F.desc("priority"), F.asc("skill")], k)


def pending(ratings: DataFrame) -> DataFrame:
    """``candidate, skills``: the skills a candidate has not rated, as one text.

    The text is as long as the rated list at most, whatever the number of candidates.
    """
    return (
        ratings.filter(F.col("rating").isNull())
        .groupBy("candidate")
        .agg(F.array_join(F.sort_array(F.collect_list("skill")), ", ").alias("skills"))
    )


def peer_help(priorities: DataFrame, ratings: DataFrame) -> DataFrame:
    """Per skill with a gap: how many have it, the total gap, the highest level held
    by anyone and how many share it. Works for any number of candidates."""
    needy = priorities.groupBy("skill").agg(
        F.count("*").alias("with_gap"), F.sum("gap").alias("total_gap")
    )
    best = (
        ratings.groupBy("skill", "rating")
        .agg(F.count("*").alias("holders"))
        .groupBy("skill")
        .agg(F.max(F.when(F.col("rating").isNotNull(), F.struct("rating", "holders"))).alias("top"))
    )
    return needy.join(best, "skill").select(
        "skill",
        "with_gap",
        "total_gap",
        F.col("top.rating").alias("best_rating"),
        F.col("top.holders").alias("strongest"),
    )


def peer_rows(priorities: DataFrame, ratings: DataFrame) -> DataFrame:
    """``skill, part, candidate, level`` of the skills with a gap: a row ``gap`` for everyone
    who has one, with its size, and ``strongest`` for everyone who shares the highest level."""
    in_gap = priorities.select(
        "skill", F.lit("gap").alias("part"), "candidate", F.col("gap").alias("level")
    )
    stated = ratings.filter(F.col("rating").isNotNull())
    strongest = largest_with_ties(stated, ["skill"], "rating").select(
        "skill", F.lit("strongest").alias("part"), "candidate", F.col("rating").alias("level")
    )
    needy = priorities.select("skill").distinct()
    return in_gap.unionByName(strongest.join(needy, "skill", "left_semi"))


def peer_names(priorities: DataFrame, ratings: DataFrame) -> DataFrame:
    """``peer_help`` with names written out, for one team of people: who has a gap,
    and everyone who shares the highest level, with that level. For many candidates
    take ``peer_rows``, which puts no list of them into a cell."""

    def names(rows: DataFrame, out: str) -> DataFrame:
        return rows.groupBy("skill").agg(
            F.array_join(F.sort_array(F.collect_list("candidate")), ", ").alias(out)
        )

    strongest = names(largest_with_ties(ratings, ["skill"], "rating"), "names")
    return (
        names(priorities, "members")
        .join(peer_help(priorities, ratings), "skill")
        .join(strongest, "skill")
        .select(
            "skill",
            "members",
            "total_gap",
            F.concat("names", F.lit(" ("), "best_rating", F.lit(")")).alias("strongest"),
        )
    )
