"""Gaps of rated candidates: every user as a candidate, and a named team of six cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobstrata.catalog.inputs import SKILLS, VISITS_SQL, uses, visits
from jobstrata.catalog.registry import query
from jobstrata.operators import gaps as g
from jobstrata.operators.items import demand, demand_by_group
from jobstrata.operators.ranking import largest_with_ties
from jobstrata.presets import postings as preset

TEAM = [f"c{i}" for i in range(6)]
_LIST = ", ".join(f"'{s}'" for s in SKILLS)
_LISTED_SQL = f"listed AS (SELECT unnest([{_LIST}]) AS skill)"
_TIER_SQL = "CASE WHEN {0} >= 20 THEN 4 WHEN {0} >= 10 THEN 3 ELSE 2 END"


def half_up(expr: str, digits: int) -> str:
    """Round a double the way its decimal digits read, as Spark does."""
    return f"CAST(round(CAST({expr} AS DECIMAL(18, 8)), {digits}) AS DOUBLE)"


def _user_rating(n: Column) -> Column:
    return F.when(n > 0, F.least(F.lit(5), 1 + F.floor(n / 3))).cast("int")


def _team_rating(n: Column) -> Column:
    return F.when(n % 9 != 0, 1 + n % 5).cast("int")


def _rated(events: DataFrame, candidate: Column, rating) -> DataFrame:
    """``candidate, skill, rating`` for every skill, null where not rated; one scan."""
    counts = events.groupBy(candidate.alias("candidate")).agg(
        *[F.count_if(F.col("item") == s).alias(s) for s in SKILLS]
    )
    return counts.unpivot("candidate", SKILLS, "skill", "n").select(
        "candidate", "skill", rating(F.col("n")).alias("rating")
    )


def _user_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(uses(spark, sf_dir), F.col("user_id"), _user_rating)


def _team_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = F.concat(F.lit("c"), (F.col("user_id") % 6).cast("string"))
    return _rated(uses(spark, sf_dir), cohort, _team_rating)


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = demand(visits(spark, sf_dir), F.col("items"), SKILLS).withColumnRenamed("item", "skill")
    return g.targets(asked, preset.TARGET_TIERS, preset.TARGET_BASE)


def _user_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gaps(_user_ratings(spark, sf_dir), _targets(spark, sf_dir))


def _team_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gaps(_team_ratings(spark, sf_dir), _targets(spark, sf_dir))


def _ratings_sql(candidate: str, rating: str) -> str:
    return f"""counted AS (SELECT {candidate} AS candidate, item AS skill, count(*) AS n FROM uses GROUP BY ALL),
    candidates AS (SELECT DISTINCT {candidate} AS candidate FROM uses),
    ratings AS (SELECT candidate, skill, CAST({rating} AS INT) AS rating FROM candidates CROSS JOIN listed
        LEFT JOIN counted USING (candidate, skill))"""


_USER_SQL = _ratings_sql("user_id", "CASE WHEN n > 0 THEN least(5, 1 + n // 3) END")
_TEAM_SQL = _ratings_sql(
    "'c' || (user_id % 6)", "CASE WHEN coalesce(n, 0) % 9 <> 0 THEN 1 + n % 5 END"
)
_GAPS_SQL = f"""asked AS (SELECT skill, round(100e0 * (SELECT count_if(list_contains(items, skill)) FROM visits)
        / (SELECT count(*) FROM visits), 1) AS share FROM listed),
    targets AS (SELECT skill, share, {_TIER_SQL.format('share')} AS target FROM asked),
    gaps AS (SELECT candidate, skill, rating, share, target, greatest(target - rating, 0) AS gap
        FROM ratings JOIN targets USING (skill) WHERE rating IS NOT NULL)"""
_USERS = f"WITH {VISITS_SQL}, {_LISTED_SQL}, {_USER_SQL}, {_GAPS_SQL}"
_TEAMS = f"WITH {VISITS_SQL}, {_LISTED_SQL}, {_TEAM_SQL}, {_GAPS_SQL}"
_TEAM_GAP_SQL = "".join(f"max(gap) FILTER (candidate = '{p}') AS {p}_gap, " for p in TEAM)


def _table_sql(named: str) -> str:
    return f"""grouped AS (SELECT skill, share, target, {half_up('avg(rating)', 2)} AS average_rating, {named}
        {half_up('avg(gap)', 2)} AS average_gap FROM gaps GROUP BY skill, share, target),
    gap_table AS (SELECT grouped.*, {half_up('average_gap * share / 100', 2)} AS priority,
        average_rating < target AS falls_short FROM grouped)"""


@query(f"{_USERS} SELECT candidate, skill, rating, share, target, gap FROM gaps")
def gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_gaps(spark, sf_dir)


@query(f"{_USERS}, {_table_sql('')} SELECT * FROM gap_table")
def gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.by_priority(g.gap_table(_user_gaps(spark, sf_dir)))


@query(f"{_TEAMS}, {_table_sql(_TEAM_GAP_SQL)} SELECT * FROM gap_table")
def gap_summary_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.by_priority(g.gap_table(_team_gaps(spark, sf_dir), TEAM))


@query(
    f"""{_USERS}, {_table_sql('')} SELECT skill, priority FROM gap_table ORDER BY priority DESC, share DESC, skill LIMIT 3"""
)
def top_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.top_priorities(g.gap_table(_user_gaps(spark, sf_dir)))


@query(f"{_TEAMS} SELECT skill FROM gaps GROUP BY skill HAVING max(gap) = 0")
def skills_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.skills_met(_team_gaps(spark, sf_dir))


@query(f"{_USERS} SELECT candidate, CAST(sum(gap) AS BIGINT) AS levels FROM gaps GROUP BY candidate")
def levels_to_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.levels_to_close(_user_gaps(spark, sf_dir))


@query(
    f"""{_USERS}, wanted AS (SELECT user_id AS candidate, min_by(event_type, (ts, event_id)) AS first,
        max_by(event_type, (ts, event_id)) AS last FROM uses GROUP BY user_id),
    candidate_roles AS (SELECT DISTINCT candidate, unnest([first, last]) AS role FROM wanted),
    by_role AS (SELECT role, skill, count_if(list_contains(items, skill)) AS n, count(*) AS total
        FROM visits CROSS JOIN listed GROUP BY ALL),
    demanded AS (SELECT candidate, skill, 100e0 * sum(n) / sum(total) AS role_share
        FROM candidate_roles JOIN by_role USING (role) GROUP BY ALL),
    short AS (SELECT candidate, skill, role_share, rating, {_TIER_SQL.format('role_share')} AS target
        FROM ratings JOIN demanded USING (candidate, skill) WHERE rating IS NOT NULL)
    SELECT candidate, skill, {half_up('role_share', 1)} AS role_share, rating, target, target - rating AS gap FROM short
    WHERE target > rating"""
)
def role_shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("ts", "event_id")
    wanted = (
        uses(spark, sf_dir)
        .groupBy(F.col("user_id").alias("candidate"))
        .agg(F.min_by("event_type", order).alias("first"), F.max_by("event_type", order).alias("last"))
        .select("candidate", F.explode(F.array_distinct(F.array("first", "last"))).alias("role"))
    )
    by_role = demand_by_group(visits(spark, sf_dir), "role", F.col("items"), SKILLS)
    return g.role_gaps(
        by_role, _user_ratings(spark, sf_dir), wanted, preset.TARGET_TIERS, preset.TARGET_BASE
    )


_PRIORITY_SQL = f"""priorities AS (SELECT gaps.*, {half_up('gap * share / 100', 2)} AS priority
    FROM gaps WHERE gap > 0)"""


@query(f"{_USERS}, {_PRIORITY_SQL} SELECT * FROM priorities")
def priorities_by_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.candidate_priorities(_user_gaps(spark, sf_dir)).select(
        "candidate", "skill", "rating", "share", "target", "gap", "priority"
    )


@query(
    f"""{_USERS}, {_PRIORITY_SQL} SELECT candidate, skill, priority,
    CAST(row_number() OVER (PARTITION BY candidate ORDER BY priority DESC, skill) AS INT) AS place
    FROM priorities QUALIFY place <= 3"""
)
def top_per_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    priorities = g.candidate_priorities(_user_gaps(spark, sf_dir))
    return g.top_per_candidate(priorities).select("candidate", "skill", "priority", "place")


@query(
    f"""{_USERS} SELECT candidate, string_agg(skill, ', ' ORDER BY skill) AS skills FROM ratings
    WHERE rating IS NULL GROUP BY candidate"""
)
def pending_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.pending(_user_ratings(spark, sf_dir))


@query(
    f"""{_USERS}, {_PRIORITY_SQL}, needy AS (SELECT skill, count(*) AS with_gap, CAST(sum(gap) AS BIGINT) AS total_gap
        FROM priorities GROUP BY skill),
    best AS (SELECT skill, max(rating) AS best_rating FROM ratings GROUP BY skill)
    SELECT skill, with_gap, total_gap, best_rating,
    (SELECT count(*) FROM ratings r WHERE r.skill = needy.skill AND r.rating = best_rating) AS strongest
    FROM needy JOIN best USING (skill)"""
)
def peer_help(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _user_ratings(spark, sf_dir)
    return g.peer_help(g.candidate_priorities(g.gaps(ratings, _targets(spark, sf_dir))), ratings)


@query(
    f"""{_TEAMS}, {_PRIORITY_SQL}, needy AS (SELECT skill, string_agg(candidate, ', ' ORDER BY candidate) AS members,
        CAST(sum(gap) AS BIGINT) AS total_gap FROM priorities GROUP BY skill),
    holders AS (SELECT skill, candidate, rating FROM ratings WHERE rating IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY skill ORDER BY rating DESC) = 1),
    named AS (SELECT skill, string_agg(candidate, ', ' ORDER BY candidate) || ' (' || max(rating) || ')' AS strongest
        FROM holders GROUP BY skill)
    SELECT skill, members, total_gap, strongest FROM needy JOIN named USING (skill)"""
)
def peer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _team_ratings(spark, sf_dir)
    return g.peer_names(g.candidate_priorities(g.gaps(ratings, _targets(spark, sf_dir))), ratings)


@query(
    f"""{_USERS}, {_PRIORITY_SQL}, holders AS (SELECT skill, candidate, rating FROM ratings WHERE rating IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY skill ORDER BY rating DESC) = 1)
    SELECT skill, 'gap' AS part, candidate, gap AS level FROM priorities
    UNION ALL SELECT skill, 'strongest', candidate, rating FROM holders WHERE skill IN (SELECT skill FROM priorities)"""
)
def peer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _user_ratings(spark, sf_dir)
    return g.peer_rows(g.candidate_priorities(g.gaps(ratings, _targets(spark, sf_dir))), ratings)


@query(
    f"""{_USERS} SELECT skill, candidate, rating FROM ratings WHERE rating IS NOT NULL
    QUALIFY rank() OVER (PARTITION BY skill ORDER BY rating DESC) = 1"""
)
def strongest_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = _user_ratings(spark, sf_dir)
    return largest_with_ties(ratings, ["skill"], "rating").select("skill", "candidate", "rating")


_WIDE_SQL = ", ".join(f"max(rating) FILTER (candidate = '{p}') AS {p}" for p in TEAM)


@query(
    f"""{_TEAMS} SELECT skill, {half_up('avg(rating)', 4)} AS mean_rating, {_WIDE_SQL} FROM ratings GROUP BY skill"""
)
def rating_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.rating_matrix(_team_ratings(spark, sf_dir), TEAM)


@query(f"{_TEAMS} SELECT skill, candidate, rating FROM ratings")
def ratings_reshaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long to wide and back."""
    wide = g.ratings_wide(_team_ratings(spark, sf_dir), ["skill"], TEAM)
    return g.ratings_long(wide, ["skill"], TEAM)
