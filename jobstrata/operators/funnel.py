"""Filter funnels counted in one pass over the rows.

The recency window depends on the latest date among matched rows, which would
cost a pass of its own. Counting per posting date first makes that table (at
most one row per calendar day) answer both questions, so the raw rows are read
once however many steps and coverage measures are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.functions.cells import any_of, share
from jobstrata.operators.joins import keep_together


def code_is(col: Column, code: str) -> Column:
    return col.cast("string") == code


def title_has(col: Column, patterns: Sequence[str]) -> Column:
    return col.rlike(any_of(patterns))


def title_lacks(col: Column, patterns: Sequence[str]) -> Column:
    return ~col.rlike(any_of(patterns))


def recent(df: DataFrame, date: str, days: int, latest: DataFrame | None = None) -> DataFrame:
    """Rows dated within ``days`` of the latest date, both ends included; undated rows go."""
    newest = df.agg(F.max(date)) if latest is None else latest
    return df.filter(F.col(date) >= F.date_sub(newest.scalar(), days))


@dataclass(frozen=True)
class Funnel:
    """Ordered filter steps, an optional recency window and extra row counts.

    ``compared`` are predicates counted beside the steps (a rejected filter),
    ``in_panel`` are predicates counted only on rows that pass everything.
    """

    steps: Sequence[tuple[str, Column]]
    date: Column | None = None
    days: int = 0
    compared: Mapping[str, Column] = field(default_factory=dict)
    in_panel: Mapping[str, Column] = field(default_factory=dict)

    def _matched(self) -> Column:
        return reduce(and_, [p for _, p in self.steps])

    def _depth(self) -> Column:
        """How many steps a row passes before the first it fails."""
        depth = F.lit(len(self.steps))
        for i, (_, predicate) in reversed(list(enumerate(self.steps))):
            depth = F.when(predicate, depth).otherwise(F.lit(i))
        return depth

    def counts(self, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row: raw, every cumulative step, undated/before/in window, extra counts.

        With ``by`` a row for each of those labels, each with a window of its own, from the
        same single pass.
        """
        # Each pattern and date is evaluated once per row, dates on matched rows only.
        rows = df.withColumn("_depth", self._depth())
        inside = F.col("_depth") == len(self.steps)
        measures = [
            F.count("*").alias("raw"),
            *[F.count_if(F.col("_depth") > i).alias(n) for i, (n, _) in enumerate(self.steps)],
            *[F.count_if(p).alias(n) for n, p in self.compared.items()],
            *[F.count_if(inside & p).alias(n) for n, p in self.in_panel.items()],
        ]
        if self.date is None:
            return rows.groupBy(*by).agg(*measures)

        day = F.when(inside, self.date).alias("day")
        names = ["raw", *[n for n, _ in self.steps], *self.compared, *self.in_panel]
        daily = keep_together(rows.groupBy(*by, day).agg(*measures), *names)
        last = self.steps[-1][0]
        # a label has a row for each calendar day at most
        latest = F.max("day").over(Window.partitionBy(*by)) if by else daily.agg(F.max("day")).scalar()
        dated = daily.withColumn("latest", latest)
        within = F.col("day") >= F.date_sub("latest", self.days)
        totals = ["raw", *[n for n, _ in self.steps], *self.compared]
        return dated.groupBy(*by).agg(
            *[F.sum(n).alias(n) for n in totals],
            F.sum(F.when(F.col("day").isNull(), F.col(last)).otherwise(0)).alias("undated"),
            F.sum(F.when(within, F.col(last)).otherwise(0)).alias("in_window"),
            F.max("latest").alias("window_end"),
            *[F.sum(F.when(within, F.col(n)).otherwise(0)).alias(n) for n in self.in_panel],
        ).withColumns(
            {
                "window_start": F.date_sub("window_end", self.days),
                "before_window": F.col(last) - F.col("undated") - F.col("in_window"),
            }
        )

    def table(self, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """``step_no, step, postings, share`` with the share in percent of the raw rows, after
        the ``by`` columns."""
        names = ["raw", *[n for n, _ in self.steps]]
        if self.date is not None:
            names.append("in_window")
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).alias("step_no"),
                    F.lit(n).alias("step"),
                    F.col(n).alias("postings"),
                    share(F.col(n), F.col("raw"), 2).alias("share"),
                )
                for i, n in enumerate(names)
            ]
        )
        return self.counts(df, by).select(*by, F.inline(rows))

    def survivors(
        self, df: DataFrame, date: str = "posted_date", latest: DataFrame | None = None
    ) -> DataFrame:
        """The rows that pass every step and the window."""
        kept = df.filter(self._matched())
        if self.date is None:
            return kept
        return recent(kept.withColumn(date, self.date), date, self.days, latest)


def compare_funnels(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two funnel tables side by side, step by step."""
    left = first.select("step", F.col("postings").alias("first"), F.col("share").alias("first_share"))
    right = second.select(
        "step", F.col("postings").alias("second"), F.col("share").alias("second_share")
    )
    return left.join(right, "step", "full_outer")


def compare_extracts(
    funnel: Funnel, df: DataFrame, extract: Column, first: str, second: str
) -> DataFrame:
    """The same table for two extracts that lie in one table, told apart by ``extract``, from
    one pass. An extract without rows has nulls; without either there are no rows."""
    marked = df.withColumn("_extract", extract).filter(F.col("_extract").isin(first, second))
    steps = funnel.table(marked, by=["_extract"])

    def of(label: str, value: str) -> Column:
        return F.max(F.when(F.col("_extract") == label, F.col(value)))

    return steps.groupBy("step").agg(
        of(first, "postings").alias("first"),
        of(first, "share").alias("first_share"),
        of(second, "postings").alias("second"),
        of(second, "share").alias("second_share"),
    )
