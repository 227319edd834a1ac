"""Mixing sources to target weights by Pfair scheduling of source blocks.

A source of weight w gives its k-th block the release time floor(k / w) and the
deadline ceil((k + 1) / w). In every time slot the released block with the earliest
deadline runs. With weights that sum to one, each source is then always less than one
block away from its share. Weights are whole parts of a common total Q, so the
timetable repeats after Q slots: it is worked out once for Q slots, a bound set by the
caller and independent of the data, and every block finds its slot by arithmetic.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARTS = 1000


def whole_parts(weights: Mapping[str, float], parts: int = PARTS) -> dict[str, int]:
    """Weights as whole numbers that sum to ``parts``, by largest remainders; at least one each."""
    positive = {s: w for s, w in weights.items() if w > 0}
    if not positive:
        return {}
    if len(positive) > parts:
        raise ValueError(f"{len(positive)} sources need at least as many parts")
    total = sum(map(Fraction, positive.values()))
    exact = {s: Fraction(w) / total * (parts - len(positive)) for s, w in positive.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    short = parts - sum(out.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:short]:
        out[s] += 1
    return out


def timetable(parts: Mapping[str, int]) -> list[str]:
    """The source of every slot of one period: earliest deadline first among released blocks."""
    total = sum(parts.values())
    waiting = [(0, -(-total // p), s, 0) for s, p in sorted(parts.items())]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for now in range(total):
        while waiting and waiting[0][0] <= now:
            _, deadline, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, k))
        deadline, s, k = heapq.heappop(ready)
        slots.append(s)
        p = parts[s]
        if k + 1 < p:
            heapq.heappush(waiting, ((k + 1) * total // p, -(-(k + 2) * total // p), s, k + 1))
    return slots


def slot_table(spark: SparkSession, parts: Mapping[str, int]) -> DataFrame:
    """(source, nth, slot, parts, period): at most one row for each of the period's slots."""
    seen: dict[str, int] = {}
    rows = []
    for slot, s in enumerate(timetable(parts)):
        rows.append((s, seen.get(s, 0), slot, parts[s], sum(parts.values())))
        seen[s] = seen.get(s, 0) + 1
    return spark.createDataFrame(
        rows, "source string, nth long, slot long, parts long, period long"
    )


def numbered(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (with ``__source``) and each row's ``__place`` in its source, in an order
    mixed by the key's hash.

    A source may hold a third of all rows, so places are not counted in one window per
    source: rows are counted in 65,536 hash buckets, the bucket counts are summed up per
    source, and only a bucket is ordered as one group. Both sides of the join are dealt
    by (source, bucket), so the rows are shuffled once.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    salted = docs.withColumn("__mix", digest).withColumn(
        "__bucket", F.conv(F.substring("__mix", 1, 4), 16, 10).cast("int")
    )
    inside = Window.partitionBy("__source", "__bucket").orderBy("__mix", key)
    lead = Window.partitionBy("__source").orderBy("__bucket")
    leads = (
        salted.groupBy("__source", "__bucket")
        .count()
        .withColumn("__lead", F.sum("count").over(lead) - F.col("count"))
        .drop("count")
    )
    return (
        salted.withColumn("__n", F.row_number().over(inside))
        .join(leads, ["__source", "__bucket"])
        .withColumn("__place", F.col("__lead") + F.col("__n") - 1)
    )


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float],
    block: int = 16,
    key: str = "doc_id",
    source: str = "source",
    parts: int = PARTS,
) -> DataFrame:
    """``docs`` with ``mix_block`` (the block's number in its source), ``mix_slot`` (its
    time slot) and ``mix_place`` (the row's place inside its block); no row is dropped.

    Sorting by (mix_slot, mix_place) gives the mixed stream. While every weighted source
    still has blocks, each is less than one block away from its share of the slots; a
    source that has run out leaves its later slots empty. Null counts as the empty source
    name. Rows of a source without a positive weight get a null slot and sort last.

    Null keys share one hash and are told apart by their place only. Repeated rows count
    as rows. An empty table gives no rows; columns of other names are passed through.
    """
    spark = docs.sparkSession
    table = slot_table(spark, whole_parts(weights, parts)).select(
        F.col("source").alias("__source"),
        F.col("nth").alias("__turn"),
        F.col("slot").alias("__slot"),
        F.col("parts").alias("__parts"),
        F.col("period").alias("__period"),
    )
    # both tables have at most ``parts`` rows by construction
    shares = F.broadcast(table.select("__source", "__parts", "__period").distinct())
    slots = F.broadcast(table.select("__source", "__turn", "__slot"))
    rows = docs.withColumn("__source", F.coalesce(F.col(source), F.lit("")))
    return (
        numbered(rows, key)
        .withColumn("mix_block", F.floor(F.col("__place") / block))
        .withColumn("mix_place", F.col("__place") % block)
        .join(shares, "__source", "left")
        .withColumn("__turn", F.col("mix_block") % F.col("__parts"))
        .join(slots, ["__source", "__turn"], "left")
        .withColumn(
            "mix_slot",
            F.floor(F.col("mix_block") / F.col("__parts")) * F.col("__period") + F.col("__slot"),
        )
        .select(*docs.columns, "mix_block", "mix_slot", "mix_place")
    )


def tempered_weights(
    docs: DataFrame, power: float = 0.5, source: str = "source", most: int = PARTS
) -> dict[str, float]:
    """Row counts raised to ``power``: a usual flattening of source sizes.

    Reads one count per source; more sources than ``most`` is an error, not a cut.
    """
    counts = docs.where(F.col(source).isNotNull()).groupBy(source).count()
    rows = counts.orderBy(source).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} sources: pass weights for the ones to mix")
    return {r[source]: float(r["count"]) ** power for r in rows}
