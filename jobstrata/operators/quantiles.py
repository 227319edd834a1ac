"""Exact quantiles that never hold a group in one task, and approximate ones.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here a value
has a key, a 64-bit integer in the order of the doubles, and a quantile is found by radix
selection on the keys: the values are counted by their key's leading 22 bits, a running total
tells which of these buckets holds the wanted rank, its values are counted by the next 21 bits,
and after the last 21 the key is known and is turned back into the value. No step orders values
and none has more than 2**22 buckets of a group in a task, however the values lie.

There are two ways to count. Counting equal values first reads the rows once and suits values
that repeat (pay in whole dollars, years); counts combine on the map side and spread by value,
so a hot group or a hot value stays cheap. Where the groups are few, the rows are read once
for each step, and only bucket counts are shuffled.

NaN stands after all other values, as in Spark's own order; -0.0 is 0.0.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobstrata.operators.joins import same_keys

#: bits of the key that are left out at each step
SHIFTS = (42, 21, 0)
_FRACTION = 1 << 52
_INFINITY = 2047 << 52
_LEAST_NORMAL, _GREATEST = 2.0**-1022, float.fromhex("0x1.fffffffffffffp+1023")


def order_key(x: Column) -> Column:
    """A bigint in the order of the doubles: exponent and fraction, negated below zero."""
    size = F.least(F.abs(F.nanvl(x, F.lit(0.0))), F.lit(_GREATEST))
    guess = F.floor(F.log2(F.greatest(size, F.lit(_LEAST_NORMAL))))
    ratio = size / F.pow(F.lit(2.0), guess)
    # the logarithm can be off by one next to a power of two
    off = F.when(ratio >= 2, 1).when((ratio < 1) & (size >= _LEAST_NORMAL), -1).otherwise(0)
    exponent = F.least(guess + off, F.lit(1023))
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(_FRACTION))).cast("bigint")
    finite = (exponent + 1023) * F.lit(_FRACTION) + fraction
    key = F.when(F.abs(x) <= _GREATEST, finite).otherwise(F.lit(_INFINITY))
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(F.isnan(x), F.lit(_INFINITY + 1)).otherwise(sign * key)


def value_of(key: Column) -> Column:
    """The double with this key."""
    size = F.abs(key)
    exponent = F.shiftright(size, 52)
    fraction = size.bitwiseAND(F.lit(_FRACTION - 1)).cast("double")
    normal = (1 + fraction / F.lit(float(_FRACTION))) * F.pow(F.lit(2.0), exponent - 1023)
    value = (
        F.when(size >= _INFINITY, F.lit(float("inf")))
        .when(exponent == 0, fraction * F.lit(2.0**-1074))
        .otherwise(normal)
    )
    return F.when(key > _INFINITY, F.lit(float("nan"))).when(key < 0, -value).otherwise(value)


def keyed(x: Column) -> Column:
    """An array to ``inline``: the value as double and its key, which is so worked out once,
    not again wherever a plan uses it."""
    x = x.cast("double")
    return F.array(F.struct(x.alias("x"), order_key(x).alias("key")))


def _long(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """``by, measure, x, key``: one row per stated value."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), col.cast("double").alias("x"))
            for name, col in values.items()
        ]
    )
    stated = df.select(*by, F.inline(cells)).filter(F.col("x").isNotNull())
    return stated.select(*by, "measure", F.inline(keyed(F.col("x"))))


def value_counts(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """``by, measure, x, key, c``: how often each stated value occurs."""
    return _long(df, by, values).groupBy(*by, "measure", "x", "key").agg(F.count("*").alias("c"))


def _ranks(probs: Sequence[float]) -> Column:
    """For ``n`` values, the one or two ranks each probability falls on and their weights."""

    def ranks(p: float) -> Column:
        at = p * (F.col("n") - 1)
        low, rest = F.floor(at), at - F.floor(at)
        prob = F.lit(p).alias("prob")
        return F.array(
            F.struct(prob, low.alias("rank"), (1 - rest).alias("weight")),
            F.struct(prob, (low + 1).alias("rank"), rest.alias("weight")),
        )

    return F.filter(F.flatten(F.array(*[ranks(p) for p in probs])), lambda r: r["weight"] > 0)


#: how often each bucket occurs, by the bits to leave out and the buckets found a step before:
#: ``keys, bucket, c`` at first, then also ``above, n, base, ranks`` of those found
Counts = Callable[[int, "DataFrame | None", int], DataFrame]


def select_ranks(counts: Counts, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``keys, prob, quantile, n`` by radix selection, interpolated between ranks.

    A step has at most two buckets per group and probability to go on with.
    """
    found = None
    for step, shift in enumerate(SHIFTS):
        held = counts(shift, found, SHIFTS[step - 1])
        group = [*keys] if found is None else [*keys, "above"]
        upto = F.sum("c").over(Window.partitionBy(*group).orderBy("bucket"))
        if found is None:
            held = held.withColumns({"n": F.sum("c").over(Window.partitionBy(*keys)), "base": F.lit(0)})
            held = held.withColumn("ranks", _ranks(probs))
        held = held.withColumn("base", F.col("base") + upto - F.col("c"))
        here = F.filter(
            "ranks", lambda r: (r["rank"] >= F.col("base")) & (r["rank"] < F.col("base") + F.col("c"))
        )
        found = (
            held.select(*keys, F.col("bucket").alias("above"), "n", "base", here.alias("ranks"))
            .filter(F.size("ranks") > 0)
        )
    hits = found.select(*keys, "n", value_of(F.col("above")).alias("x"), F.explode("ranks").alias("hit"))
    ends = hits.groupBy(*keys, F.col("hit.prob").alias("prob")).agg(
        F.min_by("x", "hit.rank").alias("low"),
        F.max_by("x", "hit.rank").alias("high"),
        F.sum(F.col("hit.weight") * F.col("x")).alias("between"),
        F.max("n").alias("n"),
    )
    same = F.col("low") == F.col("high")  # also of infinities, whose weighted sum has no value
    return ends.select(
        *keys, "prob", F.when(same, F.col("low")).otherwise(F.col("between")).alias("quantile"), "n"
    )


#: what is known of a bucket found; it goes along in the grouping, so a step reads the last once
KNOWN = ("above", "n", "base", "ranks")


def narrowed(rows: DataFrame, found: DataFrame, keys: Sequence[str], taken: int, small: bool) -> DataFrame:
    """``rows`` that lie in the buckets found, whose keys leave out ``taken`` bits, with what is
    known of these."""
    placed = rows.withColumn("above", F.shiftright("key", taken))
    return same_keys(placed, F.broadcast(found) if small else found, [*keys, "above"])


def bucket_counts(rows: DataFrame, keys: Sequence[str], c: Column, small: bool = False) -> Counts:
    """The counts of a ``keys, key`` table, each row standing for ``c`` values."""

    def counts(shift: int, found: DataFrame | None, taken: int) -> DataFrame:
        bucket = F.shiftright("key", shift).alias("bucket")
        inside = rows if found is None else narrowed(rows, found, keys, taken, small)
        group = [*keys] if found is None else [*keys, *KNOWN]
        return inside.groupBy(*group, bucket).agg(F.sum(c).alias("c"))

    return counts


def quantiles_of_counts(
    counted: DataFrame, keys: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """``keys, prob, quantile, n`` from a ``keys, key, c`` table."""
    return select_ranks(bucket_counts(counted, keys, F.col("c")), keys, probs)


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    values: Mapping[str, Column],
    probs: Sequence[float],
    few_groups: bool = False,
) -> DataFrame:
    """``by, measure, prob, quantile, n`` over the stated values of each measure.

    ``few_groups`` promises that ``by`` has a closed domain of labels, so that the buckets
    found (two per group, measure and probability at most) can be broadcast. Without any
    ``by`` that holds by itself.
    """
    keys = [*by, "measure"]
    if few_groups or not by:
        rows = _long(df, by, values)
        return select_ranks(bucket_counts(rows, keys, F.lit(1), small=True), keys, probs)
    return quantiles_of_counts(value_counts(df, by, values), keys, probs)


def medians(
    df: DataFrame, by: Sequence[str], values: Mapping[str, Column], few_groups: bool = False
) -> DataFrame:
    """One row per group that states any value: a median column per measure."""
    long = quantiles(df, by, values, [0.5], few_groups)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("measure") == n, F.col("quantile"))).alias(n) for n in values]
    )


def median_value(df: DataFrame, value: Column) -> Column:
    """The median of all rows as a scalar usable in any expression over them."""
    return medians(df, [], {"median": value}).scalar()


def approximate_quantiles(
    df: DataFrame,
    by: Sequence[str],
    values: Mapping[str, Column],
    probs: Sequence[float],
    size: int = 200,
) -> DataFrame:
    """``by, measure, prob, quantile, n`` from one mergeable KLL sketch per group and measure.

    One read and one sketch a task and group in the shuffle. ``size`` sets the error: the
    rank of the value given is off by about 2.3 / ``size`` ** 0.9 of the values, 1.65 % for
    200 (99 % of the time). A value is one that occurs, never between two. NaN is left out,
    as are unstated values; ``n`` counts the rest.
    """
    rows = _long(df, by, values).filter(~F.isnan("x"))
    sketched = rows.groupBy(*by, "measure").agg(
        F.kll_sketch_agg_double("x", size).alias("sketch"), F.count("*").alias("n")
    )
    asked = F.array(*[F.lit(float(p)) for p in probs])
    found = F.arrays_zip(
        asked.alias("prob"), F.kll_sketch_get_quantile_double("sketch", asked).alias("quantile")
    )
    return sketched.select(*by, "measure", "n", F.inline(found)).select(
        *by, "measure", "prob", "quantile", "n"
    )
