"""Exact quantiles of any amount of data, and value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import stage

# A group with at most this many distinct values fits the built-in aggregate,
# which keeps one counter per distinct value in memory.
IN_MEMORY_VALUES = 100_000
# Accuracy of the approximate quantiles that bracket an exact one: at most this,
# less where a group holds fewer values.
ACCURACY = 100_000

_KEY = "_all"


def most_distinct(rows: DataFrame, keys: Sequence[str], value: str) -> int:
    """About how many distinct values the largest group holds."""
    per_group = rows.groupBy(*keys).agg(F.approx_count_distinct(value).alias("d"))
    return per_group.agg(F.max("d")).first()[0] or 0


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Sequence[float],
    in_memory_values: int = IN_MEMORY_VALUES,
    distinct: int | None = None,
) -> DataFrame:
    """``keys``, ``n`` and an array ``quantiles``: linear interpolation, unknown values left out.

    Few distinct values: the built-in ``percentile``. Many: approximate
    quantiles bracket each wanted one, the rows below the bracket are only
    counted, and only the narrow bracket is sorted. ``distinct`` is an upper
    bound of the distinct values per group where the caller knows one.
    """
    known = rows.select(*keys, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    if distinct is None:
        distinct = most_distinct(known, keys, "v")
    if distinct <= in_memory_values:
        wanted = F.array(*[F.lit(float(s)) for s in shares])
        return known.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile("v", wanted).alias("quantiles")
        )
    return bracketed_quantiles(known, keys, shares, min(ACCURACY, max(1000, distinct // 100)))


def bracketed_quantiles(
    known: DataFrame, keys: Sequence[str], shares: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Exact quantiles of column ``v``; no task sorts more than a narrow bracket of a group.

    The approximate quantiles are off by at most ``1 / accuracy`` of the rows.
    With ends twice that far out the bracket holds the wanted rows, given that
    the margin is worth several rows; smaller groups are ranked as a whole.
    """
    margin = 2.0 / accuracy
    small = F.col("n") <= 10 * accuracy
    ends = [max(0.0, s - margin) for s in shares] + [min(1.0, s + margin) for s in shares]
    keyed = known if keys else known.withColumn(_KEY, F.lit(0))
    group = list(keys) or [_KEY]
    ranges = keyed.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("v", F.array(*[F.lit(e) for e in ends]), accuracy).alias("ends"),
    )
    brackets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.when(small, float("-inf")).otherwise(F.col("ends")[i]).alias("low"),
                F.when(small, float("inf")).otherwise(F.col("ends")[i + len(shares)]).alias("high"),
                F.lit(float(s)).alias("share"),
            )
            for i, s in enumerate(shares)
        ]
    )
    ranges = ranges.select(*group, "n", brackets.alias("brackets"))
    # written once: small ones are broadcast, and beyond that adaptive execution
    # can split a huge group, which it only does for sides that come from a scan
    ranges = stage(ranges, "ranges") if keys else F.broadcast(ranges)  # without keys a single row
    cells = (
        keyed.join(ranges, group)
        .select(*group, "v", "n", F.inline("brackets"))
        .filter("v <= high")
        .withColumn("cell", F.when(F.col("v") >= F.col("low"), F.col("v")))
        .groupBy(*group, "n", "i", "share", "cell")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upward = W.partitionBy(*group, "i").orderBy(F.asc_nulls_first("cell"))
    position = F.col("share") * (F.col("n") - 1)
    ranked = cells.withColumns({"seen": F.sum("c").over(upward), "position": position})

    def at(rank):
        return F.min(F.when(F.col("seen") > rank, F.col("cell")))

    found = ranked.groupBy(*group, "n", "i", "position").agg(
        at(F.floor("position")).alias("below"), at(F.ceil("position")).alias("above")
    )
    part = F.col("position") - F.floor("position")
    exact = F.col("below") + (F.col("above") - F.col("below")) * part
    ordered = F.array_sort(F.collect_list(F.struct("i", exact.alias("q"))))
    return found.groupBy(*group, "n").agg(F.transform(ordered, lambda s: s["q"]).alias("quantiles")).select(
        *keys, "n", "quantiles"
    )


def column_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns at once: ``column_name, n, quantiles``."""
    lines = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return exact_quantiles(df.select(F.inline(lines)), ["column_name"], "value", shares)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value, n`` for every value, unknown included, in one scan."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def top_values(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most frequent known values per column with their rank; ties go to the smaller value.

    Each task keeps ``limit`` rows per column before the shuffle.
    """
    order = W.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    known = counts.filter("value IS NOT NULL")
    return known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
