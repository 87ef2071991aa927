"""Data profiles: nulls, value counts, conversion, associations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import columns as X
from clickloom.functions.quantiles import column_quantiles, exact_quantiles, top_values, value_counts
from clickloom.session import stage


def _missing(df: DataFrame, column: str) -> Column:
    null = F.col(column).isNull()
    return (null | F.isnan(column)) if dict(df.dtypes)[column] in ("double", "float") else null


def null_profile(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Columns with unknown values and their share, worst first."""
    one = df.agg(*[F.avg(_missing(df, c).cast("int")).alias(c) for c in df.columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_share")) for c in df.columns])
    shares = one.select(F.inline(lines)).filter("null_share > 0")
    return shares.orderBy(F.desc("null_share"), "column_name").limit(limit or len(df.columns))


def top_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of the most frequent value per column; unknown counts as a value."""
    sizes = value_counts(df, columns).groupBy("column_name").agg(F.max("n").alias("top"), F.sum("n").alias("rows"))
    return sizes.select("column_name", (F.col("top") / F.col("rows")).alias("top_share"))


def top_categories(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    return top_values(value_counts(df, columns), limit)


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per class. The classes are few, so the total is a window over them."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def session_class_balance(hits: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Class balance of sessions, where one target hit makes the session positive."""
    per_session = hits.groupBy("session_id").agg(F.max(X.is_target(F.col("event_action"), targets)).alias("event_value"))
    return class_balance(per_session, "event_value")


def conversion_by(df: DataFrame, dimensions: Sequence[str], target: str) -> DataFrame:
    """Rows and conversion rate per value of every dimension, all in one scan and one shuffle."""
    lines = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]
    )
    rows = df.select(target, F.inline(lines))
    return rows.groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum(target).alias("n_converted"), F.avg(target).alias("conversion_rate")
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def frequent_visitors(df: DataFrame, client: str, number: str, share: float = 0.99) -> DataFrame:
    """Clients whose highest visit number lies above the given quantile of all rows' numbers."""
    cut = exact_quantiles(df, [], number, [share]).first()["quantiles"][0]
    return df.groupBy(client).agg(F.max(number).alias(number), F.count(F.lit(1)).alias("n")).filter(F.col(number) > cut)


def column_profile(df: DataFrame, target: str) -> DataFrame:
    """Per column: kind, rows, unknown values, distinct values, most frequent value, moments, ends.

    One pass for the numbers and one grouping for value counts; counts of
    distinct values come from that grouping and are exact.
    """
    studied = [c for c in df.columns if c != target]
    numbers = [c for c in X.numeric_columns(df) if c in studied]
    counts = stage(value_counts(df, studied), "value-counts")
    per_column = counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    )
    top = top_values(counts, 1).select("column_name", F.col("value").alias("top_value"), F.col("n").alias("top_n"))
    kind = F.when(F.col("column_name").isin(numbers), "number").otherwise("text").alias("kind")
    profile = per_column.join(top, "column_name", "left").select("*", kind)
    if not numbers:
        return profile
    aggregates = []
    for c in numbers:
        v = F.col(c).cast("double")
        aggregates += [f(v).alias(f"{n}:{c}") for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), *[F.col(f"`{n}:{c}`").alias(f"{n}_value") for n in ("mean", "std", "min", "max")]
            )
            for c in numbers
        ]
    )
    moments = df.agg(*aggregates).select(F.inline(lines))
    return profile.join(moments, "column_name", "left")


def target_rate_by_value(df: DataFrame, columns: Sequence[str], target: str, limit: int) -> DataFrame:
    """Target mean of the most frequent values of each column."""
    rates = conversion_by(df, columns, target).withColumnsRenamed({"dimension": "column_name"})
    order = W.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    known = rates.filter("value IS NOT NULL")
    return known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)


# --- associations ---------------------------------------------------------------


def binned(df: DataFrame, numbers: Sequence[str], bins: int = 10) -> DataFrame:
    """Numbers replaced by the index of their bin, cut at exact quantiles."""
    shares = [i / bins for i in range(1, bins)]
    cuts = {r["column_name"]: r["quantiles"] for r in column_quantiles(df, numbers, shares).collect()}
    for c in numbers:
        ends = sorted(set(cuts.get(c, [])))
        made = Bucketizer(
            splits=[float("-inf"), *ends, float("inf")], inputCol="_number", outputCol="_bin", handleInvalid="keep"
        )
        cut = made.transform(df.withColumn("_number", F.col(c).cast("double")))
        df = cut.withColumn(c, F.col("_bin").cast("int").cast("string")).drop("_number", "_bin")
    return df


def _value_classes(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``feature, value, ones, zeros``: class counts per value of every feature."""
    lines = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value")) for c in features]
    )
    return df.select(target, F.inline(lines)).groupBy("feature", "value").agg(
        F.sum(F.when(F.col(target) == 1, 1).otherwise(0)).alias("ones"),
        F.sum(F.when(F.col(target) == 1, 0).otherwise(1)).alias("zeros"),
    )


def mutual_information(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Mutual information (in nats) of every feature with a two-class target, and its place in the ranking.

    With x log x summed over cells, values, classes and the whole, only sums
    per feature remain: one grouping by value and one by feature, no joins.
    """
    cells = _value_classes(df, features, target)
    size = F.col("ones") + F.col("zeros")
    sums = cells.groupBy("feature").agg(
        F.sum(X.xlogx(F.col("ones")) + X.xlogx(F.col("zeros"))).alias("cell"),
        F.sum(X.xlogx(size)).alias("value"),
        F.sum("ones").alias("n1"),
        F.sum("zeros").alias("n0"),
    )
    total = F.col("n1") + F.col("n0")
    joint = F.col("cell") - F.col("value") - X.xlogx(F.col("n1")) - X.xlogx(F.col("n0")) + X.xlogx(total)
    found = sums.select("feature", F.greatest(joint / total, F.lit(0.0)).alias("mutual_info"))
    best_first = W.orderBy(F.desc(F.round("mutual_info", 9)), "feature")  # one row per feature
    return found.withColumn("place", F.row_number().over(best_first))


def cramers_v(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Cramér's V of every feature with a two-class target, from sums per feature."""
    cells = _value_classes(df, features, target)
    size = F.col("ones") + F.col("zeros")
    sums = cells.groupBy("feature").agg(
        F.sum(F.col("ones") * F.col("ones") / size).alias("q1"),
        F.sum(F.col("zeros") * F.col("zeros") / size).alias("q0"),
        F.sum("ones").alias("n1"),
        F.sum("zeros").alias("n0"),
    )
    both = (F.col("n1") > 0) & (F.col("n0") > 0)
    # chi square over the row count; with two classes that is V squared
    phi = F.col("q1") / F.col("n1") + F.col("q0") / F.col("n0") - 1
    return sums.select("feature", F.when(both, F.sqrt(F.greatest(phi, F.lit(0.0)))).otherwise(0.0).alias("cramers_v"))


def correlation_ratio(df: DataFrame, categories: Sequence[str], number: str) -> DataFrame:
    """Share of a number's spread that lies between the categories of each column (square root)."""
    value = F.col(number).cast("double")
    lines = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value")) for c in categories]
    )
    rows = df.filter(value.isNotNull()).select(value.alias("y"), F.inline(lines))
    groups = rows.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")
    )
    sums = groups.groupBy("feature").agg(
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"),
        F.sum("ss").alias("ss"),
        F.sum("s").alias("s"),
        F.sum("n").alias("n"),
    )
    mean = F.col("s") * F.col("s") / F.col("n")
    spread = F.col("ss") - mean
    eta = F.when(spread > 0, F.sqrt(F.greatest((F.col("between") - mean) / spread, F.lit(0.0)))).otherwise(0.0)
    return sums.select("feature", eta.alias("correlation_ratio"))


def correlations(df: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, all in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(numbers) for b in numbers[i + 1 :]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    lines = F.array(
        *[
            F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"`{a}|{b}`").alias("correlation"))
            for a, b in pairs
        ]
    )
    return one.select(F.inline(lines))
