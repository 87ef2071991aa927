"""Category encoders: tables for wide domains, Spark ML indexers for collapsed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import columns as X
from clickloom.functions.quantiles import top_values, value_counts
from clickloom.session import stage

# Slices of the sorted values that are ranked side by side, as a multiple of the shuffle partitions.
SLICES_PER_PARTITION = 4


def collapse_rare_categories(df: DataFrame, columns: Sequence[str], top_n: int = 10) -> DataFrame:
    """Keep the ``top_n`` values of each column; the rest, unknown included, becomes ``other``."""
    kept: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        for row in top_values(value_counts(df, columns), top_n).collect():
            kept[row["column_name"]].append(row["value"])
    return df.withColumns({c: X.collapsed(F.col(c).cast("string"), kept[c], "other") for c in columns})


def indexers(columns: Sequence[str]) -> StringIndexer:
    """Indexes in alphabetical order with a frozen domain; unseen values get the index after the last.

    The domain is held by the driver: for collapsed columns only.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def ranged_domain(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, slice): the distinct values of each column, cut into ranges of about equal size, in a written table."""
    ranges = SLICES_PER_PARTITION * int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), _textual(c).alias("value")) for c in columns])
    values = train.select(F.inline(lines)).distinct()
    return stage(values.repartitionByRange(ranges, "column_name", "value").withColumn("slice", F.spark_partition_id()), "domain")


def ordinal_domain(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, place): the distinct values of each column in alphabetical order from 0, in a written table.

    Values are ranked within their range, whatever bytes they share, and range
    starts are sums over one row per range, so a column may have as many values
    as the frame has rows.
    """
    values = ranged_domain(train, columns)
    counts = values.groupBy("column_name", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("column_name").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("column_name", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("column_name", "slice").orderBy("value")) - 1
    placed = values.withColumn("inside", inside).join(starts, ["column_name", "slice"])
    return stage(placed.select("column_name", "value", (F.col("start") + F.col("inside")).alias("place")), "domain")


def _textual(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def ordinal_encode(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their alphabetical position in ``train``; unseen values become -1.

    Unknown values are a category of their own, written ``nan``. The domain is a
    table, joined once per column; Spark broadcasts it where it is small.
    """
    domain = ordinal_domain(train, columns)
    encoded = df
    for c in columns:
        places = domain.filter(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("place").alias("_place"))
        joined = encoded.join(places, _textual(c) == F.col("_value"), "left")
        encoded = joined.withColumn(c, F.coalesce(F.col("_place").cast("double"), F.lit(-1.0))).drop("_value", "_place")
    return encoded


def hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """One slot per category. The index kept for unseen values is the last one, and
    the last one has no slot: an unseen value is all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns], dropLast=True
    )


def one_hot(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Slots in alphabetical order, frozen to the categories of ``train``."""
    return Pipeline(stages=[indexers(columns), hot_encoder(columns)]).fit(train)


def feature_stages(numbers: Sequence[str], categories: Sequence[str], output: str = "features") -> list:
    """Index the categories and gather everything into one vector; unseen categories keep a slot."""
    columns = list(numbers) + [f"{c}_index" for c in categories]
    stages = [indexers(categories)] if categories else []
    return stages + [VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="error")]


def hot_stages(numbers: Sequence[str], categories: Sequence[str], output: str = "features") -> list:
    """Like :func:`feature_stages`, with one slot per category: for linear models and networks."""
    stages = [indexers(categories), hot_encoder(categories)] if categories else []
    columns = list(numbers) + [f"{c}_hot" for c in categories]
    return stages + [VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="error")]

