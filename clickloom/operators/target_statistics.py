"""Categories as ordered target statistics: what a category's target was on earlier rows.

Training rows stand in the order of a seeded digest of their keys. A row's category gets the mean target of
the rows before it that hold the same value, drawn to the overall mean with the weight of ``strength`` rows; its own target
and those behind it stay out, so nothing leaks. Other rows get the statistics of all training rows. Missing and unseen values
get the overall mean: they take no slot of their own.

Scale: one narrow row per training row and column. The order is cut into slices of about ``SLICE_ROWS`` rows; running
sums go over a value's rows in one slice, and totals per slice give each slice its start. So a category with most
of the rows is spread over as many tasks as there are slices. Domains of any size stay tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.session import stage

SLICE_ROWS = 50_000
#: weight of the overall mean, in rows
STRENGTH = 1.0
TABLE_SCHEMA = "column_name string, value string, n long, total double"


def _overall(train: DataFrame, label: str) -> float:
    return train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0


def _drawn(total: Column, n: Column, overall: float, strength: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + overall * strength) / (F.coalesce(n, F.lit(0)) + strength)


def _pairs(columns: Sequence[str]) -> Column:
    return F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))


def ordered_targets(
    train: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str], seed: int = C.SEED, strength: float = STRENGTH, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The training rows with ``<column>_target`` from the rows before each. ``keys`` tell rows apart."""
    rows = stage(train.withColumn("_row", F.monotonically_increasing_id()), "training-rows")
    overall, slices = _overall(rows, label), max(1, rows.count() // slice_rows)
    place = X.hash_share(*keys, seed=seed)
    narrow = rows.select("_row", *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), F.col(label).cast("double").alias("_y"), place.alias("_place"), F.explode(_pairs(columns)).alias("p"))
    narrow = narrow.select("*", "p.*", F.floor(F.col("_place") * slices).alias("_slice")).drop("p").where("value IS NOT NULL")
    value = ["column_name", "value"]
    sums = narrow.groupBy(*value, "_slice").agg(F.count("_y").alias("_n"), F.sum("_y").alias("_total"))
    before = W.partitionBy(*value).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)  # one row per slice
    starts = sums.select(*value, "_slice", F.sum("_n").over(before).alias("_n0"), F.sum("_total").over(before).alias("_total0"))
    # rows of equal keys stand in the order of the table
    order = W.partitionBy(*value, "_slice").orderBy("_place", *(f"_key{i}" for i in range(len(keys))), "_row").rowsBetween(W.unboundedPreceding, -1)
    counted = narrow.withColumns({"_n": F.count("_y").over(order), "_total": F.sum("_y").over(order)}).join(starts, [*value, "_slice"])
    n = F.col("_n") + F.coalesce("_n0", F.lit(0))
    total = F.coalesce("_total", F.lit(0.0)) + F.coalesce("_total0", F.lit(0.0))
    found = counted.select("_row", "column_name", _drawn(total, n, overall, strength).alias("s"))
    wide = found.groupBy("_row").agg(*(F.max(F.when(F.col("column_name") == c, F.col("s"))).alias(f"{c}_target") for c in columns))
    joined = rows.join(wide, "_row", "left")
    return joined.select(*train.columns, *(F.coalesce(f"`{c}_target`", F.lit(overall)).alias(f"{c}_target") for c in columns))


class _StatisticsWriter(DefaultParamsWriter):
    """Saves the parameters and, next to them, the statistics."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/statistics")


class _StatisticsReader(DefaultParamsReader):
    """Loads what ``_StatisticsWriter`` saved, from the model folder alone."""

    def load(self, path: str) -> TargetStatistics:
        model = super().load(path)
        model.table = self.sparkSession.read.schema(TABLE_SCHEMA).parquet(f"{path}/statistics")
        return model


class TargetStatistics(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<column>_target`` from the statistics of all training rows; one join per column."""

    inputs = Param(Params._dummy(), "inputs", "columns that are encoded", TypeConverters.toListString)
    overall = Param(Params._dummy(), "overall", "mean target of the training rows", TypeConverters.toFloat)
    strength = Param(Params._dummy(), "strength", "weight of the overall mean in rows", TypeConverters.toFloat)
    table: DataFrame | None = None

    def write(self) -> _StatisticsWriter:
        return _StatisticsWriter(self)

    @classmethod
    def read(cls) -> _StatisticsReader:
        return _StatisticsReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        overall, strength = self.getOrDefault(self.overall), self.getOrDefault(self.strength)
        for c in self.getOrDefault(self.inputs):
            known = self.table.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("n").alias("_n"), F.col("total").alias("_total"))
            joined = df.join(known, F.col(f"`{c}`").cast("string") == F.col("_value"), "left")
            df = joined.withColumn(f"{c}_target", _drawn(F.col("_total"), F.col("_n"), overall, strength)).drop("_value", "_n", "_total")
        return df


def fit_target_statistics(train: DataFrame, columns: Sequence[str], label: str, strength: float = STRENGTH) -> TargetStatistics:
    """Count and total of the target per column and value of the training rows, as a model."""
    narrow = train.select(F.col(label).cast("double").alias("_y"), F.explode(_pairs(columns)).alias("p")).select("p.*", "_y").where("value IS NOT NULL")
    model = TargetStatistics()
    model._set(inputs=list(columns), overall=_overall(train, label), strength=strength)
    model.table = stage(narrow.groupBy("column_name", "value").agg(F.count("_y").alias("n"), F.sum("_y").alias("total")), "target-statistics")
    return model
