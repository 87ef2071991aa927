"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import stage

#: name of the column that numbers the rows of a staged table
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_number(df: DataFrame) -> DataFrame:
    """Add a number that is unique per row. Only stable once the table has been written."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts of a column, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def blocks(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows whose lengths add up to about ``most``; a longer row is a run of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Pieces of Arrow batches, so that the Python objects made of one at a time stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to each Arrow batch inside the tasks."""

    def run(batches):
        for batch in small(batches):
            yield work(batch)

    return df.mapInArrow(run, schema)


def positions(df: DataFrame, order: list, groups: list[str], name: str) -> DataFrame:
    """Rows of a written table numbered 0, 1, ... by ``order`` inside each group, next to all columns.

    ``order`` is a list of columns and starts with those of ``groups``, whose values
    are not null. One range exchange sorts the rows and the sorted rows are written
    once; a row's number is its place in its partition and the sum of the counts of
    the partitions before. No window runs over more than one row per partition.
    """
    part = F.shiftright("__place", 33)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn("__place", F.monotonically_increasing_id()), "sorted").withColumn("__part", part)
    counts = placed.groupBy(*groups, "__part").agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = W.partitionBy(*groups).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.col("__place") - F.col("__first") + F.col("__start")
    return placed.join(starts, [*groups, "__part"]).select(*df.columns, number.alias(name))
