"""Run a stream over what is there now and read its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.session import new_path


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the parquet files in a folder; new files become new batches."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(stream: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all available files into a parquet table in append mode and read it.

    The checkpoint lies in the shared folder: a restarted job goes on where it
    stopped and writes no row twice.
    """
    return run_counting_late(stream, name, out, checkpoint)[0]


def run_counting_late(
    stream: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None
) -> tuple[DataFrame, int]:
    """Like :func:`run_available`, with the number of rows that came behind the watermark and were dropped.

    Rows that a task merges before the shuffle count as one. The number is read from the progress of the
    last batches, as many as ``spark.sql.streaming.numRecentProgressUpdates`` keeps.
    """
    spark = stream.sparkSession
    out = out or new_path(spark, name)
    checkpoint = checkpoint or new_path(spark, f"{name}-progress")
    started = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    late = sum(o["numRowsDroppedByWatermark"] for batch in started.recentProgress for o in batch["stateOperators"])
    return spark.read.schema(stream.schema).parquet(out), late


def run_batches(
    stream: DataFrame, name: str, write: Callable[[DataFrame, int], None], checkpoint: str | None = None
) -> None:
    """Process all available files, handing every micro-batch to ``write``."""
    started = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or new_path(stream.sparkSession, f"{name}-progress"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
