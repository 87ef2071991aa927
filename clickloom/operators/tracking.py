"""Run, parameter and metric tables, and the scoring monitor."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.constants import CONFIDENCE_BUCKETS


def _append(df: DataFrame, root: str, table: str) -> None:
    df.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{table}")


def log_run(spark: SparkSession, root: str, run_id: str, name: str, **tags: str) -> None:
    """One row per run; versions and change notes are tags."""
    row = spark.createDataFrame([(run_id, name, {k: str(v) for k, v in tags.items()})], "run_id string, name string, tags map<string,string>")
    _append(row.withColumn("started_at", F.current_timestamp()), root, "runs")


def clean_key(key: str) -> str:
    return re.sub("[:=,]", "_", key)


def log_metrics(spark: SparkSession, root: str, run_id: str, values: dict[str, float], step: int = 0) -> None:
    rows = [(run_id, clean_key(k), float(v), step) for k, v in values.items()]
    _append(spark.createDataFrame(rows, "run_id string, key string, value double, step int"), root, "metrics")


def log_params(spark: SparkSession, root: str, run_id: str, values: dict) -> None:
    rows = [(run_id, str(k), str(v)) for k, v in values.items()]
    _append(spark.createDataFrame(rows, "run_id string, key string, value string"), root, "params")


def read_log(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative counts: rows at or below each bound, then all rows."""
    below = [F.count_if(value <= b).alias(f"le_{str(b).replace('.', '_')}") for b in bounds]
    return [*below, F.count(value).alias("le_inf")]


def prediction_monitor(
    scored: DataFrame,
    day: str,
    prediction: str = "prediction",
    confidence: str = "confidence",
    bounds: Sequence[float] = tuple(CONFIDENCE_BUCKETS),
) -> DataFrame:
    """Per day and predicted class: rows, sum of confidences and the confidence histogram."""
    return scored.groupBy(F.col(day).alias("day"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(confidence).alias("confidence_sum"),
        *bucket_counts(F.col(confidence), bounds),
    )


def latency_histogram(requests: DataFrame, seconds: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative latency histogram of logged requests."""
    return requests.agg(*bucket_counts(F.col(seconds), bounds))
