"""Streaming forms of scoring, the session mart, monitoring and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.operators.mart import COUNTERS, SESSION_COLUMNS
from clickloom.operators.models import score
from clickloom.operators.tracking import bucket_counts
from clickloom.streaming.sinks import run_batches


def score_new_files(
    sessions: DataFrame, model: Model, keys: Sequence[str], out: str, checkpoint: str | None = None
) -> DataFrame:
    """Score every session of a file stream and append the scores, one folder per batch.

    A batch overwrites its own folder, so a batch repeated after a failure
    leaves no duplicates. Without any batch the result is empty.
    """
    spark = sessions.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        score(model, batch, list(keys)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_batches(sessions, "scores", write, checkpoint)
    nothing = score(model, spark.createDataFrame([], sessions.schema), list(keys))
    try:
        return spark.read.schema(nothing.schema).parquet(out).select(*nothing.columns)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return nothing
        raise


def deduplicated(events: DataFrame, keys: Sequence[str], time: str = "ts", delay: str = "2 hours") -> DataFrame:
    """Each key once; state older than the delay is dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def session_counters(
    hits: DataFrame,
    targets: Sequence[str] = tuple(C.TARGET_ACTIONS),
    client: str = "client_id",
    time: str = "ts",
    gap: str = "30 minutes",
    delay: str = "2 hours",
) -> DataFrame:
    """Mart counters per client and activity session, late hits included up to ``delay``.

    Distinct counts are exact: the state of a session holds the set of its actions
    and cars, which are few values of a catalogue, not of the log.

    Start and end are aggregates, not parts of the grouping key: Spark would
    push a filter on the key below the merging of sessions and cut them short.
    """
    marked = _marked(hits.withWatermark(time, delay), targets)
    grouped = marked.groupBy(F.session_window(time, gap).alias("visit"), client)
    return grouped.agg(
        F.min(time).alias("start"),
        (F.max(time) + F.expr(f"INTERVAL {gap}")).alias("end"),
        *_counters(),
    ).drop("visit")


def _marked(hits: DataFrame, targets: Sequence[str]) -> DataFrame:
    return hits.withColumns({"target": X.is_target(F.col("event_action"), targets), "car": X.car_id(F.col("hit_page_path"))})


def _counters() -> list[Column]:
    """The mart's counters over marked hits; an unknown target marks a row that is no hit."""
    other = F.col("target") == 0
    return [
        F.count(F.when(other, 1)).alias("total_hits_count"),
        F.count(F.when(other & (F.col("hit_type") == "event"), 1)).alias("total_events_count"),
        F.size(F.collect_set(F.when(other, F.col("event_action")))).cast("bigint").alias("unique_event_actions"),
        F.size(F.collect_set("car")).cast("bigint").alias("unique_cars_viewed"),
        F.count("car").alias("total_car_views"),
        F.max("target").alias("event_value"),
    ]


def _backwards(field: T.StructField) -> Column:
    """A value whose ascending order, unknown first, is the descending order of the date or text."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType):
        return -F.unix_date(column)
    # digits of the bytes turned round; the end mark sorts a text behind those that it begins
    return F.concat(F.translate(F.hex(F.encode(column.cast("string"), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def session_mart(
    hits: DataFrame,
    sessions: DataFrame,
    targets: Sequence[str] = tuple(C.TARGET_ACTIONS),
    time: str = "ts",
    gap: str = "1 day",
    delay: str = "2 hours",
) -> DataFrame:
    """The whole mart over a stream of hits and one of session rows, both with their event time ``time``.

    Both streams become one, grouped by session, so hits and session rows may come in any order inside ``delay``. A
    session is closed, and comes out, when the watermark has passed its last row by ``gap``: the longest pause inside
    a session. Of conflicting session rows the state keeps the one that the batch mart chooses. Rows behind the watermark
    are dropped and counted (``sinks.run_counting_late``); a session whose rows come that late or pause longer than
    ``gap`` may come out twice. Hits without a session row give no row, session rows without hits give zeros;
    rows without a time are dropped, as no watermark ever passes them.

    Scale: hits of one session meet before the shuffle. The state of a session is one session row, five
    numbers and the sets of its actions and cars, which are few values of a catalogue, whatever its hits are.
    """
    ties = [c for c in sessions.columns if c not in ("session_id", "visit_date", "visit_time", time)]
    order = [_backwards(sessions.schema[c]).alias(f"_by_{c}") for c in ("visit_date", "visit_time")]
    later = [part for c in ties for part in (F.col(f"`{c}`").isNull().alias(f"_no_{c}"), F.col(f"`{c}`"))]
    context = F.struct(*order, *later, "visit_date", "visit_time").alias("context")
    marked = _marked(hits, targets).select("session_id", time, "event_action", "hit_type", "target", "car")
    both = marked.unionByName(sessions.select("session_id", time, context), allowMissingColumns=True)
    grouped = both.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("visit"), "session_id")
    closed = grouped.agg(F.min("context").alias("context"), *_counters()).filter("context IS NOT NULL")
    ratio = X.safe_ratio(F.col("total_car_views"), F.col("total_hits_count"), 4)
    row = ["session_id", *(F.col(f"context.{c}").alias(c) for c in SESSION_COLUMNS if c != "session_id")]
    return closed.select(*row, *COUNTERS, ratio.alias("car_view_ratio"), F.coalesce("event_value", F.lit(0)).alias("event_value"))


def prediction_windows(
    scored: DataFrame,
    time: str = "ts",
    prediction: str = "prediction",
    confidence: str = "confidence",
    length: str = "1 minute",
    delay: str = "10 minutes",
    bounds: Sequence[float] = tuple(C.CONFIDENCE_BUCKETS),
) -> DataFrame:
    """Predictions by class and their confidence histogram per time window."""
    windows = scored.withWatermark(time, delay).groupBy(F.window(time, length).alias("w"), F.col(prediction).alias("predicted"))
    return windows.agg(F.count(F.lit(1)).alias("n"), *bucket_counts(F.col(confidence), bounds)).select(
        F.col("w.start").alias("window_start"), "*"
    ).drop("w")
