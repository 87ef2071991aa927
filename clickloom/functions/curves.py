"""Running totals over an ordered score without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import stage

# Rows that one task numbers.
SLICE_ROWS = 50_000
# Slices of the ordered scores; each slice is summed by its own task.
SLICES = 512
# With no more distinct scores than this, one task sums them quickly.
ONE_TASK_SCORES = 100_000


def numbered(df: DataFrame, place: str, order: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``position``: 0, 1, ... in the order of a place spread evenly over [0, 1), then of the given columns.

    The places are cut into slices of about ``slice_rows`` rows; a task numbers a
    slice, and the slice starts are sums over one row per slice. ``df`` is read twice.
    """
    slices = max(1, df.count() // slice_rows)
    cut = df.withColumn("_slice", F.floor(F.col(place) * slices))
    counts = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)  # one row per slice
    starts = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.row_number().over(W.partitionBy("_slice").orderBy(place, *order)) - 1
    ranked = cut.withColumn("_number", number).join(starts, "_slice")
    return ranked.select(*df.columns, (F.col("_start") + F.col("_number")).alias("position"))


def running_totals(
    scores: DataFrame,
    score: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    one_task_scores: int = ONE_TASK_SCORES,
) -> DataFrame:
    """Adds ``<sum>_below``: the total of each sum over smaller scores of the same key.

    ``scores`` holds one row per key and distinct score. A large one is cut
    into slices at approximate quantiles of the score: totals per slice give
    each slice its start, and a window inside the slice gives the rest.
    """
    group = list(keys)
    total = scores.count()
    if total <= one_task_scores:
        below = W.partitionBy(*group).orderBy(score).rowsBetween(W.unboundedPreceding, -1)
        return scores.withColumns({f"{s}_below": F.coalesce(F.sum(s).over(below), F.lit(0)) for s in sums})
    ends = scores.agg(
        F.percentile_approx(score, [i / SLICES for i in range(1, SLICES)], 10_000).alias("ends")
    ).first()["ends"]
    splits = [float("-inf"), *sorted({float(e) for e in ends}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol=score, outputCol="_slice").transform(scores)
    # at most keys times SLICES rows: their running total is a small window
    starts = cut.groupBy(*group, "_slice").agg(*[F.sum(s).alias(f"{s}_slice") for s in sums])
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select(
        *group, "_slice", *[F.coalesce(F.sum(f"{s}_slice").over(before), F.lit(0)).alias(f"{s}_start") for s in sums]
    )
    inside = W.partitionBy(*group, "_slice").orderBy(score).rowsBetween(W.unboundedPreceding, -1)
    summed = cut.withColumns({f"{s}_in": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    joined = summed.join(starts, [*group, "_slice"])
    return joined.select(
        *scores.columns, *[(F.col(f"{s}_in") + F.col(f"{s}_start")).alias(f"{s}_below") for s in sums]
    )


def staged_scores(scores: DataFrame) -> DataFrame:
    """Distinct scores with their counts, written once: several jobs read them."""
    return stage(scores, "scores")
