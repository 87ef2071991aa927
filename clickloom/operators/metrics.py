"""Model metrics as aggregations."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.curves import ONE_TASK_SCORES, running_totals, staged_scores

log = logging.getLogger(__name__)

TASKS = ("binary", "multiclass", "regression")


def confusion(df: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """Rows per actual and predicted class."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class from a confusion table.

    Each cell counts once for its actual class and once for its predicted one,
    so a single grouping gives all sums; the table is classes squared at most.
    """
    hit = F.col("actual") == F.col("predicted")
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("named"),
                    F.when(hit, F.col("n")).otherwise(0).alias("right"),
                ),
                F.struct(
                    F.col("predicted").cast("string").alias("class"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("named"),
                    F.lit(0).cast("bigint").alias("right"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "named", "right")])

    def share(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    right, named, support = F.col("right"), F.col("named"), F.col("support")
    return sums.select(
        "class",
        share(right, named).alias("precision"),
        share(right, support).alias("recall"),
        share(2 * right, named + support).alias("f1"),
        "support",
    )


def report_averages(per_class: DataFrame) -> DataFrame:
    """Macro and weighted averages of a class report."""
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    aggregates = [total.alias("support")]
    for s in scores:
        aggregates += [F.avg(s).alias(f"macro_{s}"), (F.sum(F.col(s) * F.col("support")) / total).alias(f"weighted_{s}")]
    one = per_class.agg(*aggregates)
    lines = [
        F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{s}").alias(s) for s in scores], "support")
        for kind in ("macro", "weighted")
    ]
    return one.select(F.inline(F.array(*lines)))


def class_report_full(df: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """Per-class rows followed by macro and weighted averages."""
    per_class = class_report(confusion(df, label, prediction))
    return per_class.unionByName(report_averages(per_class))


def classification_scores(df: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """Accuracy and support-weighted F1 in one row, rounded to 4 digits."""
    per_class = class_report(confusion(df, label, prediction))
    total = F.sum("support")
    return per_class.agg(
        F.round(F.sum(F.col("recall") * F.col("support")) / total, 4).alias("accuracy"),
        F.round(F.sum(F.col("f1") * F.col("support")) / total, 4).alias("f1_weighted"),
    )


def auc_table(
    df: DataFrame, classes: str | None, positive: Column, score: str, one_task_scores: int = ONE_TASK_SCORES
) -> DataFrame:
    """Exact area under the ROC curve, per value of ``classes`` where given.

    Rows are merged per distinct score first; equal scores count half. A class
    without both kinds of rows has no area: NULL.
    """
    counts = df.select(
        *([classes] if classes else []),
        F.col(score).cast("double").alias("score"),
        positive.cast("bigint").alias("ones"),
        (~positive).cast("bigint").alias("zeros"),
    )
    return areas_of_counts(counts, classes, "score", one_task_scores)


def areas_of_counts(counts: DataFrame, classes: str | None, score: str, one_task_scores: int = ONE_TASK_SCORES) -> DataFrame:
    """The areas of ``auc_table`` from rows with the numbers of positives and negatives (``ones``, ``zeros``) at a score."""
    keys = [classes] if classes else []
    merged = counts.groupBy(*keys, F.col(score).alias("score")).agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    summed = running_totals(staged_scores(merged), "score", ["zeros"], keys, one_task_scores)
    pairs = F.sum(F.col("ones") * (F.col("zeros_below") + F.col("zeros") / 2))
    ones, zeros = F.sum("ones").cast("double"), F.sum("zeros").cast("double")
    area = F.when((ones > 0) & (zeros > 0), pairs / (ones * zeros))
    if keys:
        return summed.groupBy(*keys).agg(area.alias("auc"), ones.cast("bigint").alias("support"))
    return summed.agg(area.alias("auc"), ones.cast("bigint").alias("support"))


def auc_exact(df: DataFrame, label: str = "actual", score: str = "probability", **options) -> DataFrame:
    """One row: the area under the ROC curve, NULL if only one class is present."""
    return auc_table(df, None, F.col(label) == 1, score, **options).select("auc")


def auc_ovr(df: DataFrame, label: str, class_scores: dict[str, str]) -> DataFrame:
    """Area per class against the rest; ``class_scores`` maps a class to its score column.

    All classes are handled in one pass over rows repeated once per class.
    """
    lines = F.array(
        *[F.struct(F.lit(str(k)).alias("class"), F.col(c).cast("double").alias("score")) for k, c in class_scores.items()]
    )
    rows = df.select(F.col(label).cast("string").alias("label"), F.inline(lines))
    return auc_table(rows, "class", F.col("label") == F.col("class"), "score")


def auc_ovr_macro(df: DataFrame, label: str, class_scores: dict[str, str]) -> DataFrame:
    """Plain mean of the one-against-rest areas, NULL where a class is missing."""
    areas = auc_ovr(df, label, class_scores)
    return areas.agg(F.when(F.count(F.when(F.col("auc").isNull(), 1)) == 0, F.avg("auc")).alias("roc_auc_ovr"))


def regression_metrics(df: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """Root mean squared error, mean absolute error and R2 in one aggregation."""
    error = F.col(prediction) - F.col(label)
    square = F.avg(error * error)
    spread = F.var_pop(label)
    return df.agg(
        F.round(F.sqrt(square), 4).alias("rmse"),
        F.round(F.avg(F.abs(error)), 4).alias("mae"),
        F.round(F.when(spread > 0, 1 - square / spread).when(square == 0, 1.0).otherwise(0.0), 4).alias("r2"),
    )


def metrics(
    df: DataFrame,
    label: str = "actual",
    prediction: str = "predicted",
    probability: str | None = None,
    task: str = "binary",
    class_scores: dict[str, str] | None = None,
) -> dict[str, float]:
    """The task's metrics by name, rounded to 4 digits; an undefined area is left out with a warning."""
    if task not in TASKS:
        raise ValueError(f"unknown task type: {task}")
    if task == "regression":
        return regression_metrics(df, label, prediction).first().asDict()
    found = classification_scores(df, label, prediction).first().asDict()
    area = None
    if task == "binary" and probability:
        area = ("roc_auc", auc_exact(df, label, probability).first()[0])
    elif task == "multiclass" and class_scores:
        area = ("roc_auc_ovr", auc_ovr_macro(df, label, class_scores).first()[0])
    if area and area[1] is not None:
        found[area[0]] = round(area[1], 4)
    elif area:
        log.warning("%s is undefined: not all classes are present", area[0])
    return found


def prefixed(found: dict[str, float], prefix: str) -> dict[str, float]:
    return {f"{prefix}{name}": value for name, value in found.items()}
