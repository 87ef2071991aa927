"""Error tables: where and how badly a model is wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions.quantiles import exact_quantiles, top_values, value_counts
from clickloom.operators.filters import report_columns
from clickloom.session import stage

OTHER = "... OTHER ..."
# Columns that the operators of this module add to a frame, by task: reports by feature leave them out.
_NAMED = ("actual", "predicted")
_ADDED = {
    "regression": ("error", "abs_error"),
    "binary": ("is_error", "probability", "confidence_of_mistake"),
    "multiclass": ("is_error", "probability"),
}
_RANKED = ("prediction_type", "is_worst")


def _not_features() -> list[str]:
    """Added columns and the technical keys of a frame."""
    return [*_NAMED, *dict.fromkeys(c for added in _ADDED.values() for c in added), *_RANKED, *C.SERVICE_COLUMNS]


def error_table(df: DataFrame, label: str, prediction: str, task: str = "binary") -> DataFrame:
    """The frame with ``actual``, ``predicted`` and the error columns of its task."""
    named = df.withColumns({"actual": F.col(label), "predicted": F.col(prediction)})
    if task == "regression":
        error = F.col("predicted") - F.col("actual")
        return named.withColumns({"error": error, "abs_error": F.abs(error)})
    wrong = (~F.col("actual").eqNullSafe(F.col("predicted"))).cast("int")
    marked = named.withColumn("is_error", wrong)
    if task == "binary" and "probability" in df.columns:
        sure = F.when(F.col("actual") == 1, 1 - F.col("probability")).otherwise(F.col("probability"))
        marked = marked.withColumn("confidence_of_mistake", sure)
    return marked


def false_positives(errors: DataFrame) -> DataFrame:
    return errors.filter("actual = 0 AND predicted = 1")


def false_negatives(errors: DataFrame) -> DataFrame:
    return errors.filter("actual = 1 AND predicted = 0")


def _by_category(errors: DataFrame, columns: Sequence[str], top_k: int, measure: str) -> DataFrame:
    """``column_name, category, measure`` with the categories past the top ``top_k`` merged into one.

    The top list is at most ``top_k`` values per column, so it travels as
    literals inside the expression instead of through a join.
    """
    kept: dict[str, list[str]] = {c: [] for c in columns}
    for row in top_values(value_counts(errors, columns), top_k).collect():
        kept[row["column_name"]].append(row["value"])

    def category(c: str):
        text = F.col(c).cast("string")
        return F.when(text.isin(*kept[c]), text).otherwise(OTHER) if kept[c] else F.lit(OTHER)

    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), category(c).alias("category")) for c in columns])
    return errors.select(measure, F.inline(lines))


def error_by_category(
    errors: DataFrame, columns: Sequence[str] | None = None, top_features: int = 6, top_k: int = 15
) -> DataFrame:
    """Error share and row count per category of the first text columns."""
    columns = list(columns or report_columns(errors, _not_features(), top_features))
    rows = _by_category(errors, columns, top_k, "is_error")
    return rows.groupBy("column_name", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_error").alias("n_errors"),
        F.avg("is_error").alias("error_share"),
    )


def residual_box(
    errors: DataFrame, columns: Sequence[str] | None = None, top_features: int = 6, top_k: int = 15
) -> DataFrame:
    """Quartiles, ends and whiskers of the residuals per category of the first text columns."""
    columns = list(columns or report_columns(errors, _not_features(), top_features))
    # the quantiles read these narrow rows several times
    rows = stage(_by_category(errors, columns, top_k, "error"), "residuals")
    keys = ["column_name", "category"]
    boxes = exact_quantiles(rows, keys, "error", [0.0, 0.25, 0.5, 0.75, 1.0])
    q = [F.col("quantiles")[i] for i in range(5)]
    fences = boxes.select(
        *keys,
        "n",
        q[0].alias("low"),
        q[1].alias("q1"),
        q[2].alias("median"),
        q[3].alias("q3"),
        q[4].alias("high"),
        (q[1] - 1.5 * (q[3] - q[1])).alias("low_fence"),
        (q[3] + 1.5 * (q[3] - q[1])).alias("high_fence"),
    )
    return fences


def worst_cases(errors: DataFrame, key: Sequence[str], per_kind: int = 5) -> DataFrame:
    """The most confident false positives and false negatives; equal scores in key order.

    One pass: every task keeps its ``per_kind`` worst rows of either kind before the shuffle.
    """
    wrong = errors.filter("is_error = 1 AND actual IN (0, 1)")
    confident = F.when(F.col("actual") == 0, F.col("probability")).otherwise(-F.col("probability"))
    worst = W.partitionBy("actual").orderBy(F.desc("_confident"), *key)
    ranked = wrong.withColumn("_confident", confident).withColumn("_place", F.row_number().over(worst))
    kind = F.when(F.col("actual") == 0, "FP").otherwise("FN")
    return (
        ranked.filter(F.col("_place") <= per_kind)
        .drop("_confident", "_place")
        .withColumn("prediction_type", kind)
    )


def first_errors(errors: DataFrame, key: Sequence[str], limit: int = 10) -> DataFrame:
    """Some misclassified rows where no probability ranks them: the first by key."""
    return errors.filter("is_error = 1").orderBy(*key).limit(limit)


def worst_residuals(errors: DataFrame, key: Sequence[str], limit: int = 10) -> DataFrame:
    return errors.orderBy(F.desc("abs_error"), *key).limit(limit)


def flag_worst(errors: DataFrame, key: Sequence[str], limit: int = 10) -> DataFrame:
    """Every row with ``is_worst``: 1 for the rows of :func:`worst_residuals`.

    The worst rows are ``limit`` at most, so they are broadcast.
    """
    worst = worst_residuals(errors, key, limit).select(*key).withColumn("is_worst", F.lit(1))
    return errors.join(F.broadcast(worst), list(key), "left").na.fill(0, ["is_worst"])


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Row counts in equally wide bins from the smallest to the largest value; the last bin is closed."""
    # read twice, so the rows behind it are computed once
    known = stage(df.filter(F.col(value).isNotNull()).select(value, *by), "values")
    ends = known.agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")).first()
    if ends["low"] is None:
        low, width = 0.0, 1.0
    else:
        low, width = ends["low"], (ends["high"] - ends["low"]) / bins or 1.0
    place = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return known.groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"bin_low": F.lit(low) + F.col("bin") * width, "bin_high": F.lit(low) + (F.col("bin") + 1) * width}
    )


def probability_histogram(errors: DataFrame, bins: int = 20) -> DataFrame:
    """Probabilities of the wrong predictions, by actual class."""
    return histogram(errors.filter("is_error = 1"), "probability", bins, ["actual"])


def write_worst_report(worst: DataFrame, path: str, score: str, features: Sequence[str], title: str) -> None:
    """Save a text report of a few worst rows (the top-k report): a title, then one paragraph per row."""
    kind = [F.upper("prediction_type")] if "prediction_type" in worst.columns else []
    head = F.concat_ws(" ", *kind, F.concat(F.lit(f"{score}="), F.format_number(F.col(score), 3)))
    parts = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("unknown"))) for c in features]
    body = worst.select(F.concat(F.lit("\n"), F.concat_ws("\n", head, *parts)).alias("value"), F.lit(1).alias("o"))
    heading = worst.sparkSession.range(1).select(F.lit(f"# {title}").alias("value"), F.lit(0).alias("o"))
    heading.unionByName(body).coalesce(1).sortWithinPartitions("o").select("value").write.mode("overwrite").text(path)
