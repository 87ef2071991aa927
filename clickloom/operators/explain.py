"""Explanations: per-row contributions of a linear model and permutation importance."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.functions.curves import numbered
from clickloom.operators.errors import false_positives
from clickloom.operators.metrics import auc_table
from clickloom.operators.models import feature_names, score
from clickloom.session import stage


def contributions(model: PipelineModel, df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows with ``contributions``: weight times distance from the mean, per feature slot.

    The weights and means are one number per slot. Returns the frame and the slot names.
    """
    linear = model.stages[-1]
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    names = feature_names(prepared)
    means = prepared.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
    weights = linear.coefficients.toArray()

    def numbers(values) -> Column:
        return F.array(*[F.lit(float(v)) for v in values])

    slots = F.arrays_zip(
        vector_to_array("features").alias("x"), numbers(means).alias("m"), numbers(weights).alias("w")
    )
    parts = F.transform(slots, lambda s: s["w"] * (s["x"] - s["m"]))
    return prepared.select(*keys, "features", parts.alias("contributions")), names


def _per_slot(names: Sequence[str]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("feature"), F.col("contributions")[i].alias("contribution")) for i, n in enumerate(names)]
    )


def mean_contributions(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    one = parts.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"c{i}") for i in range(len(names))])
    lines = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("importance")) for i, n in enumerate(names)])
    return one.select(F.inline(lines)).orderBy(F.desc("importance"), "feature")


def explain_rows(parts: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Contributions of the given rows, one line per feature, strongest first within a row."""
    lines = parts.select(*keys, F.inline(_per_slot(names)))
    return lines.orderBy(*keys, F.desc(F.abs("contribution")), "feature")


def explain_worst_false_positives(
    errors: DataFrame, parts: DataFrame, names: Sequence[str], keys: Sequence[str], limit: int = 10
) -> DataFrame:
    """Contributions of the most confident false positives (``limit`` rows, so they are broadcast)."""
    worst = false_positives(errors).orderBy(F.desc("probability"), *keys).limit(limit).select(*keys, "probability")
    chosen = parts.join(F.broadcast(worst), list(keys))
    return chosen.select(*keys, "probability", F.inline(_per_slot(names)))


def dependence(parts: DataFrame, names: Sequence[str], feature: str, bins: int = 20) -> DataFrame:
    """Mean contribution of one feature over equally wide bins of its value."""
    i = names.index(feature)
    pairs = parts.select(vector_to_array("features")[i].alias("x"), F.col("contributions")[i].alias("c"))
    ends = pairs.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    low, width = ends["low"] or 0.0, ((ends["high"] or 0.0) - (ends["low"] or 0.0)) / bins or 1.0
    place = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    return pairs.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_value"), F.avg("c").alias("mean_contribution")
    )


def _shift(column: str, rows: int, seed: int) -> int:
    """How far the donors of a column stand away: a seeded number from 1 to the number of rows less one."""
    if rows < 2:
        return 0
    return 1 + int(hashlib.md5(f"{column}|{seed}".encode()).hexdigest()[:12], 16) % (rows - 1)


def shuffled_copies(df: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int = C.SEED) -> DataFrame:
    """The rows as they are (``redrawn`` is empty) and once per column with that column's values dealt out anew.

    Rows stand in the order of a seeded digest of their keys. A column's values
    move on by a seeded number of places, so every value of the column is used
    once, on another row. Donors come by one join on the place; nothing but the number of rows reaches the driver.
    """
    rows = stage(numbered(df.withColumn("_place", X.hash_share(*keys, seed=seed)), "_place", keys).drop("_place"), "numbered")
    total = rows.count()
    shift = F.lit(0)
    for c in columns:
        shift = F.when(F.col("redrawn") == c, _shift(c, total, seed)).otherwise(shift)
    copies = rows.withColumn("redrawn", F.explode(F.array(F.lit(""), *[F.lit(c) for c in columns])))
    copies = copies.withColumn("_donor", F.pmod(F.col("position") + shift, F.lit(max(total, 1))))
    donors = rows.select(F.col("position").alias("_donor"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = copies.join(donors, "_donor")
    dealt = {c: F.when(F.col("redrawn") == c, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(dealt).select(*df.columns, "redrawn")


def area_losses(scored: DataFrame, label: str) -> DataFrame:
    """Loss of area per redrawn column against the rows as they are; ``scored`` has redrawn, label and probability."""
    areas = auc_table(scored, "redrawn", F.col(label) == 1, "probability")
    # one row per column
    full = F.max(F.when(F.col("redrawn") == "", F.col("auc"))).over(W.partitionBy(F.lit(1)))
    losses = areas.withColumn("importance", full - F.col("auc")).filter("redrawn <> ''")
    return losses.select(F.col("redrawn").alias("feature"), "importance").orderBy(F.desc("importance"), "feature")


def permutation_importance(
    model: Model, df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str], seed: int = C.SEED
) -> DataFrame:
    """Loss of area under the curve when a column's values are dealt out anew over all rows.

    All copies are scored and measured together, in one job.
    """
    return area_losses(score(model, shuffled_copies(df, columns, keys, seed), [*keys, "redrawn", label]), label)
