"""Fitted trees as tables: contributions per row, margins per boosting iteration, and models cut to their best iteration.

Contributions are Shapley values of the game in which a feature outside the coalition
sends a row down both branches in proportion to the training rows there. A leaf adds its value times a
product with one factor per feature of its path, so the sum over all coalitions is a polynomial: each feature extends it
by its factor, and unwinding one factor gives the weight of that feature. The work per row and leaf is the
square of the path's features, not their subsets, and the rows of an Arrow batch go through it together.

The node table is as large as the model (trees times ``2 ** depth`` rows); it goes to the tasks as it is. Rows
are never shuffled for contributions or margins.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.metrics import areas_of_counts
from clickloom.operators.models import feature_names
from clickloom.session import new_path, stage

# the functions below travel with their tasks: executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Step:
    """What the splits on one feature along a path ask for, and the share of training rows that do it."""

    feature: int
    low: float | None = None
    high: float | None = None
    left: list[frozenset] | None = None  # category sets a row must be in
    right: list[frozenset] | None = None  # and must not be in
    share: float = 1.0

    def followed(self, x: np.ndarray) -> np.ndarray:
        """Rows (by feature) that follow the path at every split on this feature; a missing number goes right."""
        value, ok = x[:, self.feature], np.ones(len(x), bool)
        if self.low is not None:
            ok &= ~(value <= self.low)
        if self.high is not None:
            ok &= value <= self.high
        for wanted, sets in ((True, self.left), (False, self.right)):
            for categories in sets or ():
                ok &= np.isin(value, list(categories)) == wanted
        return ok


@dataclass
class Leaf:
    tree: int
    value: float
    steps: list[Step]


def node_table(model: Model) -> DataFrame:
    """The nodes of a fitted tree model, as Spark stores them."""
    spark = SparkSession.active()
    path = new_path(spark, "trees")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def _cover(node, classes: bool) -> float:
    return float(sum(node["impurityStats"])) if classes else float(node["impurityStats"][0])


def _with_split(steps: dict[int, Step], split, goes_left: bool, share: float) -> dict[int, Step]:
    feature, values = split["featureIndex"], split["leftCategoriesOrThreshold"]
    old = steps.get(feature, Step(feature))
    new = Step(feature, old.low, old.high, list(old.left or ()), list(old.right or ()), old.share * share)
    if split["numCategories"] >= 0:
        (new.left if goes_left else new.right).append(frozenset(values))
    elif goes_left:
        new.high = values[0] if old.high is None else min(old.high, values[0])
    else:
        new.low = values[0] if old.low is None else max(old.low, values[0])
    return {**steps, feature: new}


def leaves_of(model: Model) -> list[Leaf]:
    """Every leaf of a boosted or forest model with its weighted value and the steps of its path, one per feature.

    Boosted trees: values add up to the margin of class 1, or to the prediction. Forests: to the probability
    of class 1, or to the prediction.
    """
    # impurity statistics of forests of classes are counts per class, else count, sum and sum of squares
    classes = getattr(model, "numClasses", None) is not None and not isinstance(model, GBTClassificationModel)
    if classes and model.numClasses != 2:
        raise ValueError("contributions need two classes or a number")
    boosted = type(model).__name__.startswith("GBT")
    weights = list(model.treeWeights) if boosted else [1.0 / len(model.treeWeights)] * len(model.treeWeights)
    trees: dict[int, dict[int, Row]] = {}
    for node in node_table(model).collect():  # as large as the model
        trees.setdefault(node["treeID"], {})[node["id"]] = node
    found = []
    for tree, nodes in sorted(trees.items()):
        todo: list[tuple[int, dict[int, Step]]] = [(0, {})]
        while todo:
            at, steps = todo.pop()
            node = nodes[at]
            if node["leftChild"] < 0:
                value = node["impurityStats"][1] / _cover(node, True) if classes else node["prediction"]
                found.append(Leaf(tree, weights[tree] * value, list(steps.values())))
                continue
            whole = _cover(node, classes)
            for child, goes_left in ((node["leftChild"], True), (node["rightChild"], False)):
                todo.append((child, _with_split(steps, node["split"], goes_left, _cover(nodes[child], classes) / whole)))
    return found


def shapley(leaves: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Contributions (rows by features) to the sum of the leaf values, from which ``base_value`` is left out."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        d = len(leaf.steps)
        ones = [s.followed(x).astype(float) for s in leaf.steps]
        path = np.zeros((d + 1, len(x)))  # coefficient of t ** k: coalitions of k features that the row follows
        path[0] = 1.0
        for k, (step, one) in enumerate(zip(leaf.steps, ones), 1):  # extend by share + one * t
            path[1 : k + 1] = path[1 : k + 1] * step.share + path[:k] * one
            path[0] *= step.share
        weights = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
        for step, one in zip(leaf.steps, ones):
            # unwind: divide by share + one * t, from the top where the row follows, from the bottom where not
            rest, total, follows = path[d].copy(), np.zeros(len(x)), one > 0
            for k in range(d - 1, -1, -1):
                total += weights[k] * np.where(follows, rest, path[k] / step.share)
                rest = path[k] - step.share * rest
            out[:, step.feature] += leaf.value * (one - step.share) * total
    return out


def base_value(leaves: Sequence[Leaf]) -> float:
    """The mean of the leaf values over the training rows: what a row gets without any feature."""
    return float(sum(leaf.value * np.prod([s.share for s in leaf.steps]) for leaf in leaves))


def tree_values(leaves: Sequence[Leaf], x: np.ndarray, trees: int) -> np.ndarray:
    """The weighted value of each tree for each row (rows by trees)."""
    out = np.zeros((len(x), trees))
    for leaf in leaves:
        ok = np.ones(len(x), bool)
        for step in leaf.steps:
            ok &= step.followed(x)
        out[ok, leaf.tree] += leaf.value
    return out


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(-1, width)


def _mapped(prepared: DataFrame, keep: Sequence[str], width: int, work, name: str) -> DataFrame:
    """The columns to keep and an array per row that ``work`` makes of the batch's vectors."""

    def run(batches):
        for batch in batches:
            found = work(_vectors(batch.column(0), width))
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], [*keep, name])

    rows = prepared.select(vector_to_array("features").alias("__x"), *keep)
    fields = [prepared.schema[c] for c in keep] + [T.StructField(name, T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(run, T.StructType(fields))


def tree_contributions(model: PipelineModel, df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], float]:
    """Rows with ``contributions`` of the trees per feature slot, the slot names, and the base value.

    Base value and contributions add up to the margin of boosted trees, the probability of class 1 of a
    forest, or the prediction of a number. The frame serves all reports of ``explain``.
    """
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    names, leaves = feature_names(prepared), leaves_of(model.stages[-1])
    found = _mapped(prepared, [*keys, "features"], len(names), lambda x: shapley(leaves, x), "contributions")
    return found, names, base_value(leaves)


def prefix_margins(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows with ``margins``: the margin of boosted trees after each iteration, all in one pass."""
    last = model.stages[-1]
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    width, trees, leaves = len(feature_names(prepared)), len(last.treeWeights), leaves_of(last)
    return _mapped(prepared, keep, width, lambda x: tree_values(leaves, x, trees).cumsum(axis=1), "margins")


def iteration_areas(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """(iteration, auc): the exact area under the curve after each boosting iteration, all in one job.

    Margins are rounded to 12 digits first: sums that differ in their last bits only are ties.
    """
    last = model.stages[-1]
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    width, trees, leaves = len(feature_names(prepared)), len(last.treeWeights), leaves_of(last)

    def run(batches):
        for batch in batches:
            margins = tree_values(leaves, _vectors(batch.column(0), width), trees).cumsum(axis=1)
            yield _counted_margins(margins, batch.column(1).to_numpy(zero_copy_only=False))

    rows = prepared.select(vector_to_array("features").alias("__x"), (F.col(label) == 1).cast("double").alias("__y"))
    counted = rows.mapInArrow(run, "iteration int, margin double, ones bigint, zeros bigint")
    return areas_of_counts(counted.withColumn("margin", F.round("margin", 12)), "iteration", "margin").select("iteration", "auc")


def _counted_margins(margins: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """(iteration, margin, ones, zeros) of margins (rows by iterations), equal ones of an iteration added up.

    A row with an unknown label (NaN) keeps its margin and counts for neither side.
    """
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for k in range(margins.shape[1]):
        values, place = np.unique(margins[:, k], return_inverse=True)
        sides = (np.bincount(place, label == side, len(values)).astype(np.int64) for side in (1, 0))
        for part, found in zip(parts, (np.full(len(values), k + 1, np.int32), values, *sides)):
            part.append(found)
    columns = [pa.array(np.concatenate(p)) for p in parts]
    return pa.RecordBatch.from_arrays(columns, ["iteration", "margin", "ones", "zeros"])


def cut_model(model: PipelineModel, iterations: int) -> PipelineModel:
    """The pipeline with the first iterations of its boosted trees only."""
    last = model.stages[-1]
    if not isinstance(last, GBTClassificationModel):
        raise ValueError("only boosted trees of two classes have iterations to cut")
    if not 1 <= iterations <= len(last.treeWeights):
        raise ValueError(f"the model has 1 to {len(last.treeWeights)} iterations, not {iterations}")
    java, gateway = last._java_obj, SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, iterations)
    weights = gateway.new_array(gateway.jvm.double, iterations)
    for k in range(iterations):
        trees[k], weights[k] = java.trees()[k], float(last.treeWeights[k])
    made = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    java.copyValues(made, java.extractParamMap())
    return PipelineModel(stages=[*model.stages[:-1], GBTClassificationModel(made)])


def best_iteration(areas: DataFrame) -> int:
    """The iteration with the largest area, the first of equal ones; areas within 1e-9 are equal."""
    row = areas.orderBy(F.desc(F.round("auc", 9)), "iteration").first()  # one row per iteration
    return row["iteration"]


def fit_to_best(model: PipelineModel, val: DataFrame, label: str) -> tuple[PipelineModel, DataFrame]:
    """The model cut to the iteration with the best area on the validation rows, and the areas of all of them."""
    areas = stage(iteration_areas(model, val, label), "iteration-areas")
    return cut_model(model, best_iteration(areas)), areas
