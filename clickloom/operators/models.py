"""Model factory, training, scoring and importance tables on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.encoding import feature_stages, hot_stages
from clickloom.operators.metrics import auc_ovr_macro, metrics
from clickloom.operators.multiclass import BoostedClasses
from clickloom.operators.target_statistics import fit_target_statistics, ordered_targets
from clickloom.session import allow_checkpoints

TREES = ("boosted_trees", "random_forest")
ESTIMATORS: dict[tuple[str, str], Callable[..., Estimator]] = {
    ("boosted_trees", "binary"): GBTClassifier,
    ("boosted_trees", "multiclass"): BoostedClasses,
    ("boosted_trees", "regression"): GBTRegressor,
    ("random_forest", "binary"): RandomForestClassifier,
    ("random_forest", "multiclass"): RandomForestClassifier,
    ("random_forest", "regression"): RandomForestRegressor,
    ("linear", "binary"): LogisticRegression,
    ("linear", "multiclass"): LogisticRegression,
    ("linear", "regression"): LinearRegression,
    ("network", "binary"): MultilayerPerceptronClassifier,
    ("network", "multiclass"): MultilayerPerceptronClassifier,
}
HIDDEN_UNITS = 64


def make_estimator(name: str, task: str = "binary", label: str = "event_value", **params) -> Estimator:
    """An estimator by family and task; unknown combinations are errors."""
    if task not in ("binary", "multiclass", "regression"):
        raise ValueError(f"unknown task type: {task}")
    made = ESTIMATORS.get((name, task))
    if made is None:
        raise ValueError(f"no model {name} for task {task}")
    return made(featuresCol="features", labelCol=label, **params)


def with_class_weight(df: DataFrame, label: str, positive_weight: float, column: str = "weight") -> DataFrame:
    """Weight column: positives count ``positive_weight`` times."""
    return df.withColumn(column, F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(1.0))


def input_stages(name: str, numbers: list[str], categories: list[str]) -> list:
    """Trees take category indexes as they are; linear models and networks take one slot per category."""
    return feature_stages(numbers, categories) if name in TREES else hot_stages(numbers, categories)


@dataclass
class Encoded:
    """What a model is fitted on: fitted encoders, and vectors with their label, validation rows marked by ``is_val``."""

    encoder: PipelineModel
    vectors: DataFrame
    #: names of the classes where the labels are texts
    names: list[str] | None = None


def encode(
    train: DataFrame,
    numbers: list[str],
    categories: list[str],
    name: str = "boosted_trees",
    task: str = "binary",
    label: str = "event_value",
    val: DataFrame | None = None,
    order_keys: list[str] | None = None,
) -> Encoded:
    """Encoders learned from ``train``, and its vectors and those of ``val``. No setting of the model changes them.

    With ``order_keys`` trees take categories as target statistics: training rows, told apart
    by these keys, by the targets of earlier rows, all others by those of the whole training frame.
    Text labels of the multiclass task become their place in alphabetical order. Rows without such a label,
    and validation rows of an unseen one, are left out.
    """
    names = None
    if isinstance(train.schema[label].dataType, T.StringType):
        if task != "multiclass":
            raise ValueError(f"the labels of {label} are texts: use numbers or the multiclass task")
        train, val, names = _numbered_labels(train, val, label)
    by_target = bool(order_keys and categories and name in TREES)
    if by_target:
        statistics = fit_target_statistics(train, categories, label)
        targets = [f"{c}_target" for c in categories]
        encoder = PipelineModel(stages=[statistics, *feature_stages([*numbers, *targets], [])])
        train = ordered_targets(train, categories, label, order_keys)
        val = statistics.transform(val) if val is not None else None
    else:
        encoder = Pipeline(stages=input_stages(name, numbers, categories)).fit(train)
    frame = train
    if val is not None:
        frame = train.withColumn("is_val", F.lit(False)).unionByName(val.withColumn("is_val", F.lit(True)))
    # the targets are in the frame already, training rows by other values than the statistics would give
    assembled = encoder.stages[-1].transform(frame) if by_target else encoder.transform(frame)
    return Encoded(encoder, assembled.select("features", label, *[c for c in ("is_val",) if c in frame.columns]), names)


def fit_encoded(
    encoded: Encoded,
    name: str = "boosted_trees",
    task: str = "binary",
    label: str = "event_value",
    positive_weight: float | None = None,
    **params,
) -> Model:
    """A model of the vectors. Boosted trees stop early on the validation rows; other families leave those out."""
    if positive_weight is not None and name == "network":
        raise ValueError("the network takes no class weight: leave positive_weight out")
    vectors = encoded.vectors
    if "is_val" in vectors.columns and name == "boosted_trees":
        params["validationIndicatorCol"] = "is_val"
    elif "is_val" in vectors.columns:
        vectors = vectors.filter("NOT is_val").drop("is_val")
    if name == "network":
        width = vectors.first()["features"].size
        classes = vectors.agg(F.max(label)).first()[0]
        params.setdefault("layers", [width, HIDDEN_UNITS, max(2, int(classes) + 1)])
    if positive_weight is not None:
        vectors = with_class_weight(vectors, label, positive_weight)
        params["weightCol"] = "weight"
    return make_estimator(name, task, label, **params).fit(vectors)


def fit_model(
    train: DataFrame,
    numbers: list[str],
    categories: list[str],
    name: str = "boosted_trees",
    task: str = "binary",
    label: str = "event_value",
    val: DataFrame | None = None,
    positive_weight: float | None = None,
    order_keys: list[str] | None = None,
    **params,
) -> PipelineModel:
    """Fit encoders and a model: :func:`encode`, then :func:`fit_encoded`.

    Boosting reads its input once per iteration, so the assembled vectors are cached; lost blocks are
    recomputed. Where the labels are texts, the pipeline gives their names back as ``predicted_label``.
    """
    allow_checkpoints(train.sparkSession)
    encoded = encode(train, numbers, categories, name, task, label, val if name == "boosted_trees" else None, order_keys)
    encoded.vectors.persist()
    try:
        model = fit_encoded(encoded, name, task, label, positive_weight, **params)
    finally:
        encoded.vectors.unpersist()
    named = [IndexToString(inputCol="prediction", outputCol="predicted_label", labels=encoded.names)] if encoded.names else []
    return PipelineModel(stages=[*encoded.encoder.stages, model, *named])


def _numbered_labels(train: DataFrame, val: DataFrame | None, label: str) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Both frames with the label's place in the alphabetical order of the training labels, and that order."""
    numbering = StringIndexer(inputCol=label, outputCol="_place", stringOrderType="alphabetAsc", handleInvalid="skip").fit(train)

    def numbered(df: DataFrame) -> DataFrame:
        return numbering.transform(df).withColumn(label, F.col("_place")).drop("_place")

    return numbered(train), numbered(val) if val is not None else None, list(numbering.labels)


def last_model(model: Model) -> Model:
    """The model itself: the last stage of a pipeline, before the one that gives names to its classes."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    return next(s for s in reversed(stages) if not isinstance(s, IndexToString))


def label_names(model: Model) -> list[str] | None:
    """Names of the classes where the labels are texts."""
    end = model.stages[-1] if isinstance(model, PipelineModel) else model
    return list(end.getLabels()) if isinstance(end, IndexToString) else None


def prediction_column(model: Model) -> str:
    """The column to compare with the label."""
    return "predicted_label" if label_names(model) else "prediction"


def n_classes(model: Model) -> int | None:
    """Number of classes of a classifier or of the one that ends a pipeline."""
    return getattr(last_model(model), "numClasses", None)


def class_area(model: Model, df: DataFrame, label: str) -> float | None:
    """Mean of the one-against-rest areas of all classes; None where a class has no rows."""
    names = label_names(model)
    scored = class_probabilities(model, df.filter(F.col(label).isNotNull()), n_classes(model))
    scored = scored.withColumn("_class", F.col(label) if names else F.col(label).cast("int"))
    scores = {k: f"p{i}" for i, k in enumerate(names or range(n_classes(model)))}
    return auc_ovr_macro(scored, "_class", scores).first()["roc_auc_ovr"]


def score(model: Model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predictions with their keys: ``prediction``, ``confidence`` and, for two classes, ``probability`` of class 1.

    Where the labels are texts, ``predicted_label`` is the name of the predicted class.
    """
    if not isinstance(model, Model):
        raise ValueError("the model is not fitted")
    scored = model.transform(df)
    if "probability" in scored.columns:
        shares = vector_to_array(F.col("probability"))
        scored = scored.withColumn("confidence", F.array_max(shares))
        scored = scored.withColumn("probability", shares[1]) if n_classes(model) == 2 else scored.drop("probability")
    drop = [c for c in scored.columns if c.endswith(("_index", "_hot", "_target")) or c in ("features", "rawPrediction")]
    scored = scored.drop(*drop)
    if keep is None:
        return scored
    made = [c for c in ("prediction", "predicted_label", "probability", "confidence") if c in scored.columns]
    return scored.select(*keep, *made)


def class_probabilities(model: Model, df: DataFrame, classes: int) -> DataFrame:
    """One column per class, ``p0`` and so on, for one-against-rest areas."""
    shares = vector_to_array(F.col("probability"))
    return model.transform(df).withColumns({f"p{i}": shares[i] for i in range(classes)})


def best_val_score(model: Model, val: DataFrame, label: str, task: str = "binary", metric: str | None = None) -> float:
    """The wanted metric on the validation set, else the task's first one that is defined."""
    scored = score(model, val)
    probability = "probability" if task == "binary" else None
    found = metrics(scored, label, prediction_column(model), probability, task)
    if task == "multiclass" and (area := class_area(model, val, label)) is not None:
        found["roc_auc_ovr"] = area
    order = [metric, "roc_auc", "roc_auc_ovr", "f1_weighted", "accuracy", "r2"]
    return next(found[m] for m in order if m in found)


def feature_names(scored: DataFrame, column: str = "features") -> list[str]:
    """Slot names of a vector column from its metadata."""
    attributes = scored.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in slots]


def importance_table(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Feature and importance, most important first; zeros where a model has none.

    Trees: their own importances. Linear models: the size of the coefficient.
    """
    names = feature_names(model.transform(sample.limit(0)))
    last = last_model(model)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif isinstance(getattr(last, "numClasses", 2), int) and hasattr(last, "coefficientMatrix"):
        values = abs(last.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        values = [0.0] * len(names)
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = sample.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def top_features(table: DataFrame, count: int = 15) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(count)


def bottom_features(table: DataFrame, count: int = 15) -> DataFrame:
    return table.orderBy(F.asc("importance"), "feature").limit(count)


def save_model(model: PipelineModel, root: str, version: str) -> str:
    path = f"{root.rstrip('/')}/model_v{version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/model_v{version}")
