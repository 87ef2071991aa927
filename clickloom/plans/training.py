"""The jobs around the model: prepare, train, tune, evaluate, score."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from threading import get_ident

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom import constants as C
from clickloom.operators import models
from clickloom.operators.cleaning import SessionCleaner
from clickloom.operators.errors import error_table
from clickloom.operators.features import SessionFeatures
from clickloom.operators.filters import drop_sparse_rows, require_rows
from clickloom.operators.metrics import metrics, prefixed
from clickloom.operators.splitting import group_split, three_frames
from clickloom.operators.tracking import log_metrics, log_params, log_run
from clickloom.operators.trees import fit_to_best
from clickloom.operators.tuning import random_search, trials_table
from clickloom.session import stage
from clickloom.sources.files import write_predictions
from clickloom.sources.schemas import read_contract, require_columns, write_contract

KEYS = ["session_id", "client_id"]
# metrics that are better when smaller; all others are better when larger
ERRORS = ("rmse", "mae")


@dataclass
class Spec:
    """What to train: model family, task, columns and settings."""

    model: str = "boosted_trees"
    task: str = "binary"
    label: str = C.TARGET_COLUMN
    keys: list[str] = field(default_factory=lambda: list(KEYS))
    model_params: dict = field(default_factory=dict)
    cleaner_params: dict = field(default_factory=dict)
    positive_weight: float | None = None
    metric: str = "roc_auc"
    #: trees take categories as ordered target statistics instead of alphabetical numbers
    target_statistics: bool = False
    #: boosted trees of two classes run all iterations and keep those up to the best area on the validation rows
    keep_best: bool = False


def direction_of(metric: str) -> str:
    """Which way a metric improves."""
    return "minimize" if metric in ERRORS else "maximize"


def prepare(mart: DataFrame, spec: Spec, seed: int = C.SEED, **sizes: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop sparse rows, split by client and write the result once: fitting reads it many times."""
    stratum = None if spec.task == "regression" else spec.label
    rows = stage(drop_sparse_rows(mart), "mart")
    split = group_split(rows, target=stratum, seed=seed, **sizes)
    return three_frames(stage(split, "split"))


def fit_preparation(train: DataFrame, spec: Spec) -> tuple[list, DataFrame]:
    """Feature and cleaning stages learned from the training frame, and that frame cleaned.

    Fitting reads the engineered and the cleaned frame several times, so both are worked out once and cached; lost
    blocks are recomputed. The caller unpersists the cleaned frame.
    """
    features = SessionFeatures()
    engineered = features.transform(train).persist()
    try:
        cleaner = SessionCleaner(passThrough=[*spec.keys, spec.label], **spec.cleaner_params)
        fitted = cleaner.fit(engineered)
        cleaned = fitted.transform(engineered).persist()
        cleaned.count()  # filled while the engineered frame is at hand
    finally:
        engineered.unpersist()
    return [features, fitted], cleaned


def split_columns(cleaned: DataFrame, spec: Spec) -> tuple[list[str], list[str]]:
    """(numbers, categories) of the cleaned frame, keys and label left out."""
    inputs = [f for f in cleaned.schema if f.name not in (*spec.keys, spec.label)]
    numbers = [f.name for f in inputs if isinstance(f.dataType, T.NumericType)]
    return numbers, [f.name for f in inputs if f.name not in numbers]


def fit_pipeline(
    train: DataFrame, val: DataFrame | None, spec: Spec, prepared: tuple[list, DataFrame] | None = None
) -> PipelineModel:
    """Features, cleaning, encoding and the model as one pipeline that saves as a whole.

    Preparation does not depend on the model: ``prepared`` takes what ``fit_preparation`` gave, for several models.
    """
    if spec.keep_best and (spec.model, spec.task) != ("boosted_trees", "binary"):
        raise ValueError("only boosted trees of two classes can be cut to their best iteration")
    stages, cleaned = prepared or fit_preparation(train, spec)
    numbers, categories = split_columns(cleaned, spec)
    clean_val = PipelineModel(stages=stages).transform(val) if val is not None else None
    cut_later = spec.keep_best and clean_val is not None
    try:
        fitted = models.fit_model(
            cleaned,
            numbers,
            categories,
            spec.model,
            spec.task,
            spec.label,
            None if cut_later else clean_val,
            spec.positive_weight,
            spec.keys if spec.target_statistics else None,
            **spec.model_params,
        )
    finally:
        if not prepared:
            cleaned.unpersist()
    if cut_later:
        fitted, _ = fit_to_best(fitted, clean_val, spec.label)
    return PipelineModel(stages=[*stages, *fitted.stages])


def evaluate(model: PipelineModel, df: DataFrame, spec: Spec, prefix: str = "") -> tuple[dict[str, float], DataFrame]:
    """Metrics and the error table of a labelled frame."""
    scored = models.score(model, require_rows(df, "the evaluation set"))
    errors = error_table(scored, spec.label, models.prediction_column(model), spec.task)
    probability = "probability" if spec.task == "binary" else None
    found = metrics(errors, "actual", "predicted", probability, spec.task)
    if spec.task == "multiclass" and (area := models.class_area(model, df, spec.label)) is not None:
        found["roc_auc_ovr"] = area
    return prefixed(found, prefix), errors


def _save(
    model: PipelineModel, train: DataFrame, root: str, version: str, spec: Spec, run_name: str, found: dict[str, float]
) -> None:
    """Log the run and its metrics, save the pipeline and the contract of its input."""
    spark = train.sparkSession
    run_id = uuid.uuid4().hex
    log_run(spark, root, run_id, run_name, version=version, model=spec.model, task=spec.task)
    log_params(spark, root, run_id, spec.model_params)
    log_metrics(spark, root, run_id, found)
    models.save_model(model, root, version)
    write_contract(train.drop(spec.label), f"{root.rstrip('/')}/feature_schema_v{version}")


def train_job(mart: DataFrame, root: str, version: str, spec: Spec, run_name: str = "train", **sizes: float) -> dict[str, float]:
    """Train, measure on the validation and test sets, log and save."""
    train, val, test = prepare(mart, spec, **sizes)
    model = fit_pipeline(train, val, spec)
    found = {**evaluate(model, val, spec, "final_val_")[0], **evaluate(model, test, spec, "test_")[0]}
    _save(model, train, root, version, spec, run_name, found)
    return found


def tune_and_train_job(
    mart: DataFrame,
    root: str,
    version: str,
    spec: Spec,
    space: dict,
    trials: int,
    seed: int = C.SEED,
    direction: str | None = None,
    threads: int = 1,
    rungs: Sequence[dict] = ({},),
    **sizes: float,
) -> dict[str, float]:
    """Search for the best parameters, log all trials, then train once more with the best ones and save."""
    train, val, test = prepare(mart, spec, **sizes)
    best, history = tune_job(train, val, spec, space, trials, seed, direction, threads, rungs)
    trials_table(mart.sparkSession, history).write.mode("overwrite").parquet(f"{root.rstrip('/')}/trials_v{version}")
    if best is None:
        raise ValueError("every trial failed: see the trials table")
    drawn = dict(best)
    weight = drawn.pop("positive_weight", spec.positive_weight)
    tuned = replace(spec, model_params={**spec.model_params, **drawn}, positive_weight=weight)
    model = fit_pipeline(train, val, tuned)
    found = {**evaluate(model, val, tuned, "best_val_")[0], **evaluate(model, test, tuned, "test_")[0]}
    _save(model, train, root, version, tuned, "tune", found)
    return found


def evaluate_job(mart: DataFrame, root: str, version: str, spec: Spec, **sizes: float) -> tuple[dict[str, float], DataFrame]:
    """Metrics and error table of a saved model on the test set; the split repeats, so it is the same set."""
    _, _, test = prepare(mart, spec, **sizes)
    return evaluate(models.load_model(root, version), test, spec, "test_")


def tune_job(
    train: DataFrame,
    val: DataFrame,
    spec: Spec,
    space: dict,
    trials: int,
    seed: int = C.SEED,
    direction: str | None = None,
    threads: int = 1,
    rungs: Sequence[dict] = ({},),
) -> tuple[dict | None, list]:
    """Random search. Preparation and encoding do not depend on the drawn parameters: vectors are made and written once.

    ``threads`` trials run side by side, each in a scheduler pool of its own (pools share the cluster where
    ``spark.scheduler.mode`` is FAIR). ``rungs`` end weak trials early, see ``random_search``.
    Without a direction the metric decides.
    """
    spark = train.sparkSession
    models.allow_checkpoints(spark)
    stages, cleaned = fit_preparation(train, spec)
    staged = stage(cleaned, "tuning")
    cleaned.unpersist()
    numbers, categories = split_columns(staged, spec)
    clean_val = PipelineModel(stages=stages).transform(val)
    order_keys = spec.keys if spec.target_statistics else None
    encoded = models.encode(staged, numbers, categories, spec.model, spec.task, spec.label, clean_val, order_keys)
    encoded = replace(encoded, vectors=stage(encoded.vectors, "vectors"))
    val_vectors = encoded.vectors.filter("is_val")

    def objective(params: dict) -> float:
        drawn = {**spec.model_params, **params}
        weight = drawn.pop("positive_weight", spec.positive_weight)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{get_ident()}" if threads > 1 else None)
        fitted = models.fit_encoded(encoded, spec.model, spec.task, spec.label, weight, **drawn)
        return models.best_val_score(fitted, val_vectors, spec.label, spec.task, spec.metric)

    encoded.vectors.persist()
    try:
        return random_search(objective, space, trials, direction or direction_of(spec.metric), seed, threads, rungs)
    finally:
        encoded.vectors.unpersist()


def score_job(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    version: str,
    out: str,
    file_format: str = "parquet",
    keys: list[str] | None = None,
    drop_sparse: bool = False,
) -> DataFrame:
    """Load a saved model, check the input against its contract and save scores with their keys."""
    contract = read_contract(spark, f"{root.rstrip('/')}/feature_schema_v{version}")
    require_columns(df, contract)
    model = models.load_model(root, version)
    rows = drop_sparse_rows(df) if drop_sparse else df
    scored = models.score(model, rows, keys or KEYS)
    write_predictions(scored, out, file_format)
    reader = spark.read.schema(scored.schema)
    return (reader.option("header", True) if file_format == "csv" else reader).format(file_format).load(out)
