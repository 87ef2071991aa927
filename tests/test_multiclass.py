"""Boosted trees for several classes and text labels."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickloom.operators import models, multiclass
from clickloom.operators import tracking as K
from clickloom.plans import training as T

KINDS = ["buyer", "guest", "reader"]


@pytest.fixture(scope="module")
def mart(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        hits, device = rng.randrange(1, 40), rng.choice(["mobile", "desktop", "tablet"])
        kind = "buyer" if hits > 28 else "guest" if device == "mobile" else "reader"
        kind = rng.choice(KINDS) if rng.random() < 0.1 else kind
        rows.append((f"s{i}", f"c{i % 300}", "2024-01-0%d" % (i % 9 + 1), "10:00:00", device, hits, kind))
    return spark.createDataFrame(
        rows, "session_id string, client_id string, visit_date string, visit_time string, device_category string, total_hits_count bigint, kind string"
    )


SPEC = T.Spec(task="multiclass", label="kind", metric="roc_auc_ovr", model_params={"maxIter": 4, "maxDepth": 3, "seed": 1})


def test_job_on_text_labels(spark, mart, tmp_path):
    root = str(tmp_path)
    found = T.train_job(mart, root, "1", SPEC)
    assert found["test_roc_auc_ovr"] > 0.85 and found["test_accuracy"] > 0.8 and found["final_val_roc_auc_ovr"] > 0.85
    logged = {r.key: r.value for r in K.read_log(spark, root, "metrics").collect()}
    assert logged["test_roc_auc_ovr"] == found["test_roc_auc_ovr"]
    again, errors = T.evaluate_job(mart, root, "1", SPEC)
    assert again == {k: v for k, v in found.items() if k.startswith("test_")}
    assert {r[0] for r in errors.select("predicted").distinct().collect()} <= set(KINDS)
    scored = T.score_job(spark, mart.drop("kind"), root, "1", f"{root}/scores")
    assert scored.columns == [*T.KEYS, "prediction", "predicted_label", "confidence"]
    assert scored.filter("confidence < 1 / 3.0 OR confidence > 1").isEmpty() and scored.count() == 900
    pairs = {tuple(r) for r in scored.select("prediction", "predicted_label").distinct().collect()}
    assert pairs == {(float(i), k) for i, k in enumerate(KINDS)}


def test_saved_scores_and_importance(mart, tmp_path):
    train, val, test = T.prepare(mart, SPEC)
    model = T.fit_pipeline(train, val, SPEC)
    models.save_model(model, str(tmp_path), "1")
    loaded = models.load_model(str(tmp_path), "1")
    ours, theirs = (sorted(map(tuple, models.score(m, test, T.KEYS).collect())) for m in (model, loaded))
    assert ours == theirs and models.n_classes(loaded) == 3 and models.label_names(loaded) == KINDS
    table = {r.feature: r.importance for r in models.importance_table(loaded, train).collect()}
    assert max(table, key=table.get).startswith(("total_hits", "device")) and sum(table.values()) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(2)
    rows = [(i, rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    df = df.withColumn("y", F.when(F.col("a") > 0.6, 0).when(F.col("b") > 0.5, 1).otherwise(3))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).persist()


def test_shares_are_the_normalised_sigmoids_of_plain_models(vectors):
    params = {"maxIter": 3, "maxDepth": 2, "seed": 4}
    model = multiclass.BoostedClasses(labelCol="y", **params).fit(vectors)
    assert model.numClasses == 4  # class 2 has no rows
    found = {r.i: r for r in model.transform(vectors).collect()}
    want = {i: [] for i in found}
    for k in range(4):
        plain = GBTClassifier(labelCol="is", **params).fit(vectors.withColumn("is", (F.col("y") == k).cast("double")))
        for r in plain.transform(vectors).collect():
            want[r.i].append(1 / (1 + math.exp(-2 * r.rawPrediction[1])))
    for i, row in found.items():
        shares = [x / sum(want[i]) for x in want[i]]
        assert list(row.probability) == pytest.approx(shares, abs=1e-12)
        assert row.prediction == shares.index(max(shares)) != 2
    assert set(model.transform(vectors).columns) == {*vectors.columns, "probability", "prediction"}


def test_odd_labels(spark, vectors):
    with pytest.raises(ValueError, match="no labelled rows"):
        multiclass.BoostedClasses(labelCol="y").fit(vectors.limit(0))
    with pytest.raises(ValueError, match="at most"):
        multiclass.BoostedClasses(labelCol="y").fit(vectors.withColumn("y", F.lit(multiclass.MOST_CLASSES)))
    rows = spark.createDataFrame([(float(i % 10), ["x", "y", "z", None][i % 4]) for i in range(80)], "a double, y string")
    with pytest.raises(ValueError, match="multiclass"):
        models.fit_model(rows, ["a"], [], label="y")
    unseen = spark.createDataFrame([(1.0, "new"), (2.0, None), (3.0, "x")], "a double, y string")
    model = models.fit_model(rows, ["a"], [], "boosted_trees", "multiclass", "y", unseen, maxIter=2, maxDepth=1, seed=1)
    assert models.label_names(model) == ["x", "y", "z"]
    assert models.score(model, unseen).count() == 3
    forest = models.fit_model(rows, ["a"], [], "random_forest", "multiclass", "y", numTrees=2, seed=1)
    assert {r.predicted_label for r in models.score(forest, rows).collect()} <= {"x", "y", "z"}
