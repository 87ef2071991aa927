"""Training, scoring, saving, tuning and explaining on a small learnable table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import explain, models, tuning
from clickloom.operators import tracking as K
from clickloom.operators.encoding import one_hot, ordinal_domain, ordinal_encode, ranged_domain
from clickloom.plans import training as T
from clickloom.sources.schemas import read_contract
from clickloom.streaming import jobs, sinks


@pytest.fixture(scope="module")
def mart(spark):
    rng = random.Random(42)
    rows = []
    for i in range(900):
        hits = rng.randrange(1, 40)
        device = rng.choice(["mobile", "desktop", "tablet"])
        y = int(rng.random() < (0.8 if hits > 25 else 0.1) * (1.0 if device == "desktop" else 0.7))
        rows.append((f"s{i}", f"c{i % 300}", "2024-01-0%d" % (i % 9 + 1), "10:00:00", device, rng.choice(["Apple", "Samsung", None]), hits, y))
    schema = (
        "session_id string, client_id string, visit_date string, visit_time string, device_category string, device_brand string, "
        "total_hits_count bigint, event_value int"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def frames(mart):
    return T.prepare(mart, T.Spec())


@pytest.fixture(scope="module")
def trees(frames):
    spec = T.Spec(model_params={"maxIter": 5, "maxDepth": 3, "seed": 1}, positive_weight=2.0)
    return T.fit_pipeline(frames[0], frames[1], spec), spec


def test_probabilities_and_quality(frames, trees):
    model, spec = trees
    scored = models.score(model, frames[2], T.KEYS)
    assert scored.columns == [*T.KEYS, "prediction", "probability", "confidence"]
    assert scored.count() == frames[2].count()
    assert scored.filter("probability < 0 OR probability > 1 OR confidence < 0.5").isEmpty()
    found, errors = T.evaluate(model, frames[2], spec, "test_")
    assert found["test_roc_auc"] > 0.7 and set(found) == {"test_accuracy", "test_f1_weighted", "test_roc_auc"}
    assert "confidence_of_mistake" in errors.columns


def test_scoring_a_batch_equals_scoring_row_by_row(frames, trees):
    model, _ = trees
    rows = frames[2].orderBy("session_id").limit(3)
    whole = {r.session_id: r.probability for r in models.score(model, rows, T.KEYS).collect()}
    for key, probability in whole.items():
        alone = models.score(model, rows.filter(F.col("session_id") == key), T.KEYS).first()
        assert alone.probability == pytest.approx(probability)


def test_same_seed_same_model(frames, trees):
    model, spec = trees
    again = T.fit_pipeline(frames[0], frames[1], spec)
    a, b = ({r.session_id: r.probability for r in models.score(m, frames[2], T.KEYS).collect()} for m in (model, again))
    assert a == pytest.approx(b)


def test_odd_rows_still_get_scores(spark, frames, trees):
    model, _ = trees
    schema = frames[2].schema
    rows = [tuple(None for _ in schema), tuple(["x", "y", "no date", "99:99:99", "fridge", "Nokia", 10**15, 0][: len(schema)])]
    odd = spark.createDataFrame([rows[0], rows[1] + (None,) * (len(schema) - len(rows[1]))], schema)
    assert models.score(model, odd, T.KEYS).filter("probability IS NOT NULL").count() == 2


def test_importance(frames, trees):
    model, _ = trees
    table = models.importance_table(model, frames[0])
    assert table.first()["feature"] == "total_hits_count"
    assert models.top_features(table, 2).count() == 2
    assert models.bottom_features(table, 1).first()["importance"] == table.agg(F.min("importance")).first()[0]


def test_unknown_models_and_tasks(frames):
    with pytest.raises(ValueError):
        models.make_estimator("oracle")
    with pytest.raises(ValueError):
        models.make_estimator("linear", "ranking")
    with pytest.raises(ValueError):
        models.make_estimator("network", "regression")
    with pytest.raises(ValueError):
        models.score(models.make_estimator("linear"), frames[0])


def test_train_and_score_jobs(spark, mart, tmp_path):
    root = str(tmp_path)
    spec = T.Spec(model="linear", model_params={"maxIter": 10})
    found = T.train_job(mart, root, "1.0", spec)
    assert {"final_val_roc_auc", "test_roc_auc"} <= set(found)
    logged = {r["key"]: r["value"] for r in K.read_log(spark, root, "metrics").collect()}
    assert logged == pytest.approx(found)
    assert K.read_log(spark, root, "runs").first()["tags"]["version"] == "1.0"
    contract = read_contract(spark, f"{root}/feature_schema_v1.0")
    assert contract["total_hits_count"] == "bigint" and "event_value" not in contract
    new = mart.drop("event_value")
    returned = T.score_job(spark, new.withColumn("split", F.lit("x")), root, "1.0", f"{root}/out", "csv")
    assert returned.count() == 900 and all(f.endswith(".csv") for f in returned.inputFiles())
    saved = spark.read.option("header", True).csv(f"{root}/out")
    assert saved.count() == 900 and {"session_id", "client_id", "prediction", "probability"} <= set(saved.columns)
    with pytest.raises(ValueError):
        T.score_job(spark, new.drop("total_hits_count"), root, "1.0", f"{root}/out2")


def test_tune_train_and_evaluate_jobs(spark, mart, tmp_path):
    root = str(tmp_path)
    spec = T.Spec(model="random_forest", model_params={"numTrees": 3, "seed": 1})
    space = {"maxDepth": {"type": "int", "bounds": [2, 4]}, "positive_weight": {"type": "float", "bounds": [1.0, 3.0]}}
    found = T.tune_and_train_job(mart, root, "2", spec, space, trials=2)
    assert spark.read.parquet(f"{root}/trials_v2").count() == 2
    again, errors = T.evaluate_job(mart, root, "2", spec)
    assert again == pytest.approx({k: v for k, v in found.items() if k.startswith("test_")})
    assert {"actual", "predicted", "is_error", "probability"} <= set(errors.columns)
    with pytest.raises(ValueError):
        T.tune_and_train_job(mart, root, "3", T.Spec(model="no such model"), space, trials=1)


def test_error_metrics_pick_the_lowest_trial(frames):
    spec = T.Spec(model="linear", task="regression", label="total_hits_count", metric="rmse")
    best, history = T.tune_job(frames[0], frames[1], spec, {"regParam": {"type": "float", "bounds": [0.0, 80.0]}}, trials=3)
    assert T.direction_of("rmse") == "minimize" and T.direction_of("roc_auc") == "maximize"
    assert best == min(history, key=lambda h: h[1])[2]


def test_multiclass_job_logs_an_area(spark, mart, tmp_path):
    rows = mart.withColumn("kind", F.pmod("total_hits_count", F.lit(3)).cast("int"))
    spec = T.Spec(model="random_forest", task="multiclass", label="kind", model_params={"numTrees": 3, "seed": 1})
    found = T.train_job(rows, str(tmp_path), "m", spec)
    assert 0.5 < found["test_roc_auc_ovr"] <= 1 and 0.5 < found["final_val_roc_auc_ovr"] <= 1
    scored = models.score(models.load_model(str(tmp_path), "m"), rows)
    assert "probability" not in scored.columns and scored.agg(F.min("confidence")).first()[0] >= 1 / 3


def test_the_network_takes_no_class_weight(frames):
    with pytest.raises(ValueError, match="class weight"):
        T.fit_pipeline(frames[0], None, T.Spec(model="network", model_params={"maxIter": 1}, positive_weight=2.0))


def test_streamed_scores_equal_batch_scores(spark, frames, trees, tmp_path):
    model, _ = trees
    incoming = str(tmp_path / "in")
    frames[2].repartition(3).write.parquet(incoming)
    stream = sinks.read_files(spark, incoming, frames[2].schema, files_per_batch=1)
    scored = jobs.score_new_files(stream, model, T.KEYS, str(tmp_path / "out"), str(tmp_path / "progress"))
    batch = models.score(model, frames[2], T.KEYS)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, batch.collect()))


def test_contributions_add_up_to_the_score(frames):
    spec = T.Spec(model="linear", model_params={"maxIter": 10})
    model = T.fit_pipeline(frames[0], None, spec)
    parts, names = explain.contributions(model, frames[1], T.KEYS)
    scored = model.transform(frames[1]).select("session_id", "rawPrediction")
    joined = parts.join(scored, "session_id").collect()
    margins = [r["rawPrediction"][1] - sum(r["contributions"]) for r in joined]
    assert max(margins) - min(margins) == pytest.approx(0.0, abs=1e-6)
    ranking = explain.mean_contributions(parts, names)
    assert ranking.count() == len(names)
    one = parts.limit(1)
    assert explain.explain_rows(one, names, T.KEYS).count() == len(names)
    assert explain.dependence(parts, names, "total_hits_count", 4).agg(F.sum("n")).first()[0] == frames[1].count()


def test_permutation_importance_finds_the_signal(frames, trees):
    model, _ = trees
    table = explain.permutation_importance(model, frames[2], ["total_hits_count", "device_brand"], "event_value", T.KEYS)
    assert table.first()["feature"] == "total_hits_count" and table.first()["importance"] > 0.1


def test_random_search_and_failed_trials(spark):
    space = {
        "a": {"type": "int", "bounds": [1, 9]},
        "b": {"type": "float", "bounds": [0.001, 10.0], "log": True},
        "c": {"type": "float", "bounds": [0.0, 1.0]},
    }

    def objective(p):
        if p["a"] == 5:
            raise RuntimeError("no luck")
        return -((p["a"] - 3) ** 2)

    best, history = tuning.random_search(objective, space, 60)
    assert best["a"] == 3 and len(history) == 60
    assert any(h[3] == "no luck" for h in history)
    assert all(0.001 <= h[2]["b"] <= 10.0 for h in history)
    assert tuning.random_search(objective, space, 60)[1] == history
    assert tuning.trials_table(spark, history).filter("error IS NOT NULL").count() == sum(h[3] is not None for h in history)


def test_tuning_reuses_the_preparation(frames):
    spec = T.Spec(model_params={"maxIter": 2, "seed": 1})
    best, history = T.tune_job(frames[0], frames[1], spec, {"maxDepth": {"type": "int", "bounds": [1, 3]}}, 2)
    assert best["maxDepth"] in (1, 2, 3) and all(h[1] > 0.5 for h in history)


def test_trials_side_by_side_find_the_same(frames, monkeypatch):
    encoded = []
    monkeypatch.setattr(models, "encode", lambda *a, made=models.encode: encoded.append(1) or made(*a))
    spec = T.Spec(model_params={"seed": 1})
    space = {"maxDepth": {"type": "int", "bounds": [1, 4]}, "positive_weight": {"bounds": [1.0, 3.0]}}
    rungs = [{"maxIter": 1}, {"maxIter": 3}]
    found = [T.tune_job(frames[0], frames[1], spec, space, 4, threads=t, rungs=rungs) for t in (1, 4)]
    assert found[0] == found[1] and len(encoded) == 2
    best, history = found[0]
    assert [h[0] for h in history] == [0, 1, 2, 3] and best["maxIter"] == 3
    assert sorted(h[2]["maxIter"] for h in history) == [1, 1, 3, 3]


def test_rungs_keep_the_better_half():
    space = {"x": {"type": "float", "bounds": [0.0, 1.0]}}
    asked = []

    def objective(p):
        asked.append(p["n"])
        if p["n"] == 1 and p["x"] > 0.9:
            raise ValueError("too large")
        return p["x"] * p["n"]

    best, history = tuning.random_search(objective, space, 9, seed=3, rungs=[{"n": 1}, {"n": 2}, {"n": 4}])
    scored = sorted((h[2]["x"] for h in history if h[3] is None), reverse=True)
    half = (len(scored) + 1) // 2
    assert asked == [1] * 9 + [2] * half + [4] * ((half + 1) // 2)
    assert best == {"x": scored[0], "n": 4}
    assert tuning.random_search(lambda p: float("nan"), space, 2)[0] is None


def test_encoders(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    new = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    assert [r.x for r in ordinal_encode(train, new, ["x"]).collect()] == [0.0, 1.0, -1.0, 2.0]
    hot = one_hot(train.na.fill("nan"), ["x"]).transform(new.na.fill("nan"))
    assert [list(r.x_hot.toArray()) for r in hot.collect()] == [[1, 0, 0], [0, 1, 0], [0, 0, 0], [0, 0, 1]]


def test_ordinal_domain_of_keys_with_a_common_prefix(spark):
    keys = [f"user_of_the_first_shop_{i:06d}" for i in range(5_000)]
    train = spark.createDataFrame([(k,) for k in keys for _ in range(2)], "x string")
    domain = ordinal_domain(train, ["x"])
    assert [r.place for r in domain.orderBy("value").collect()] == list(range(5_000))
    slices = ranged_domain(train, ["x"]).groupBy("slice").count().collect()
    assert len(slices) > 4 and max(r["count"] for r in slices) < 1_500


def test_other_families(frames):
    train = frames[0]
    for name, params in (("random_forest", {"numTrees": 3, "seed": 1}), ("network", {"maxIter": 10, "seed": 1})):
        spec = T.Spec(model=name, model_params=params)
        model = T.fit_pipeline(train, None, spec)
        assert models.score(model, frames[1], T.KEYS).count() == frames[1].count()
        assert models.best_val_score(model, frames[1], "event_value") > 0.5
    spec = T.Spec(model="linear", task="regression", label="total_hits_count", model_params={"maxIter": 5})
    model = T.fit_pipeline(train, None, spec)
    assert models.best_val_score(model, frames[1], "total_hits_count", "regression") <= 1.0


def test_preparation_is_worked_out_once_and_serves_several_models(spark, frames):
    prepared = T.fit_preparation(frames[0], T.Spec())
    assert prepared[1].storageLevel.useMemory and prepared[1].count() == frames[0].count()
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    for settings in ({"model": "linear", "model_params": {"maxIter": 5}}, {"model_params": {"maxIter": 2, "maxDepth": 2, "seed": 1}}):
        alone, shared = (T.fit_pipeline(frames[0], frames[1], T.Spec(**settings), p) for p in (None, prepared))
        a, b = ({r.session_id: r.probability for r in models.score(m, frames[2], T.KEYS).collect()} for m in (alone, shared))
        assert a == pytest.approx(b, abs=1e-9)
    assert prepared[1].storageLevel.useMemory and len(spark.sparkContext._jsc.getPersistentRDDs()) <= kept
    prepared[1].unpersist()
