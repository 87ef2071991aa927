from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.operators import models
from clickloom.operators.target_statistics import fit_target_statistics, ordered_targets
from clickloom.plans import training as T


@pytest.fixture(scope="module")
def rows(spark):
    kind = "CASE WHEN id % 10 < 6 THEN 'hot' WHEN id % 10 = 6 THEN NULL ELSE concat('k', id % 37) END AS kind"
    return spark.range(900).selectExpr("id", kind, "concat('u', id) AS own", "cast(id % 3 = 0 OR id % 10 = 8 AS int) AS y", "cast(id % 5 AS double) AS x").repartition(4)


def plain(rows, column, strength):
    seen = sorted(rows, key=lambda r: (int(hashlib.md5(f"{r['id']}|42".encode()).hexdigest()[:13], 16) / (1 << 52), r["id"]))
    overall = sum(r["y"] for r in rows) / len(rows)
    n, total, out = defaultdict(int), defaultdict(float), {}
    for r in seen:
        value = r[column]
        out[r["id"]] = overall if value is None else (total[value] + overall * strength) / (n[value] + strength)
        n[value] += 1
        total[value] += r["y"]
    return out


@pytest.mark.parametrize("strength", [1.0, 5.0])
@pytest.mark.parametrize("slice_rows", [7, 100, 10_000])
def test_against_one_pass_in_order(rows, strength, slice_rows):
    found = ordered_targets(rows, ["kind", "own"], "y", ["id"], strength=strength, slice_rows=slice_rows).collect()
    assert len(found) == 900
    for c in ("kind", "own"):
        want = plain(rows.collect(), c, strength)
        assert all(abs(r[f"{c}_target"] - want[r["id"]]) < 1e-12 for r in found)


def test_layout_changes_nothing(rows):
    one, many = (sorted(map(tuple, ordered_targets(r, ["kind"], "y", ["id"], slice_rows=50).collect())) for r in (rows.coalesce(1), rows.repartition(9)))
    assert one == many


def test_unseen_and_missing_values_get_the_overall_mean(spark, rows, tmp_path):
    model = fit_target_statistics(rows, ["kind"], "y")
    overall = rows.agg(F.avg("y")).first()[0]
    new = spark.createDataFrame([(1, "hot"), (2, "never seen"), (3, None)], "id long, kind string")
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, type(model).load(str(tmp_path / "m"))):
        got = {r["id"]: r["kind_target"] for r in m.transform(new).collect()}
        hot = rows.where("kind = 'hot'").agg(F.sum("y"), F.count("*")).first()
        assert abs(got[1] - (hot[0] + overall) / (hot[1] + 1)) < 1e-12
        assert abs(got[2] - overall) < 1e-12 and abs(got[3] - overall) < 1e-12


def test_empty_table(rows):
    assert ordered_targets(rows.where("false"), ["kind"], "y", ["id"]).columns == [*rows.columns, "kind_target"]
    assert ordered_targets(rows.where("false"), ["kind"], "y", ["id"]).count() == 0


def test_a_hot_category_is_spread_over_tasks(rows):
    """No window partition holds more than a slice of the category with most rows."""
    narrow = rows.withColumn("slice", F.floor(F.conv(F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("42")).cast("binary")), 1, 13), 16, 10).cast("double") / (1 << 52) * 18))
    assert narrow.where("kind = 'hot'").groupBy("slice").count().agg(F.max("count")).first()[0] < 60


def test_trees_learn_from_targets_and_score_unseen_values(spark, rows, tmp_path):
    train, val = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    settings = {"maxIter": 5, "maxDepth": 3, "seed": 1}
    model = models.fit_model(train, ["x"], ["kind", "own"], "boosted_trees", "binary", "y", val, order_keys=["id"], **settings)
    scored = models.score(model, val.withColumn("own", F.lit("unseen")), ["id", "y"])
    assert scored.count() == val.count()
    path = models.save_model(model, str(tmp_path), "1")
    again = models.load_model(str(tmp_path), "1")
    same = models.score(again, val, ["id"]).join(models.score(model, val, ["id"]).withColumnRenamed("probability", "p"), "id")
    assert path and same.where("probability <> p").count() == 0
    # a column with one value per row tells nothing about later rows and must not be learned by heart
    importance = {r["feature"]: r["importance"] for r in models.importance_table(model, train).collect()}
    assert importance["own_target"] == 0.0


def test_spec_of_a_training_job(rows):
    cleaned = rows.withColumnRenamed("y", "event_value").withColumn("session_id", F.col("id").cast("string")).withColumn("client_id", F.col("id").cast("string")).drop("id", "own")
    spec = T.Spec(model_params={"maxIter": 4, "maxDepth": 2, "seed": 1}, target_statistics=True, keep_best=True)
    train, val = cleaned.where("x < 3"), cleaned.where("x >= 3")
    model = T.fit_pipeline(train, val, spec, ([], train))
    assert 1 <= len(model.stages[-1].treeWeights) <= 4
    assert models.score(model, val, spec.keys).count() == val.count()
