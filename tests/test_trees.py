"""Contributions of trees against the definition over all coalitions, margins per iteration, and models cut to the best one."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickloom.operators import explain, models, trees

KEYS = ["id"]


@pytest.fixture(scope="module")
def rows(spark):
    numbers = ["cast(id % 7 as double) as a", "cast((id * 31) % 11 as double) as b", "cast((id * 17) % 5 as double) as c", "cast((id * 13) % 23 as double) as d"]
    kind = "concat('k', cast((id * 7) % 6 as string)) as kind"
    label = "cast((id % 7 > 3 and (id * 31) % 11 < 6) or ((id * 7) % 6 in (1, 4) and id % 3 = 0) as int) as y"
    return spark.range(600).selectExpr("id", *numbers, kind, label).repartition(3)


def fitted(rows, name, task="binary", label="y", **params):
    defaults = {"maxIter": 6} if name == "boosted_trees" else {"numTrees": 4}
    return models.fit_model(rows, ["a", "b", "c", "d"], ["kind"], name, task, label, maxDepth=4, seed=3, **defaults, **params)


def by_definition(leaves, x):
    """Shapley values of one row from the values of all coalitions."""
    width = len(x)

    def value(coalition):
        total = 0.0
        for leaf in leaves:
            share = leaf.value
            for step in leaf.steps:
                share *= float(step.followed(x[None])[0]) if step.feature in coalition else step.share
            total += share
        return total

    values = {s: value(s) for k in range(width + 1) for s in itertools.combinations(range(width), k)}
    out = np.zeros(width)
    for f in range(width):
        rest = [g for g in range(width) if g != f]
        for k in range(width):
            for s in itertools.combinations(rest, k):
                weight = math.factorial(k) * math.factorial(width - k - 1) / math.factorial(width)
                out[f] += weight * (values[tuple(sorted((*s, f)))] - values[s])
    return out


@pytest.mark.parametrize(("name", "task", "label"), [("boosted_trees", "binary", "y"), ("random_forest", "binary", "y"), ("boosted_trees", "regression", "d"), ("random_forest", "regression", "d")])
def test_contributions_are_shapley_values_and_add_up(rows, name, task, label):
    model = fitted(rows, name, task, label)
    parts, names, base = trees.tree_contributions(model, rows, KEYS)
    leaves = trees.leaves_of(model.stages[-1])
    column = {"boosted_trees": "rawPrediction", "random_forest": "probability"}[name]
    margin = vector_to_array(column)[1] if task == "binary" else F.col("prediction")
    margins = {r["id"]: r["m"] for r in model.transform(rows).select("id", margin.alias("m")).collect()}
    found = parts.withColumn("x", vector_to_array("features")).collect()
    assert len(found) == 600 and len(names) == 5
    for r in found:
        assert abs(base + sum(r["contributions"]) - margins[r["id"]]) < 1e-9
    for r in found[:12]:
        assert np.allclose(r["contributions"], by_definition(leaves, np.array(r["x"])), atol=1e-9)


def test_base_value_is_the_mean_over_the_training_rows(rows):
    model = fitted(rows, "random_forest", "regression", "d", bootstrap=False)
    _, _, base = trees.tree_contributions(model, rows, KEYS)
    assert abs(base - model.transform(rows).agg(F.avg("prediction")).first()[0]) < 1e-9


def test_reports_take_the_contributions_of_trees(rows):
    model = fitted(rows, "boosted_trees")
    parts, names, _ = trees.tree_contributions(model, rows, KEYS)
    ranking = explain.mean_contributions(parts, names).collect()
    assert {r["feature"] for r in ranking[:2]} == {"a", "b"} and len(ranking) == 5
    assert explain.dependence(parts, names, "a", 4).agg(F.sum("n")).first()[0] == 600
    assert explain.explain_rows(parts.where("id = 5"), names, KEYS).count() == 5


def test_margins_after_each_iteration(rows):
    model = fitted(rows, "boosted_trees")
    margins = {r["id"]: r["margins"] for r in trees.prefix_margins(model, rows, KEYS).collect()}
    for k in (1, 3, 6):
        cut = trees.cut_model(model, k)
        for r in cut.transform(rows).select("id", vector_to_array("rawPrediction")[1].alias("m"), "prediction").collect():
            assert abs(margins[r["id"]][k - 1] - r["m"]) < 1e-9


def test_layout_changes_nothing(rows):
    model = fitted(rows, "boosted_trees")
    one = trees.tree_contributions(model, rows.coalesce(1), KEYS)[0].select("id", "contributions")
    many = trees.tree_contributions(model, rows.repartition(9), KEYS)[0].select("id", "contributions")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_the_best_iteration_is_kept_and_saves(spark, rows, tmp_path):
    train, val = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    model = fitted(train, "boosted_trees")
    best, areas = trees.fit_to_best(model, val, "y")
    table = {r["iteration"]: r["auc"] for r in areas.collect()}
    assert sorted(table) == [1, 2, 3, 4, 5, 6]
    kept = len(best.stages[-1].treeWeights)
    assert table[kept] == max(table.values()) and all(table[k] < table[kept] - 1e-10 for k in range(1, kept))
    path = models.save_model(best, str(tmp_path), "1")
    again = models.load_model(str(tmp_path), "1")
    assert path.endswith("model_v1") and len(again.stages[-1].treeWeights) == kept
    columns = ["id", "prediction", "probability"]
    assert sorted(map(str, again.transform(val).select(columns).collect())) == sorted(map(str, best.transform(val).select(columns).collect()))


def test_errors(rows):
    forest = fitted(rows, "random_forest")
    with pytest.raises(ValueError, match="only boosted trees"):
        trees.cut_model(forest, 1)
    with pytest.raises(ValueError, match="1 to 6 iterations"):
        trees.cut_model(fitted(rows, "boosted_trees"), 7)
    three = models.fit_model(rows.withColumn("z", F.col("id") % 3), ["a", "b"], [], "random_forest", "multiclass", "z", numTrees=2)
    with pytest.raises(ValueError, match="two classes"):
        trees.leaves_of(three.stages[-1])


def test_missing_numbers_go_right():
    step = trees.Step(0, low=1.0)
    assert step.followed(np.array([[np.nan], [1.0], [2.0]])).tolist() == [True, False, True]
    assert trees.Step(0, high=1.0).followed(np.array([[np.nan], [1.0], [2.0]])).tolist() == [False, True, False]


def test_equal_margins_of_a_batch_leave_the_task_added_up():
    margins = np.array([[0.5, 1.0], [0.5, 2.0], [0.25, 1.0], [0.5, 1.0]])
    found = trees._counted_margins(margins, np.array([1.0, 0.0, 1.0, np.nan])).to_pylist()
    assert [tuple(r.values()) for r in found] == [(1, 0.25, 1, 0), (1, 0.5, 1, 1), (2, 1.0, 2, 0), (2, 2.0, 0, 1)]
