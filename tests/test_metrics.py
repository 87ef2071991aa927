"""Metrics, error tables and associations against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import eda
from clickloom.operators import errors as R
from clickloom.operators import metrics as Q


def scored(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = round(rng.random(), 2)
        actual = int(rng.random() < p)
        rows.append((i, actual, int(p >= 0.5), p, rng.choice(["a", "a", "a", "b", None])))
    return rows, spark.createDataFrame(rows, "id int, actual int, predicted int, probability double, cat string")


def brute_auc(pairs):
    ones = [p for y, p in pairs if y]
    zeros = [p for y, p in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("limit", [10**6, 5])
def test_auc_with_ties(spark, limit):
    rows, df = scored(spark)
    assert Q.auc_exact(df, one_task_scores=limit).first()[0] == pytest.approx(brute_auc([(r[1], r[3]) for r in rows]))


def test_auc_of_one_class_is_undefined(spark, caplog):
    df = scored(spark)[1].filter("actual = 1")
    assert Q.auc_exact(df).first()[0] is None
    with caplog.at_level("WARNING"):
        found = Q.metrics(df, probability="probability")
    assert "roc_auc" not in found and "undefined" in caplog.text


def test_one_against_rest(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), *[round(rng.random(), 1) for _ in range(3)]) for _ in range(200)]
    df = spark.createDataFrame(rows, "label string, px double, py double, pz double")
    areas = {r["class"]: r["auc"] for r in Q.auc_ovr(df, "label", {"x": "px", "y": "py", "z": "pz"}).collect()}
    for i, c in enumerate("xyz"):
        assert areas[c] == pytest.approx(brute_auc([(r[0] == c, r[1 + i]) for r in rows]))
    macro = Q.auc_ovr_macro(df, "label", {"x": "px", "y": "py", "z": "pz"}).first()[0]
    assert macro == pytest.approx(sum(areas.values()) / 3)
    assert Q.auc_ovr_macro(df, "label", {"x": "px", "w": "py"}).first()[0] is None


def test_class_report(spark):
    df = spark.createDataFrame([(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 1)] * 2, "actual int, predicted int")
    report = {r["class"]: r for r in Q.class_report_full(df).collect()}
    assert report["0"]["precision"] == pytest.approx(5 / 6) and report["0"]["recall"] == pytest.approx(5 / 7)
    assert (report["2"]["precision"], report["2"]["recall"], report["2"]["f1"], report["2"]["support"]) == (0.0, 0.0, 0.0, 2)
    one = Q.classification_scores(df).first()
    assert one["accuracy"] == round(8 / 13, 4)
    f1 = {"0": 2 * 5 / 13, "1": 2 * 3 / 11, "2": 0.0}
    assert one["f1_weighted"] == round((7 * f1["0"] + 4 * f1["1"]) / 13, 4)


def test_regression(spark):
    rows = [(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)]
    one = Q.metrics(spark.createDataFrame(rows, "actual double, predicted double"), task="regression")
    mean = 7 / 3
    assert one["rmse"] == round(math.sqrt(2 / 3), 4) and one["mae"] == round(2 / 3, 4)
    assert one["r2"] == round(1 - 2 / sum((y - mean) ** 2 for y, _ in rows), 4)
    with pytest.raises(ValueError):
        Q.metrics(spark.range(1), task="ranking")


def test_worst_cases_and_report(spark, tmp_path):
    rows, df = scored(spark)
    errors = R.error_table(df.drop("predicted").withColumn("p", F.col("probability")), "actual", "actual").drop("p")
    assert errors.filter("is_error = 1").isEmpty()
    errors = R.error_table(df.withColumnRenamed("predicted", "guess"), "actual", "guess")
    worst = R.worst_cases(errors, ["id"])
    got = [(r["prediction_type"], r["id"]) for r in worst.collect()]
    fp = sorted((r for r in rows if r[1] == 0 and r[2] == 1), key=lambda r: (-r[3], r[0]))[:5]
    fn = sorted((r for r in rows if r[1] == 1 and r[2] == 0), key=lambda r: (r[3], r[0]))[:5]
    assert sorted(got) == sorted([("FP", r[0]) for r in fp] + [("FN", r[0]) for r in fn])
    R.write_worst_report(worst, str(tmp_path / "report"), "probability", ["cat", "id"], "Worst")
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "report"), wholetext=True).collect())
    assert text.startswith("# Worst") and text.count("probability=") == 10 and text.count("FP probability") == 5
    assert R.false_positives(errors).count() + R.false_negatives(errors).count() == errors.filter("is_error = 1").count()


def test_error_shares_merge_the_tail(spark):
    rows, df = scored(spark)
    errors = R.error_table(df.withColumnRenamed("predicted", "guess"), "actual", "guess")
    found = {r["category"]: r for r in R.error_by_category(errors, ["cat"], top_k=1).collect()}
    assert set(found) == {"a", "... OTHER ..."}
    other = [r for r in rows if r[4] != "a"]
    assert found["... OTHER ..."]["n"] == len(other)
    assert found["... OTHER ..."]["n_errors"] == sum(r[1] != r[2] for r in other)
    assert {r["column_name"] for r in R.error_by_category(errors).collect()} == {"cat"}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    bins = {r["bin"]: r["n"] for r in R.histogram(df, "v", 5).collect()}
    assert bins == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert R.histogram(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v", 5).first()["n"] == 2


def test_mutual_information_and_cramers_v(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.randrange(2)) for _ in range(300)]
    rows = [(x, 1 if x == "a" else y) for x, y in rows]
    df = spark.createDataFrame([(x, "k", y) for x, y in rows], "x string, constant string, y int")
    n = len(rows)
    mi = chi = 0.0
    for v in "abc":
        for t in (0, 1):
            both = sum(r == (v, t) for r in rows)
            px, py = sum(r[0] == v for r in rows), sum(r[1] == t for r in rows)
            mi += both / n * math.log(both * n / (px * py)) if both else 0.0
            chi += (both - px * py / n) ** 2 / (px * py / n)
    found = {r["feature"]: r["mutual_info"] for r in eda.mutual_information(df, ["x", "constant"], "y").collect()}
    assert found["x"] == pytest.approx(mi) and found["constant"] == pytest.approx(0.0, abs=1e-12)
    vs = {r["feature"]: r["cramers_v"] for r in eda.cramers_v(df, ["x", "constant"], "y").collect()}
    assert vs["x"] == pytest.approx(math.sqrt(chi / n)) and vs["constant"] == pytest.approx(0.0, abs=1e-6)
