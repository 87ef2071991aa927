from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators.neighbours import balls, digamma, neighbour_information

HARMONIC = np.concatenate([[np.nan], -np.euler_gamma + np.concatenate([[0.0], np.cumsum(1 / np.arange(1, 5000))])])


def plain(rows, k):
    """The estimate by looking at all pairs of rows."""
    rows = [(x, y) for x, y in rows if x is not None and y is not None and abs(x) < float("inf")]
    sizes = {c: sum(y == c for _, y in rows) for _, c in rows}
    rows = [(x, y) for x, y in rows if sizes[y] > 1]
    xs, total = np.array([x for x, _ in rows]), 0.0
    for at, (x, y) in enumerate(rows):
        mine = min(k, sizes[y] - 1)
        radius = sorted(abs(v - x) for n, (v, c) in enumerate(rows) if c == y and n != at)[mine - 1]
        inside = (np.abs(xs - x) < radius).sum() if radius > 0 else (xs == x).sum()
        total += HARMONIC[mine] - HARMONIC[sizes[y]] - HARMONIC[inside]
    return max(0.0, HARMONIC[len(rows)] + total / len(rows))


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = rng.choice("aaaaab")
        tied, fine = float(rng.randrange(9) + 4 * (y == "b")), rng.randrange(1 << 20) / 64 + 4000 * (y == "b")
        rows.append((tied if rng.random() > 0.05 else None, fine, y if rng.random() > 0.05 else None))
    return [*rows, (1.0, 2.0, "alone"), (float("nan"), float("inf"), "a"), (3.0, float("-inf"), "b")]


def test_digamma(spark):
    rows = spark.range(1, 2000).select("id", digamma(F.col("id")).alias("v")).collect()
    assert max(abs(r["v"] - HARMONIC[r["id"]]) for r in rows) < 1e-12


@pytest.mark.parametrize(("k", "n", "block_cells", "one_task"), [(3, 400, 50_000, 100_000), (3, 400, 7, 0), (1, 60, 1, 0), (5, 12, 5, 0)])
def test_same_as_all_pairs(spark, k, n, block_cells, one_task):
    rows = sample(n + k, n)
    df = spark.createDataFrame(rows, "`t.ied` double, fine double, y string")
    found = {r["feature"]: r for r in neighbour_information(df, ["t.ied", "fine"], "y", k, block_cells=block_cells, one_task_scores=one_task).collect()}
    for at, name in enumerate(["t.ied", "fine"]):
        assert found[name]["mutual_info"] == pytest.approx(plain([(r[at], r[2]) for r in rows], k), abs=1e-9)


def test_a_number_that_tells_the_class_and_one_that_does_not(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(y + rng.random() / 2, rng.random(), y) for y in (0, 1) for _ in range(500)], "told double, noise double, y int")
    found = {r["feature"]: r["mutual_info"] for r in neighbour_information(df, ["told", "noise"], "y").collect()}
    assert found["told"] == pytest.approx(np.log(2), abs=0.01) and found["noise"] < 0.08


def test_counters_are_spread_by_their_keys(spark):
    """Two values that give the class with 0.9: the information of the table of counts, whatever the layout of the rows."""
    rows = [(k, (k % 10 == 0) ^ (k % 2), k % 2) for k in range(2000)]
    df = spark.createDataFrame([(k, float(x), float(y)) for k, x, y in rows], "id long, x double, y double")
    counts = np.array([[sum((x, y) == (a, b) for _, x, y in rows) for b in (0, 1)] for a in (0, 1)]) / 2000
    told = sum(counts[a, b] * np.log(counts[a, b] / (counts[a].sum() * counts[:, b].sum())) for a in (0, 1) for b in (0, 1) if counts[a, b])
    first = neighbour_information(df, ["x"], "y", keys=["id"]).first()
    again = neighbour_information(df.repartition(5, "x"), ["x"], "y", keys=["id"], block_cells=50, one_task_scores=0).first()
    assert first["mutual_info"] == pytest.approx(told, abs=0.05)
    assert first["mutual_info"] == pytest.approx(again["mutual_info"], abs=1e-9)
    assert neighbour_information(df, ["x"], "y").first()["estimate"] < 0


def test_no_rows_and_only_single_rows(spark):
    empty = spark.createDataFrame([], "x double, y string")
    assert neighbour_information(empty, ["x"], "y").count() == 0
    alone = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (None, "b"), (3.0, None)], "x double, y string")
    assert neighbour_information(alone, ["x"], "y").count() == 0


def test_neighbours_are_looked_up_by_offset_and_not_collected(spark):
    cells = spark.createDataFrame([("f", "a", float(x), 1, 9, 9, 1) for x in range(9)], "feature string, y string, x double, n long, class_rows long, rows long, cell int")
    found = balls(cells, 3)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert {r["x"]: (r["radius"], r["low"], r["high"]) for r in found.collect()}[4.0] == (2.0, 2.0, 6.0)
