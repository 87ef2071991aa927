"""Column expressions, exact quantiles and running totals."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.functions import columns as X
from clickloom.functions.curves import running_totals
from clickloom.functions.quantiles import bracketed_quantiles, exact_quantiles, top_values, value_counts


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "text, area",
    [
        ("1920x1080", 2073600.0),
        ("abc", None),
        ("12xab", None),
        ("1x2x3", 2.0),
        (" 360 x640", 230400.0),
        ("12fx10", None),
        (None, None),
    ],
)
def test_screen_area(spark, text, area):
    assert one(spark, text, "string", X.screen_area) == area


@pytest.mark.parametrize("text, hour", [("23:10:11", 23.0), ("7:05:09", 7.0), ("25:00:00", 12.0), ("7", 12.0), (None, 12.0)])
def test_clock_hours(spark, text, hour):
    assert one(spark, text, "string", X.visit_hour) == hour


def test_number_hours(spark):
    assert one(spark, "7", "string", lambda c: X.visit_hour(c, "number")) == 7.0
    with pytest.raises(ValueError):
        X.visit_hour(F.col("c"), "roman")


@pytest.mark.parametrize("text, day", [("2024-01-01", 0), ("2024-01-07", 6), ("no date", 0), (None, 0)])
def test_weekday(spark, text, day):
    assert one(spark, text, "string", X.weekday_number) == day


@pytest.mark.parametrize("value, want", [(None, None), (-5.0, 0.0), (0.5, 0.5), (9.0, 1.0)])
def test_clipping_keeps_unknown(spark, value, want):
    assert one(spark, value, "double", lambda c: X.clipped(c, 0.0, 1.0)) == want


@pytest.mark.parametrize("value, want", [("a", "a"), ("b", "rest"), (None, "rest")])
def test_collapse(spark, value, want):
    assert one(spark, value, "string", lambda c: X.collapsed(c, ["a"], "rest")) == want


@pytest.mark.parametrize(
    "os, category, brand, want",
    [
        (None, "desktop", "Apple", "Windows"),
        (None, "tablet", "APPLE", "iOS"),
        (None, "mobile", "Unknown", "Android"),
        (None, None, "Apple", None),
        ("BeOS", "desktop", "Apple", "BeOS"),
    ],
)
def test_operating_systems(spark, os, category, brand, want):
    df = spark.createDataFrame([(os, category, brand)], "o string, c string, b string")
    assert df.select(X.imputed_os(F.col("o"), F.col("c"), F.col("b"))).first()[0] == want


def test_small_expressions(spark):
    assert one(spark, " KAZAN\t", "string", X.normal_city) == "kazan"
    assert one(spark, None, "string", lambda c: X.joined_text(c, F.lit("x"))) == "nan_x"
    assert one(spark, "12", "string", X.form_int) == 12
    assert one(spark, "twelve", "string", X.form_int) == 0
    assert one(spark, 0.5, "double", X.verdict) == "low"
    assert one(spark, "(none)", "string", X.without_placeholders) == "(none)"
    assert one(spark, "(not set)", "string", X.without_placeholders) is None
    assert one(spark, "/p?utm_source_initial=abc&x=1", "string", lambda c: X.utm_initial(c, "source")) == "abc"


def test_nan_becomes_null(spark):
    df = X.nan_to_null(spark.createDataFrame([(float("nan"), 1)], "a double, b int"))
    assert tuple(df.first()) == (None, 1)


def skewed_values(n, seed=3):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", rng.choice([0.0, 0.0, rng.gauss(0, 1), None])) for _ in range(n)
    ]


@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_bracketed_quantiles_are_exact(spark, accuracy):
    rows = skewed_values(4000)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    known = spark.createDataFrame(rows, "g string, v double").filter("v IS NOT NULL")
    found = {r["g"]: r for r in bracketed_quantiles(known, ["g"], shares, accuracy).collect()}
    for g in {r[0] for r in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        assert found[g]["n"] == len(values)
        assert found[g]["quantiles"] == pytest.approx(list(np.quantile(values, shares)))


def test_both_quantile_ways_agree(spark):
    rows = skewed_values(2000)
    df = spark.createDataFrame(rows, "g string, v double")
    values = [v for _, v in rows if v is not None]
    small = exact_quantiles(df, [], "v", [0.3, 0.5]).first()["quantiles"]
    large = exact_quantiles(df, [], "v", [0.3, 0.5], in_memory_values=10).first()["quantiles"]
    assert small == pytest.approx(list(np.quantile(values, [0.3, 0.5])))
    assert large == pytest.approx(small)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    row = exact_quantiles(empty, [], "v", [0.5]).first()
    assert row is None or not row["quantiles"]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "x string")
    rows = top_values(value_counts(df, ["x"]), 2).orderBy("place").collect()
    assert [(r["value"], r["n"]) for r in rows] == [("c", 2), ("a", 1)]


@pytest.mark.parametrize("limit", [10**6, 10])
def test_running_totals(spark, limit):
    rng = random.Random(5)
    rows = [(k, round(rng.random() ** 6, 4), rng.randrange(9)) for k in "ab" for _ in range(700)]
    merged = {}
    for k, s, n in rows:
        merged[k, s] = merged.get((k, s), 0) + n
    df = spark.createDataFrame([(k, s, n) for (k, s), n in merged.items()], "k string, s double, n long")
    found = {(r["k"], r["s"]): r["n_below"] for r in running_totals(df, "s", ["n"], ["k"], limit).collect()}
    for (k, s) in merged:
        assert found[k, s] == sum(n for (a, b), n in merged.items() if a == k and b < s)
