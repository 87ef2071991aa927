"""Cleaning against a plain pandas computation of the same rules, and its properties."""

from __future__ import annotations

import shutil

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from clickloom.operators import cleaning
from clickloom.operators.cleaning import SessionCleaner, SessionCleanerModel
from clickloom.operators.features import ENGINEERED_COLUMNS, SessionFeatures

COLUMNS = {
    "session_id": "string",
    "visit_date": "string",
    "visit_time": "string",
    "device_brand": "string",
    "device_category": "string",
    "device_os": "string",
    "kind": "string",
    "campaign": "string",
    "rare_note": "string",
    "always_seven": "double",
    "screen_area": "double",
    "total_hits": "double",
}
SCHEMA = ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items())
BRANDS, SYSTEMS = ["Apple", "Nokia", "Sony", "Fairphone"], ["iOS", "Android", "Windows", "KaiOS"]


def sample(n=180, shift=0):
    """Rows by arithmetic: every column has its own period, and some values are unknown."""
    rows = []
    for i in range(shift, shift + n):
        rows.append(
            (
                f"row-{i}",
                f"2025-03-{i % 28 + 1:02d}",
                f"{i % 24:02d}:15:00",
                None if i % 17 == 3 else BRANDS[i * 11 % 13 % 4],
                ("desktop", "mobile", "mobile", "tablet")[i // 2 % 4],
                None if i % 3 == 1 else SYSTEMS[i * 5 % 11 % 4],
                None if i % 13 == 5 else "aaaabbbccd"[i * 3 % 10] + ("" if i % 19 else "z"),
                "spring",
                "seen" if i % 60 == 7 else None,
                7.0,
                None if i % 9 == 2 else 1000.0 * (i * 37 % 101) + i % 4,
                float(i * i % 31 + 1),
            )
        )
    return pd.DataFrame(rows, columns=list(COLUMNS))


def frame(spark, pdf):
    rows = pdf.astype(object).where(pdf.notna(), None).values.tolist()
    return spark.createDataFrame(rows, SCHEMA)


SETTINGS = dict(dropCols=["session_id", "campaign"], topCategories=3, catStrategy="mode")


def by_hand(pdf, top=3):
    """The rules of the cleaner for this table, one by one."""
    out = pd.DataFrame(index=pdf.index)
    brand_medians = pdf.groupby("device_brand").screen_area.median()
    kept = {}
    for c in ("device_brand", "device_category", "device_os", "kind"):
        counts = pdf[c].value_counts()
        kept[c] = sorted(counts.index, key=lambda v: (-counts[v], v))[:top]
    brand = pdf.device_brand.fillna("Unknown")
    guess = np.where(
        pdf.device_category == "desktop", "Windows", np.where(brand.str.lower() == "apple", "iOS", "Android")
    )
    system = pdf.device_os.where(pdf.device_os.notna(), guess)
    for c, values in (("device_brand", brand), ("device_category", pdf.device_category), ("device_os", system), ("kind", pdf.kind)):
        out[c] = values.where(values.isin(kept[c]), "other_collapsed")
    out["screen_area"] = pdf.screen_area.fillna(brand.map(brand_medians)).fillna(pdf.screen_area.median())
    out["total_hits"] = pdf.total_hits
    return out


def test_same_as_by_hand(spark):
    pdf = sample()
    df = frame(spark, pdf)
    model = SessionCleaner(passThrough=["session_id"], **SETTINGS).fit(df)
    got = model.transform(df).toPandas().set_index("session_id").loc[pdf.session_id].reset_index(drop=True)
    want = by_hand(pdf)
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_learned_values(spark):
    pdf = sample()
    learned = SessionCleaner(**SETTINGS).fit(frame(spark, pdf)).learned
    assert {"campaign", "always_seven", "rare_note", "visit_date", "visit_time"} <= set(learned["dropped"])
    hits = pdf.total_hits.value_counts(normalize=True)
    assert learned["top_share"]["total_hits"] == pytest.approx(hits.max()) and hits.max() < 0.5
    assert learned["top_share"]["rare_note"] == pytest.approx(pdf.rare_note.isna().mean())
    assert learned["fills"]["total_hits"] == pdf.total_hits.median()
    assert learned["fills"]["kind"] == "a"
    assert learned["screen_median"] == pytest.approx(pdf.screen_area.median())


def test_rows_kept_and_nothing_unknown_left(spark):
    df = frame(spark, sample())
    out = SessionCleaner(**SETTINGS).fit(df).transform(df)
    assert out.count() == df.count()
    nulls = out.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in out.columns]).first()
    assert set(nulls) == {0}
    assert "campaign" not in out.columns and "always_seven" not in out.columns


def test_statistics_come_from_train_only(spark):
    """Applied to other rows, the model fills with the medians and keeps the values of its own rows."""
    pdf, other = sample(), sample(60, shift=1000)
    other["screen_area"] = other.screen_area * 50
    other["kind"] = "new"
    model = SessionCleaner(passThrough=["session_id"], **SETTINGS).fit(frame(spark, pdf))
    out = model.transform(frame(spark, other)).toPandas().set_index("session_id")
    medians = pdf.groupby("device_brand").screen_area.median()
    for row in other.itertuples():
        if pd.isna(row.screen_area):
            assert out.screen_area[row.session_id] == medians.get(row.device_brand, pdf.screen_area.median())
    assert set(out.kind) == {"other_collapsed"}


@pytest.mark.parametrize("method, width", [("zscore", 2.0), ("iqr", 1.5)])
def test_outliers_are_clipped(spark, method, width):
    """Both ends of a column with one very small and one very large value, and nothing in between changes."""
    pdf = sample()
    pdf.loc[[4, 11], "total_hits"] = [-5e6, 7e5]
    model = SessionCleaner(passThrough=["session_id"], outlierMethod=method, outlierThreshold=width, **SETTINGS).fit(frame(spark, pdf))
    values = pdf.total_hits
    middle, spread = (values.mean(), values.std()) if method == "zscore" else (None, values.quantile(0.75) - values.quantile(0.25))
    low = middle - width * spread if method == "zscore" else values.quantile(0.25) - width * spread
    high = middle + width * spread if method == "zscore" else values.quantile(0.75) + width * spread
    assert model.learned["bounds"]["total_hits"] == pytest.approx([low, high])
    out = model.transform(frame(spark, pdf)).toPandas().set_index("session_id").total_hits
    assert out.loc[pdf.session_id].tolist() == pytest.approx(values.clip(low, high).tolist())


def test_no_clipping_by_default(spark):
    assert SessionCleaner(**SETTINGS).fit(frame(spark, sample())).learned["bounds"] == {}


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(1.0 if i else 2.0, "a" if i > 9 else None) for i in range(100)], "c double, t string")
    kept = SessionCleaner(dropCols=[], maxConstantShare=0.99, maxNullShare=0.1).fit(df).learned["dropped"]
    assert "c" not in kept and "t" not in kept
    stricter = SessionCleaner(dropCols=[], maxConstantShare=0.98, maxNullShare=0.09).fit(df).learned["dropped"]
    assert "c" in stricter and "t" in stricter


def test_low_constant_limits_count_all_values(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(10)], "c double")
    assert "c" in SessionCleaner(dropCols=[], maxConstantShare=0.39).fit(df).learned["dropped"]
    assert "c" not in SessionCleaner(dropCols=[], maxConstantShare=0.4).fit(df).learned["dropped"]


def test_both_quantile_ways_learn_the_same(spark, monkeypatch):
    df = frame(spark, sample())
    usual = SessionCleaner(outlierMethod="iqr", **SETTINGS).fit(df).learned
    monkeypatch.setattr(cleaning, "IN_MEMORY_VALUES", 3)
    narrow = SessionCleaner(outlierMethod="iqr", **SETTINGS).fit(df).learned
    assert narrow["fills"] == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in usual["fills"].items()}
    assert narrow["screen_median"] == pytest.approx(usual["screen_median"])
    assert narrow["bounds"] == {k: pytest.approx(v) for k, v in usual["bounds"].items()}


def test_medians_of_brands_in_both_ways(spark, monkeypatch):
    df = frame(spark, sample())
    usual = SessionCleaner(**SETTINGS).fit(df).brand_report()
    monkeypatch.setattr(cleaning, "IN_MEMORY_VALUES", 3)
    narrow = SessionCleaner(**SETTINGS).fit(df).brand_report()
    assert sorted(map(tuple, usual.collect())) == sorted(map(tuple, narrow.collect())) and usual.count() == len(BRANDS)


def test_a_copied_model_needs_nothing_else(spark, tmp_path, monkeypatch):
    """Saved, copied elsewhere and loaded, with the tables of the fit out of reach."""
    df = frame(spark, sample())
    staged = []

    def remembered(table, name):
        path = str(tmp_path / "scratch" / f"{name}-{len(staged)}")
        table.write.parquet(path)
        staged.append(path)
        return spark.read.parquet(path)

    monkeypatch.setattr(cleaning, "stage", remembered)
    model = SessionCleaner(passThrough=["session_id"], **SETTINGS).fit(df)
    want = sorted(map(tuple, model.transform(df).collect()))
    model.write().overwrite().save(str(tmp_path / "m"))
    shutil.copytree(tmp_path / "m", tmp_path / "elsewhere")
    assert staged and shutil.move(tmp_path / "scratch", tmp_path / "gone")
    again = SessionCleanerModel.load(str(tmp_path / "elsewhere"))
    assert sorted(map(tuple, again.transform(df).collect())) == want
    piped = PipelineModel(stages=[again])
    piped.write().overwrite().save(str(tmp_path / "pipeline"))
    assert sorted(map(tuple, PipelineModel.load(str(tmp_path / "pipeline")).transform(df).collect())) == want


def test_unfitted_model_is_an_error(spark):
    with pytest.raises(ValueError):
        SessionCleanerModel().transform(frame(spark, sample()))
    with pytest.raises(ValueError):
        SessionCleaner(outlierMethod="magic").fit(frame(spark, sample()))


def test_all_null_row_and_extremes(spark):
    df = frame(spark, sample())
    model = SessionCleaner(**SETTINGS).fit(df)
    odd = spark.createDataFrame([(None,) * 12, ("s", "d", "t", "x", "fridge", None, "zz", None, None, None, 1e300, -1e9)], SCHEMA)
    rows = model.transform(odd).collect()
    assert len(rows) == 2 and all(v is not None for r in rows for v in r)


def test_features_with_everything_missing(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    out = SessionFeatures().transform(df)
    assert out.columns == ["x"] + [c for c in ENGINEERED_COLUMNS if c != "user_vs_city_car_interest"]
    row = out.first()
    assert (row.geo_zone, row.dev_category_brand, row.is_mobile_device, row.is_night) == ("other_countries", "Unknown_Unknown", 0, 0)
    assert (row.screen_area, row.session_duration_ms, row.ms_per_hit, row.city_population) == (None, None, None, 100000)


def test_feature_hours(spark):
    df = spark.createDataFrame([("23:10:11",), ("25:00:00",), ("3",), (None,)], "visit_time string")
    clock = [r.is_night for r in SessionFeatures().transform(df).collect()]
    number = [r.is_night for r in SessionFeatures(hourMode="number").transform(df).collect()]
    assert clock == [1, 0, 0, 0] and number == [0, 0, 1, 0]
    assert [r.is_night for r in SessionFeatures(hourMode="auto").transform(df).collect()] == clock
    whole = spark.createDataFrame([("23",), ("12",)], "visit_time string")
    assert [r.is_night for r in SessionFeatures(hourMode="auto").transform(whole).collect()] == [1, 0]


def test_feature_speed_from_hit_times(spark):
    df = spark.createDataFrame([(100, 1100, 4), (5, 5, 0)], "first_hit_time_ms long, last_hit_time_ms long, total_hits_count long")
    rows = SessionFeatures().transform(df).collect()
    assert [(r.session_duration_ms, r.ms_per_hit) for r in rows] == [(1000.0, 250.0), (0.0, 0.0)]
