"""Splits, samples and row filters by their properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.operators import sampling as S
from clickloom.operators.filters import drop_sparse_by_count, drop_sparse_rows, require_rows
from clickloom.operators.splitting import (
    assert_no_leakage,
    client_labels,
    group_split,
    shared_clients,
    split_sizes,
    three_frames,
)


def frame(spark, clients=400, per_client=3, positive_every=5):
    rows = [
        (f"s{c}_{i}", f"c{c}", f"2024-01-0{i + 1}", int(c % positive_every == 0 and i == per_client - 1))
        for c in range(clients)
        for i in range(per_client)
    ]
    return spark.createDataFrame(rows, "session_id string, client_id string, visit_date string, event_value int")


def test_split_keeps_rows_clients_and_class_shares(spark):
    df = frame(spark)
    split = group_split(df, test_size=0.2, val_size=0.2).cache()
    assert split.count() == df.count()
    assert_no_leakage(split)
    sizes = {r["split"]: r for r in split_sizes(split).collect()}
    assert abs(sizes["test"]["n_clients"] - 80) <= 2
    assert abs(sizes["val"]["n_clients"] - 80) <= 2
    assert sum(r["n_clients"] for r in sizes.values()) == 400
    overall = df.agg(F.avg("event_value")).first()[0]
    assert all(abs(r["target_share"] - overall) < 0.01 for r in sizes.values())
    train, val, test = three_frames(split)
    assert shared_clients(train, test).isEmpty() and shared_clients(val, test).isEmpty()
    assert train.columns == val.columns == test.columns


def test_split_repeats_and_depends_on_the_seed(spark):
    df = frame(spark)

    def result(d, seed):
        return {r["client_id"]: r["split"] for r in group_split(d, seed=seed).collect()}

    assert result(df, 1) == result(df.repartition(9), 1)
    assert result(df, 1) != result(df, 2)


@pytest.mark.parametrize("test_size, val_size, empty", [(0.2, 0.0, "val"), (0.0, 0.2, "test")])
def test_size_zero_gives_an_empty_set(spark, test_size, val_size, empty):
    split = group_split(frame(spark, 60), test_size=test_size, val_size=val_size)
    frames = dict(zip(["train", "val", "test"], three_frames(split)))
    assert frames[empty].isEmpty() and len(frames[empty].columns) == 4
    assert not frames["train"].isEmpty()
    with pytest.raises(ValueError):
        require_rows(frames[empty], "the set")


def test_bad_sizes_and_missing_key(spark):
    with pytest.raises(ValueError):
        group_split(frame(spark, 5), test_size=0.6, val_size=0.4)
    with pytest.raises(ValueError):
        group_split(frame(spark, 5).drop("client_id"))


def test_tiny_class_falls_back_to_no_strata(spark, caplog):
    rows = [(f"s{c}", f"c{c}", "2024-01-01", int(c == 0)) for c in range(50)]
    df = spark.createDataFrame(rows, "session_id string, client_id string, visit_date string, event_value int")
    with caplog.at_level("WARNING"):
        split = group_split(df, test_size=0.2, val_size=0.2)
    assert "without strata" in caplog.text
    sizes = {r["split"]: r["n_clients"] for r in split_sizes(split).collect()}
    assert sizes["test"] == 10 and sizes["val"] == 10


@pytest.mark.parametrize("labels, per_label", [(200, 2), (1500, 2), (300, 10)])
def test_many_labels_give_their_shares(spark, labels, per_label):
    rows = [(f"c{k}", f"l{k % labels}") for k in range(labels * per_label)]
    split = group_split(spark.createDataFrame(rows, "client_id string, kind string"), target="kind", test_size=0.2, val_size=0.2)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts["test"] == labels * per_label // 5 and abs(counts["val"] - labels * per_label // 5) <= 1
    if per_label >= 10:  # enough clients for strata
        each = split.filter("split = 'test'").groupBy("kind").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
        assert tuple(each) == (per_label // 5, per_label // 5, labels)


def test_label_is_the_last_one(spark):
    labels = {r["client_id"]: r["label"] for r in client_labels(frame(spark, 10), "client_id", "event_value").collect()}
    assert labels["c0"] == "1" and labels["c1"] == "0"


def test_client_sample(spark):
    df = frame(spark, 2000, 2)
    sample = S.client_sample(df, 0.2)
    kept = sample.groupBy("client_id").count().collect()
    assert {r["count"] for r in kept} == {2}
    assert abs(len(kept) / 2000 - 0.2) < 0.04
    assert S.client_sample(df.repartition(5), 0.2).exceptAll(sample).isEmpty()
    unknown = df.withColumn("client_id", F.lit(None).cast("string"))
    assert S.client_sample(unknown, 1.0).isEmpty()
    assert "Exchange" not in sample._jdf.queryExecution().toString()
    listed = sample.select("client_id").distinct()
    assert S.rows_of_clients(df, listed).count() == sample.count()


@pytest.mark.parametrize("ratio, zeros_kept", [(3, 120), (1, 40), (30, 560)])
def test_balanced_set(spark, ratio, zeros_kept):
    rows = [(i, int(i % 15 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, y int")
    chosen = S.balanced_set(df, "y", ["id"], ratio)
    counts = {r["y"]: r["count"] for r in chosen.groupBy("y").count().collect()}
    assert counts == {1: 40, 0: zeros_kept}
    assert chosen.select("id").distinct().count() == 40 + zeros_kept


def test_row_filters_round_differently(spark):
    rows = [tuple([1.0] * k + [None] * (9 - k)) for k in range(10)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(9)))
    assert drop_sparse_by_count(df).count() == 6  # 4 to 9 known values
    assert drop_sparse_rows(df).count() == 5  # 5 to 9 known values
    assert drop_sparse_by_count(df, 1.0).count() == 10
    nan = spark.createDataFrame([(float("nan"), 1.0), (None, None)], "a double, b double")
    assert drop_sparse_rows(nan, 0.5).count() == 1
