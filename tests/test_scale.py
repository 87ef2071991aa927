"""Plans: pushed filters, pruned columns, no cross joins, hot keys spread over tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from clickloom.plans import queries as Q
from clickloom.operators import mart as M
from clickloom.operators.features import SessionFeatures
from clickloom.operators.splitting import group_split
from clickloom.sources import events as E

SF_DIR = "/root/testdata/sf0.001"
# these fit models or run streams while they are built
BUILT_WITH_JOBS = {
    "gbt_scores",
    "forest_importance",
    "network_scores",
    "model_metrics",
    "price_regression",
    "linear_fit",
    "event_class_auc",
    "logreg_contributions",
    "worst_fp_contributions",
    "contribution_dependence",
    "permutation_importance",
    "tune_random",
    "score_checks",
    "contribution_checks",
    "stream_score_checks",
    "stream_dedup",
    "stream_sessions",
    "stream_monitor",
    "stream_scores",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - BUILT_WITH_JOBS))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(Q.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_mart_reads_only_what_it_needs(spark):
    text = plan(M.build_mart(*E.raw_tables(spark, SF_DIR), E.ADAPTED_TARGETS))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all("value" not in s and "event_id" not in s for s in schemas)
    assert "WindowGroupLimit" in text  # one row per session and task before the shuffle


def test_target_filter_reaches_the_scan(spark):
    text = plan(M.dirty_mart(*E.raw_tables(spark, SF_DIR), E.ADAPTED_TARGETS))
    assert re.search(r"PushedFilters: \[[^\]]*event_type", text)


def test_city_table_is_broadcast_and_adds_no_shuffle(spark):
    df = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("geo_city", F.col("event_type"))
    text = plan(SessionFeatures().transform(df))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


@pytest.fixture
def large_joins(spark):
    """Settings under which small test tables are treated like large ones."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_hits(spark, rows=60_000):
    """A third of all hits belongs to one session."""
    session = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, rows, 1, 12).select(
        session.alias("session_id"),
        (F.col("id") / 3).cast("int").alias("hit_number"),
        F.col("id").alias("hit_time"),
        F.lit("event").alias("hit_type"),
        F.concat(F.lit("/cars/c"), (F.col("id") % 997).cast("string")).alias("hit_page_path"),
        F.when(F.col("id") % 9 == 7, "buy").when(F.col("id") == 59_997, "buy").otherwise("view").alias("event_action"),
    )


def test_hot_session_is_split_in_the_client_join(spark, large_joins):
    hits = hot_hits(spark)
    days = F.lit("2024-01-01").cast("date").alias("visit_date")
    owners = hits.select("session_id").distinct().select(
        "session_id", F.col("session_id").alias("client_id"), days, F.lit("10:00:00").alias("visit_time")
    )
    joined = M.hits_with_client(hits, owners, deduplicate=True)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_hot_session_is_split_when_speed_is_attached(spark, large_joins):
    speed = M.session_speed(hot_hits(spark, 3000), ["buy"])
    copies = hot_hits(spark).select("session_id", "hit_page_path", "hit_time")
    joined = M.sessions_with_speed(copies, speed)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_hot_client_is_split_in_the_group_split(spark, large_joins):
    rows = hot_hits(spark).select(
        F.col("hit_time").cast("string").alias("session_id"),
        F.col("session_id").alias("client_id"),
        (F.col("event_action") == "buy").cast("int").alias("event_value"),
    )
    split = group_split(rows)
    assert "skew=true" in final_plan(split)
    assert split.count() == 60_000


def test_hot_session_is_spread_in_the_speed_join(spark, large_joins):
    hits = hot_hits(spark)
    before = M.hits_before_target(hits, ["buy"])
    text = plan(before)
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
    # hits are joined by session and block; the join by session alone takes one row per block, summed before its shuffle
    assert len(joins) == 2 and sum("block" in line.split("]")[0] for line in joins) == 1
    sized = [line for line in text.splitlines() if "HashAggregate" in line and "keys=[session_id" in line and "block" in line]
    assert any("partial_count(1)" in line for line in sized)
    hot = {r[0]: r[1] for r in before.collect()}["hot"]
    assert hot == hits.filter("session_id = 'hot' AND hit_number < 19999").count()


def test_distinct_counts_spread_a_hot_session(spark):
    text = plan(M.hit_counters(hot_hits(spark), ["buy"]))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # the wide shuffle is keyed by session and value, only partial sums are keyed by session
    assert len(exchanges) == 2 and sum("car#" in e for e in exchanges) == 1


def test_hits_are_merged_by_action_and_car_in_two_rows_each(spark):
    text = plan(M.hit_counters(hot_hits(spark), ["buy"]))
    expands = [line.split("Expand [[")[1].split("]], [")[0] for line in text.splitlines() if "Expand [[" in line]
    # one row for the action and one for the car; a third one would carry the counters alone
    assert len(expands) == 1 and expands[0].count("], [") == 1


def test_days_are_numbered_before_texts_are_made(spark):
    text = plan(E.as_sessions(E.read_events(spark, SF_DIR)))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    below_window = text[text.index("Window [") :]
    assert len(exchanges) == 2 and "Generate explode" not in below_window and "utm_source" not in below_window


def test_linear_parts_prepare_the_validation_rows_once(spark):
    _, vectors, parts, _, _ = Q.linear_parts(spark, SF_DIR)
    assert vectors.columns == ["session_id", "client_id", "event_value", "features"]
    # both read the written vectors: no features, cleaning or encoding left in their plans
    for text in (plan(vectors), plan(parts)):
        assert "val-vectors" in text and "BroadcastHashJoin" not in text and "geo_city" not in text
