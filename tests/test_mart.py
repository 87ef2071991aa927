"""Hand-written rows for the mart, URL parsing and session speed."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.functions import columns as X
from clickloom.operators import mart as M
from clickloom.sources.schemas import HITS_SCHEMA, SESSIONS_SCHEMA

DAY = dt.date(2024, 1, 1)


def hit(session, number, action="view", kind="pageview", path=None, time=0):
    return (session, DAY, time, number, kind, None, path, None, action, None, None)


def visit(session, client, day=DAY, time="10:00:00", **more):
    names = SESSIONS_SCHEMA.fieldNames()
    row = {n: None for n in names} | {"session_id": session, "client_id": client, "visit_date": day, "visit_time": time}
    row |= more
    return tuple(row[n] for n in names)


def hits_frame(spark, rows):
    return spark.createDataFrame(rows, HITS_SCHEMA)


def sessions_frame(spark, rows):
    return spark.createDataFrame(rows, SESSIONS_SCHEMA)


@pytest.mark.parametrize(
    "path, car",
    [
        ("/cars/a/b/c9?x", "c9"),
        ("/cars/c9", "c9"),
        ("/cars/", None),
        ("/cars/a-b", None),
        ("/home", None),
        (None, None),
        ("/cars/a?x=/cars/b", "b"),
        ("/cars/a\nb/c1", "c1"),
        ("/cars/a\n", None),
        ("/cars/a#top", None),
    ],
)
def test_car_id(spark, path, car):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(X.car_id(F.col("p"))).first()[0] == car


def test_latest_row_wins_and_unknown_time_beats_known(spark):
    rows = [
        visit("s1", "a", time="23:00:00"),
        visit("s1", "b", day=DAY + dt.timedelta(days=1), time="01:00:00"),
        visit("s2", "a", time="23:00:00"),
        visit("s2", "b", time=None),
    ]
    found = {r["session_id"]: r["client_id"] for r in M.latest_sessions(sessions_frame(spark, rows)).collect()}
    assert found == {"s1": "b", "s2": "b"}


def test_ties_are_broken_by_the_other_columns_whatever_the_layout(spark):
    rows = [visit("s", f"c{i}", utm_source=f"u{i % 3}") for i in range(30)]
    df = sessions_frame(spark, rows)
    first = M.latest_sessions(df.repartition(7)).collect()
    second = M.latest_sessions(df.coalesce(1).orderBy(F.desc("client_id"))).collect()
    assert first == second


def test_mart_counts(spark):
    hits = hits_frame(
        spark,
        [
            hit("s1", 1, "view", path="/cars/x/c1"),
            hit("s1", 2, "buy", "event", "/cars/x/c1"),
            hit("s1", 3, "buy", "event", "/cars/x/c2"),
            hit("s1", 4, None, "event"),
            hit("s2", 1, "buy", "event", "/cars/c5"),
        ],
    )
    sessions = sessions_frame(spark, [visit("s1", "a"), visit("s2", "b"), visit("s3", "c")])
    mart = {r["session_id"]: r for r in M.build_mart(hits, sessions, ["buy"]).collect()}
    s1 = mart["s1"]
    assert (s1.total_hits_count, s1.total_events_count, s1.unique_event_actions) == (2, 1, 1)
    assert (s1.unique_cars_viewed, s1.total_car_views, s1.car_view_ratio, s1.event_value) == (2, 3, 1.5, 1)
    assert (mart["s2"].total_hits_count, mart["s2"].car_view_ratio, mart["s2"].event_value) == (0, 0.0, 1)
    assert (mart["s3"].total_hits_count, mart["s3"].event_value) == (0, 0)
    strict = {r["session_id"]: r for r in M.build_mart(hits, sessions, ["buy"], exclude_target_cars=True).collect()}
    assert (strict["s1"].total_car_views, strict["s1"].car_view_ratio) == (1, 0.5)


def test_empty_target_list_is_an_error(spark):
    with pytest.raises(ValueError):
        M.hit_counters(hits_frame(spark, [hit("s", 1)]), [])


def test_joined_hits_repeat_for_conflicting_sessions(spark):
    hits = hits_frame(spark, [hit("s", 1), hit("s", 2)])
    sessions = sessions_frame(spark, [visit("s", "a"), visit("s", "b", time=None)])
    assert M.hits_with_client(hits, sessions).count() == 4
    assert [r.client_id for r in M.hits_with_client(hits, sessions, deduplicate=True).collect()] == ["b", "b"]


def test_session_speed(spark):
    hits = hits_frame(
        spark,
        [
            hit("a", 1, time=None),
            hit("a", 2, time=400),
            hit("a", 3, "buy", time=1000),
            hit("a", 4, time=1001),
            hit("b", 1, "buy", time=5),
            hit("c", 1, time=7),
            hit("c", 9, time=17),
        ],
    )
    found = {r["session_id"]: r for r in M.session_speed(hits, ["buy"]).collect()}
    assert (found["a"].session_duration_ms, found["a"].hits_before_target, found["a"].target) == (1001, 2, 1)
    assert found["a"].avg_time_between_hits == pytest.approx(1001 / 3)
    assert (found["b"].avg_time_between_hits, found["b"].hits_before_target) == (0.0, 0)
    assert (found["c"].hits_before_target, found["c"].avg_time_between_hits) == (2, 10.0)


def test_sessions_without_hits_get_zeros(spark):
    speed = M.session_speed(hits_frame(spark, [hit("a", 1, time=1), hit("a", 2, time=4), hit("a", 3, time=9)]), ["buy"])
    joined = M.sessions_with_speed(sessions_frame(spark, [visit("a", "x"), visit("z", "y")]), speed)
    rows = {r["session_id"]: r for r in joined.collect()}
    assert rows["z"].total_hits_count == 0 and rows["z"].session_duration_ms == 0
    assert rows["a"].avg_time_between_hits == 4


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_results_do_not_depend_on_the_partitioning(spark, partitions):
    rows = [hit(f"s{i % 13}", i % 7, "buy" if i % 5 == 0 else "view", path=f"/cars/c{i % 11}", time=i) for i in range(500)]
    expected = sorted(map(tuple, M.session_speed(hits_frame(spark, rows), ["buy"]).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = M.session_speed(hits_frame(spark, rows).repartition(int(partitions)), ["buy"])
        assert sorted(map(tuple, found.collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hits_before_target_against_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = []
    for _ in range(3000):
        session = "hot" if rng.random() < 0.4 else f"s{rng.randrange(60)}"
        rows.append((session, rng.choice([None, *range(1, 40)]), "buy" if rng.random() < 0.02 else "view"))
    want = {}
    for s in {r[0] for r in rows}:
        numbers = [(r[1], r[2]) for r in rows if r[0] == s and r[1] is not None]
        targets = [n for n, a in numbers if a == "buy"]
        if targets:
            want[s] = sum(n < min(targets) for n, _ in numbers)
    hits = hits_frame(spark, [hit(s, n, a) for s, n, a in rows])
    assert {r[0]: r[1] for r in M.hits_before_target(hits, ["buy"], block_size=8).collect()} == want


def test_first_target_with_the_largest_number(spark):
    last = 2**31 - 1
    rows = [("a", n, "view") for n in (-5, 0, 3, 9_999, 10_000, 25_000, last)] + [("a", last, "buy"), ("b", 2, "buy"), ("b", 1, "view"), ("c", last, "view")]
    found = M.hits_before_target(hits_frame(spark, [hit(*r) for r in rows]), ["buy"])
    assert "Generate" not in found._jdf.queryExecution().toString()
    assert {r[0]: r[1] for r in found.collect()} == {"a": 6, "b": 1}


def test_counters_of_unknown_actions_kinds_and_sessions(spark):
    rows = [
        hit("s1", 1, action=None, path="/cars/a/c1"),
        hit("s1", 2, action="view", kind=None, path="/cars/a/c1"),
        hit("s1", 3, action="view", kind="event", path="/cars/a/c2"),
        hit("s1", 3, action="view", kind="event", path="/cars/a/c2"),
        hit("s1", 4, action="buy", kind="event", path="/cars/a/c3"),
        hit("s2", 1, action="buy", kind="event"),
        hit("s3", 1, action=None, kind="event"),
        hit(None, 1, action="view", path="/cars/a/c9"),
    ]
    found = {r["session_id"]: tuple(r)[1:] for r in M.hit_counters(hits_frame(spark, rows), ["buy"]).collect()}
    assert found == {"s1": (4, 2, 1, 3, 5, 1), "s2": (0, 0, 0, 0, 0, 1), "s3": (1, 1, 0, 0, 0, 0), None: (1, 0, 1, 1, 1, 0)}
    assert M.hit_counters(hits_frame(spark, []), ["buy"]).count() == 0
