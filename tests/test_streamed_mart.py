"""The streamed mart next to the batch mart on the same rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from clickloom.operators import mart as M
from clickloom.sources.schemas import HITS_SCHEMA, SESSIONS_SCHEMA
from clickloom.streaming import jobs, sinks

START = datetime(2024, 3, 1)


def rows_of(spark, seed=3, sessions=40):
    """Hits and session rows with conflicting copies, unknown values, sessions without hits and hits without session."""
    rng = random.Random(seed)
    hits, contexts = [], []
    for i in range(sessions):
        begin = START + timedelta(minutes=rng.randrange(600))
        if i % 9 != 4:
            for _ in range(rng.choice([1, 1, 2, 4])):
                contexts.append(
                    {
                        "session_id": f"s{i}",
                        "client_id": rng.choice(["c", "d", None]),
                        "visit_date": rng.choice([date(2024, 3, 1), date(2024, 3, 2), date(1960, 1, 1), None]),
                        "visit_time": rng.choice(["09:00", "09:00:00", "9", "", "é", None]),
                        "utm_source": rng.choice(["a", "aa", "", None]),
                        "visit_number": rng.choice([1, 2, None]),
                        "ts": begin + timedelta(minutes=rng.randrange(100)),
                    }
                )
        for _ in range(0 if i % 7 == 3 else rng.randrange(1, 12)):
            hits.append(
                {
                    "session_id": f"s{i}",
                    "event_action": rng.choice(["view", "call", "buy", None]),
                    "hit_type": rng.choice(["event", "pageview", None]),
                    "hit_page_path": rng.choice(["/cars/all/b/c1?x", "/cars/all/b/c2", "/home", None]),
                    "ts": begin + timedelta(minutes=rng.randrange(120)),
                }
            )
    return [spark.createDataFrame([{**dict.fromkeys(s.names), **r} for r in rows], s.add("ts", "timestamp")) for rows, s in ((hits, _copy(HITS_SCHEMA)), (contexts, _copy(SESSIONS_SCHEMA)))]


def _copy(schema):
    return type(schema)(list(schema.fields))


def streamed(spark, folder, df, name):
    """The rows in four files in random order, one file a batch."""
    for i, part in enumerate(df.randomSplit([1.0] * 4, seed=5)):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    return sinks.read_files(spark, f"{folder}/{name}", df.schema, files_per_batch=1)


def closing(df, **values):
    """A row a year later: the watermark passes everything before it."""
    row = {**dict.fromkeys(df.columns), "session_id": "end", "ts": datetime(2025, 3, 1), **values}
    return df.sparkSession.createDataFrame([row], df.schema)


def test_streamed_mart_equals_the_batch_mart_in_any_order(spark, tmp_path):
    hits, sessions = rows_of(spark)
    batch = M.build_mart(hits.drop("ts"), sessions.drop("ts"), ["buy"])
    streams = [streamed(spark, str(tmp_path), df, name) for df, name in ((hits, "hits"), (sessions, "sessions"))]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    mart = jobs.session_mart(*streams, ["buy"], gap="3 hours", delay="2 days")
    first, late = sinks.run_counting_late(mart, "m", out, progress)
    assert first.count() == 0 and late == 0  # nothing has closed yet
    for name, df in (("hits", hits), ("sessions", sessions)):
        closing(df).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    found, late = sinks.run_counting_late(mart, "m", out, progress)
    assert late == 0 and found.columns == batch.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, batch.select(found.columns).collect()))
    assert batch.count() > 20


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    hits, sessions = rows_of(spark, sessions=5)
    streams = [streamed(spark, str(tmp_path), df, name) for df, name in ((hits, "hits"), (sessions, "sessions"))]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    mart = jobs.session_mart(*streams, ["buy"], gap="3 hours", delay="2 days")
    sinks.run_available(mart, "m", out, progress)
    closing(hits).coalesce(1).write.mode("append").parquet(f"{tmp_path}/hits")
    closed = sinks.run_available(mart, "m", out, progress).count()
    assert closed > 0
    closing(hits, session_id="s0", ts=START).coalesce(1).write.mode("append").parquet(f"{tmp_path}/hits")
    found, late = sinks.run_counting_late(mart, "m", out, progress)
    assert late == 1 and found.count() == closed


def test_order_of_conflicting_rows_equals_the_batch(spark):
    times = ["", "0", "00", "09:00", "09:00:00", "~", "é", "日", None]
    rows = spark.createDataFrame([(t, date(1960 + i, 1, 1) if i % 3 else None) for i, t in enumerate(times)], "t string, d date")
    for name in ("t", "d"):
        by = jobs._backwards(rows.schema[name])
        ours = [r[0] for r in rows.orderBy(by.asc_nulls_first(), "t").select(name).collect()]
        assert ours == [r[0] for r in rows.orderBy(F.desc_nulls_first(name), "t").select(name).collect()]
