"""Files, tables, contracts, tracking and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.operators import mart as M
from clickloom.operators import tracking as K
from clickloom.operators.errors import histogram
from clickloom.sources import events as E
from clickloom.sources import files as S
from clickloom.sources import schemas as H
from clickloom.streaming import jobs, sinks

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return E.raw_tables(spark, SF_DIR)


def test_csv_load_round_trip(spark, raw, tmp_path):
    _, sessions = raw
    csv, out = str(tmp_path / "sessions_csv"), str(tmp_path / "sessions")
    writer = sessions.select(*H.SESSIONS_SCHEMA.fieldNames()).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(csv)
    loaded = S.load_raw_csv(spark, csv, "sessions", out)
    assert loaded.schema == H.SESSIONS_SCHEMA
    assert loaded.select(*sessions.columns).exceptAll(sessions).isEmpty() and loaded.count() == sessions.count()
    plan = loaded.filter("visit_date = DATE'2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(visit_date" in plan
    with pytest.raises(ValueError):
        S.load_raw_csv(spark, csv, "orders", out)


def hits_csv(tmp_path, header, *lines):
    path = tmp_path / "hits.csv"
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def test_csv_columns_go_by_name_and_quotes_hold(spark, tmp_path):
    names = H.HITS_SCHEMA.fieldNames()[::-1]
    values = {"session_id": "s1", "hit_date": "2024-01-02", "hit_time": "597864.0", "hit_number": "3", "event_label": '"say ""hi"", ok\nnext line"', "event_value": "0.5"}
    path = hits_csv(tmp_path, names, ",".join(values.get(n, "") for n in names))
    rows = S.load_raw_csv(spark, path, "hits", str(tmp_path / "out")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["session_id"], row["hit_time"], row["hit_number"], row["event_value"], row["hit_type"]) == ("s1", 597864, 3, 0.5, None)
    assert row["event_label"] == 'say "hi", ok\nnext line'
    assert S.read_flat(spark, path, H.HITS_SCHEMA).collect() == rows


def test_csv_bad_values_and_missing_columns_are_errors(spark, tmp_path):
    names = H.HITS_SCHEMA.fieldNames()
    path = hits_csv(tmp_path, names, *(",".join(["s", "2024-01-02", t, "1", *[""] * 7]) for t in ("1", "notanumber", "1.5", "9007199254740993")))
    with pytest.raises(ValueError, match="hit_time: 2"):
        S.load_raw_csv(spark, path, "hits", str(tmp_path / "out"))
    assert [(r["column_name"], r["n_rejected"]) for r in S.csv_rejects(spark, path, H.HITS_SCHEMA).collect()] == [("hit_time", 2)]
    loaded = S.load_raw_csv(spark, path, "hits", str(tmp_path / "out"), max_rejects=2)
    assert sorted(r["hit_time"] or 0 for r in loaded.collect()) == [0, 0, 1, 9007199254740993]
    short = hits_csv(tmp_path, names[1:], ",".join(["2024-01-02", "1", "1", *[""] * 7]))
    with pytest.raises(ValueError, match="no column session_id"):
        S.load_raw_csv(spark, short, "hits", str(tmp_path / "out2"))


def test_flat_files(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    df.write.parquet(str(tmp_path / "a.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "a.csv"))
    assert S.read_flat(spark, str(tmp_path / "a.parquet")).count() == 1000
    assert dict(S.read_flat(spark, str(tmp_path / "a.csv")).dtypes)["x"] == "int"
    share = S.read_flat(spark, str(tmp_path / "a.csv"), df.schema, sample=0.3).count() / 1000
    assert 0.2 < share < 0.4
    with pytest.raises(ValueError, match="unsupported"):
        S.read_flat(spark, str(tmp_path / "a.xlsx"))
    with pytest.raises(ValueError, match="no data file"):
        S.read_flat(spark, str(tmp_path / "nothing.parquet"))


def test_cache_is_keyed_and_survives_half_writes(spark, tmp_path):
    built = []

    def build(n):
        def run():
            built.append(n)
            return spark.range(n)

        return run

    root = str(tmp_path)
    assert S.cached_table(spark, root, "mart", "1", 0.2, build(3)).count() == 3
    assert S.cached_table(spark, root, "mart", "1", 0.2, build(4)).count() == 3
    assert S.cached_table(spark, root, "dirty", "1", 0.2, build(5)).count() == 5
    assert S.cached_table(spark, root, "mart", "2", 0.2, build(6)).count() == 6
    (tmp_path / "mart" / "version=1" / "sample=0.2" / "_SUCCESS").unlink()
    assert S.cached_table(spark, root, "mart", "1", 0.2, build(7)).count() == 7
    assert built == [3, 5, 6, 7]


def test_raw_tables_and_bucketed_join(spark, raw):
    H.create_raw_tables(spark, "t_hits", "t_sessions")
    assert spark.table("t_hits").count() == 0 and set(spark.table("t_sessions").columns) == set(H.SESSIONS_SCHEMA.fieldNames())
    H.create_raw_tables(spark, "t_hits", "t_sessions")
    hits, sessions = raw
    H.save_bucketed(hits, "b_hits", 4)
    H.save_bucketed(sessions, "b_sessions", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = M.hits_with_client(spark.table("b_hits"), spark.table("b_sessions"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == M.hits_with_client(hits, sessions).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_contract(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", None), ("x", "b", 2.0)], "n string, t string, v double")
    path = str(tmp_path / "contract")
    H.write_contract(df, path)
    assert H.read_contract(spark, path) == json.loads(H.contract_of(df)) == {"n": "string", "t": "string", "v": "double"}
    report = {r["column_name"]: r for r in H.check_schema(df, {"n": "int", "v": "int"}).collect()}
    assert (report["n"]["n_broken"], report["v"]["n_null"], report["v"]["n_broken"]) == (1, 1, 0)
    assert [r.n for r in H.apply_contract(df, {"n": "int"}).collect()] == [1, None]
    with pytest.raises(ValueError, match="missing"):
        H.check_schema(df, {"absent": "int"})


def test_stages_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    staged = session.stage(spark.range(5), "numbers")
    other = tmp_path / "another-application"
    other.mkdir()
    assert staged.count() == 5 and len(list(tmp_path.glob("clickloom-*"))) == 1
    session.clear_stages(spark)
    assert not list(tmp_path.glob("clickloom-*")) and other.exists()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.1), ("a", 0.9)], "feature string, importance double")
    S.write_ranking(df, str(tmp_path / "rank"))
    assert len(list((tmp_path / "rank").glob("*.csv"))) == 1
    S.write_predictions(df, str(tmp_path / "p"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).count() == 2
    with pytest.raises(ValueError):
        S.write_predictions(df, str(tmp_path / "q"), "xml")


def test_tracking_tables(spark, tmp_path):
    root = str(tmp_path)
    K.log_run(spark, root, "r1", "train", version="1")
    K.log_metrics(spark, root, "r1", {"a:b=c,d": 1}, step=2)
    K.log_metrics(spark, root, "r2", {"auc": 0.5})
    K.log_params(spark, root, "r1", {"depth": 7})
    assert {(r.run_id, r.key, r.step) for r in K.read_log(spark, root, "metrics").collect()} == {("r1", "a_b_c_d", 2), ("r2", "auc", 0)}
    assert K.read_log(spark, root, "params").first()["value"] == "7"
    assert K.read_log(spark, root, "runs").count() == 1


def test_latency_buckets_are_cumulative(spark):
    df = spark.createDataFrame([(0.005,), (0.05,), (0.3,), (9.0,), (None,)], "s double")
    assert tuple(K.latency_histogram(df, "s", [0.01, 0.05, 0.5]).first()) == (1, 2, 3, 4)
    assert histogram(df, "s", 2).agg(F.sum("n")).first()[0] == 4


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class Fake:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        session.shared_dir(Fake())
    Fake.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: "hdfs:///shared")})
    assert session.shared_dir(Fake()) == "hdfs:///shared"


def stream_events(spark, tmp_path, files=4):
    """The events in time order, one file after the other."""
    events = E.read_events(spark, SF_DIR)
    folder = str(tmp_path / "events")
    days = [r[0] for r in events.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    step = len(days) // files + 1
    for i in range(0, len(days), step):
        part = events.filter(F.to_date("ts").isin(days[i : i + step]))
        part.coalesce(1).write.mode("append").parquet(folder)
    return events, sinks.read_files(spark, folder, events.schema, files_per_batch=1)


def test_streamed_sessions_equal_the_batch(spark, tmp_path):
    events, stream = stream_events(spark, tmp_path)
    extra = ("CAST(ts AS TIMESTAMP) AS ts", "CAST(user_id AS STRING) AS client_id")
    streamed = sinks.run_available(jobs.session_counters(E.as_hits(stream, *extra), ["purchase"], gap="6 hours"), "s")
    batch = jobs.session_counters(E.as_hits(events, *extra), ["purchase"], gap="6 hours")
    last = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = batch.filter(F.col("end") <= F.lit(last) - F.expr("INTERVAL 2 HOURS"))
    assert streamed.count() > 0
    assert streamed.exceptAll(closed).isEmpty() and closed.exceptAll(streamed).isEmpty()


def test_streamed_monitor_equals_the_batch(spark, tmp_path):
    events, stream = stream_events(spark, tmp_path)

    def scored(df):
        share = (F.col("user_id") % 10) / 10
        return df.select(
            F.col("ts").cast("timestamp").alias("ts"), (share > 0.5).cast("int").alias("prediction"), share.alias("confidence")
        )

    streamed = sinks.run_available(jobs.prediction_windows(scored(stream), length="1 day"), "m")
    batch = jobs.prediction_windows(scored(events), length="1 day")
    missing = batch.exceptAll(streamed)
    assert streamed.exceptAll(batch).isEmpty() and streamed.count() > 0
    assert missing.select("window_start").distinct().count() <= 1  # the day still open


def test_streamed_dedup(spark, tmp_path):
    events, stream = stream_events(spark, tmp_path)
    keyed = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = keyed.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = sinks.run_available(jobs.deduplicated(twice, ["event_id"]), "d")
    assert kept.count() == events.count()


def test_stopped_stream_goes_on_where_it_stood(spark, tmp_path):
    events = E.read_events(spark, SF_DIR).select("event_id")
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    events.coalesce(1).write.mode("append").parquet(folder)
    for round_ in (1, 2):
        stream = sinks.read_files(spark, folder, events.schema)
        done = sinks.run_available(stream, "x", out, progress)
        assert done.count() == round_ * events.count()
        events.coalesce(1).write.mode("append").parquet(folder)
