"""Shape the ``events`` table as raw hits and sessions.

A session is one user's day. Hits count their time from the first one of their
session and are numbered in it; streamed hits, which cannot see their session,
count both from midnight. Some sessions get a second, conflicting row, and text
columns hold unknown values and placeholders, so that every cleaning rule has
something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ADAPTED_TARGETS = ["purchase"]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def payload_key(events: DataFrame) -> Column:
    """The number ``k`` of the payload; a pattern is three times as fast as a JSON parser here."""
    return F.regexp_extract("props", r'"k"\s*:\s*(-?[0-9]+)', 1).try_cast("int")


# Streamed hits: times count from midnight.
_SECOND_OF_DAY = "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
# zone offsets are whole seconds, so the fraction is the same in every session time zone
_MS_OF_DAY = f"({_SECOND_OF_DAY}) * 1000L + pmod(unix_micros(CAST(ts AS TIMESTAMP)), 1000000L) div 1000L"
_SESSION_ID = "concat_ws('_', CAST(user_id AS STRING), CAST(to_date(ts) AS STRING))"
_PAGE = """
  CASE WHEN event_type IN ('view', 'click', 'purchase')
       THEN concat('/cars/all/b', k % 7, '/c', k,
                   CASE WHEN k % 2 = 0 THEN concat('?utm_source_initial=s', k % 5, '&utm_medium_initial=cpc') ELSE '' END)
       WHEN event_type <> 'error' THEN '/home?x=1' END"""


def as_hits(events: DataFrame, *more: str) -> DataFrame:
    """One hit per event; ``more`` adds SQL expressions over the event."""
    return events.withColumn("k", payload_key(events)).selectExpr(
        f"{_SESSION_ID} AS session_id",
        "to_date(ts) AS hit_date",
        f"CASE WHEN k % 11 <> 0 THEN {_MS_OF_DAY} END AS hit_time",
        f"CAST({_SECOND_OF_DAY} AS INT) AS hit_number",
        "CASE WHEN event_type = 'view' THEN 'pageview' ELSE 'event' END AS hit_type",
        "CAST(NULL AS STRING) AS hit_referer",
        f"{_PAGE} AS hit_page_path",
        "concat('cat_', event_type) AS event_category",
        "event_type AS event_action",
        "CAST(NULL AS STRING) AS event_label",
        "value AS event_value",
        *more,
    )


def as_numbered_hits(events: DataFrame) -> DataFrame:
    """Hits with the time since the first one of the session and their number in it."""
    hits = as_hits(events, "event_id", "ts", "k", "unix_micros(CAST(ts AS TIMESTAMP)) div 1000 AS ms")
    session = W.partitionBy("session_id")
    return hits.withColumns(
        {
            "hit_time": F.when(F.col("k") % 11 != 0, F.col("ms") - F.min("ms").over(session)),
            "hit_number": F.row_number().over(session.orderBy("ts", "event_id")),
        }
    ).drop("event_id", "ts", "k", "ms")


def as_sessions(events: DataFrame) -> DataFrame:
    """One row per user and day, plus a conflicting copy for every tenth user.

    Days are numbered before their copies and texts are made, so narrow rows are shuffled and sorted.
    """
    days = events.groupBy(F.col("user_id").alias("u"), F.to_date("ts").alias("visit_date")).agg(F.min("ts").alias("t0"))
    days = days.withColumn("visit_number", F.row_number().over(W.partitionBy("u").orderBy("visit_date")))
    copied = days.selectExpr("*", "explode(CASE WHEN u % 10 = 0 THEN array(0, 1) ELSE array(0) END) AS dup")
    return copied.selectExpr(
        "concat_ws('_', CAST(u AS STRING), CAST(visit_date AS STRING)) AS session_id",
        "CAST(u AS STRING) AS client_id",
        "visit_date",
        """CASE WHEN dup = 0 THEN substring(CAST(t0 AS STRING), 12, 8) WHEN u % 20 <> 0 THEN '00:00:00' END AS visit_time""",
        "visit_number",
        "CASE WHEN u % 9 <> 0 THEN concat('src', u % 9) END AS utm_source",
        """CASE u % 6 WHEN 0 THEN 'organic' WHEN 1 THEN 'referral' WHEN 2 THEN '(none)' WHEN 3 THEN 'cpc'
           WHEN 4 THEN 'cpm' ELSE '(not set)' END AS utm_medium""",
        "CASE WHEN dup = 1 THEN 'dup' ELSE concat('camp', u % 30) END AS utm_campaign",
        "CASE WHEN u % 5 >= 3 THEN concat('kw', u % 4) END AS utm_keyword",
        "CASE WHEN u % 5 <> 0 THEN concat('ad', u % 3) END AS utm_adcontent",
        "CASE WHEN u % 10 < 6 THEN 'mobile' WHEN u % 10 < 9 THEN 'desktop' ELSE 'tablet' END AS device_category",
        """CASE WHEN u % 7 >= 4 AND u % 10 BETWEEN 6 AND 8 THEN 'Windows' WHEN u % 7 >= 4 THEN 'Android' END AS device_os""",
        """CASE u % 8 WHEN 0 THEN 'Apple' WHEN 1 THEN 'Samsung' WHEN 2 THEN 'Xiaomi' WHEN 3 THEN 'Huawei'
           WHEN 4 THEN '(not set)' WHEN 5 THEN NULL ELSE 'Apple' END AS device_brand""",
        "CASE WHEN u % 100 = 0 THEN 'm1' END AS device_model",
        """CASE u % 6 WHEN 0 THEN '1920x1080' WHEN 1 THEN '414x896' WHEN 2 THEN '360x720' WHEN 3 THEN '(not set)'
           WHEN 4 THEN NULL ELSE '0x0' END AS device_screen_resolution""",
        "CASE u % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'YaBrowser' ELSE '(Other)' END AS device_browser",
        """CASE u % 20 WHEN 0 THEN 'Belarus' WHEN 1 THEN 'Kazakhstan' WHEN 2 THEN 'Germany' WHEN 3 THEN '(not set)'
           ELSE 'Russia' END AS geo_country""",
        """CASE u % 9 WHEN 0 THEN 'Moscow' WHEN 1 THEN 'Saint Petersburg' WHEN 2 THEN ' KAZAN ' WHEN 3 THEN 'Dublin'
           WHEN 4 THEN '(not set)' WHEN 5 THEN NULL WHEN 6 THEN 'Smallville' WHEN 7 THEN 'Sochi'
           ELSE 'Yekaterinburg' END AS geo_city""",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(hits, sessions) of one scale factor."""
    events = read_events(spark, sf_dir)
    return as_numbered_hits(events), as_sessions(events)
