"""The session mart and its relatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.session import stage

SESSION_COLUMNS = [
    "session_id",
    "client_id",
    "visit_date",
    "visit_time",
    "visit_number",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_adcontent",
    "device_category",
    "device_os",
    "device_brand",
    "device_screen_resolution",
    "device_browser",
    "geo_country",
    "geo_city",
]
COUNTERS = [
    "total_hits_count",
    "total_events_count",
    "unique_event_actions",
    "unique_cars_viewed",
    "total_car_views",
]


def latest_sessions(sessions: DataFrame) -> DataFrame:
    """One row per session: the latest date, then time; an unknown time wins.

    Equal rows are told apart by their other columns, so the choice repeats.
    Spark keeps one row per session and task before the shuffle, so copies of
    one session never meet in bulk.
    """
    ties = [c for c in sessions.columns if c not in ("session_id", "visit_date", "visit_time")]
    newest = W.partitionBy("session_id").orderBy(
        F.desc_nulls_first("visit_date"),
        F.desc_nulls_first("visit_time"),
        *[F.asc_nulls_last(c) for c in ties],
    )
    return sessions.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


def hit_counters(hits: DataFrame, targets: Sequence[str] = tuple(C.TARGET_ACTIONS)) -> DataFrame:
    """Counters and target flag per session.

    Counts of hits leave target hits out; car views keep them. Hits are
    grouped by session and action and by session and car first, which spreads a huge
    session over many tasks and merges its hits before any shuffle; all other counters
    are sums over the groups of actions. Only partial sums are shuffled by session.
    """
    marked = hits.select(
        "session_id",
        "event_action",
        (F.col("hit_type") == "event").alias("event"),
        X.is_target(F.col("event_action"), targets).alias("target"),
        X.car_id(F.col("hit_page_path")).alias("car"),
    )
    other = F.col("target") == 0
    values = marked.groupingSets([["session_id", "event_action"], ["session_id", "car"]], "session_id", "event_action", "car").agg(
        (F.grouping("event_action") == 0).alias("by_action"),
        F.count(F.when(other, 1)).alias("n_other"),
        F.count(F.when(other & F.col("event"), 1)).alias("n_events"),
        F.count("car").alias("n_views"),
        F.max("target").alias("target"),
    )
    by_action = F.col("by_action")
    return values.groupBy("session_id").agg(
        F.sum(F.when(by_action, F.col("n_other"))).alias("total_hits_count"),
        F.sum(F.when(by_action, F.col("n_events"))).alias("total_events_count"),
        F.count(F.when(by_action & (F.col("n_other") > 0), F.col("event_action"))).alias("unique_event_actions"),
        F.count(F.when(~by_action, F.col("car"))).alias("unique_cars_viewed"),
        F.sum(F.when(by_action, F.col("n_views"))).alias("total_car_views"),
        F.max("target").alias("event_value"),
    )


def build_mart(
    hits: DataFrame,
    sessions: DataFrame,
    targets: Sequence[str] = tuple(C.TARGET_ACTIONS),
    exclude_target_cars: bool = False,
) -> DataFrame:
    """One row per session: context, behaviour counters, car share and target.

    ``exclude_target_cars`` leaves target hits out of the car counters too,
    so that the car share cannot pass 1.
    """
    counted = hits
    if exclude_target_cars:
        path = F.when(X.is_target(F.col("event_action"), targets) == 0, F.col("hit_page_path"))
        counted = hits.withColumn("hit_page_path", path)
    # all columns take part in the order, so that every mart keeps the same copy
    context = latest_sessions(sessions).select(*SESSION_COLUMNS)
    joined = context.join(hit_counters(counted, targets), "session_id", "left")
    joined = joined.na.fill(0, [*COUNTERS, "event_value"])
    ratio = X.safe_ratio(F.col("total_car_views"), F.col("total_hits_count"), 4)
    return joined.select(*SESSION_COLUMNS, *COUNTERS, ratio.alias("car_view_ratio"), "event_value")


def dirty_mart(
    hits: DataFrame, sessions: DataFrame, targets: Sequence[str] = tuple(C.TARGET_ACTIONS)
) -> DataFrame:
    """All session columns plus a flag: did any target hit happen in the session."""
    converted = hits.filter(X.target_filter(F.col("event_action"), targets)).select("session_id").distinct().withColumn("hit", F.lit(1))
    joined = latest_sessions(sessions).join(converted, "session_id", "left")
    return joined.withColumn(C.TARGET_COLUMN, X.flag(F.col("hit").isNotNull())).drop("hit")


def hits_with_client(hits: DataFrame, sessions: DataFrame, deduplicate: bool = False) -> DataFrame:
    """Every hit with its client. Conflicting session rows repeat a hit, as a join does.

    Adaptive execution splits the hits of a huge session over many tasks. It
    does so only where both sides come straight from a scan, so deduplicated
    sessions are written first.
    """
    owners = sessions.select("session_id", "client_id")
    if deduplicate:
        owners = stage(latest_sessions(sessions).select("session_id", "client_id"), "owners")
    return hits.join(owners, "session_id")


def parsed_urls(hits: DataFrame) -> DataFrame:
    """Hits with the car and the first campaign tags found in the page address."""
    path = F.col("hit_page_path")
    tags = {f"utm_{t}_init": X.utm_initial(path, t) for t in ("source", "medium", "campaign")}
    return hits.withColumns({**tags, "car_id": X.car_id(path)})


# Hit numbers of one session are handled in blocks of this many.
NUMBER_BLOCK = 10_000


def hits_before_target(
    hits: DataFrame, targets: Sequence[str] = tuple(C.TARGET_ACTIONS), block_size: int = NUMBER_BLOCK
) -> DataFrame:
    """Per session with a numbered target hit: hits numbered below the first one.

    That is the place of the first target among the hits sorted by number, with
    targets first among equal numbers and unknown numbers last. The first
    targets come from a scan filtered to target hits. Hits meet them per session
    and block of numbers, so a hit of a session without a target goes no further
    than the join, and no task receives more than a block of a session at once.
    Blocks before that of the first target count whole: their sizes are summed
    per block before any shuffle, for the few sessions that have such blocks.
    A first target is one row, whatever its number is.
    """
    known = F.col("hit_number").isNotNull()
    number = F.col("hit_number").alias("number")

    def block(c: str) -> Column:
        return F.floor(F.greatest(F.col(c), F.lit(0)) / block_size).cast("int").alias("block")

    target = X.target_filter(F.col("event_action"), targets)
    firsts = hits.filter(target & known).select("session_id", number).groupBy("session_id")
    firsts = firsts.agg(F.min("number").alias("first")).select("session_id", "first", block("first"))
    placed = hits.filter(known).select("session_id", number).select("session_id", "number", block("number"))
    # the target hit itself always finds its block, so every session comes out, if only with 0
    met = placed.join(firsts, ["session_id", "block"]).groupBy("session_id")
    same = met.agg(F.count(F.when(F.col("number") < F.col("first"), 1)).alias("n"))
    later = firsts.filter("block > 0").select("session_id", F.col("block").alias("last"))
    whole = placed.groupBy("session_id", "block").agg(F.count(F.lit(1)).alias("n")).join(later, "session_id")
    parts = same.unionByName(whole.filter("block < last").select("session_id", "n"))
    return parts.groupBy("session_id").agg(F.sum("n").alias("hits_before_target"))


def session_speed(hits: DataFrame, targets: Sequence[str] = tuple(C.TARGET_ACTIONS)) -> DataFrame:
    """Times, counts and speed of every session that has hits."""
    marked = hits.select(
        "session_id",
        "hit_number",
        F.coalesce("hit_time", F.lit(0)).alias("time"),
        X.car_id(F.col("hit_page_path")).alias("car"),
        X.is_target(F.col("event_action"), targets).alias("target"),
    )
    totals = marked.groupBy("session_id").agg(
        F.min("time").alias("first_hit_time_ms"),
        F.max("time").alias("last_hit_time_ms"),
        F.count("hit_number").alias("total_hits_count"),
        F.count_distinct("car").alias("unique_cars_viewed"),
        F.count("car").alias("total_car_views"),
        F.max("target").alias("target"),
    )
    duration = F.col("last_hit_time_ms") - F.col("first_hit_time_ms")
    steps = F.col("total_hits_count") - 1
    timed = totals.withColumns(
        {
            "session_duration_ms": duration,
            "avg_time_between_hits": F.when(steps > 0, duration / steps).otherwise(0.0),
        }
    )
    # without a numbered target every numbered hit counts
    before = hits_before_target(hits, targets)
    joined = timed.join(before, "session_id", "left")
    return joined.withColumn(
        "hits_before_target", F.coalesce("hits_before_target", "total_hits_count")
    )


SPEED_FILLED = [
    "total_hits_count",
    "unique_cars_viewed",
    "total_car_views",
    "session_duration_ms",
    "avg_time_between_hits",
    "hits_before_target",
    "target",
]


def sessions_with_speed(sessions: DataFrame, speed: DataFrame) -> DataFrame:
    """Sessions with their speed features; sessions without hits get whole zeros.

    The features are written first, so that adaptive execution can split a
    session id with very many rows over several tasks.
    """
    joined = sessions.join(stage(speed, "speed"), "session_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in SPEED_FILLED})


def with_calendar(sessions: DataFrame) -> DataFrame:
    """Date, weekday, weekend and hour columns of the visit."""
    day = X.weekday_number(F.col("visit_date"))
    return sessions.withColumns(
        {
            "visit_date_dt": F.col("visit_date").try_cast("date"),
            "day_of_week": day,
            "is_weekend": X.flag(day.isin(*C.WEEKEND_DAYS)),
            "visit_hour": X.clock_hour(F.col("visit_time")),
        }
    )


def with_traffic_flags(sessions: DataFrame) -> DataFrame:
    """Flags for organic mediums and social ad sources."""
    return sessions.withColumns(
        {
            "is_organic_medium": X.flag(F.col("utm_medium").isin(*C.ORGANIC_MEDIUMS)),
            "is_social_media": X.flag(F.col("utm_source").isin(*C.SOCIAL_SOURCES)),
        }
    )
