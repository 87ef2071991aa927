"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.functions.quantiles import exact_quantiles
from clickloom.operators import eda, explain, models, trees, tuning
from clickloom.operators import errors as R
from clickloom.operators import mart as M
from clickloom.operators import metrics as Q
from clickloom.operators import sampling as S
from clickloom.operators import tracking as K
from clickloom.operators.cleaning import SessionCleaner
from clickloom.operators.encoding import collapse_rare_categories, one_hot, ordinal_encode
from clickloom.operators.features import SessionFeatures
from clickloom.operators.filters import drop_sparse_by_count, drop_sparse_rows
from clickloom.operators.neighbours import neighbour_information
from clickloom.operators.splitting import client_labels, group_split, split_sizes, three_frames
from clickloom.operators.target_statistics import ordered_targets
from clickloom.plans import oracle as O
from clickloom.plans import training as T
from clickloom.session import new_path, stage
from clickloom.sources import events as E
from clickloom.sources import quoted_csv
from clickloom.sources.files import read_flat, write_csv
from clickloom.sources.schemas import SESSIONS_SCHEMA, check_schema
from clickloom.streaming import jobs, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TARGETS = E.ADAPTED_TARGETS


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def text_dates(df: DataFrame) -> DataFrame:
    """Dates as text, so that both engines hand back the same values."""
    dates = [name for name, kind in df.dtypes if kind in ("date", "timestamp", "timestamp_ntz")]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def mart_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, sessions = E.raw_tables(spark, sf_dir)
    return M.build_mart(hits, sessions, TARGETS)


# --- mart ----------------------------------------------------------------------


@query(
    "session_mart",
    O.sql(O.BLOCKS["mart"], "SELECT * REPLACE (CAST(visit_date AS VARCHAR) AS visit_date) FROM mart"),
)
def session_mart(spark, sf_dir):
    return text_dates(mart_of(spark, sf_dir))


@query(
    "session_mart_strict",
    O.sql(
        [*O.BLOCKS["latest"], O.HITS, O.MARKED.replace("AS car\n", "AS any_car\n").replace(
            "marked AS (", "all_marked AS ("
        ), "marked AS (SELECT *, CASE WHEN NOT is_target THEN any_car END AS car FROM all_marked)", O.MART],
        "SELECT session_id, unique_cars_viewed, total_car_views, car_view_ratio, event_value FROM mart",
    ),
)
def session_mart_strict(spark, sf_dir):
    """The mart with car views counted on non-target hits only."""
    mart = M.build_mart(*E.raw_tables(spark, sf_dir), TARGETS, exclude_target_cars=True)
    return mart.select("session_id", "unique_cars_viewed", "total_car_views", "car_view_ratio", "event_value")


@query(
    "dirty_mart",
    O.sql(
        [*O.BLOCKS["latest"], O.HITS, O.MARKED],
        """SELECT l.* REPLACE (CAST(visit_date AS VARCHAR) AS visit_date),
                  CASE WHEN h.session_id IS NULL THEN 0 ELSE 1 END AS event_value
           FROM latest l LEFT JOIN (SELECT DISTINCT session_id FROM marked WHERE is_target) h USING (session_id)""",
    ),
)
def dirty_mart(spark, sf_dir):
    return text_dates(M.dirty_mart(*E.raw_tables(spark, sf_dir), TARGETS))


@query(
    "hits_with_client",
    O.sql(
        [*O.BLOCKS["sessions"], O.HITS],
        """SELECT h.* REPLACE (CAST(hit_date AS VARCHAR) AS hit_date), s.client_id
           FROM ga_hits h JOIN ga_sessions s USING (session_id)""",
    ),
)
def hits_with_client(spark, sf_dir):
    return text_dates(M.hits_with_client(*E.raw_tables(spark, sf_dir)))


@query(
    "hits_with_one_client",
    O.sql(
        [*O.BLOCKS["latest"], O.HITS],
        "SELECT h.session_id, h.hit_number, h.event_action, l.client_id FROM ga_hits h JOIN latest l USING (session_id)",
    ),
)
def hits_with_one_client(spark, sf_dir):
    """Hits with the client of the deduplicated session."""
    joined = M.hits_with_client(*E.raw_tables(spark, sf_dir), deduplicate=True)
    return joined.select("session_id", "hit_number", "event_action", "client_id")


@query(
    "utm_from_url",
    O.sql(
        O.BLOCKS["hits"],
        f"""SELECT session_id, hit_number, hit_page_path,
                  nullif(regexp_extract(hit_page_path, 'utm_source_initial=([^&]+)', 1), '') AS utm_source_init,
                  nullif(regexp_extract(hit_page_path, 'utm_medium_initial=([^&]+)', 1), '') AS utm_medium_init,
                  nullif(regexp_extract(hit_page_path, 'utm_campaign_initial=([^&]+)', 1), '') AS utm_campaign_init,
                  nullif(regexp_extract(hit_page_path, '{C.CAR_ID_PATTERN}', 1), '') AS car_id
           FROM ga_hits""",
    ),
)
def utm_from_url(spark, sf_dir):
    hits, _ = E.raw_tables(spark, sf_dir)
    return M.parsed_urls(hits).select(
        "session_id", "hit_number", "hit_page_path", "utm_source_init", "utm_medium_init", "utm_campaign_init", "car_id"
    )


@query("session_speed", O.sql(O.BLOCKS["speed"], "SELECT * FROM speed"))
def session_speed(spark, sf_dir):
    hits, _ = E.raw_tables(spark, sf_dir)
    return M.session_speed(hits, TARGETS)


@query(
    "sessions_with_speed",
    O.sql(
        O.BLOCKS["speed"],
        """SELECT s.session_id, s.client_id, s.utm_campaign, first_hit_time_ms, last_hit_time_ms,
                  coalesce(total_hits_count, 0) AS total_hits_count,
                  coalesce(unique_cars_viewed, 0) AS unique_cars_viewed,
                  coalesce(total_car_views, 0) AS total_car_views,
                  CAST(coalesce(target, 0) AS BIGINT) AS target,
                  coalesce(session_duration_ms, 0) AS session_duration_ms,
                  CAST(trunc(coalesce(avg_time_between_hits, 0)) AS BIGINT) AS avg_time_between_hits,
                  coalesce(hits_before_target, 0) AS hits_before_target
           FROM ga_sessions s LEFT JOIN speed USING (session_id)""",
    ),
)
def sessions_with_speed(spark, sf_dir):
    hits, sessions = E.raw_tables(spark, sf_dir)
    keys = sessions.select("session_id", "client_id", "utm_campaign")
    return M.sessions_with_speed(keys, M.session_speed(hits, TARGETS))


@query(
    "calendar_and_traffic",
    O.sql(
        O.BLOCKS["sessions"],
        f"""SELECT session_id, utm_campaign, CAST(visit_date AS VARCHAR) AS visit_date_dt,
                  CAST(isodow(visit_date) - 1 AS INT) AS day_of_week,
                  CAST(isodow(visit_date) IN (6, 7) AS INT) AS is_weekend,
                  CAST(substring(visit_time, 1, 2) AS INT) AS visit_hour,
                  CAST(utm_medium IN ({O.quoted(C.ORGANIC_MEDIUMS)}) AS INT) AS is_organic_medium,
                  CAST(coalesce(utm_source IN ({O.quoted(C.SOCIAL_SOURCES)}), false) AS INT) AS is_social_media
           FROM ga_sessions""",
    ),
)
def calendar_and_traffic(spark, sf_dir):
    _, sessions = E.raw_tables(spark, sf_dir)
    return text_dates(
        M.with_traffic_flags(M.with_calendar(sessions)).select(
            "session_id",
            "utm_campaign",
            "visit_date_dt",
            "day_of_week",
            "is_weekend",
            "visit_hour",
            "is_organic_medium",
            "is_social_media",
        )
    )


# --- filters, samples, splits --------------------------------------------------

SPARSE_COLUMNS = [
    "session_id",
    "utm_source",
    "utm_keyword",
    "utm_adcontent",
    "device_os",
    "device_brand",
    "device_model",
    "device_screen_resolution",
    "geo_city",
]
_KNOWN = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in SPARSE_COLUMNS)


def sparse_frame(spark, sf_dir):
    return E.raw_tables(spark, sf_dir)[1].select(*SPARSE_COLUMNS)


@query(
    "row_null_filter_count",
    O.sql(O.BLOCKS["sessions"], f"SELECT {', '.join(SPARSE_COLUMNS)} FROM ga_sessions WHERE {_KNOWN} >= 4"),
)
def row_null_filter_count(spark, sf_dir):
    return drop_sparse_by_count(sparse_frame(spark, sf_dir))


@query(
    "row_null_filter_share",
    O.sql(O.BLOCKS["sessions"], f"SELECT {', '.join(SPARSE_COLUMNS)} FROM ga_sessions WHERE (9 - ({_KNOWN})) / 9 <= 0.5"),
)
def row_null_filter_share(spark, sf_dir):
    return drop_sparse_rows(sparse_frame(spark, sf_dir))


@query(
    "client_sample",
    O.sql(
        O.BLOCKS["mart"],
        f"SELECT * REPLACE (CAST(visit_date AS VARCHAR) AS visit_date) FROM mart WHERE {O.share_of('client_id')} < {C.SAMPLE_SHARE}",
    ),
)
def client_sample(spark, sf_dir):
    return text_dates(S.client_sample(mart_of(spark, sf_dir)))


@query(
    "rows_of_clients",
    """SELECT event_id, user_id, event_type FROM events
       WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 107)""",
)
def rows_of_clients(spark, sf_dir):
    """All events of the users with a large purchase; the list repeats users, the events stay single."""
    events = E.read_events(spark, sf_dir)
    buyers = events.filter("event_type = 'purchase' AND value > 107")
    return S.rows_of_clients(events.select("event_id", "user_id", "event_type"), buyers, "user_id")


@query(
    "row_sample",
    f"SELECT event_id, user_id, event_type FROM events WHERE {O.share_of('event_id')} < 0.2",
)
def row_sample(spark, sf_dir):
    """Bernoulli sample of events by the digest of their key."""
    return S.row_sample(E.read_events(spark, sf_dir).select("event_id", "user_id", "event_type"), 0.2, keys=["event_id"])


@query(
    "group_split",
    O.sql(
        O.BLOCKS["mart"],
        "SELECT session_id, client_id, event_value, split FROM mart JOIN client_splits USING (client_id)",
        O.SPLIT,
    ),
)
def group_split_query(spark, sf_dir):
    return group_split(stage(mart_of(spark, sf_dir), "mart")).select("session_id", "client_id", "event_value", "split")


@query(
    "group_split_counts",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT split, count(*) AS n_rows, count(DISTINCT client_id) AS n_clients, avg(event_value) AS target_share
           FROM mart JOIN client_splits USING (client_id) GROUP BY split""",
        O.SPLIT,
    ),
)
def group_split_counts(spark, sf_dir):
    return split_sizes(group_split(stage(drop_sparse_rows(mart_of(spark, sf_dir)), "mart")))


@query(
    "group_split_labels",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT client_id, CAST(event_value AS VARCHAR) AS label FROM mart
           QUALIFY row_number() OVER (PARTITION BY client_id
                     ORDER BY visit_date DESC, visit_time DESC NULLS LAST, session_id DESC) = 1""",
    ),
)
def group_split_labels(spark, sf_dir):
    return client_labels(mart_of(spark, sf_dir), "client_id", "event_value")


@query(
    "split_many_labels",
    """WITH labelled AS (
         SELECT o_orderkey, CAST(o_custkey % 500 AS VARCHAR) AS label, CAST(o_orderkey AS VARCHAR) || '|SEED' AS k FROM orders),
       placed AS (SELECT *, CAST('0x' || substring(md5(k), 1, 13) AS BIGINT) / 4503599627370496 AS place FROM labelled),
       sizes AS (SELECT min(n) AS least, sum(n) AS total, count(*) AS classes FROM (SELECT label, count(*) AS n FROM labelled GROUP BY label)),
       ordered AS (
         SELECT placed.*, row_number() OVER (ORDER BY CASE WHEN least < 2 OR total * 0.2 < classes THEN '' ELSE label END, place, o_orderkey) - 1 AS p
         FROM placed, sizes),
       remaining AS (SELECT *, p - floor(p * CAST(0.2 AS DOUBLE)) AS r FROM ordered),
       split AS (SELECT label, CASE WHEN floor((p + 1) * CAST(0.2 AS DOUBLE)) > floor(p * CAST(0.2 AS DOUBLE)) THEN 'test'
         WHEN floor((r + 1) * CAST(0.25 AS DOUBLE)) > floor(r * CAST(0.25 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM remaining)
       SELECT label, split, count(*) AS n_clients FROM split GROUP BY label, split""".replace("SEED", str(C.SEED)),
)
def split_many_labels(spark, sf_dir):
    """A split of orders with 500 labels: every label gives its share up to one order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", (F.col("o_custkey") % 500).cast("string").alias("label"))
    split = group_split(orders, "o_orderkey", "label", test_size=0.2, val_size=0.2)
    return split.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_clients"))


@query(
    "csv_round_trip",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def csv_round_trip(spark, sf_dir):
    """Documents, with their quotes and line breaks, written as CSV and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = new_path(spark, "documents") + ".csv"
    write_csv(docs, path)
    return read_flat(spark, path, docs.schema)


@query(
    "csv_in_pieces",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def csv_in_pieces(spark, sf_dir):
    """The same, read in chunks of about 700 characters: most documents are put together from fragments."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = new_path(spark, "documents") + ".csv"
    write_csv(docs, path)
    texts = quoted_csv.parsed(quoted_csv.csv_records(quoted_csv.csv_chunks(spark, path, 700)), docs.columns)
    return texts.select(*(F.col(f.name).cast(f.dataType) for f in docs.schema))


@query(
    "split_leakage",
    O.sql(O.BLOCKS["latest"], "SELECT client_id, CAST(1 AS BIGINT) AS n_splits FROM latest GROUP BY client_id"),
)
def split_leakage(spark, sf_dir):
    split = group_split(stage(mart_of(spark, sf_dir), "mart"))
    return split.groupBy("client_id").agg(F.count_distinct("split").alias("n_splits"))


def marked_events(spark, sf_dir):
    events = E.read_events(spark, sf_dir)
    return events.select("event_id", "user_id", X.is_target(F.col("event_type"), TARGETS).alias("target"))


@query(
    "balanced_set",
    f"""WITH marked AS (SELECT event_id, user_id, CAST(event_type = 'purchase' AS INT) AS target,
                              {O.share_of('event_id')} AS place FROM events)
        SELECT event_id, user_id, target FROM marked WHERE target = 1
        UNION ALL
        SELECT event_id, user_id, target FROM (
          SELECT *, row_number() OVER (ORDER BY place) AS nth FROM marked WHERE target = 0)
        WHERE nth <= 3 * (SELECT count(*) FROM marked WHERE target = 1)""",
)
def balanced_set(spark, sf_dir):
    return S.balanced_set(marked_events(spark, sf_dir), "target", ["event_id"])


@query(
    "balanced_counts",
    """SELECT target, CASE WHEN target = 1 THEN n ELSE least(n, 3 * ones) END AS n
       FROM (SELECT CAST(event_type = 'purchase' AS INT) AS target, count(*) AS n,
                    (SELECT count(*) FROM events WHERE event_type = 'purchase') AS ones
             FROM events GROUP BY 1)""",
)
def balanced_counts(spark, sf_dir):
    chosen = S.balanced_set(marked_events(spark, sf_dir), "target", ["event_id"])
    return chosen.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


# --- profiles -------------------------------------------------------------------

DIMENSIONS = [
    "geo_city",
    "geo_country",
    "device_browser",
    "device_category",
    "device_brand",
    "visit_hour",
    "day_of_week",
    "is_weekend",
    "is_organic_medium",
    "is_social_media",
]
PROFILED = ["utm_source", "utm_medium", "utm_campaign", "device_os", "device_brand", "device_model", "geo_city"]
_DIMENSION_COLUMNS = f"""
dims AS (
  SELECT event_value, geo_city, geo_country, device_browser, device_category, device_brand,
         CAST(substring(visit_time, 1, 2) AS INT) AS visit_hour, CAST(isodow(visit_date) - 1 AS INT) AS day_of_week,
         CAST(isodow(visit_date) >= 6 AS INT) AS is_weekend,
         CAST(utm_medium IN ({O.quoted(C.ORGANIC_MEDIUMS)}) AS INT) AS is_organic_medium,
         CAST(coalesce(utm_source IN ({O.quoted(C.SOCIAL_SOURCES)}), false) AS INT) AS is_social_media
  FROM mart),
long AS ({O.unpivoted("dims", DIMENSIONS).replace("SELECT '", "SELECT event_value, '")})"""


def dimension_frame(spark, sf_dir):
    return M.with_traffic_flags(M.with_calendar(mart_of(spark, sf_dir)))


@query(
    "null_profile",
    O.sql(
        O.BLOCKS["sessions"],
        "SELECT column_name, avg(CAST(value IS NULL AS INT)) AS null_share FROM long GROUP BY column_name HAVING null_share > 0",
        f"long AS ({O.unpivoted('ga_sessions', SESSIONS_SCHEMA.fieldNames())})",
    ),
)
def null_profile(spark, sf_dir):
    return eda.null_profile(E.raw_tables(spark, sf_dir)[1])


_PROFILE_COUNTS = (
    f"long AS ({O.unpivoted('ga_sessions', PROFILED)})",
    "value_counts AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL)",
)


@query(
    "top_values",
    O.sql(
        O.BLOCKS["sessions"],
        """SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INT) AS place
           FROM value_counts WHERE value IS NOT NULL QUALIFY place <= 5""",
        *_PROFILE_COUNTS,
    ),
)
def top_values_query(spark, sf_dir):
    return eda.top_categories(E.raw_tables(spark, sf_dir)[1], PROFILED, 5)


@query(
    "top_shares",
    O.sql(
        O.BLOCKS["sessions"],
        "SELECT column_name, max(n) / sum(n) AS top_share FROM value_counts GROUP BY column_name",
        *_PROFILE_COUNTS,
    ),
)
def top_shares(spark, sf_dir):
    return eda.top_shares(E.raw_tables(spark, sf_dir)[1], PROFILED)


@query(
    "class_balance",
    O.sql(
        [*O.BLOCKS["hits"], O.MARKED],
        """SELECT event_value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
           FROM (SELECT session_id, max(CAST(is_target AS INT)) AS event_value FROM marked GROUP BY session_id)
           GROUP BY event_value""",
    ),
)
def class_balance(spark, sf_dir):
    return eda.session_class_balance(E.raw_tables(spark, sf_dir)[0], TARGETS)


@query(
    "conversion_by_dim",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT column_name AS dimension, value, count(*) AS n, CAST(sum(event_value) AS BIGINT) AS n_converted,
                  avg(event_value) AS conversion_rate
           FROM long GROUP BY column_name, value""",
        _DIMENSION_COLUMNS,
    ),
)
def conversion_by_dim(spark, sf_dir):
    return eda.conversion_by(dimension_frame(spark, sf_dir), DIMENSIONS, "event_value")


@query(
    "target_rate_by_value",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT column_name, value, count(*) AS n, CAST(sum(event_value) AS BIGINT) AS n_converted, avg(event_value) AS conversion_rate,
                  CAST(row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS INT) AS place
           FROM long WHERE value IS NOT NULL GROUP BY column_name, value QUALIFY place <= 5""",
        _DIMENSION_COLUMNS,
    ),
)
def target_rate_by_value(spark, sf_dir):
    return eda.target_rate_by_value(dimension_frame(spark, sf_dir), DIMENSIONS, "event_value", 5)


@query(
    "duplicates",
    O.sql(O.BLOCKS["sessions"], "SELECT session_id, count(*) AS n FROM ga_sessions GROUP BY session_id HAVING n > 1"),
)
def duplicates(spark, sf_dir):
    return eda.duplicates(E.raw_tables(spark, sf_dir)[1], ["session_id"])


@query(
    "frequent_visitors",
    O.sql(
        O.BLOCKS["sessions"],
        """SELECT client_id, max(visit_number) AS visit_number, count(*) AS n FROM ga_sessions GROUP BY client_id
           HAVING max(visit_number) > (SELECT quantile_cont(visit_number, 0.95) FROM ga_sessions)""",
    ),
)
def frequent_visitors(spark, sf_dir):
    return eda.frequent_visitors(E.raw_tables(spark, sf_dir)[1], "client_id", "visit_number", 0.95)


_COLLAPSED = ["utm_campaign", "geo_city", "device_brand"]


@query(
    "collapse_rare",
    O.sql(
        O.BLOCKS["sessions"],
        "SELECT session_id, "
        + ", ".join(
            f"CASE WHEN {c} IN (SELECT value FROM tops WHERE column_name = '{c}') THEN {c} ELSE 'other' END AS {c}"
            for c in _COLLAPSED
        )
        + " FROM ga_sessions",
        f"long AS ({O.unpivoted('ga_sessions', _COLLAPSED)})",
        """tops AS (SELECT column_name, value FROM long WHERE value IS NOT NULL GROUP BY column_name, value
             QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) <= 4)""",
    ),
)
def collapse_rare(spark, sf_dir):
    sessions = E.raw_tables(spark, sf_dir)[1].select("session_id", *_COLLAPSED)
    return collapse_rare_categories(sessions, _COLLAPSED, 4)


_COUNTERS = ["visit_number", *M.COUNTERS]


@query(
    "column_profile",
    O.sql(
        O.BLOCKS["mart"],
        f"""SELECT p.*, t.value AS top_value, t.n AS top_n, round(mean_value, 6) AS mean_value, round(std_value, 6) AS std_value,
                  min_value, max_value, CASE WHEN column_name IN ({", ".join(f"'{c}'" for c in _COUNTERS)}) THEN 'number' ELSE 'text' END AS kind
           FROM (SELECT column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_null, count(value) AS n_distinct
                 FROM value_counts GROUP BY column_name) p
           LEFT JOIN (SELECT * FROM value_counts WHERE value IS NOT NULL
                      QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) = 1) t USING (column_name)
           LEFT JOIN (SELECT column_name, avg(value) AS mean_value, stddev_samp(value) AS std_value, min(value) AS min_value,
                             max(value) AS max_value FROM numbers GROUP BY column_name) USING (column_name)""",
        f"long AS ({O.unpivoted('mart', [*PROFILED[:5], 'geo_city', *_COUNTERS])})",
        "value_counts AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL)",
        f"numbers AS ({O.unpivoted('mart', _COUNTERS, 'DOUBLE')})",
    ),
)
def column_profile(spark, sf_dir):
    mart = stage(mart_of(spark, sf_dir).select(*PROFILED[:5], "geo_city", *_COUNTERS, "event_value"), "mart")
    profile = eda.column_profile(mart, "event_value")
    return profile.withColumns({c: F.round(c, 6) for c in ("mean_value", "std_value")})


_ASSOCIATED = ["device_category", "device_brand", "utm_medium", "geo_city", "visit_number", "total_hits_count"]
_BINNED = ["visit_number", "total_hits_count"]
_ASSOCIATION_BLOCK = f"""
ends AS (
  SELECT column_name, list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS ends
  FROM ({O.unpivoted("mart", _BINNED, "DOUBLE")}) GROUP BY column_name),
binned AS (
  SELECT event_value, device_category, device_brand, utm_medium, geo_city,
         {", ".join(f"len(list_filter((SELECT ends FROM ends WHERE column_name = '{c}'), lambda e: e <= {c})) AS {c}" for c in _BINNED)}
  FROM mart),
long AS ({O.unpivoted("binned", _ASSOCIATED).replace("SELECT '", "SELECT event_value, '")}),
cells AS (
  SELECT column_name AS feature, value, sum(event_value) AS ones, sum(1 - event_value) AS zeros, count(*) AS n
  FROM long GROUP BY column_name, value),
sides AS (SELECT sum(event_value) AS n1, sum(1 - event_value) AS n0, count(*) AS total FROM mart)"""


def associated(spark, sf_dir):
    return eda.binned(stage(mart_of(spark, sf_dir), "mart"), _BINNED)


@query(
    "mutual_info",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT *, row_number() OVER (ORDER BY mutual_info DESC, feature) AS place FROM (
           SELECT feature, round(greatest(sum(
                    CASE WHEN ones > 0 THEN ones / total * ln(ones * total / (n * n1)) ELSE 0 END
                  + CASE WHEN zeros > 0 THEN zeros / total * ln(zeros * total / (n * n0)) ELSE 0 END), 0), 6) AS mutual_info
           FROM cells, sides GROUP BY feature)""",
        _ASSOCIATION_BLOCK,
    ),
)
def mutual_info(spark, sf_dir):
    found = eda.mutual_information(associated(spark, sf_dir), _ASSOCIATED, "event_value")
    return found.withColumn("mutual_info", F.round("mutual_info", 6))


_INFORMATION = """SELECT feature, count(*) AS rows, round(max(whole.psi) + avg(kth.psi - class.psi - inside.psi), 6) AS estimate,
       round(greatest(max(whole.psi) + avg(kth.psi - class.psi - inside.psi), 0), 6) AS mutual_info
FROM balls JOIN digamma AS kth ON kth.n = k JOIN digamma AS class ON class.n = class_rows
JOIN digamma AS inside ON inside.n = m JOIN digamma AS whole ON whole.n = all_rows
GROUP BY feature"""
_DIGAMMA = """
digamma AS (
  SELECT n, coalesce(sum(1 / n) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 0.5772156649015329 AS psi
  FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM known))) AS n))"""


def _neighbour_sql(lines: str, blocks: list[str]) -> str:
    """The estimate row by row, for numbers that are whole: the third nearest row of the class, and all rows that are nearer."""
    steps = ", ".join(f"x - lag(x, {i}) OVER w, lead(x, {i}) OVER w - x" for i in (1, 2, 3))
    return O.sql(
        blocks,
        _INFORMATION,
        f"""
lines AS ({lines}),
known AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS class_rows FROM lines WHERE x IS NOT NULL AND y IS NOT NULL),
near AS (
  SELECT feature, x, class_rows, least(class_rows - 1, 3) AS k, list_sort([{steps}], 'ASC', 'NULLS LAST') AS ds
  FROM known WHERE class_rows > 1 WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
radii AS (SELECT *, greatest(ds[k] - 1, 0) AS r FROM near),
balls AS (
  SELECT feature, k, class_rows, count(*) OVER (PARTITION BY feature) AS all_rows,
         count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS m
  FROM radii)""",
        _DIGAMMA,
    )


def _rounded_information(found: DataFrame) -> DataFrame:
    return found.withColumns({c: F.round(c, 6) for c in ("estimate", "mutual_info")})


@query(
    "neighbour_info",
    _neighbour_sql(
        " UNION ALL ".join(f"SELECT '{c}' AS feature, event_value AS y, CAST({c} AS BIGINT) AS x FROM mart" for c in _COUNTERS),
        O.BLOCKS["mart"],
    ),
)
def neighbour_info(spark, sf_dir):
    return _rounded_information(neighbour_information(mart_of(spark, sf_dir), _COUNTERS, "event_value"))


@query(
    "neighbour_info_of_counters",
    O.sql(
        O.BLOCKS["mart"],
        _INFORMATION,
        "lines AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, event_value AS y, CAST({c} AS DOUBLE) AS x, avg(abs({c})) OVER () AS size,
                       {O.share_of(f"session_id || '|{c}'")} AS share FROM mart"""
            for c in _COUNTERS
        )
        + ")",
        """
known AS (
  SELECT feature, y, x + (2 * share - 1) * (1e-10::DOUBLE * greatest(1, size)) AS x, count(*) OVER (PARTITION BY feature, y) AS class_rows
  FROM lines WHERE x IS NOT NULL AND y IS NOT NULL),
near AS (
  SELECT *, least(class_rows - 1, 3) AS k, count(*) OVER (PARTITION BY feature) AS all_rows,
         lag(x, 1) OVER w AS b1, lag(x, 2) OVER w AS b2, lag(x, 3) OVER w AS b3, lead(x, 1) OVER w AS a1, lead(x, 2) OVER w AS a2, lead(x, 3) OVER w AS a3
  FROM known WHERE class_rows > 1 WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
radii AS (SELECT *, list_sort([x - b1, x - b2, x - b3, a1 - x, a2 - x, a3 - x], 'ASC', 'NULLS LAST')[k] AS r FROM near),
open_ends AS (
  SELECT feature, x, k, class_rows, all_rows,
         least(x + r, CASE WHEN a1 - x >= r THEN a1 WHEN a2 - x >= r THEN a2 WHEN a3 - x >= r THEN a3 END) AS high,
         greatest(x - r, CASE WHEN x - b1 >= r THEN b1 WHEN x - b2 >= r THEN b2 WHEN x - b3 >= r THEN b3 END) AS low
  FROM radii),
marks AS (
  SELECT feature, v, n, sum(n) OVER (PARTITION BY feature ORDER BY v RANGE UNBOUNDED PRECEDING) AS upto
  FROM (SELECT feature, v, sum(n) AS n FROM (
    SELECT feature, x AS v, 1 AS n FROM open_ends UNION ALL SELECT feature, low, 0 FROM open_ends UNION ALL SELECT feature, high, 0 FROM open_ends)
    GROUP BY feature, v)),
balls AS (
  SELECT e.feature, e.k, e.class_rows, e.all_rows, h.upto - h.n - l.upto AS m
  FROM open_ends e JOIN marks h ON h.feature = e.feature AND h.v = e.high JOIN marks l ON l.feature = e.feature AND l.v = e.low)""",
        _DIGAMMA,
    ),
)
def neighbour_info_of_counters(spark, sf_dir):
    return _rounded_information(neighbour_information(mart_of(spark, sf_dir), _COUNTERS, "event_value", keys=["session_id"]))


@query(
    "neighbour_info_many_classes",
    _neighbour_sql(
        """SELECT 'cents' AS feature, l_quantity AS y, CAST(round(l_extendedprice * 100) AS BIGINT) AS x FROM lineitem
           UNION ALL SELECT 'l_partkey', l_quantity, l_partkey FROM lineitem""",
        [],
    ),
)
def neighbour_info_many_classes(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cents = lines.select("l_quantity", "l_partkey", F.round(F.col("l_extendedprice") * 100).alias("cents"))
    return _rounded_information(neighbour_information(cents, ["cents", "l_partkey"], "l_quantity"))


@query(
    "cramers_v",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT feature, round(sqrt(sum((ones - n * n1 / total) ** 2 / (n * n1 / total)
                                        + (zeros - n * n0 / total) ** 2 / (n * n0 / total)) / max(total)), 6) AS cramers_v
           FROM cells, sides GROUP BY feature""",
        _ASSOCIATION_BLOCK,
    ),
)
def cramers_v(spark, sf_dir):
    found = eda.cramers_v(associated(spark, sf_dir), _ASSOCIATED, "event_value")
    return found.withColumn("cramers_v", F.round("cramers_v", 6))


@query(
    "correlations",
    O.sql(
        O.BLOCKS["mart"],
        "\nUNION ALL ".join(
            f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS correlation FROM mart"
            for i, a in enumerate(_COUNTERS)
            for b in _COUNTERS[i + 1 :]
        ),
    ),
)
def correlations(spark, sf_dir):
    found = eda.correlations(mart_of(spark, sf_dir), _COUNTERS)
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    "correlation_ratio",
    O.sql(
        O.BLOCKS["mart"],
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(sqrt(sum(n * (m - total_mean) ** 2) / max(spread)), 6) AS correlation_ratio
                FROM (SELECT count(*) AS n, avg(total_hits_count) AS m FROM mart GROUP BY {c}),
                     (SELECT avg(total_hits_count) AS total_mean, var_pop(total_hits_count) * count(*) AS spread FROM mart)"""
            for c in ("device_category", "device_brand", "geo_city")
        ),
    ),
)
def correlation_ratio(spark, sf_dir):
    found = eda.correlation_ratio(
        mart_of(spark, sf_dir), ["device_category", "device_brand", "geo_city"], "total_hits_count"
    )
    return found.withColumn("correlation_ratio", F.round("correlation_ratio", 6))


# --- features and cleaning ------------------------------------------------------


def features_of(spark, sf_dir):
    return SessionFeatures().transform(mart_of(spark, sf_dir))


def staged_features(spark, sf_dir):
    """Engineered features written once: learning from them takes several jobs."""
    return stage(features_of(spark, sf_dir), "features")


@query(
    "engineered_features",
    O.sql(
        O.BLOCKS["features"],
        """SELECT * REPLACE (CAST(visit_date AS VARCHAR) AS visit_date,
                            round(user_vs_city_car_interest, 6) AS user_vs_city_car_interest) FROM features""",
    ),
)
def engineered_features(spark, sf_dir):
    made = features_of(spark, sf_dir)
    return text_dates(made.withColumn("user_vs_city_car_interest", F.round("user_vs_city_car_interest", 6)))


@query(
    "speed_features",
    O.sql(
        O.BLOCKS["speed"],
        """SELECT session_id, CAST(session_duration_ms AS DOUBLE) AS session_duration_ms,
                  CASE WHEN total_hits_count > 0 THEN session_duration_ms / total_hits_count ELSE 0 END AS ms_per_hit
           FROM speed""",
    ),
)
def speed_features(spark, sf_dir):
    """Durations come from the hit times where the frame has them."""
    hits, _ = E.raw_tables(spark, sf_dir)
    made = SessionFeatures().transform(M.session_speed(hits, TARGETS))
    return made.select("session_id", "session_duration_ms", "ms_per_hit")


def learned(spark, sf_dir, **settings):
    return SessionCleaner(passThrough=["session_id", "event_value"], **settings).fit(staged_features(spark, sf_dir))


@query(
    "preprocess_drop_cols",
    O.sql(
        O.BLOCKS["studied"],
        f"""SELECT column_name, null_share, top_share,
                   CAST(null_share > {C.MAX_NULL_SHARE} OR top_share > {C.MAX_CONSTANT_SHARE} AS INT) AS dropped
            FROM column_shares""",
    ),
)
def preprocess_drop_cols(spark, sf_dir):
    report = learned(spark, sf_dir).report(spark)
    return report.filter("null_share IS NOT NULL").select("column_name", "null_share", "top_share", "dropped")


@query(
    "preprocess_fill_values",
    O.sql(
        O.BLOCKS["studied"],
        """SELECT column_name, mid AS fill_number, CAST(NULL AS VARCHAR) AS fill_text FROM number_stats
           UNION ALL SELECT column_name, NULL, value FROM tops WHERE place = 1""",
    ),
)
def preprocess_fill_values(spark, sf_dir):
    report = learned(spark, sf_dir).report(spark).filter("dropped = 0 AND null_share IS NOT NULL")
    return report.select("column_name", "fill_number", "fill_text")


@query("preprocess_brand_medians", O.sql(O.BLOCKS["studied"], "SELECT * FROM brand_medians"))
def preprocess_brand_medians(spark, sf_dir):
    return learned(spark, sf_dir).brand_report()


@query(
    "many_brands",
    """WITH lines AS (
         SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS session_id, 'b' || l_orderkey AS brand,
                CASE WHEN l_linenumber % 3 <> 1 THEN CAST(l_partkey AS DOUBLE) END AS area FROM lineitem),
       medians AS (SELECT brand, median(area) AS m FROM lines GROUP BY brand)
       SELECT session_id, coalesce(area, m, (SELECT median(area) FROM lines)) AS screen_area FROM lines JOIN medians USING (brand)""",
)
def many_brands(spark, sf_dir):
    """Unknown areas filled by the medians of as many brands as there are orders."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    area = F.when(F.col("l_linenumber") % 3 != 1, F.col("l_partkey").cast("double"))
    rows = stage(lines.select(key.alias("session_id"), F.concat(F.lit("b"), "l_orderkey").alias("device_brand"), area.alias("screen_area")), "areas")
    cleaner = SessionCleaner(passThrough=["session_id"], dropCols=[], maxNullShare=1.0, maxConstantShare=1.0)
    return cleaner.fit(rows).transform(rows).select("session_id", "screen_area")


@query(
    "preprocess_bounds",
    O.sql(
        O.BLOCKS["studied"],
        """SELECT 'zscore' AS method, column_name, round(mean - 2 * std, 6) AS low, round(mean + 2 * std, 6) AS high
           FROM number_stats WHERE std > 0
           UNION ALL SELECT 'iqr', column_name, round(q1 - 1.5 * (q3 - q1), 6), round(q3 + 1.5 * (q3 - q1), 6)
           FROM number_stats WHERE q3 > q1""",
    ),
)
def preprocess_bounds(spark, sf_dir):
    features = staged_features(spark, sf_dir)

    def bounds(method: str, width: float) -> DataFrame:
        cleaner = SessionCleaner(
            passThrough=["session_id", "event_value"], outlierMethod=method, outlierThreshold=width
        )
        found = cleaner.fit(features).report(spark).filter("low IS NOT NULL")
        return found.select(
            F.lit(method).alias("method"), "column_name", F.round("low", 6).alias("low"), F.round("high", 6).alias("high")
        )

    return bounds("zscore", 2.0).unionByName(bounds("iqr", 1.5))


@query("preprocessed", O.sql(O.BLOCKS["studied"], O.PREPROCESSED.replace(
    "AS DOUBLE) AS user_vs_city_car_interest", "AS DOUBLE) AS interest_").replace("SELECT f.session_id", "SELECT * EXCLUDE (interest_), round(interest_, 6) AS user_vs_city_car_interest FROM (SELECT f.session_id") + ")"))
def preprocessed(spark, sf_dir):
    features = staged_features(spark, sf_dir)
    cleaner = SessionCleaner(passThrough=["session_id", "event_value"]).fit(features)
    cleaned = cleaner.transform(features)
    return cleaned.withColumn("user_vs_city_car_interest", F.round("user_vs_city_car_interest", 6))


_ENCODED = ["device_category", "utm_medium", "device_browser"]


@query(
    "clipped_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(greatest(l_extendedprice, low), high), 4) AS price
       FROM lineitem, (SELECT q1 - 0.25 * (q3 - q1) AS low, q3 + 0.25 * (q3 - q1) AS high
                       FROM (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem))""",
)
def clipped_rows(spark, sf_dir):
    """Prices of order lines drawn in to fences close around the quartiles."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    q1, q3 = exact_quantiles(lines, [], "l_extendedprice", [0.25, 0.75]).first()["quantiles"]
    fence = 0.25 * (q3 - q1)
    price = X.clipped(F.col("l_extendedprice").cast("double"), q1 - fence, q3 + fence)
    return lines.select(*LINE_KEY, F.round(price, 4).alias("price"))


@query(
    "ordinal_encode",
    O.sql(
        O.BLOCKS["sessions"],
        "SELECT session_id, utm_campaign, "
        + ", ".join(
            f"coalesce((SELECT place FROM places WHERE column_name = '{c}' AND value = coalesce(s.{c}, 'nan')), -1) AS {c}"
            for c in _ENCODED
        )
        + " FROM ga_sessions s",
        f"long AS ({O.unpivoted('(SELECT * FROM ga_sessions WHERE device_category <> ' + chr(39) + 'tablet' + chr(39) + ')', _ENCODED)})",
        """places AS (SELECT column_name, coalesce(value, 'nan') AS value,
                             CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY coalesce(value, 'nan')) - 1 AS DOUBLE) AS place
                      FROM (SELECT DISTINCT column_name, value FROM long))""",
    ),
)
def ordinal_encode_query(spark, sf_dir):
    """Tablets are kept out of the training rows, so that unseen values occur."""
    sessions = E.raw_tables(spark, sf_dir)[1].select("session_id", "utm_campaign", *_ENCODED)
    return ordinal_encode(sessions.filter("device_category <> 'tablet'"), sessions, _ENCODED)


@query(
    "one_hot",
    O.sql(
        O.BLOCKS["sessions"],
        """SELECT session_id, utm_campaign, CAST(device_category = 'desktop' AS INT) AS desktop,
                  CAST(device_category = 'mobile' AS INT) AS mobile FROM ga_sessions""",
    ),
)
def one_hot_query(spark, sf_dir):
    sessions = E.raw_tables(spark, sf_dir)[1].select("session_id", "utm_campaign", "device_category")
    model = one_hot(sessions.filter("device_category <> 'tablet'"), ["device_category"])
    slots = vector_to_array("device_category_hot")
    return model.transform(sessions).select(
        "session_id", "utm_campaign", slots[0].cast("int").alias("desktop"), slots[1].cast("int").alias("mobile")
    )


# --- metrics --------------------------------------------------------------------


def scored_events(spark, sf_dir):
    """Events with a score that SQL can repeat: whether it is a purchase, foretold by arithmetic."""
    events = E.read_events(spark, sf_dir)
    chance = ((F.col("user_id") * 37 + E.payload_key(events) * 13) % 100) / 100
    judged = events.select(
        "event_id",
        F.to_date("ts").cast("string").alias("day"),
        (F.col("event_type") == "purchase").cast("int").alias("actual"),
        chance.alias("probability"),
    )
    return judged.withColumns(
        {
            "predicted": (F.col("probability") >= 0.5).cast("int"),
            "confidence": F.greatest(F.col("probability"), 1 - F.col("probability")),
        }
    )


_CELLS = "cells AS (SELECT actual, predicted, count(*) AS n FROM judged GROUP BY ALL)"


@query("confusion", O.sql([O.SCORED, _CELLS], "SELECT * FROM cells"))
def confusion_query(spark, sf_dir):
    return Q.confusion(scored_events(spark, sf_dir))


@query(
    "class_report",
    O.sql(
        [O.SCORED, _CELLS, O.report("cells")],
        """SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
             SELECT * FROM per_class
             UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM per_class
             UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
                              sum(f1 * support) / sum(support), sum(support) FROM per_class)""",
    ),
)
def class_report_query(spark, sf_dir):
    report = Q.class_report_full(scored_events(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "classification_scores",
    O.sql(
        [O.SCORED, _CELLS, O.report("cells")],
        """SELECT round(sum(recall * support) / sum(support), 4) AS accuracy, round(sum(f1 * support) / sum(support), 4) AS f1_weighted
           FROM per_class""",
    ),
)
def classification_scores(spark, sf_dir):
    return Q.classification_scores(scored_events(spark, sf_dir))


@query(
    "auc_exact",
    O.sql(
        [O.SCORED],
        """SELECT round(sum(CASE WHEN actual = 1 THEN place END - (ones + 1) / 2) / max(ones * (total - ones)) , 6) AS auc
           FROM (SELECT actual, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS place,
                        sum(actual) OVER () AS ones, count(*) OVER () AS total FROM judged)
           WHERE actual = 1""",
    ),
)
def auc_exact_query(spark, sf_dir):
    return Q.auc_exact(scored_events(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


_CLASSES = ["click", "error", "purchase", "signup", "view"]


def _class_score(i: int, k: str) -> str:
    return f"((user_id * {7 + i} + {k} * {13 + 2 * i}) % 97) / 97"


@query(
    "auc_ovr",
    O.sql(
        [
            "scored AS ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS class, CAST(event_type = '{c}' AS INT) AS hit, "
                + _class_score(i, "CAST(json_extract_string(props, '$.k') AS INT)")
                + " AS score FROM events"
                for i, c in enumerate(_CLASSES)
            )
            + ")"
        ],
        """SELECT class, round((sum(place) FILTER (hit = 1) - max(ones) * (max(ones) + 1) / 2) / (max(ones) * (max(total) - max(ones))), 6) AS auc,
                  CAST(sum(hit) AS BIGINT) AS support
           FROM (SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS place,
                        sum(hit) OVER (PARTITION BY class) AS ones, count(*) OVER (PARTITION BY class) AS total FROM scored)
           GROUP BY class""",
    ),
)
def auc_ovr_query(spark, sf_dir):
    events = E.read_events(spark, sf_dir)
    events = events.withColumn("k", E.payload_key(events))
    scored = events.select("event_type", *[F.expr(_class_score(i, "k")).alias(f"s{i}") for i in range(5)])
    found = Q.auc_ovr(scored, "event_type", {c: f"s{i}" for i, c in enumerate(_CLASSES)})
    return found.withColumn("auc", F.round("auc", 6))


@query("auc_ovr_macro", f"SELECT round(avg(auc), 5) AS roc_auc_ovr FROM ({ORACLE['auc_ovr']})")
def auc_ovr_macro_query(spark, sf_dir):
    """The plain mean of the areas of all classes."""
    events = E.read_events(spark, sf_dir)
    events = events.withColumn("k", E.payload_key(events))
    scored = events.select("event_type", *[F.expr(_class_score(i, "k")).alias(f"s{i}") for i in range(5)])
    found = Q.auc_ovr_macro(scored, "event_type", {c: f"s{i}" for i, c in enumerate(_CLASSES)})
    return found.withColumn("roc_auc_ovr", F.round("roc_auc_ovr", 5))


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def priced_lines(spark, sf_dir):
    """Order lines with a price foretold by arithmetic."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    guess = F.col("l_quantity") * 1500 * (1 - F.col("l_discount")) + F.col("l_tax") * 1000
    named = lines.select(
        *LINE_KEY,
        "l_returnflag",
        "l_linestatus",
        F.col("l_extendedprice").alias("price"),
        guess.alias("guess"),
    )
    return R.error_table(named, "price", "guess", "regression").drop("price", "guess")


@query(
    "regression_metrics",
    O.sql(
        [O.LINES],
        """SELECT round(sqrt(avg(error * error)), 4) AS rmse, round(avg(abs_error), 4) AS mae,
                  round(1 - avg(error * error) / var_pop(actual), 4) AS r2 FROM residuals""",
    ),
)
def regression_metrics(spark, sf_dir):
    return Q.regression_metrics(priced_lines(spark, sf_dir))


# --- error analysis -------------------------------------------------------------


def judged_mart(spark, sf_dir):
    mart = mart_of(spark, sf_dir)
    chance = (F.col("client_id").cast("bigint") * 37 + F.col("visit_number") * 13 + F.col("total_hits_count") * 7) % 100
    scored = mart.withColumn("probability", chance / 100)
    scored = scored.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
    return R.error_table(scored, "event_value", "prediction").drop("prediction")


_TREND_COLUMNS = ["utm_campaign", "device_brand", "geo_city"]
_TOPS = (
    f"long AS ({O.unpivoted('judged', _TREND_COLUMNS).replace('SELECT ' + chr(39), 'SELECT is_error, ' + chr(39))})",
    """tops AS (SELECT column_name, value FROM long WHERE value IS NOT NULL GROUP BY column_name, value
         QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) <= 6)""",
)


@query(
    "error_trends",
    O.sql(
        [*O.BLOCKS["mart"], O.MART_SCORED],
        """SELECT l.column_name, coalesce(t.value, '... OTHER ...') AS category, count(*) AS n, CAST(sum(is_error) AS BIGINT) AS n_errors,
                  avg(is_error) AS error_share
           FROM long l LEFT JOIN tops t USING (column_name, value) GROUP BY ALL""",
        *_TOPS,
    ),
)
def error_trends(spark, sf_dir):
    errors = stage(judged_mart(spark, sf_dir).select("is_error", *_TREND_COLUMNS), "errors")
    return R.error_by_category(errors, _TREND_COLUMNS, top_k=6)


_BOX = ["l_returnflag", "l_linestatus"]


@query(
    "residual_box",
    O.sql(
        [O.LINES],
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {c} AS category, count(*) AS n, round(min(error), 4) AS low, round(q[1], 4) AS q1,
                       round(q[2], 4) AS median, round(q[3], 4) AS q3, round(max(error), 4) AS high,
                       round(q[1] - 1.5 * (q[3] - q[1]), 4) AS low_fence, round(q[3] + 1.5 * (q[3] - q[1]), 4) AS high_fence
                FROM (SELECT {c}, error, quantile_cont(error, [0.25, 0.5, 0.75]) OVER (PARTITION BY {c}) AS q FROM residuals)
                GROUP BY {c}, q"""
            for c in _BOX
        ),
    ),
)
def residual_box(spark, sf_dir):
    boxes = R.residual_box(priced_lines(spark, sf_dir), _BOX)
    rounded = ("low", "q1", "median", "q3", "high", "low_fence", "high_fence")
    return boxes.withColumns({c: F.round(c, 4) for c in rounded})


@query(
    "worst_preds",
    O.sql(
        [*O.BLOCKS["mart"], O.MART_SCORED],
        """(SELECT session_id, actual, predicted, probability, probability AS confidence_of_mistake, 'FP' AS prediction_type
            FROM judged WHERE is_error = 1 AND actual = 0 ORDER BY probability DESC, session_id LIMIT 5)
           UNION ALL
           (SELECT session_id, actual, predicted, probability, 1 - probability, 'FN'
            FROM judged WHERE is_error = 1 AND actual = 1 ORDER BY probability, session_id LIMIT 5)""",
    ),
)
def worst_preds(spark, sf_dir):
    return R.worst_cases(judged_mart(spark, sf_dir), ["session_id"]).select(
        "session_id", "actual", "predicted", "probability", "confidence_of_mistake", "prediction_type"
    )


@query(
    "first_errors",
    O.sql(
        [*O.BLOCKS["mart"], O.MART_SCORED],
        "SELECT session_id, actual, predicted FROM judged WHERE is_error = 1 ORDER BY session_id LIMIT 10",
    ),
)
def first_errors(spark, sf_dir):
    return R.first_errors(judged_mart(spark, sf_dir), ["session_id"]).select("session_id", "actual", "predicted")


@query(
    "worst_residuals",
    O.sql(
        [O.LINES],
        """SELECT l_orderkey, l_linenumber, round(actual, 4) AS actual, round(predicted, 4) AS predicted, round(error, 4) AS error
           FROM residuals ORDER BY abs_error DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""",
    ),
)
def worst_residuals(spark, sf_dir):
    worst = R.worst_residuals(priced_lines(spark, sf_dir), LINE_KEY)
    rounded = {c: F.round(c, 4) for c in ("actual", "predicted", "error")}
    return worst.withColumns(rounded).select("l_orderkey", "l_linenumber", "actual", "predicted", "error")


@query(
    "worst_flagged",
    O.sql(
        [O.LINES],
        """SELECT l_returnflag, count(*) AS n, CAST(sum(is_worst) AS BIGINT) AS n_worst FROM (
             SELECT *, CAST(row_number() OVER (ORDER BY abs_error DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 10 AS INT) AS is_worst
             FROM residuals) GROUP BY l_returnflag""",
    ),
)
def worst_flagged(spark, sf_dir):
    flagged = R.flag_worst(priced_lines(spark, sf_dir), LINE_KEY)
    return flagged.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("is_worst").alias("n_worst"))


_HISTOGRAM_SQL = """
ends AS (SELECT min({v}) AS low, max({v}) AS high, (max({v}) - min({v})) / {bins} AS width FROM {rows}),
placed AS (SELECT *, CAST(least(floor(({v} - low) / width), {bins} - 1) AS INT) AS bin FROM {rows}, ends)"""


@query(
    "prob_histogram",
    O.sql(
        [*O.BLOCKS["mart"], O.MART_SCORED],
        """SELECT actual, bin, count(*) AS n, round(max(low) + bin * max(width), 6) AS bin_low, round(max(low) + (bin + 1) * max(width), 6) AS bin_high
           FROM placed GROUP BY actual, bin""",
        "wrong AS (SELECT * FROM judged WHERE is_error = 1)",
        _HISTOGRAM_SQL.format(v="probability", rows="wrong", bins=20),
    ),
)
def prob_histogram(spark, sf_dir):
    bins = R.probability_histogram(judged_mart(spark, sf_dir))
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_low", "bin_high")})


@query(
    "residual_histogram",
    O.sql(
        [O.LINES],
        """SELECT bin, count(*) AS n, round(max(low) + bin * max(width), 4) AS bin_low, round(max(low) + (bin + 1) * max(width), 4) AS bin_high
           FROM placed GROUP BY bin""",
        _HISTOGRAM_SQL.format(v="error", rows="residuals", bins=50),
    ),
)
def residual_histogram(spark, sf_dir):
    bins = R.histogram(priced_lines(spark, sf_dir), "error", 50)
    return bins.withColumns({c: F.round(c, 4) for c in ("bin_low", "bin_high")})


# --- monitoring and contracts -----------------------------------------------------

_BUCKETS = ", ".join(
    f"count(*) FILTER (confidence <= {b}) AS le_{str(b).replace('.', '_')}" for b in C.CONFIDENCE_BUCKETS
)


@query(
    "prediction_monitor",
    O.sql(
        [O.SCORED],
        f"""SELECT day, predicted, count(*) AS n, round(sum(confidence), 4) AS confidence_sum, {_BUCKETS}, count(confidence) AS le_inf
            FROM judged GROUP BY day, predicted""",
    ),
)
def prediction_monitor(spark, sf_dir):
    monitor = K.prediction_monitor(scored_events(spark, sf_dir), "day", "predicted")
    return monitor.withColumn("confidence_sum", F.round("confidence_sum", 4))


LATENCY_BUCKETS = [0.01, 0.05, 0.1, 0.5, 1.0, 5.0]


@query(
    "latency_buckets",
    "SELECT "
    + ", ".join(f"count(*) FILTER (value <= {b}) AS le_{str(b).replace('.', '_')}" for b in LATENCY_BUCKETS)
    + ", count(value) AS le_inf FROM events",
)
def latency_buckets(spark, sf_dir):
    """The measured value of an event stands in for the seconds of a request."""
    return K.latency_histogram(E.read_events(spark, sf_dir), "value", LATENCY_BUCKETS)


_CONTRACT = {"session_id": "string", "client_id": "bigint", "visit_time": "int", "utm_source": "int", "geo_city": "string"}


@query(
    "schema_check",
    O.sql(
        O.BLOCKS["sessions"],
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{t}' AS wanted_type, count(*) AS n_rows, count(*) - count({c}) AS n_null,
                       count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {'VARCHAR' if t == 'string' else t}) IS NULL) AS n_broken
                FROM ga_sessions"""
            for c, t in _CONTRACT.items()
        ),
    ),
)
def schema_check(spark, sf_dir):
    return check_schema(E.raw_tables(spark, sf_dir)[1], _CONTRACT)


@query(
    "form_and_verdict",
    O.sql(
        [O.SCORED],
        """SELECT event_id, CASE WHEN probability > 0.5 THEN 'hot' ELSE 'low' END AS verdict,
                  coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INT), 0) AS form_number,
                  coalesce(TRY_CAST(event_type AS INT), 0) AS form_text
           FROM judged JOIN events USING (event_id)""",
    ),
)
def form_and_verdict(spark, sf_dir):
    events = E.read_events(spark, sf_dir)
    chance = ((F.col("user_id") * 37 + E.payload_key(events) * 13) % 100) / 100
    return events.select(
        "event_id",
        X.verdict(chance).alias("verdict"),
        X.form_int(F.get_json_object("props", "$.k")).alias("form_number"),
        X.form_int(F.col("event_type")).alias("form_text"),
    )


# --- models ---------------------------------------------------------------------

_KEYS = ["session_id", "client_id"]
_SMALL_TREES = {"maxIter": 8, "maxDepth": 4, "seed": C.SEED}


def training_frames(spark, sf_dir):
    return T.prepare(mart_of(spark, sf_dir), T.Spec())


def fitted(spark, sf_dir, **settings):
    """A model trained on the train split, and the three splits."""
    spec = T.Spec(**settings)
    train, val, test = training_frames(spark, sf_dir)
    return T.fit_pipeline(train, val, spec), (train, val, test), spec


def rounded_scores(scored: DataFrame) -> DataFrame:
    return scored.withColumns({c: F.round(c, 6) for c in ("probability", "confidence")})


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    """Boosted trees with class weight and early stopping, scored on the test split."""
    model, (_, _, test), _ = fitted(spark, sf_dir, model_params=_SMALL_TREES, positive_weight=2.0)
    return rounded_scores(models.score(model, test, _KEYS))


@query("forest_importance")
def forest_importance(spark, sf_dir):
    settings = {"numTrees": 10, "maxDepth": 5, "seed": C.SEED}
    model, (train, _, _), _ = fitted(spark, sf_dir, model="random_forest", model_params=settings)
    return models.importance_table(model, train)


@query("network_scores")
def network_scores(spark, sf_dir):
    settings = {"maxIter": 15, "seed": C.SEED}
    model, (_, _, test), _ = fitted(spark, sf_dir, model="network", model_params=settings)
    return rounded_scores(models.score(model, test, _KEYS))


@query("model_metrics")
def model_metrics(spark, sf_dir):
    """Validation metrics of a linear model, as a table."""
    model, (_, val, _), spec = fitted(spark, sf_dir, model="linear", model_params={"maxIter": 15})
    scored = models.score(model, val)
    errors = R.error_table(scored, spec.label, "prediction")
    one = Q.classification_scores(errors, "actual", "predicted").withColumn("one", F.lit(1))
    area = Q.auc_exact(errors, "actual", "probability").withColumn("one", F.lit(1))
    return one.join(F.broadcast(area), "one").drop("one")  # one row on each side


@query("price_regression")
def price_regression(spark, sf_dir):
    """Regression task: order line prices by boosted trees, measured on the orders held out."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    numbers = ["l_quantity", "l_discount", "l_tax"]
    rows = lines.select(*LINE_KEY, *numbers, "l_returnflag", "l_extendedprice")
    train, _, test = three_frames(group_split(rows, "l_orderkey", None))
    params = {"maxIter": 5, "maxDepth": 4, "seed": C.SEED}
    model = models.fit_model(
        train, numbers, ["l_returnflag"], "boosted_trees", "regression", "l_extendedprice", **params
    )
    return Q.regression_metrics(models.score(model, test), "l_extendedprice", "prediction")


@query(
    "linear_fit",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, count(*) AS n_rows FROM lineitem""",
)
def linear_fit(spark, sf_dir):
    """The line that a linear model learns, read off its predictions, next to the closed form."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_extendedprice")
    model = models.fit_model(lines, ["l_quantity"], [], "linear", "regression", "l_extendedprice")
    scored = models.score(model, lines)
    return scored.agg(
        F.round(F.regr_slope("prediction", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("prediction", "l_quantity"), 2).alias("intercept"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query("event_class_auc")
def event_class_auc(spark, sf_dir):
    """Multiclass task: the kind of an event by a forest, one area per class, measured on the users held out."""
    events = E.read_events(spark, sf_dir).withColumn("k", E.payload_key(E.read_events(spark, sf_dir)))
    place = F.array_position(F.array(*[F.lit(c) for c in _CLASSES]), F.col("event_type")) - 1
    rows = events.select("event_id", "user_id", F.hour("ts").alias("hour"), "value", "k", place.cast("int").alias("kind"))
    train, _, test = three_frames(group_split(rows, "user_id", None))
    params = {"numTrees": 5, "maxDepth": 4, "seed": C.SEED}
    model = models.fit_model(train, ["hour", "value", "k"], [], "random_forest", "multiclass", "kind", **params)
    scored = models.class_probabilities(model, test, 5)
    return Q.auc_ovr(scored, "kind", {i: f"p{i}" for i in range(5)}).withColumn("auc", F.round("auc", 6))


@query(
    "class_boosting_checks",
    """SELECT event_type AS actual, count(*) AS n_rows, 0 AS n_unnamed, 0 AS n_out_of_range, 0 AS n_changed
       FROM events GROUP BY event_type""",
)
def class_boosting_checks(spark, sf_dir):
    """Text labels: the type of every event by boosted trees per class, scored by the fitted model and by the saved one."""
    events = E.read_events(spark, sf_dir)
    rows = events.select("event_id", "user_id", F.hour("ts").alias("hour"), "value", E.payload_key(events).alias("k"), "event_type")
    train, val, _ = three_frames(group_split(rows, "user_id", None))
    params = {"maxIter": 3, "maxDepth": 3, "seed": C.SEED}
    model = models.fit_model(train, ["hour", "value", "k"], [], "boosted_trees", "multiclass", "event_type", val, **params)
    root = new_path(spark, "class-boosting")
    models.save_model(model, root, "1")
    ours, again = (models.score(m, rows, ["event_id", "event_type"]) for m in (model, models.load_model(root, "1")))
    both = ours.alias("a").join(again.alias("b"), "event_id")
    same = F.col("a.confidence").eqNullSafe(F.col("b.confidence")) & F.col("a.predicted_label").eqNullSafe(F.col("b.predicted_label"))
    least = 1 / len(models.label_names(model))
    return both.groupBy(F.col("a.event_type").alias("actual")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.array_position(F.array(*[F.lit(c) for c in _CLASSES]), F.col("a.predicted_label")) == 0, 1)).alias("n_unnamed"),
        F.count(F.when(~F.col("a.confidence").between(least - 1e-9, 1), 1)).alias("n_out_of_range"),
        F.count(F.when(~same, 1)).alias("n_changed"),
    )


def linear_parts(spark, sf_dir):
    """The linear model alone, the vectors of the validation rows, written once, and their contributions."""
    model, (_, val, _), spec = fitted(spark, sf_dir, model="linear", model_params={"maxIter": 15})
    prepared = PipelineModel(stages=model.stages[:-1]).transform(val)
    vectors = stage(prepared.select(*_KEYS, spec.label, "features"), "val-vectors")
    linear = PipelineModel(stages=model.stages[-1:])
    parts, names = explain.contributions(linear, vectors, _KEYS)
    return linear, vectors, parts, names, spec


@query("logreg_contributions")
def logreg_contributions(spark, sf_dir):
    _, _, parts, names, _ = linear_parts(spark, sf_dir)
    return explain.mean_contributions(parts, names)


@query("worst_fp_contributions")
def worst_fp_contributions(spark, sf_dir):
    linear, vectors, parts, names, spec = linear_parts(spark, sf_dir)
    errors = R.error_table(models.score(linear, vectors), spec.label, "prediction")
    return explain.explain_worst_false_positives(errors, parts, names, _KEYS)


@query("contribution_dependence")
def contribution_dependence(spark, sf_dir):
    _, _, parts, names, _ = linear_parts(spark, sf_dir)
    top = explain.mean_contributions(parts, names).first()["feature"]
    return explain.dependence(parts, names, top)


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    settings = {"numTrees": 5, "maxDepth": 4, "seed": C.SEED}
    model, (_, val, _), spec = fitted(spark, sf_dir, model="random_forest", model_params=settings)
    columns = ["total_hits_count", "unique_event_actions", "total_car_views", "utm_medium", "device_category"]
    return explain.permutation_importance(model, val, columns, spec.label, _KEYS)


_DEALT = {"a": "user_id % 100", "b": "CAST(json_extract_string(props, '$.k') AS INT)"}


def _shift_sql(c: str) -> str:
    digest = f"CAST('0x' || substring(md5('{c}|{C.SEED}'), 1, 12) AS BIGINT)"
    return f"1 + {digest} % (total - 1)"


@query(
    "permutation_loss",
    O.sql(
        [
            f"""places AS (
                 SELECT CAST(event_type = 'purchase' AS INT) AS actual, {_DEALT["a"]} AS a, {_DEALT["b"]} AS b, count(*) OVER () AS total,
                        row_number() OVER (ORDER BY {O.share_of("event_id")}, event_id) - 1 AS p FROM events)""",
            f"""copies AS (
                 SELECT '' AS redrawn, actual, a, b FROM places
                 UNION ALL SELECT 'a', r.actual, d.a, r.b FROM places r JOIN places d ON d.p = (r.p + {_shift_sql("a").replace("total", "r.total")}) % r.total
                 UNION ALL SELECT 'b', r.actual, r.a, d.b FROM places r JOIN places d ON d.p = (r.p + {_shift_sql("b").replace("total", "r.total")}) % r.total)""",
            "scored AS (SELECT *, ((a * 37 + b * 13) % 100) / 100 AS probability FROM copies)",
            """areas AS (
                 SELECT redrawn, (sum(place) FILTER (actual = 1) - max(ones) * (max(ones) + 1) / 2) / (max(ones) * (max(total) - max(ones))) AS auc
                 FROM (SELECT *, rank() OVER (PARTITION BY redrawn ORDER BY probability) + (count(*) OVER (PARTITION BY redrawn, probability) - 1) / 2 AS place,
                         sum(actual) OVER (PARTITION BY redrawn) AS ones, count(*) OVER (PARTITION BY redrawn) AS total FROM scored)
                 GROUP BY redrawn)""",
        ],
        """SELECT redrawn AS feature, round((SELECT auc FROM areas WHERE redrawn = '') - auc, 6) AS importance FROM areas WHERE redrawn <> ''""",
    ),
)
def permutation_loss(spark, sf_dir):
    """Permutation importance of two columns under a fixed score."""
    events = E.read_events(spark, sf_dir)
    rows = events.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("actual"), (F.col("user_id") % 100).alias("a"), E.payload_key(events).alias("b"))
    copies = explain.shuffled_copies(stage(rows, "events"), ["a", "b"], ["event_id"])
    losses = explain.area_losses(copies.withColumn("probability", ((F.col("a") * 37 + F.col("b") * 13) % 100) / 100), "actual")
    return losses.withColumn("importance", F.round("importance", 6))


@query(
    "ordinal_encode_wide",
    """SELECT CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber || '/' || l_partkey AS line,
              CAST(dense_rank() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS code FROM lineitem""",
)
def ordinal_encode_wide(spark, sf_dir):
    """A key-like column: as many categories as there are orders."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = lines.select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("line"), F.col("l_orderkey").cast("string").alias("code"))
    return ordinal_encode(rows, rows, ["code"])


@query("tune_random")
def tune_random(spark, sf_dir):
    """Random search over tree depth and step size."""
    train, val, _ = training_frames(spark, sf_dir)
    space = {
        "maxDepth": {"type": "int", "bounds": [2, 4]},
        "stepSize": {"type": "float", "bounds": [0.05, 0.3], "log": True},
        "positive_weight": {"type": "float", "bounds": [1.0, 4.0]},
    }
    spec = T.Spec(model_params={"maxIter": 4, "seed": C.SEED})
    _, history = T.tune_job(train, val, spec, space, trials=3)
    return tuning.trials_table(spark, history)


def _checked(model: str, scored: DataFrame, again: DataFrame) -> DataFrame:
    """Rows, keys, probabilities out of range and scores that a second scoring does not repeat."""
    both = scored.alias("a").join(again.alias("b"), _KEYS, "full")
    changed = ~(F.col("a.probability").eqNullSafe(F.col("b.probability")) & F.col("a.prediction").eqNullSafe(F.col("b.prediction")))
    return both.agg(
        F.count("a.prediction").alias("n_rows"),
        F.count_distinct(F.when(F.col("a.prediction").isNotNull(), F.col("session_id"))).alias("n_sessions"),
        F.count(F.when(~F.coalesce(F.col("a.probability").between(0, 1), F.lit(False)), 1)).alias("n_out_of_range"),
        F.count(F.when(changed, 1)).alias("n_changed"),
    ).select(F.lit(model).alias("model"), "*")


_TEST_ROWS = "test AS (SELECT session_id FROM mart JOIN client_splits USING (client_id) WHERE split = 'test')"
_MODEL_SETTINGS = {
    "boosted_trees": {"model_params": _SMALL_TREES, "positive_weight": 2.0},
    "random_forest": {"model_params": {"numTrees": 5, "maxDepth": 4, "seed": C.SEED}},
    "linear": {"model_params": {"maxIter": 10}},
    "network": {"model_params": {"maxIter": 10, "seed": C.SEED}},
}


@query(
    "score_checks",
    O.sql(
        O.BLOCKS["mart"],
        f"""SELECT model, (SELECT count(*) FROM test) AS n_rows, (SELECT count(DISTINCT session_id) FROM test) AS n_sessions,
                   0 AS n_out_of_range, 0 AS n_changed
            FROM (SELECT unnest({sorted(_MODEL_SETTINGS)}) AS model)""",
        O.SPLIT,
        _TEST_ROWS,
    ),
)
def score_checks(spark, sf_dir):
    """Every family: the test split scored by the fitted model and by the model saved and loaded again."""
    train, val, test = training_frames(spark, sf_dir)
    prepared = T.fit_preparation(train, T.Spec())  # the same for every family
    found = []
    for name, settings in _MODEL_SETTINGS.items():
        model = T.fit_pipeline(train, val, T.Spec(model=name, **settings), prepared)
        root = new_path(spark, f"checked-{name}")
        models.save_model(model, root, "1")
        found.append(_checked(name, models.score(model, test, _KEYS), models.score(models.load_model(root, "1"), test, _KEYS)))
    prepared[1].unpersist()
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query(
    "contribution_checks",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT count(*) AS n_rows, 0.0 AS spread FROM mart JOIN client_splits USING (client_id) WHERE split = 'val'""",
        O.SPLIT,
    ),
)
def contribution_checks(spark, sf_dir):
    """Contributions of every validation row add up to its margin, up to one constant."""
    model, val, parts, _, _ = linear_parts(spark, sf_dir)
    margins = model.transform(val).select(*_KEYS, vector_to_array("rawPrediction")[1].alias("margin"))
    total = F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
    rests = parts.join(margins, _KEYS).select((F.col("margin") - total).alias("rest"))
    return rests.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.max("rest") - F.min("rest"), 6).alias("spread"))


@query(
    "tree_contribution_checks",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT model, (SELECT count(*) FROM mart JOIN client_splits USING (client_id) WHERE split = 'val') AS n_rows, 0.0 AS spread
            FROM (SELECT unnest(['boosted_trees', 'random_forest']) AS model)""",
        O.SPLIT,
    ),
)
def tree_contribution_checks(spark, sf_dir):
    """Contributions of the trees and their base value add up to the margin of every validation row."""
    train, val, _ = training_frames(spark, sf_dir)
    prepared = T.fit_preparation(train, T.Spec())  # the same for both families
    found = None
    for name, margin in (("boosted_trees", F.get(vector_to_array("rawPrediction"), 1)), ("random_forest", F.get(vector_to_array("probability"), 1))):
        model = T.fit_pipeline(train, None, T.Spec(model=name, **_MODEL_SETTINGS[name]), prepared)
        parts, _, base = trees.tree_contributions(model, val, _KEYS)
        total = F.aggregate("contributions", F.lit(base), lambda a, b: a + b)
        rests = parts.join(model.transform(val).select(*_KEYS, margin.alias("margin")), _KEYS).select(F.abs(F.col("margin") - total).alias("rest"))
        line = rests.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.round(F.max("rest"), 6).alias("spread"))
        found = line if found is None else found.unionByName(line)
    prepared[1].unpersist()
    return found


def _cells(spark, sf_dir):
    """Two flags of each order line and whether its price is high."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(
        "l_extendedprice",
        (F.col("l_quantity") > 25).cast("int").alias("a"),
        (F.col("l_discount") >= 0.05).cast("int").alias("b"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 35000).cast("int").alias("y"),
    )


_CELLS = """cells AS (
  SELECT l_extendedprice AS price, CAST(l_quantity > 25 AS INT) AS a, CAST(l_discount >= 0.05 AS INT) AS b,
         CAST(l_extendedprice * (1 - l_discount) > 35000 AS INT) AS y FROM lineitem)"""


@query(
    "tree_shapley_cells",
    f"""WITH {_CELLS},
        means AS (
          SELECT DISTINCT a, b, avg(price) OVER (PARTITION BY a, b) AS m_ab, avg(price) OVER (PARTITION BY a) AS m_a, avg(price) OVER (PARTITION BY b) AS m_b,
                 avg(price) OVER () AS m, count(*) OVER (PARTITION BY a, b) AS n, count(*) OVER (PARTITION BY a) AS n_a,
                 count(*) OVER (PARTITION BY b) AS n_b, count(*) OVER () AS n_all FROM cells),
        root AS (SELECT sum(n * (m_a - m) ** 2) >= sum(n * (m_b - m) ** 2) AS a_first FROM means),
        -- with a first, a row without a goes both ways by the sizes of a, and without b by those of b below its a
        games AS (
          SELECT x.a, x.b, x.n, x.m, x.m_ab,
                 CASE WHEN a_first THEN x.m_a ELSE sum(y.m_ab * y.n_b / y.n_all) FILTER (y.a = x.a) END AS v_a,
                 CASE WHEN a_first THEN sum(y.m_ab * y.n_a / y.n_all) FILTER (y.b = x.b) ELSE x.m_b END AS v_b
          FROM means x, means y, root GROUP BY x.a, x.b, x.n, x.m, x.m_ab, x.m_a, x.m_b, a_first)
        SELECT a, b, n AS n_rows, round(m, 4) AS base, round(((v_a - m) + (m_ab - v_b)) / 2, 4) AS contribution_a,
               round(((v_b - m) + (m_ab - v_a)) / 2, 4) AS contribution_b FROM games""",
)
def tree_shapley_cells(spark, sf_dir):
    """Contributions of two flags to the price that a tree gives, next to the definition over all coalitions."""
    rows = _cells(spark, sf_dir)
    settings = {"numTrees": 1, "maxDepth": 2, "bootstrap": False, "featureSubsetStrategy": "all", "seed": C.SEED}
    model = models.fit_model(rows, ["a", "b"], [], "random_forest", "regression", "l_extendedprice", **settings)
    parts, names, base = trees.tree_contributions(model, rows, ["a", "b"])
    each = {f"contribution_{n}": F.round(F.avg(F.col("contributions")[names.index(n)]), 4) for n in ("a", "b")}
    return parts.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(round(base, 4)).alias("base"), *(c.alias(k) for k, c in each.items()))


@query(
    "ordered_targets",
    f"""WITH rows AS (
          SELECT event_id, event_type, CASE WHEN user_id % 7 > 0 THEN CAST(user_id % 300 AS VARCHAR) END AS visitor, CAST(value > 50 AS INT) AS y,
                 {O.share_of("event_id")} AS place, avg(CAST(value > 50 AS INT)) OVER () AS overall FROM events),
        sums AS (
          SELECT *, coalesce(sum(y) OVER t, 0) AS t_sum, count(*) OVER t AS t_n, coalesce(sum(y) OVER v, 0) AS v_sum, count(*) OVER v AS v_n FROM rows
          WINDOW t AS (PARTITION BY event_type ORDER BY place, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 v AS (PARTITION BY visitor ORDER BY place, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT event_id, round((t_sum + overall) / (t_n + 1), 9) AS event_type_target,
               round(CASE WHEN visitor IS NULL THEN overall ELSE (v_sum + overall) / (v_n + 1) END, 9) AS visitor_target FROM sums""",
)
def ordered_targets_of_events(spark, sf_dir):
    """Kind and visitor of each event as the share of high values on earlier events of the same kind or visitor."""
    events = E.read_events(spark, sf_dir)
    visitor = F.when(F.col("user_id") % 7 > 0, (F.col("user_id") % 300).cast("string"))
    rows = events.select("event_id", "event_type", visitor.alias("visitor"), (F.col("value") > 50).cast("int").alias("y"))
    found = ordered_targets(rows, ["event_type", "visitor"], "y", ["event_id"], slice_rows=500)
    return found.select("event_id", *(F.round(c, 9).alias(c) for c in ("event_type_target", "visitor_target")))


_ITERATIONS = 12


@query(
    "iteration_areas",
    f"""WITH RECURSIVE {_CELLS},
        kinds AS (SELECT a, b, y, count(*) AS n FROM cells GROUP BY a, b, y),
        -- a stump on the flag with the larger gain, fitted to the labels first, then to the gradients of the log loss
        boosted AS (
          SELECT 0 AS k, a, b, y, n, 0.0::DOUBLE AS f FROM kinds
          UNION ALL
          SELECT k + 1, a, b, y, n, f + CASE WHEN k = 0 THEN 1.0 ELSE 0.1 END * CASE WHEN gain_a >= gain_b THEN r_a ELSE r_b END
          FROM (
            SELECT *, sum(n * r_a * r_a) OVER () AS gain_a, sum(n * r_b * r_b) OVER () AS gain_b
            FROM (SELECT *, sum(n * r) OVER (PARTITION BY a) / sum(n) OVER (PARTITION BY a) AS r_a, sum(n * r) OVER (PARTITION BY b) / sum(n) OVER (PARTITION BY b) AS r_b
                  FROM (SELECT *, CASE WHEN k = 0 THEN 2 * y - 1 ELSE 4 * (2 * y - 1) / (1 + exp(2 * (2 * y - 1) * f)) END AS r FROM boosted WHERE k < {_ITERATIONS})))),
        scores AS (SELECT k, round(f, 12) AS f, sum(n) FILTER (y = 1) AS p, sum(n) FILTER (y = 0) AS q FROM boosted WHERE k > 0 GROUP BY k, round(f, 12)),
        placed AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY k ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scores)
        SELECT k AS iteration, round(sum(coalesce(p, 0) * (below + coalesce(q, 0) / 2.0)) / (sum(p) * sum(q)), 6) AS auc FROM placed GROUP BY k""",
)
def iteration_areas(spark, sf_dir):
    """The area after each boosting iteration of a model of stumps."""
    rows = _cells(spark, sf_dir)
    settings = {"maxIter": _ITERATIONS, "maxDepth": 1, "stepSize": 0.1, "seed": C.SEED}
    model = models.fit_model(rows, ["a", "b"], [], "boosted_trees", "binary", "y", **settings)
    return trees.iteration_areas(model, rows, "y").withColumn("auc", F.round("auc", 6))


@query(
    "stream_score_checks",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT 'streamed' AS model, (SELECT count(*) FROM test) AS n_rows, (SELECT count(DISTINCT session_id) FROM test) AS n_sessions,
                  0 AS n_out_of_range, 0 AS n_changed""",
        O.SPLIT,
        _TEST_ROWS,
    ),
)
def stream_score_checks(spark, sf_dir):
    """Sessions arriving as files get the scores that the batch job gives them."""
    model, (_, _, test), _ = fitted(spark, sf_dir, model="linear", model_params={"maxIter": 10})
    root = new_path(spark, "stream-checks")
    test.write.parquet(f"{root}/incoming")
    streamed = jobs.score_new_files(sinks.read_files(spark, f"{root}/incoming", test.schema), model, _KEYS, f"{root}/scores")
    return _checked("streamed", streamed, models.score(model, test, _KEYS))


# --- streams --------------------------------------------------------------------


def event_stream(spark, sf_dir):
    schema = E.read_events(spark, sf_dir).schema
    return sinks.read_files(spark, sf_dir, schema, "events.parquet")


def timed_hits(events: DataFrame) -> DataFrame:
    """Hits of a stream with their event time and client."""
    return E.as_hits(events, "CAST(ts AS TIMESTAMP) AS ts", "CAST(user_id AS STRING) AS client_id")


@query("stream_dedup", "SELECT count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM events")
def stream_dedup(spark, sf_dir):
    """Every event sent twice; the stream keeps one of each."""
    events = event_stream(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = sinks.run_available(jobs.deduplicated(twice, ["event_id"], delay="40 days"), "dedup")
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_distinct"))


@query(
    "stream_sessions",
    """WITH timed AS (
         SELECT user_id, ts, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k,
                coalesce(ts >= lag(ts) OVER w + INTERVAL 30 MINUTE, true) AS opens FROM events
         WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
       numbered AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM timed),
       visits AS (
         SELECT CAST(user_id AS VARCHAR) AS client_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 30 MINUTE) AS end_us,
                count(DISTINCT event_type) FILTER (event_type <> 'purchase') AS unique_event_actions,
                count(DISTINCT k) FILTER (event_type IN ('view', 'click', 'purchase')) AS unique_cars_viewed
         FROM numbered GROUP BY user_id, visit)
       SELECT * FROM visits WHERE end_us <= (SELECT epoch_us(max(ts) - INTERVAL 2 HOUR) FROM events)""",
)
def stream_sessions(spark, sf_dir):
    """Distinct counters of all activity sessions that closed before the watermark."""
    hits = timed_hits(event_stream(spark, sf_dir))
    done = sinks.run_available(jobs.session_counters(hits, TARGETS), "sessions")
    times = [F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us")]
    return done.select("client_id", *times, "unique_event_actions", "unique_cars_viewed")


@query(
    "stream_session_counts",
    O.sql(
        [*O.BLOCKS["hits"]],
        """, timed AS (
             SELECT user_id, ts, event_type, coalesce(ts > lag(ts) OVER w + INTERVAL 30 MINUTE
                      OR ts = lag(ts) OVER w + INTERVAL 30 MINUTE, true) AS opens FROM events
             WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
           numbered AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM timed),
           visits AS (
             SELECT CAST(user_id AS VARCHAR) AS client_id, epoch_us(min(ts)) AS start_us,
                    epoch_us(max(ts) + INTERVAL 30 MINUTE) AS end_us,
                    count(*) FILTER (event_type <> 'purchase') AS total_hits_count,
                    count(*) FILTER (event_type NOT IN ('purchase', 'view')) AS total_events_count,
                    count(*) FILTER (event_type IN ('view', 'click', 'purchase')) AS total_car_views,
                    max(CAST(event_type = 'purchase' AS INT)) AS event_value
             FROM numbered GROUP BY user_id, visit)
           SELECT * FROM visits WHERE end_us <= (SELECT epoch_us(max(ts) - INTERVAL 2 HOUR) FROM events)""",
    ),
)
def stream_session_counts(spark, sf_dir):
    """The exact counters of the streamed sessions."""
    hits = timed_hits(event_stream(spark, sf_dir))
    done = sinks.run_available(jobs.session_counters(hits, TARGETS), "sessions")
    times = [F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us")]
    return done.select(
        "client_id", *times, "total_hits_count", "total_events_count", "total_car_views", "event_value"
    )


@query(
    "stream_mart",
    O.sql(
        O.BLOCKS["mart"],
        """SELECT m.* REPLACE (CAST(m.visit_date AS VARCHAR) AS visit_date) FROM mart m
           JOIN (SELECT user_id, CAST(ts AS DATE) AS d, max(ts) AS last FROM events GROUP BY ALL) e
             ON m.client_id = CAST(e.user_id AS VARCHAR) AND m.visit_date = e.d
           WHERE e.last + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
    ),
)
def stream_mart(spark, sf_dir):
    """The mart from a stream of hits and a stream of session rows: all sessions that closed before the watermark."""
    hits = E.as_hits(event_stream(spark, sf_dir), "CAST(ts AS TIMESTAMP) AS ts")
    sessions = E.as_sessions(E.read_events(spark, sf_dir)).withColumn("ts", F.to_timestamp("visit_date"))
    incoming = new_path(spark, "session-rows")
    sessions.write.parquet(incoming)
    rows = sinks.read_files(spark, incoming, sessions.schema)
    return text_dates(sinks.run_available(jobs.session_mart(hits, rows, TARGETS), "stream-mart"))


@query(
    "stream_monitor",
    f"""WITH scored AS (
          SELECT ts, ((user_id * 37 + CAST(json_extract_string(props, '$.k') AS INT) * 13) % 100) / 100 AS p FROM events),
        judged AS (SELECT date_trunc('minute', ts) AS minute, CAST(p >= 0.5 AS INT) AS predicted, greatest(p, 1 - p) AS confidence FROM scored)
        SELECT strftime(minute, '%Y-%m-%d %H:%M:%S') AS window_start, predicted, count(*) AS n, {_BUCKETS}, count(confidence) AS le_inf
        FROM judged WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
        GROUP BY minute, predicted""",
)
def stream_monitor(spark, sf_dir):
    """Scores by class and confidence per minute, for all closed minutes."""
    events = event_stream(spark, sf_dir)
    chance = ((F.col("user_id") * 37 + E.payload_key(events) * 13) % 100) / 100
    scored = events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        (chance >= 0.5).cast("int").alias("prediction"),
        F.greatest(chance, 1 - chance).alias("confidence"),
    )
    return text_dates(sinks.run_available(jobs.prediction_windows(scored), "monitor"))


@query("stream_scores")
def stream_scores(spark, sf_dir):
    """Sessions arriving as files, scored by a saved pipeline."""
    model, (_, _, test), _ = fitted(spark, sf_dir, model="linear", model_params={"maxIter": 10})
    root = new_path(spark, "stream-scores")
    models.save_model(model, root, "1")
    test.write.parquet(f"{root}/incoming")
    incoming = sinks.read_files(spark, f"{root}/incoming", test.schema)
    scored = jobs.score_new_files(incoming, models.load_model(root, "1"), _KEYS, f"{root}/scores")
    return rounded_scores(scored)
