"""DuckDB SQL for each registered query, put together from shared CTEs."""

from __future__ import annotations

from clickloom import constants as C
from clickloom.sources.events import ADAPTED_TARGETS


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


TARGETS = quoted(ADAPTED_TARGETS)

EV = """
ev AS (
  SELECT event_id, user_id AS u, event_type AS action, value, ts, CAST(ts AS DATE) AS day,
         CAST(json_extract_string(props, '$.k') AS INT) AS k, epoch_us(ts) // 1000 AS ms
  FROM events)"""

HITS = """
ga_hits AS (
  SELECT u || '_' || CAST(day AS VARCHAR) AS session_id, day AS hit_date,
         CASE WHEN k % 11 <> 0 THEN ms - min(ms) OVER (PARTITION BY u, day) END AS hit_time,
         CAST(row_number() OVER (PARTITION BY u, day ORDER BY ts, event_id) AS INT) AS hit_number,
         CASE WHEN action = 'view' THEN 'pageview' ELSE 'event' END AS hit_type,
         CAST(NULL AS VARCHAR) AS hit_referer,
         CASE WHEN action IN ('view', 'click', 'purchase')
              THEN '/cars/all/b' || (k % 7) || '/c' || k
                   || CASE WHEN k % 2 = 0 THEN '?utm_source_initial=s' || (k % 5) || '&utm_medium_initial=cpc' ELSE '' END
              WHEN action <> 'error' THEN '/home?x=1' END AS hit_page_path,
         'cat_' || action AS event_category, action AS event_action,
         CAST(NULL AS VARCHAR) AS event_label, value AS event_value
  FROM ev)"""

SESSIONS = """
days AS (SELECT u, day, MIN(ts) AS t0 FROM ev GROUP BY u, day),
rows_of_days AS (
  SELECT u, day, substring(CAST(t0 AS VARCHAR), 12, 8) AS visit_time, 0 AS dup FROM days
  UNION ALL
  SELECT u, day, CASE WHEN u % 20 <> 0 THEN '00:00:00' END, 1 FROM days WHERE u % 10 = 0),
ga_sessions AS (
  SELECT u || '_' || CAST(day AS VARCHAR) AS session_id, CAST(u AS VARCHAR) AS client_id, day AS visit_date, visit_time,
         CAST(dense_rank() OVER (PARTITION BY u ORDER BY day) AS INT) AS visit_number,
         CASE WHEN u % 9 <> 0 THEN 'src' || (u % 9) END AS utm_source,
         CASE u % 6 WHEN 0 THEN 'organic' WHEN 1 THEN 'referral' WHEN 2 THEN '(none)' WHEN 3 THEN 'cpc' WHEN 4 THEN 'cpm' ELSE '(not set)' END AS utm_medium,
         CASE WHEN dup = 1 THEN 'dup' ELSE 'camp' || (u % 30) END AS utm_campaign,
         CASE WHEN u % 5 >= 3 THEN 'kw' || (u % 4) END AS utm_keyword,
         CASE WHEN u % 5 <> 0 THEN 'ad' || (u % 3) END AS utm_adcontent,
         CASE WHEN u % 10 < 6 THEN 'mobile' WHEN u % 10 < 9 THEN 'desktop' ELSE 'tablet' END AS device_category,
         CASE WHEN u % 7 >= 4 AND u % 10 BETWEEN 6 AND 8 THEN 'Windows' WHEN u % 7 >= 4 THEN 'Android' END AS device_os,
         CASE u % 8 WHEN 0 THEN 'Apple' WHEN 1 THEN 'Samsung' WHEN 2 THEN 'Xiaomi' WHEN 3 THEN 'Huawei' WHEN 4 THEN '(not set)' WHEN 5 THEN NULL ELSE 'Apple' END AS device_brand,
         CASE WHEN u % 100 = 0 THEN 'm1' END AS device_model,
         CASE u % 6 WHEN 0 THEN '1920x1080' WHEN 1 THEN '414x896' WHEN 2 THEN '360x720' WHEN 3 THEN '(not set)' WHEN 4 THEN NULL ELSE '0x0' END AS device_screen_resolution,
         CASE u % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'YaBrowser' ELSE '(Other)' END AS device_browser,
         CASE u % 20 WHEN 0 THEN 'Belarus' WHEN 1 THEN 'Kazakhstan' WHEN 2 THEN 'Germany' WHEN 3 THEN '(not set)' ELSE 'Russia' END AS geo_country,
         CASE u % 9 WHEN 0 THEN 'Moscow' WHEN 1 THEN 'Saint Petersburg' WHEN 2 THEN ' KAZAN ' WHEN 3 THEN 'Dublin' WHEN 4 THEN '(not set)'
              WHEN 5 THEN NULL WHEN 6 THEN 'Smallville' WHEN 7 THEN 'Sochi' ELSE 'Yekaterinburg' END AS geo_city
  FROM rows_of_days)"""

LATEST = """
latest AS (
  SELECT * FROM ga_sessions
  QUALIFY row_number() OVER (PARTITION BY session_id
            ORDER BY visit_date DESC NULLS FIRST, visit_time DESC NULLS FIRST, utm_campaign ASC NULLS LAST) = 1)"""

MARKED = f"""
marked AS (
  SELECT session_id, hit_number, hit_type, event_action, coalesce(hit_time, 0) AS t,
         coalesce(event_action IN ({TARGETS}), false) AS is_target,
         nullif(regexp_extract(hit_page_path, '{C.CAR_ID_PATTERN}', 1), '') AS car
  FROM ga_hits)"""

MART = """
counters AS (
  SELECT session_id,
         count(*) FILTER (NOT is_target) AS total_hits_count,
         count(*) FILTER (NOT is_target AND hit_type = 'event') AS total_events_count,
         count(DISTINCT event_action) FILTER (NOT is_target) AS unique_event_actions,
         count(DISTINCT car) AS unique_cars_viewed,
         count(car) AS total_car_views,
         max(CAST(is_target AS INT)) AS hit_target
  FROM marked GROUP BY session_id),
mart AS (
  SELECT session_id, client_id, visit_date, visit_time, visit_number, utm_source, utm_medium, utm_campaign,
         utm_adcontent, device_category, device_os, device_brand, device_screen_resolution, device_browser,
         geo_country, geo_city,
         coalesce(total_hits_count, 0) AS total_hits_count,
         coalesce(total_events_count, 0) AS total_events_count,
         coalesce(unique_event_actions, 0) AS unique_event_actions,
         coalesce(unique_cars_viewed, 0) AS unique_cars_viewed,
         coalesce(total_car_views, 0) AS total_car_views,
         CASE WHEN total_hits_count > 0 THEN round(CAST(total_car_views AS DOUBLE) / total_hits_count, 4) ELSE 0.0 END AS car_view_ratio,
         coalesce(hit_target, 0) AS event_value
  FROM latest LEFT JOIN counters USING (session_id))"""

SPEED = """
timed AS (
  SELECT *, min(CASE WHEN is_target THEN hit_number END) OVER (PARTITION BY session_id) AS first_target FROM marked),
speed AS (
  SELECT session_id, min(t) AS first_hit_time_ms, max(t) AS last_hit_time_ms, count(hit_number) AS total_hits_count,
         count(DISTINCT car) AS unique_cars_viewed, count(car) AS total_car_views, max(CAST(is_target AS INT)) AS target,
         max(t) - min(t) AS session_duration_ms,
         CASE WHEN count(hit_number) > 1 THEN (max(t) - min(t)) / (count(hit_number) - 1) ELSE 0.0 END AS avg_time_between_hits,
         CASE WHEN max(first_target) IS NULL THEN count(hit_number) ELSE count(*) FILTER (hit_number < first_target) END AS hits_before_target
  FROM timed GROUP BY session_id)"""

BLOCKS = {
    "hits": [EV, HITS],
    "sessions": [EV, SESSIONS],
    "latest": [EV, SESSIONS, LATEST],
    "mart": [EV, HITS, SESSIONS, LATEST, MARKED, MART],
    "speed": [EV, HITS, SESSIONS, MARKED, SPEED],
}


def sql(blocks: list[str], body: str, *ctes: str) -> str:
    return "WITH " + ",".join([*blocks, *ctes]) + "\n" + body


def share_of(key: str) -> str:
    """The pseudo-random share of a key, as the samples and splits compute it."""
    return f"CAST('0x' || substring(md5({key} || '|{C.SEED}'), 1, 13) AS BIGINT) / 4503599627370496"


SPLIT = f"""
client_labels AS (
  SELECT client_id, event_value AS label, {share_of("client_id")} AS place FROM mart
  QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY visit_date DESC, visit_time DESC NULLS LAST, session_id DESC) = 1),
sizes AS (SELECT min(n) AS least, sum(n) AS total, count(*) AS classes FROM (SELECT label, count(*) AS n FROM client_labels GROUP BY label)),
ordered AS (
  SELECT client_id, row_number() OVER (ORDER BY CASE
    WHEN classes > 1 AND (least < 2 OR total * CAST({C.TEST_SIZE} AS DOUBLE) < classes OR total * CAST({C.VAL_SIZE} AS DOUBLE) < classes) THEN ''
    ELSE CAST(label AS VARCHAR) END, place, client_id) - 1 AS p
  FROM client_labels, sizes),
remaining AS (SELECT *, p - floor(p * CAST({C.TEST_SIZE} AS DOUBLE)) AS r FROM ordered),
client_splits AS (
  SELECT client_id, CASE
    WHEN floor((p + 1) * CAST({C.TEST_SIZE} AS DOUBLE)) > floor(p * CAST({C.TEST_SIZE} AS DOUBLE)) THEN 'test'
    WHEN floor((r + 1) * CAST({C.VAL_SIZE / (1 - C.TEST_SIZE)!r} AS DOUBLE)) > floor(r * CAST({C.VAL_SIZE / (1 - C.TEST_SIZE)!r} AS DOUBLE)) THEN 'val'
    ELSE 'train' END AS split
  FROM remaining)"""

# --- features and cleaning ----------------------------------------------------

TEXTS = [
    "session_id",
    "client_id",
    "visit_time",
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
_HIDDEN = ", ".join(f"CASE WHEN {c} NOT IN ({quoted(C.PLACEHOLDERS)}) THEN {c} END AS {c}" for c in TEXTS)
_CITIES = ", ".join(f"('{n}', {m}, {p}, {s}, CAST({c} AS DOUBLE))" for n, m, p, s, c in C.CITY_MARKETS)

FEATURES = f"""
clean_mart AS (SELECT * REPLACE ({_HIDDEN}) FROM mart),
cities(city_key, c_metro, c_population, c_salary, c_cars) AS (VALUES {_CITIES}),
enriched AS (
  SELECT m.*,
         coalesce(c_metro, {C.CITY_DEFAULT[0]}) AS has_metro,
         CAST(coalesce(c_population, {C.CITY_DEFAULT[1]}) AS BIGINT) AS city_population,
         CAST(coalesce(c_salary, {C.CITY_DEFAULT[2]}) AS BIGINT) AS city_avg_salary,
         coalesce(c_cars, CAST({C.CITY_DEFAULT[3]} AS DOUBLE)) AS city_cars_per_family
  FROM clean_mart m LEFT JOIN cities ON lower(trim(geo_city)) = city_key),
features AS (
  SELECT *,
         TRY_CAST(split_part(device_screen_resolution, 'x', 1) AS DOUBLE)
           * TRY_CAST(split_part(device_screen_resolution, 'x', 2) AS DOUBLE) AS screen_area,
         CASE WHEN geo_country = '{C.HOME_COUNTRY}' THEN 'russia' WHEN geo_country IN ({quoted(C.CIS_COUNTRIES)}) THEN 'cis'
              ELSE 'other_countries' END AS geo_zone,
         CAST(device_category IN ({quoted(C.MOBILE_CATEGORIES)}) AS INT) AS is_mobile_device,
         CAST(isodow(visit_date) - 1 AS INT) AS day_of_week,
         CAST(isodow(visit_date) >= 6 AS INT) AS is_weekend,
         CAST(coalesce(CAST(split_part(visit_time, ':', 1) AS INT), 12) IN (23, 0, 1, 2, 3, 4, 5) AS INT) AS is_night,
         CAST(NULL AS DOUBLE) AS session_duration_ms,
         CASE WHEN total_hits_count > 0 THEN CAST(NULL AS DOUBLE) ELSE 0.0 END AS ms_per_hit,
         coalesce(device_category, 'nan') || '_' || coalesce(device_brand, 'nan') AS dev_category_brand,
         total_car_views / (city_cars_per_family + 1e-5) AS user_vs_city_car_interest
  FROM enriched)"""

BLOCKS["features"] = [*BLOCKS["mart"], FEATURES]

NUMBERS = [
    "visit_number",
    "total_hits_count",
    "total_events_count",
    "unique_event_actions",
    "unique_cars_viewed",
    "total_car_views",
    "car_view_ratio",
    "screen_area",
    "is_mobile_device",
    "day_of_week",
    "is_weekend",
    "is_night",
    "has_metro",
    "city_population",
    "city_avg_salary",
    "city_cars_per_family",
    "user_vs_city_car_interest",
]
CATEGORIES = [
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
    "geo_zone",
    "dev_category_brand",
]
# columns the data makes useless: no times in the mart, so nothing to derive from them
USELESS = ["session_duration_ms", "ms_per_hit"]


def unpivoted(source: str, columns: list[str], kind: str = "VARCHAR") -> str:
    """SELECT that turns columns into (column_name, value) rows, unknown values included."""
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS {kind}) AS value FROM {source}" for c in columns]
    return "\n    UNION ALL ".join(parts)


STUDIED = f"""
long AS ({unpivoted("features", [*CATEGORIES, *NUMBERS, *USELESS])}),
value_counts AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL),
column_shares AS (
  SELECT column_name, coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n) AS null_share, max(n) / sum(n) AS top_share
  FROM value_counts GROUP BY column_name),
tops AS (
  SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place
  FROM value_counts WHERE value IS NOT NULL AND column_name IN ({quoted(CATEGORIES)})),
number_long AS ({unpivoted("features", NUMBERS, "DOUBLE")}),
number_stats AS (
  SELECT column_name, median(value) AS mid, avg(value) AS mean, stddev_samp(value) AS std,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM number_long GROUP BY column_name),
brand_medians AS (
  SELECT device_brand, median(screen_area) AS brand_median FROM features
  WHERE device_brand IS NOT NULL AND screen_area IS NOT NULL GROUP BY device_brand)"""

BLOCKS["studied"] = [*BLOCKS["features"], STUDIED]


def _cleaned_category(c: str) -> str:
    source = {
        "device_brand": "coalesce(f.device_brand, 'Unknown')",
        "device_os": """coalesce(f.device_os, CASE WHEN f.device_category = 'desktop' THEN 'Windows'
             WHEN f.device_category IN ('mobile', 'tablet') AND lower(f.device_brand) = 'apple' THEN 'iOS'
             WHEN f.device_category IN ('mobile', 'tablet') THEN 'Android' END)""",
    }.get(c, f"f.{c}")
    return (
        f"CASE WHEN {source} IN (SELECT value FROM tops WHERE column_name = '{c}' AND place <= {C.TOP_CATEGORIES}) "
        f"THEN {source} ELSE 'other_collapsed' END AS {c}"
    )


def _cleaned_number(c: str) -> str:
    source = "coalesce(f.screen_area, b.brand_median, (SELECT median(screen_area) FROM features))" if c == "screen_area" else f"f.{c}"
    return f"CAST(coalesce({source}, (SELECT mid FROM number_stats WHERE column_name = '{c}')) AS DOUBLE) AS {c}"


PREPROCESSED = (
    "SELECT f.session_id, f.event_value, "
    + ", ".join([_cleaned_category(c) for c in CATEGORIES] + [_cleaned_number(c) for c in NUMBERS])
    + " FROM features f LEFT JOIN brand_medians b USING (device_brand)"
)

# --- scored rows -----------------------------------------------------------------

SCORED = """
scored AS (
  SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(event_type = 'purchase' AS INT) AS actual,
         ((user_id * 37 + CAST(json_extract_string(props, '$.k') AS INT) * 13) % 100) / 100 AS probability
  FROM events),
judged AS (
  SELECT *, CAST(probability >= 0.5 AS INT) AS predicted, greatest(probability, 1 - probability) AS confidence FROM scored)"""

MART_SCORED = """
scored AS (
  SELECT *, ((CAST(client_id AS BIGINT) * 37 + visit_number * 13 + total_hits_count * 7) % 100) / 100 AS probability FROM mart),
judged AS (
  SELECT *, CAST(probability >= 0.5 AS INT) AS predicted, event_value AS actual,
         CAST((probability >= 0.5) <> (event_value = 1) AS INT) AS is_error
  FROM scored)"""

LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_extendedprice AS actual,
         l_quantity * 1500 * (1 - l_discount) + l_tax * 1000 AS predicted
  FROM lineitem),
residuals AS (SELECT *, predicted - actual AS error, abs(predicted - actual) AS abs_error FROM lines)"""


def report(cells: str, labels: str = "VARCHAR") -> str:
    """CTEs of a class report over (actual, predicted, n) rows."""
    return f"""
classes AS (SELECT CAST(actual AS {labels}) AS class FROM {cells} UNION SELECT CAST(predicted AS {labels}) FROM {cells}),
sums AS (
  SELECT class,
         (SELECT coalesce(sum(n), 0) FROM {cells} WHERE CAST(actual AS {labels}) = class) AS support,
         (SELECT coalesce(sum(n), 0) FROM {cells} WHERE CAST(predicted AS {labels}) = class) AS named,
         (SELECT coalesce(sum(n), 0) FROM {cells} WHERE CAST(predicted AS {labels}) = class AND actual = predicted) AS hits
  FROM classes),
per_class AS (
  SELECT class, CASE WHEN named > 0 THEN hits / named ELSE 0 END AS "precision",
         CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
         CASE WHEN named + support > 0 THEN 2 * hits / (named + support) ELSE 0 END AS f1, support
  FROM sums)"""
