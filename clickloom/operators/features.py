"""Engineered session features as a stateless Transformer."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import constants as C
from clickloom.functions import columns as X

ENGINEERED_COLUMNS = [
    "screen_area",
    "geo_zone",
    "is_mobile_device",
    "day_of_week",
    "is_weekend",
    "is_night",
    "session_duration_ms",
    "ms_per_hit",
    "dev_category_brand",
    "has_metro",
    "city_population",
    "city_avg_salary",
    "city_cars_per_family",
    "user_vs_city_car_interest",
]

_CITY_SCHEMA = "city_key string, has_metro int, city_population bigint, city_avg_salary bigint, city_cars_per_family double"
_CITY_COLUMNS = ["has_metro", "city_population", "city_avg_salary", "city_cars_per_family"]


def city_markets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.CITY_MARKETS, _CITY_SCHEMA)


def enrich_city(df: DataFrame, city: str = "geo_city") -> DataFrame:
    """City market facts by normalised name; unlisted cities get the default row.

    The market table is a fixed list of 31 rows, so it is always broadcast.
    """
    defaults = dict(zip(_CITY_COLUMNS, C.CITY_DEFAULT))
    if city not in df.columns:
        kinds = dict(zip(_CITY_COLUMNS, ["int", "bigint", "bigint", "double"]))
        return df.withColumns({c: F.lit(v).cast(kinds[c]) for c, v in defaults.items()})
    markets = F.broadcast(city_markets(df.sparkSession))
    joined = df.withColumn("city_key", X.normal_city(F.col(city))).join(markets, "city_key", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}).drop("city_key")


class SessionFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the engineered columns; an absent input gives its column a typed default.

    ``hourMode`` says how ``visit_time`` is read: ``clock`` (``HH:mm:ss`` text),
    ``number`` (an hour), or ``auto``: clock, unless no row at all holds a clock
    time, which costs one extra look at the data.
    """

    cisCountries = Param(Params._dummy(), "cisCountries", "countries of the near zone", TypeConverters.toListString)
    placeholders = Param(Params._dummy(), "placeholders", "texts that stand for no value", TypeConverters.toListString)
    mobileCategories = Param(Params._dummy(), "mobileCategories", "mobile device categories", TypeConverters.toListString)
    hourMode = Param(Params._dummy(), "hourMode", "clock, number or auto", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cisCountries=None, placeholders=None, mobileCategories=None, hourMode=None):
        super().__init__()
        self._setDefault(
            cisCountries=list(C.CIS_COUNTRIES),
            placeholders=list(C.PLACEHOLDERS),
            mobileCategories=list(C.MOBILE_CATEGORIES),
            hourMode="clock",
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _hour_mode(self, df: DataFrame) -> str:
        mode = self.getOrDefault(self.hourMode)
        if isinstance(df.schema["visit_time"].dataType, T.NumericType):
            return "number"
        if mode != "auto":
            return mode
        no_clock = df.filter(X.clock_hour(F.col("visit_time")).isNotNull()).isEmpty()
        return "number" if no_clock else "clock"

    def _transform(self, df: DataFrame) -> DataFrame:
        hidden = self.getOrDefault(self.placeholders)
        texts = X.text_columns(df)
        if texts:
            df = df.withColumns({c: X.without_placeholders(F.col(c), hidden) for c in texts})
        has = set(df.columns).__contains__
        null = F.lit(None).cast("double")

        area = X.screen_area(F.col("device_screen_resolution")) if has("device_screen_resolution") else null
        zone = (
            X.geo_zone(F.col("geo_country"), self.getOrDefault(self.cisCountries))
            if has("geo_country")
            else F.lit("other_countries")
        )
        mobile = (
            X.flag(F.col("device_category").isin(*self.getOrDefault(self.mobileCategories)))
            if has("device_category")
            else F.lit(0)
        )
        day = X.weekday_number(F.col("visit_date")) if has("visit_date") else F.lit(0)
        hour = (
            X.visit_hour(F.col("visit_time"), self._hour_mode(df))
            if has("visit_time")
            else F.lit(float(C.DEFAULT_HOUR))
        )
        duration = (
            (F.col("last_hit_time_ms") - F.col("first_hit_time_ms")).cast("double")
            if has("last_hit_time_ms") and has("first_hit_time_ms")
            else null
        )
        hits = F.col("total_hits_count") if has("total_hits_count") else null
        per_hit = (
            F.when(hits > 0, F.col("session_duration_ms") / hits).otherwise(0.0) if has("total_hits_count") else null
        )
        pair = (
            X.joined_text(F.col("device_category"), F.col("device_brand"))
            if has("device_category") and has("device_brand")
            else F.lit("Unknown_Unknown")
        )
        df = df.withColumns(
            {
                "screen_area": area,
                "geo_zone": zone,
                "is_mobile_device": mobile,
                "day_of_week": day,
                "is_weekend": X.flag(day.isin(*C.WEEKEND_DAYS)),
                "is_night": X.is_night(hour),
                "session_duration_ms": duration,
                "dev_category_brand": pair,
            }
        ).withColumn("ms_per_hit", per_hit)
        df = enrich_city(df)
        if has("total_car_views"):
            interest = F.col("total_car_views") / (F.col("city_cars_per_family") + 1e-5)
            df = df.withColumn("user_vs_city_car_interest", interest)
        return df.select(*self.output_columns(df.columns))

    @staticmethod
    def output_columns(inputs: list[str]) -> list[str]:
        """Names after the transform: the inputs, then the engineered columns."""
        made = [c for c in ENGINEERED_COLUMNS if c != "user_vs_city_car_interest" or "total_car_views" in inputs]
        return [c for c in inputs if c not in made] + made
