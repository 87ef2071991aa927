"""Column expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import constants as C


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def target_filter(action: Column, targets: Sequence[str]) -> Column:
    """Condition for target hits, in the form a parquet scan can use."""
    if not targets:
        raise ValueError("the list of target actions is empty")
    return action.isin(*targets)


def is_target(action: Column, targets: Sequence[str]) -> Column:
    return flag(target_filter(action, targets))


def extracted(text: Column, pattern: str) -> Column:
    """First group of the pattern, NULL where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def car_id(path: Column) -> Column:
    return extracted(path, C.CAR_ID_PATTERN)


def utm_initial(path: Column, tag: str) -> Column:
    return extracted(path, C.UTM_INITIAL_PATTERN.format(tag=tag))


def safe_ratio(top: Column, bottom: Column, digits: int) -> Column:
    """Decimal division rounded half up, 0 where the divisor is not positive."""
    exact = top.cast("decimal(18,0)") / bottom.cast("decimal(18,0)")
    return F.when(bottom > 0, F.round(exact, digits)).otherwise(F.lit(0)).cast("double")


def without_placeholders(text: Column, placeholders: Sequence[str] = tuple(C.PLACEHOLDERS)) -> Column:
    return F.when(~text.isin(*placeholders), text)


def screen_area(resolution: Column) -> Column:
    """Width times height of a ``WxH`` text; only the first two numbers count."""
    parts = F.split(resolution, "x")

    def number(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        # the cast alone would also take Java suffixes such as "12f"
        return F.when(~part.rlike(r"[dDfF]\s*$"), part.try_cast("double"))

    return number(0) * number(1)


def geo_zone(country: Column, cis: Sequence[str] = tuple(C.CIS_COUNTRIES)) -> Column:
    return (
        F.when(country == C.HOME_COUNTRY, "russia")
        .when(country.isin(*cis), "cis")
        .otherwise("other_countries")
    )


def weekday_number(date: Column) -> Column:
    """Monday is 0; what is not a date counts as Monday."""
    return F.coalesce(F.weekday(date.try_cast("date")), F.lit(0))


def clock_hour(time: Column) -> Column:
    """Hour of ``H:m:s`` text, NULL where the text is no time of day."""
    return F.hour(F.try_to_timestamp(time.cast("string"), F.lit("H:m:s")))


def visit_hour(time: Column, mode: str = "clock") -> Column:
    """Hour of the visit, 12 where unknown. ``mode`` says how the text is read."""
    if mode not in ("clock", "number"):
        raise ValueError(f"unknown hour mode: {mode}")
    hour = clock_hour(time).cast("double") if mode == "clock" else time.try_cast("double")
    return F.coalesce(hour, F.lit(float(C.DEFAULT_HOUR)))


def is_night(hour: Column) -> Column:
    return flag(hour.isin(*C.NIGHT_HOURS))


def joined_text(*parts: Column) -> Column:
    """Parts joined with ``_``; an unknown part is written ``nan``."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def normal_city(city: Column) -> Column:
    return F.lower(F.regexp_replace(city, r"^\s+|\s+$", ""))


def imputed_os(os: Column, category: Column, brand: Column) -> Column:
    """Unknown operating systems follow from the device category and brand."""
    mobile = category.isin(*C.MOBILE_CATEGORIES)
    guess = (
        F.when(category == "desktop", "Windows")
        .when(mobile & (F.lower(brand) == "apple"), "iOS")
        .when(mobile, "Android")
    )
    return F.coalesce(os, guess)


def clipped(value: Column, low: float, high: float) -> Column:
    bounded = F.greatest(F.least(value, F.lit(high)), F.lit(low))
    return F.when(value.isNotNull(), bounded)


def collapsed(value: Column, kept: Sequence[str], rest: str) -> Column:
    """Values outside ``kept``, unknown ones included, become ``rest``."""
    if not kept:
        return F.lit(rest)
    return F.when(value.isin(*kept), value).otherwise(rest)


def form_int(text: Column) -> Column:
    """Whole number typed into a form; anything else is 0."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def verdict(probability: Column) -> Column:
    return F.when(probability > 0.5, "hot").otherwise("low")


def xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(0.0)


def hash_order(*keys: str | Column, seed: int = C.SEED) -> Column:
    """A repeatable pseudo-random BIGINT per key."""
    return F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys], F.lit(seed))


def hash_share(*keys: str | Column, seed: int = C.SEED) -> Column:
    """A repeatable pseudo-random number in [0, 1) per key: 52 bits of a digest any engine can compute."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


# --- column selection by type -------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def category_columns(df: DataFrame) -> list[str]:
    """Everything that is not a number."""
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Keep only one kind of missing value."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
