"""Row filters and class filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.constants import MAX_ROW_NULL_SHARE


def drop_sparse_by_count(df: DataFrame, max_null_share: float = MAX_ROW_NULL_SHARE) -> DataFrame:
    """Keep rows with at least ``int(columns * (1 - share))`` known values; a share of 1 keeps all."""
    if max_null_share >= 1.0:
        return df
    return df.dropna(thresh=int(len(df.columns) * (1.0 - max_null_share)))


def drop_sparse_rows(df: DataFrame, max_null_share: float = MAX_ROW_NULL_SHARE) -> DataFrame:
    """Keep rows whose share of unknown values is not above the limit."""
    known = dict(df.dtypes)

    def unknown(c: str):
        missing = F.col(c).isNull()
        if known[c] in ("double", "float"):
            missing = missing | F.isnan(c)
        return missing.cast("int")

    nulls = sum((unknown(c) for c in df.columns), F.lit(0))
    return df.filter(nulls / len(df.columns) <= max_null_share)


def of_class(df: DataFrame, target: str, value: int) -> DataFrame:
    return df.filter(F.col(target) == value)


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """The frame without its target, and the target alone. Rows are tied by key columns, never by position."""
    return df.drop(target), df.select(target)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def report_columns(df: DataFrame, service: Sequence[str], limit: int, text_only: bool = True) -> list[str]:
    """The first ``limit`` columns a report shows: service columns left out, in column order."""
    wanted = [n for n, kind in df.dtypes if n not in service and (kind == "string" or not text_only)]
    return wanted[:limit]
