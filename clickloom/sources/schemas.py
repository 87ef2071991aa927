"""Schemas of the raw tables, table creation and the schema contract."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HITS_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("hit_date", T.DateType()),
        T.StructField("hit_time", T.LongType()),  # ms since the session started
        T.StructField("hit_number", T.IntegerType()),
        T.StructField("hit_type", T.StringType()),
        T.StructField("hit_referer", T.StringType()),
        T.StructField("hit_page_path", T.StringType()),
        T.StructField("event_category", T.StringType()),
        T.StructField("event_action", T.StringType()),
        T.StructField("event_label", T.StringType()),
        T.StructField("event_value", T.DoubleType()),
    ]
)

SESSIONS_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("visit_date", T.DateType()),
        T.StructField("visit_time", T.StringType()),  # HH:mm:ss
        T.StructField("visit_number", T.IntegerType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("utm_medium", T.StringType()),
        T.StructField("utm_campaign", T.StringType()),
        T.StructField("utm_keyword", T.StringType()),
        T.StructField("utm_adcontent", T.StringType()),
        T.StructField("device_category", T.StringType()),
        T.StructField("device_os", T.StringType()),
        T.StructField("device_brand", T.StringType()),
        T.StructField("device_model", T.StringType()),
        T.StructField("device_screen_resolution", T.StringType()),
        T.StructField("device_browser", T.StringType()),
        T.StructField("geo_country", T.StringType()),
        T.StructField("geo_city", T.StringType()),
    ]
)

# Day column of each raw table: the partition column on disk.
DAY_COLUMN = {"hits": "hit_date", "sessions": "visit_date"}
RAW_SCHEMAS = {"hits": HITS_SCHEMA, "sessions": SESSIONS_SCHEMA}


def create_raw_tables(spark: SparkSession, hits: str = "ga_hits", sessions: str = "ga_sessions") -> None:
    """Drop and create the two raw tables, empty, partitioned by day."""
    for name, kind in ((hits, "hits"), (sessions, "sessions")):
        empty = spark.createDataFrame([], RAW_SCHEMAS[kind])
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        empty.write.format("parquet").partitionBy(DAY_COLUMN[kind]).saveAsTable(name)


def save_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Save a raw table bucketed by session, so that mart joins need no shuffle.

    Rows are spread by session before the write: each task then writes few
    buckets, instead of every task writing one small file per bucket. A session
    with a large share of all rows makes its bucket just as large: leave such a
    table unbucketed, so that the operators can spread it.
    """
    (
        df.repartition(buckets, "session_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "session_id")
        .sortBy("session_id")
        .saveAsTable(table)
    )


# --- schema contract ----------------------------------------------------------


def contract_of(df: DataFrame) -> str:
    """The feature schema as JSON text, column name to type."""
    return json.dumps({f.name: f.dataType.simpleString() for f in df.schema}, indent=4)


def write_contract(df: DataFrame, path: str) -> None:
    """One small JSON file next to the model; written by Spark, so any file system works."""
    spark = df.sparkSession
    rows = spark.createDataFrame([(contract_of(df),)], "contract string")
    rows.coalesce(1).write.mode("overwrite").text(path, lineSep="\x00")


def read_contract(spark: SparkSession, path: str) -> dict[str, str]:
    text = spark.read.text(path, wholetext=True).first()["value"]
    return json.loads(text.rstrip("\x00"))


def _converted(name: str, wanted: str) -> Column:
    return F.col(name).try_cast(wanted)


def require_columns(df: DataFrame, contract: dict[str, str]) -> None:
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ValueError(f"columns the contract asks for are missing: {', '.join(missing)}")


def apply_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """The contract's columns in its types; values that do not convert become NULL."""
    require_columns(df, contract)
    return df.select(*[_converted(c, t).alias(c) for c, t in contract.items()])


def check_schema(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Per column: rows, nulls and values that do not convert, in one aggregation."""
    require_columns(df, contract)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for name, wanted in contract.items():
        broken = F.col(name).isNotNull() & _converted(name, wanted).isNull()
        aggregates += [
            F.count(F.when(F.col(name).isNull(), 1)).alias(f"nulls:{name}"),
            F.count(F.when(broken, 1)).alias(f"broken:{name}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted).alias("wanted_type"),
            F.col("rows").alias("n_rows"),
            F.col(f"`nulls:{name}`").alias("n_null"),
            F.col(f"`broken:{name}`").alias("n_broken"),
        )
        for name, wanted in contract.items()
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))
