"""File sources and sinks."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.constants import SEED
from clickloom.sources import quoted_csv
from clickloom.sources.schemas import DAY_COLUMN, RAW_SCHEMAS

# quotes inside quoted fields are doubled, and such fields may hold line breaks
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True}

_READERS = {".csv": "csv", ".parquet": "parquet", ".pqt": "parquet", ".pq": "parquet"}


def read_flat(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sample: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Read a CSV or parquet file or folder, with an optional Bernoulli row sample.

    Give a schema for large CSV files: without one Spark reads them twice.
    """
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in _READERS:
        raise ValueError(f"unsupported file format: {suffix or path}")
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        if suffix == ".csv":
            df = _typed(csv_texts(spark, path), path, schema) if schema else reader.options(**CSV_OPTIONS).option("inferSchema", True).csv(path)
        else:
            df = reader.format(_READERS[suffix]).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"no data file at {path}") from error
        raise
    return df.sample(withReplacement=False, fraction=sample, seed=seed) if sample < 1.0 else df


def csv_texts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV file or folder with all columns as text, named by the header. Empty fields are null.

    Line breaks may stand inside quotes; byte ranges of a file are read side by side all the same
    (``quoted_csv``), and what they hold is written once to the shared folder. Where no field holds a line
    break, ``multi_line=False`` reads the files lazily and without that copy.
    """
    whole = spark.read.options(**{**CSV_OPTIONS, "multiLine": multi_line}).csv(path)  # looks at the header only
    if not multi_line:
        return whole
    return quoted_csv.parsed(quoted_csv.csv_records(quoted_csv.csv_chunks(spark, path)), whole.columns)


def _converted(field: T.StructField) -> Column:
    """A text column as the type of a field; null where it does not parse. Whole numbers may be written as 12.0."""
    name, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, T.IntegralType):
        # straight first: a double would lose digits of long numbers
        whole = F.expr(f"try_cast({name} as double)")
        through = F.when(whole == F.floor(whole), whole).try_cast(kind)
        return F.coalesce(F.expr(f"CASE WHEN {name} RLIKE '^[+-]?[0-9]+$' THEN try_cast({name} as {kind.simpleString()}) END"), through)
    return F.expr(f"try_cast({name} as {kind.simpleString()})")


def _typed(texts: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """The columns of a schema by name, in its order, converted. A missing column is an error."""
    missing = [f.name for f in schema if f.name not in texts.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return texts.select(*(_converted(f).alias(f.name) for f in schema))


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """(column_name, n_rejected, example) of the columns with values that do not parse."""
    return _rejects(csv_texts(spark, path, multi_line), schema)


def _rejects(texts: DataFrame, schema: T.StructType) -> DataFrame:
    bad = {f.name: F.col(f"`{f.name}`").isNotNull() & _converted(f).isNull() for f in schema if f.name in texts.columns}
    counts = texts.agg(
        *(F.count(F.when(b, 1)).alias(f"n:{c}") for c, b in bad.items()),
        *(F.min(F.when(b, F.col(f"`{c}`"))).alias(f"e:{c}") for c, b in bad.items()),
    )
    lines = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"`n:{c}`").alias("n_rejected"), F.col(f"`e:{c}`").alias("example")) for c in bad)
    )
    return counts.select(F.inline(lines)).where("n_rejected > 0")


def load_raw_csv(spark: SparkSession, csv_path: str, kind: str, out_path: str, max_rejects: int = 0, multi_line: bool = True) -> DataFrame:
    """Load a raw CSV (``hits`` or ``sessions``) into parquet partitioned by day.

    Columns are taken by the names in the header. Values that do not parse are
    counted first: more than ``max_rejects`` of them are an error that names
    them, fewer become null. Files of any size are read once, by as many tasks
    as they have byte ranges, line breaks inside quotes or not (see ``csv_texts``).
    Rows of one day are spread over several writers by the rebalance, however
    large the day is.
    """
    if kind not in RAW_SCHEMAS:
        raise ValueError(f"unknown raw table: {kind}")
    schema, day = RAW_SCHEMAS[kind], DAY_COLUMN[kind]
    texts = csv_texts(spark, csv_path, multi_line)
    raw = _typed(texts, csv_path, schema)
    rejects = _rejects(texts, schema).collect()  # one row per column at most
    if sum(r["n_rejected"] for r in rejects) > max_rejects:
        told = "; ".join(f"{r['column_name']}: {r['n_rejected']}, such as {r['example']!r}" for r in rejects)
        raise ValueError(f"{csv_path} has values that do not parse: {told}")
    balanced = raw.hint("rebalance", day)
    balanced.write.mode("overwrite").partitionBy(day).parquet(out_path)
    # partition columns come last on disk
    return spark.read.schema(schema).parquet(out_path).select(*schema.fieldNames())


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as CSV that ``read_flat`` and ``csv_texts`` read back unchanged: empty texts quoted, nulls bare."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', **keep).csv(path)


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of an external database over JDBC.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``: without them one task reads the whole table.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def cached_table(
    spark: SparkSession,
    root: str,
    query: str,
    version: str,
    sample: float,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """Read a result from its parquet cache, building it first where it is absent.

    The key holds the query's name, its version and the sample share. A folder
    without Spark's success marker is an unfinished write and is built again.
    """
    path = f"{root.rstrip('/')}/{query}/version={version}/sample={sample}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_predictions(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Save scores with their keys; the folder holds one file per task."""
    if file_format not in ("csv", "parquet"):
        raise ValueError(f"unsupported file format: {file_format}")
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_ranking(df: DataFrame, path: str) -> None:
    """Save a small ranking (one row per feature) as a single CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
