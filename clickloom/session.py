"""Spark session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hits of one streamed session meet before the shuffle; large state stays off the heap
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # no call-site capture for every column expression: plans are built twice as fast
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app_name: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster settings stay the cluster's."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session without the setting gets a scratch folder. On a cluster
    a machine-local folder would lose data, so a missing setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return context.getCheckpointDir()


def allow_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the shared folder.

    No run ever reads what another run wrote; the folder ``clickloom-<application id>``
    can go when the application has ended.
    """
    application = f"clickloom-{spark.sparkContext.applicationId}"
    return "/".join([shared_dir(spark).rstrip("/"), application, f"{name}-{uuid.uuid4().hex}"])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several jobs can scan it.

    The written table survives lost executors, which cached blocks do not.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stages(spark: SparkSession) -> None:
    """Remove all stage tables of this application. Call it when no frame is read any more: frames read them lazily."""
    application = f"{shared_dir(spark).rstrip('/')}/clickloom-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(application)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
