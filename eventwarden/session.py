"""Session construction and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WORK_KEY = "spark.eventwarden.work.dir"

# Runtime settings the operators rely on or profit from; all are public Spark SQL options.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
STREAM_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "eventwarden", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution on; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STREAM_STATE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Pin the zone of a session somebody else built: epoch conversions depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder, or under WORK_KEY where that is unset."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.conf.get(WORK_KEY, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_KEY} or {WORK_KEY} to a folder all executors share")
    return f"{root.rstrip('/')}/eventwarden/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where one small aggregate feeds several later steps: each step then
    scans the aggregate instead of the event table, and a lost executor costs a
    re-read rather than a recomputation.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
