"""Table sinks.  Appends for logs, replayable overwrites for micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Options a warehouse connection cannot do without.
WAREHOUSE_OPTIONS = ["sfUrl", "sfUser", "sfPassword", "sfDatabase", "sfSchema", "sfWarehouse"]

CURATED_PARTITIONS = ["country", "plan"]


def write_curated(df: DataFrame, path: str, partitions: list[str] | None = None,
                  mode: str = "append") -> None:
    """Curated Parquet by country and plan.

    Written as they come, the rows of every task would leave a small file per
    partition value; the rebalance gathers a value's rows into few files and
    still splits a hot value over several tasks.
    """
    parts = partitions or CURATED_PARTITIONS
    (_normalised(df, parts).hint("rebalance", *[F.col(p) for p in parts])
     .write.mode(mode).partitionBy(*parts).parquet(path))


def _normalised(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Empty partition values as null: both would be read back as null."""
    return df.withColumns({p: F.nullif(F.col(p).cast("string"), F.lit("")) for p in partitions})


def write_curated_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """A micro-batch of the curated table: a file or a few for each country and plan, replaced by a replay."""
    write_batch(_normalised(batch, CURATED_PARTITIONS), batch_id, path, partitions=CURATED_PARTITIONS)


def append_rebalanced(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Append Parquet by partition columns, few files for each value, a large value over several."""
    (df.hint("rebalance", *[F.col(p) for p in partitions])
     .write.mode("append").partitionBy(*partitions).parquet(path))


def append_log(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append rows to a log table: decisions, run reports, incidents, results."""
    df.write.mode("append").format(fmt).save(path)


def write_document(df: DataFrame, path: str) -> None:
    """The latest decisions as JSON, replacing the previous ones."""
    df.write.mode("overwrite").json(path)


def write_quarantine(df: DataFrame, path: str, reason: str | Column, at: Column,
                     source_path: str, condition: str) -> None:
    """Quarantined rows by reason and batch time, each with where it came from.

    Rebalanced by reason for the same reason as the curated table.
    """
    reason_c = F.lit(reason) if isinstance(reason, str) else reason
    (df.withColumns({
        "reason": reason_c,
        "quarantine_ts": F.date_format(at, "yyyyMMdd_HHmmss"),
        "source_path": F.lit(source_path),
        "filter_condition": F.lit(condition),
    }).hint("rebalance", F.col("reason"))
     .write.mode("append").partitionBy("reason", "quarantine_ts").parquet(path))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table's folder yet, in whatever file system the path is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Drop a folder that may not be there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_batch(batch: DataFrame, batch_id: int, path: str, fmt: str = "parquet", partitions: list[str] | None = None) -> None:
    """One micro-batch under its own folder; a replay overwrites just that folder.

    With ``partitions`` a value's rows are gathered into few files before they are written.
    """
    if partitions:
        batch = batch.hint("rebalance", *[F.col(p) for p in partitions])
    writer = batch.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partitions) if partitions else writer).save(f"{path.rstrip('/')}/batch_id={batch_id}")


def warehouse_options(options: dict[str, str], required: list[str] | None = None) -> dict[str, str]:
    """Check connection options before a stream starts, not in its first batch."""
    missing = [k for k in (WAREHOUSE_OPTIONS if required is None else required) if not options.get(k)]
    if missing:
        raise ValueError(f"missing warehouse options: {', '.join(missing)}")
    return dict(options)


def warehouse_writer(fmt: str, options: dict[str, str], table: str | None = None):
    """A ``foreachBatch`` function that appends non-empty batches to a warehouse table.

    Every row carries its ``batch_id``, the handle for removing a replayed batch
    in a warehouse without transactions across the two systems.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        writer = (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                  .write.format(fmt).options(**options).mode("append"))
        if table is not None:
            writer = writer.option("dbtable", table)
        writer.save()
    return write
