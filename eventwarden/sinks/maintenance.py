"""Upkeep of Parquet tables: retention by date, and compaction of partitions and batch folders with many small files.

Tables here are plain folders by partition value, as the sinks of this package write them.  Files are listed with their
sizes by Spark, so a listing is as wide as the table's folders.

A rewrite goes through a journal inside the table (``_upkeep``, which readers skip): the rows to write and the folders
to drop are written there first, then a mark, then the table is changed, then the journal goes.  A call that dies
before the mark has changed nothing; one that dies after it is finished by the next call (``finish``) from the
journal, whatever it had done.  One upkeep runs on a table at a time, and only partitions that nobody writes to
meanwhile may be given to it: whole days, or batches before the newest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventwarden import policies as P
from eventwarden.sinks.tables import exists

DATE = "event_date"
UNDATED = "undated"
JOURNAL = "_upkeep"
#: Folders that only a stream's checkpoint or sink log has.
CHECKPOINT_FOLDERS = ["offsets", "commits", "state", "_spark_metadata"]
TARGET_BYTES = 128 << 20
#: A file is small below this share of the target.
SMALL = 4


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    system, place = _fs(spark, path)
    system.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    system, place = _fs(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()) if system.exists(place) else []


def dated(df: DataFrame, at: str = "event_timestamp") -> DataFrame:
    """With the event date as text; rows without a time have a partition of their own."""
    return df.withColumn(DATE, F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(UNDATED)))


def write_dated(df: DataFrame, path: str, at: str = "event_timestamp", partitions: list[str] | None = None) -> None:
    """Write by event date, then ``partitions``; the partitions that ``df`` has rows for are replaced, the others stay.

    A repeated load of some days leaves those days as loaded last.
    """
    by = [DATE, *(partitions or [])]
    _replace(dated(df, at), path, by)


def _replace(df: DataFrame, path: str, by: list[str]) -> None:
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def table_files(spark: SparkSession, path: str, by: list[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(``folder``, ``files``, ``small_files``, ``bytes``) of each partition; no file is opened."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .load(path).select("path", "length"))
    depth = "/".join(["[^/]+=[^/]*"] * len(by))
    found = listed.withColumn("folder", F.regexp_extract("path", f"/({depth})/[^/]+$", 1))
    return found.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") < target_bytes // SMALL).alias("small_files"),
        F.sum("length").alias("bytes"))


# -- the journal --------------------------------------------------------------------------

def _journalled(spark: SparkSession, path: str, rows: DataFrame | None, by: list[str], dropped: list[str]) -> None:
    """Write the journal, mark it, and carry it out."""
    journal = f"{path}/{JOURNAL}"
    remove(spark, journal)
    if rows is not None:
        rows.write.parquet(f"{journal}/rows")
    plan = [(name, None) for name in dropped] + [(None, name) for name in by]
    # the last thing written: without its _SUCCESS the journal counts for nothing
    spark.createDataFrame(plan, "dropped string, by string").coalesce(1).write.parquet(f"{journal}/plan")
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> bool:
    """Carry out what a journal says, if there is a whole one; every upkeep begins with this."""
    path = path.rstrip("/")
    journal = f"{path}/{JOURNAL}"
    whole = exists(spark, f"{journal}/plan/_SUCCESS")
    if whole:
        lists = spark.read.parquet(f"{journal}/plan").agg(F.collect_list("dropped"), F.collect_list("by")).first()
        if exists(spark, f"{journal}/rows/_SUCCESS"):
            _replace(spark.read.parquet(f"{journal}/rows"), path, lists[1])
        for name in lists[0]:
            remove(spark, f"{path}/{name}")
    remove(spark, journal)
    return whole


def _read(spark: SparkSession, path: str, schema: T.StructType, names: list[str]) -> DataFrame:
    """The rows of some partitions; the declared schema keeps partition values as they are written."""
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


# -- compaction ---------------------------------------------------------------------------

def compact(spark: SparkSession, path: str, schema: T.StructType, by: list[str], min_files: int = 4,
            target_bytes: int = TARGET_BYTES, most: int = 10_000) -> list[str]:
    """Rewrite the partitions with ``min_files`` small files or more, and no other; returns their folders.

    Rows are rebalanced by partition, so a small one becomes a file and a large one several.  ``most`` bounds the
    partitions of a call, those with the most small files first; call again for the rest.
    """
    path = path.rstrip("/")
    finish(spark, path)
    found = (table_files(spark, path, by, target_bytes).filter((F.col("small_files") >= min_files) & (F.col("folder") != ""))
             .orderBy(F.desc("small_files"), "folder").limit(most))
    names = [r.folder for r in found.select("folder").toLocalIterator()]
    if names:
        _journalled(spark, path, _read(spark, path, schema, names), by, [])
    return names


def fold_batches(spark: SparkSession, path: str, schema: T.StructType, by: list[str], below: int, fan: int = 8) -> list[int]:
    """Merge batch folders of like size into the newest of them; returns the ids that went.

    Sizes fall into tiers, each ``fan`` times the one before.  A tier is merged once it has ``fan`` folders, which makes
    one folder of the next tier: every row is rewritten once a tier, and the folders stay few.  Batches from ``below``
    on are left alone: the newest may be written again.
    """
    path = path.rstrip("/")
    finish(spark, path)
    sizes = table_files(spark, path, ["batch_id", *by]).groupBy(
        F.regexp_extract("folder", "^batch_id=([0-9]+)", 1).cast("bigint").alias("batch_id")).agg(F.sum("bytes").alias("bytes"))
    tier = F.floor(F.log(F.col("bytes").cast("double")) / F.log(F.lit(float(fan))))
    tiers = (sizes.filter(F.col("batch_id") < below).groupBy(tier.alias("tier"))
             .agg(F.array_sort(F.collect_list("batch_id")).alias("ids")).filter(F.size("ids") >= fan).orderBy("tier"))
    row = tiers.first()
    if row is None:
        return []
    *gone, last = row.ids
    names = [f"batch_id={i}" for i in row.ids]
    rows = _read(spark, path, schema, names).withColumn("batch_id", F.lit(last).cast("bigint"))
    _journalled(spark, path, rows, ["batch_id", *by], [f"batch_id={i}" for i in gone])
    return gone


# -- retention ----------------------------------------------------------------------------

def expire(spark: SparkSession, path: str, schema: T.StructType, as_of: Column, by: list[str] | None = None,
           at: str = "event_timestamp", days: int = P.RETENTION_DAYS) -> dict[str, str]:
    """Delete rows from before the retention period; returns what became of each date.

    Whole days go as folders, unread.  Only the day that the period begins in is rewritten.  Undated rows stay.  A folder
    that belongs to a stream's checkpoint is refused.
    """
    path = path.rstrip("/")
    names = folders(spark, path)
    if any(n in CHECKPOINT_FOLDERS for n in names):
        raise ValueError(f"{path} holds a stream's checkpoint, not a table by date")
    finish(spark, path)
    cutoff = as_of - F.expr(f"INTERVAL {int(days)} DAY")
    first = spark.range(1).select(F.date_format(cutoff, "yyyy-MM-dd")).first()[0]
    dates = [n.split("=", 1)[1] for n in names if n.startswith(f"{DATE}=")]
    fate = {d: "kept" if d == UNDATED or d > first else "trimmed" if d == first else "dropped" for d in dates}
    gone = [f"{DATE}={d}" for d, f in fate.items() if f == "dropped"]
    rows = None
    if first in fate:
        day = _read(spark, path, schema, [f"{DATE}={first}"])
        counts = day.agg(F.count_if(F.col(at) >= cutoff).alias("kept"), F.count_if(F.col(at) < cutoff).alias("old")).first()
        if not counts.old:
            fate[first] = "kept"
        elif not counts.kept:
            fate[first] = "dropped"
            gone.append(f"{DATE}={first}")
        else:  # its partitions without a row left would not be replaced: the day goes first and comes back
            rows = day.filter(F.col(at) >= cutoff)
            left = rows.select(*(by or [])).distinct().count() if by else 1
            if by and left < day.select(*by).distinct().count():
                keep = {"/".join([f"{DATE}={first}", *r]) for r in _value_paths(rows, by)}
                gone += sorted({"/".join([f"{DATE}={first}", *r]) for r in _value_paths(day, by)} - keep)
    if rows is not None or gone:
        _journalled(spark, path, rows, [DATE, *(by or [])], gone)
    return fate


def _value_paths(df: DataFrame, by: list[str]) -> list[list[str]]:
    """Folder names of the partition values in ``df``: one day's, a bounded number."""
    text = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return [[f"{c}={v}" for c, v in zip(by, r)] for r in df.select(*[text(c) for c in by]).distinct().toLocalIterator()]
