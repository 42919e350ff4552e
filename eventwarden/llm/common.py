"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: White space between words of the whitespace-delimited operators: space and U+0009 to U+000D.
SPACE = "[ \\t-\\r]"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


_recorded: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


@contextmanager
def recorded():
    """The folders that :func:`stage` writes meanwhile, for a caller who knows when they are no longer read."""
    paths: list[str] = []
    token = _recorded.set(paths)
    try:
        yield paths
    finally:
        _recorded.reset(token)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then read the table: their inputs are fixed (row keys given before the
    write stay the same) and a lost executor costs a new read, not a new computation.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    if (paths := _recorded.get()) is not None:
        paths.append(path)
    return table


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system, as readers outside Spark need it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:///", system.makeQualified(place).toString())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(table: DataFrame) -> None:
    """Delete what :func:`stage` wrote for ``table``, which nothing may read afterwards."""
    remove(table.sparkSession, table.staged_path)


def packed(docs: DataFrame, name: str = "doc") -> DataFrame:
    """All columns as one struct, so that an operator's own columns clash with none of them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))


def unpacked(df: DataFrame, docs: DataFrame, name: str = "doc") -> DataFrame:
    """The columns that ``packed`` put together, with their types."""
    return df.select(*[F.col(name).getField(c).alias(c) for c in docs.columns])


def words_of(text: Column) -> Column:
    """The runs of characters between white space; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def strings(column: pa.Array) -> pa.Array:
    """A string column with 64-bit offsets, without nulls (null: empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return column.cast(pa.large_string()).fill_null("")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows, one after the other, and the offset of each row and the end."""
    column = strings(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int):
    """Row ranges of at most ``most`` bytes each, or of one row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end
