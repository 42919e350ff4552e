"""Exact stream state on tables: keys ever seen, and window reports with corrections.

State inside a stateful operator ends at the watermark: rows behind it are dropped, so the answer depends on how
the input was cut into micro-batches.  Here the state is a table beside the stream, and every row counts, however
late.

Keys.  A batch is first reduced to its distinct keys.  A key belongs to a page of its event day, a bitmap of 32,768 bits
(a Bloom filter with its own three bits per key).  Keys with a bit unset are surely new; only the others
are compared with the stored keys of their days, exactly.  So an ordinary batch reads the bitmaps of the pages it
touches and no stored key.  The day is part of a key's identity: deliveries of one event carry one event time.

Windows.  Each batch adds its part of every window, marked as a correction where the watermark had already
passed the window's end.  A window's report is the sum of its parts; readers that acted on a closed window see
which parts came after.

Both survive a replay: a batch only looks at the state of the batches before it, its outputs are folders named after
the batch, and repeated state rows change nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventwarden import policies as P
from eventwarden.operators import report as R, sketches as SK
from eventwarden.schemas import LONG, TS, struct
from eventwarden.sinks import tables as K

PAGE_BITS = 32_768
HASHES = 3
#: Pages of an event day.  A page serves about 3,000 keys before unset bits become rare; more keys than that
#: cost exact comparisons, never a wrong answer.
PAGES = 1_024
UNDATED = "undated"


def _day(at: str) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(UNDATED))


class KeyHistory:
    """The keys a stream has seen, under ``path``: stored keys and bitmaps by event day."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], at: str = "event_timestamp",
                 pages: int = PAGES) -> None:
        """``keys``: column names and their SQL types; ``at``: the column of the event time."""
        self.spark, self.names, self.at, self.pages = spark, list(keys), at, pages
        self.key_path, self.page_path, self.held_path = (f"{path.rstrip('/')}/{n}" for n in ("keys", "pages", "held"))
        kinds = ", ".join(f"`{n}` {kind}" for n, kind in keys.items())
        self.key_schema = f"{kinds}, batch_id bigint, day string"
        self.page_schema = "page int, bits binary, batch_id bigint, day string"
        for schema, place in ((self.key_schema, self.key_path), (self.page_schema, self.page_path)):
            # an empty append makes the folder that the first batch reads
            spark.createDataFrame([], schema).write.mode("append").partitionBy("day").parquet(place)

    def _marked(self, df: DataFrame) -> DataFrame:
        hashed = lambda i: F.xxhash64(*self.names, F.lit(i))
        return df.withColumns({
            "_day": _day(self.at),
            "_page": F.pmod(hashed(0), F.lit(self.pages)).cast("int"),
            "_bits": F.array(*[F.pmod(hashed(i + 1), F.lit(PAGE_BITS)) for i in range(HASHES)]),
        })

    def _pages_before(self, batch_id: int, touched: DataFrame, days: list[str]) -> DataFrame:
        """The bitmaps of the touched pages, one row each, as of before the batch."""
        stored = self.spark.read.schema(self.page_schema).parquet(self.page_path)
        stored = stored.filter((F.col("batch_id") < batch_id) & F.col("day").isin(days))
        wanted = touched.select(F.col("_day").alias("day"), F.col("_page").alias("page")).distinct()
        return (stored.join(wanted, ["day", "page"], "left_semi").groupBy("day", "page")
                .agg(F.bitmap_or_agg("bits").alias("_known")))

    def _keys_before(self, batch_id: int, days: list[str]) -> DataFrame:
        stored = self.spark.read.schema(self.key_schema).parquet(self.key_path)
        return (stored.filter((F.col("batch_id") < batch_id) & F.col("day").isin(days))
                .select(*[F.col(n).alias(f"_k_{n}") for n in self.names], F.col("day").alias("_k_day")))

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """One row for each key of the batch that no earlier batch had.

        A table that holds until :meth:`release` or the next batch.  The distinct keys are written, not cached: a
        cached plan keeps every partition of its shuffles, however few the rows, and so does all that reads it.
        """
        self.release()
        # the day comes last: rows are sorted by their first key's leading bytes, which days share
        once = self._held(self._marked(batch).dropDuplicates([*self.names, "_day"]), "once")
        known = self._pages_before(batch_id, once, _values(once, "_day"))
        on = [F.col("_day") == F.col("day"), F.col("_page") == F.col("page")]
        byte = lambda b: F.conv(F.hex(F.substring("_known", (b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.forall("_bits", lambda b: F.getbit(byte(b), (b % 8).cast("int")) == 1)
        tested = once.join(known, on, "left").withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("day", "page", "_known")
        maybe = tested.filter("_maybe")
        stored = self._keys_before(batch_id, _values(maybe, "_day"))
        same = [F.col("_day") == F.col("_k_day"), *[F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in self.names]]
        new = tested.filter(~F.col("_maybe")).unionByName(maybe.join(stored, same, "left_anti"))
        return self._held(new.select(*batch.columns), "unseen")

    def _held(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.held_path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        K.remove(self.spark, self.held_path)

    def remember(self, unseen: DataFrame, batch_id: int) -> None:
        """Store the keys and their bits.  Stored twice after a failure, they say the same."""
        marked = self._marked(unseen)
        rows = marked.select(*self.names, F.lit(batch_id).cast("bigint").alias("batch_id"), F.col("_day").alias("day"))
        K.append_rebalanced(rows, self.key_path, ["day"])
        bits = (marked.select(F.col("_day").alias("day"), F.col("_page").alias("page"), F.explode("_bits").alias("bit"))
                .groupBy("day", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))
                .select("page", "bits", F.lit(batch_id).cast("bigint").alias("batch_id"), "day"))
        K.append_rebalanced(bits, self.page_path, ["day"])


def _values(df: DataFrame, column: str) -> list[str]:
    """The distinct days of a batch: a handful, whatever its size."""
    return df.agg(F.collect_set(column)).first()[0]


class WindowHistory:
    """Window reports of a stream under ``path``: a part per batch and window, and the stream's progress."""

    def __init__(self, spark: SparkSession, path: str, width: str = P.REPORT_WINDOW, delay: str = P.WATERMARK_DELAY) -> None:
        self.spark, self.width, self.delay = spark, width, delay
        self.part_path, self.clock_path = f"{path.rstrip('/')}/windows", f"{path.rstrip('/')}/progress"
        self.clock_schema = struct(("newest", TS), ("batch_id", LONG))
        spark.createDataFrame([], self.clock_schema).write.mode("append").partitionBy("batch_id").parquet(self.clock_path)

    def watermark(self, before: int | None = None):
        """The newest event time of the batches before ``before`` (of all batches), less the delay; null at the start."""
        seen = self.spark.read.schema(self.clock_schema).parquet(self.clock_path)
        if before is not None:
            seen = seen.filter(F.col("batch_id") < before)
        return seen.agg((F.max("newest") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first().w

    def add(self, batch: DataFrame, batch_id: int) -> None:
        mark = F.lit(self.watermark(batch_id)).cast("timestamp")
        parts = R.windowed_report(batch, self.width)
        late = F.coalesce(F.col("window_end") <= mark, F.lit(False))
        K.write_batch(parts.withColumn("correction", late), batch_id, self.part_path)
        K.write_batch(batch.agg(F.max("event_timestamp").alias("newest")), batch_id, self.clock_path)

    def reports(self) -> DataFrame:
        """Every window over all rows, with what came after its end: ``corrections`` and ``corrected_records``."""
        parts = self.spark.read.parquet(self.part_path)
        counts = [c for c in parts.columns if c not in ("window_start", "window_end", "batch_id", "correction")]
        closed = F.lit(self.watermark()).cast("timestamp") >= F.col("window_end")
        return (parts.groupBy("window_start", "window_end")
                .agg(*[F.sum(c).alias(c) for c in counts], F.count_if("correction").alias("corrections"),
                     F.coalesce(F.sum(F.when(F.col("correction"), F.col("total_records"))), F.lit(0)).alias("corrected_records"))
                .withColumn("closed", F.coalesce(closed, F.lit(False))))


def complete_outputs(history: KeyHistory | None = None, windows: WindowHistory | None = None, table: str | None = None,
                     late: str | None = None, sketches: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler: first deliveries to ``table``, those behind the watermark to ``late``, windows corrected.

    ``sketches``: also the runs' distinct counts and quantiles, as sketches to be merged over the batches.

    Without a history all rows are written; without ``late`` all rows go to ``table``.  Windows count first
    deliveries.  State is stored last, so a batch that fails on the way is repeated as a whole.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if history is None:
            batch.persist()
        try:
            if batch.isEmpty():
                return
            first = batch if history is None else history.unseen(batch, batch_id)
            if table is not None:
                mark = windows.watermark(batch_id) if windows is not None and late is not None else None
                behind = F.coalesce(F.col("event_timestamp") < F.lit(mark).cast("timestamp"), F.lit(False))
                K.write_batch(first.filter(~behind), batch_id, table)
                if late is not None:
                    K.write_batch(first.filter(behind), batch_id, late)
            if sketches is not None:
                K.write_batch(SK.run_sketches(first, ["run_id"]), batch_id, sketches)
            if windows is not None:
                windows.add(first, batch_id)
            if history is not None:
                history.remember(first, batch_id)
        finally:
            if history is None:
                batch.unpersist()
            else:
                history.release()
    return handle
