"""Structured Streaming jobs around the shared operators."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from eventwarden import policies as P
from eventwarden.operators import enrich as E, report as R
from eventwarden.schemas import RUN_REPORT
from eventwarden.sinks import tables as K
from eventwarden.sources import events as SRC

REPORT_METRICS = "run_report"


def curated_stream(decoded: DataFrame, processing: Column | None = None) -> DataFrame:
    """The per-row chain on a stream: stateless, so no late row is ever dropped."""
    return E.curate(decoded, processing)


def observe_report(flagged: DataFrame, error: Column | None = None,
                   name: str = REPORT_METRICS) -> DataFrame:
    """Collect the run report's measures on the side while the stream is written."""
    return flagged.observe(name, *R.report_measures(error))


def _trigger(writer, every: str | None):
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def start_curated(flagged: DataFrame, path: str, checkpoint: str,
                  every: str | None = P.CURATED_TRIGGER) -> StreamingQuery:
    """Append to Parquet by country and plan; ``every=None`` drains what is there and stops.

    Each micro-batch is a folder of its own, rebalanced before it is written: the file sink would leave a file for each
    country, plan and task at every trigger.  ``sinks.maintenance.fold_batches`` merges the folders.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        K.write_curated_batch(batch, batch_id, path)

    return start_batches(flagged, handle, checkpoint, every)


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                  every: str | None = P.WAREHOUSE_TRIGGER) -> StreamingQuery:
    """Hand every micro-batch to ``handle``."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def batch_outputs(table: str, late: str | None = None, reports: str | None = None,
                  by: list[str] | None = None, windows: str | None = None) -> Callable[[DataFrame, int], None]:
    """A handler writing on-time rows, late rows, the batch's run report and its windows' reports.

    Each output goes to a folder named after the batch, so a replay after a
    failure replaces rather than repeats.  The batch feeds several outputs and
    is therefore persisted for their duration.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            on_time = batch if late is None else batch.filter(~F.col("is_late_arrival"))
            K.write_batch(on_time, batch_id, table)
            if late is not None:
                K.write_batch(batch.filter("is_late_arrival"), batch_id, late)
            if reports is not None:
                K.write_batch(R.run_report(batch, by), batch_id, reports)
            if windows is not None:
                K.write_batch(R.windowed_report(batch), batch_id, windows)
        finally:
            batch.unpersist()
    return handle


def windowed_report_stream(flagged: DataFrame, width: str = P.REPORT_WINDOW,
                           delay: str = P.WATERMARK_DELAY) -> DataFrame:
    """Run report per event-time window; a window is emitted once the watermark passes it.

    Rows behind the watermark are not in it.  For windows over all rows, write each batch's
    part with ``batch_outputs(windows=...)`` and add them up with :func:`merge_windows`.
    """
    return R.windowed_report(flagged.withWatermark("event_timestamp", delay), width)


def deduplicate_stream(flagged: DataFrame, keys: list[str],
                       delay: str = P.WATERMARK_DELAY, spread: Column | None = None) -> DataFrame:
    """First delivery of each key; state is kept for the watermark delay only.

    Deduplication cannot combine before its shuffle.  ``spread`` takes apart a
    key that is delivered very often: copies are first dropped within (key,
    spread), then within the key.
    """
    marked = flagged.withWatermark("event_timestamp", delay)
    if spread is not None:
        marked = (marked.withColumn("_spread", spread)
                  .dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread"))
    return marked.dropDuplicatesWithinWatermark(keys)


def drop_batch_duplicates(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Unique keys inside one micro-batch; copies collapse in the task that reads them."""
    return batch.dropDuplicates(keys)


def merge_reports(reports: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Partial reports of several micro-batches as one report per run."""
    total = lambda c: F.sum(c).alias(c)
    return reports.groupBy(*(["run_id"] if by is None else by)).agg(
        total("total_records"), total("late_records"), total("dq_failures"), total("dq_unknown"),
        total("schema_drift_count"), F.bool_or("schema_drift_detected").alias("schema_drift_detected"),
        total("processing_errors"), F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"), F.first("watermark_delay").alias("watermark_delay"))


def merge_windows(parts: DataFrame) -> DataFrame:
    """The windows' parts of several micro-batches as one report per window, late rows included."""
    counts = [c for c in parts.columns if c not in ("window_start", "window_end", "batch_id")]
    return parts.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in counts])


def ingest(raw: DataFrame, path: str, checkpoint: str, seconds: float, codec: str = "json",
           processing: Column | None = None, every: str | None = P.CURATED_TRIGGER,
           reports: str | None = None) -> DataFrame:
    """The whole job: decode, enrich, flag, write for ``seconds``, and report.

    Readable and corrupt records are written alike: a corrupt one carries its
    text and counts as a processing error of the batch it came in.  The reports
    are also appended to ``reports``, after a failure too.
    """
    spark = raw.sparkSession
    decoded = SRC.decode(raw, codec)
    error = F.col(SRC.CORRUPT).isNotNull() if SRC.CORRUPT in decoded.columns else None
    metrics = RunMetrics()
    spark.streams.addListener(metrics)
    try:
        query = start_curated(observe_report(curated_stream(decoded, processing), error),
                              path, checkpoint, every)
        metrics.only(query)
        try:
            run_bounded(query, seconds)
        finally:
            metrics.wait()
            if reports is not None:
                K.append_log(metrics.reports(spark), reports)
    finally:
        spark.streams.removeListener(metrics)
    return metrics.reports(spark)


def run_bounded(query: StreamingQuery, seconds: float) -> bool:
    """Wait up to ``seconds``, stop the query, and say whether it had ended by itself.

    A failed query raises here; :class:`RunMetrics` has counted the failure.
    """
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def _added(a: dict, b: dict) -> dict:
    """The measures of two micro-batches as those of one."""
    out = {}
    for name, x in a.items():
        y = b[name]
        both = [v for v in (x, y) if v is not None]
        if isinstance(x, bool) or isinstance(y, bool):
            out[name] = bool(x) or bool(y)
        elif name == "start_time":
            out[name] = min(both, default=None)
        elif name == "end_time":
            out[name] = max(both, default=None)
        elif isinstance(x, int):
            out[name] = x + y
        else:
            out[name] = x if x is not None else y
    return out


class RunMetrics(StreamingQueryListener):
    """Per-batch measures and failures of the queries of a session, or of one of them.

    Register with ``spark.streams.addListener``; holds one small record for each
    of the last ``keep`` micro-batches until :meth:`reports` turns them into
    run-report rows.  Earlier ones are added up into one record per query run, so
    a stream may live for any time.  After :meth:`only`, the other queries of the
    session do not count.
    """

    def __init__(self, name: str = REPORT_METRICS, keep: int = 1_000) -> None:
        self.name = name
        self.keep = keep
        self.run: str | None = None
        self._batches: list[tuple[str, int, dict]] = []
        self._ends: list[tuple[str, bool]] = []

    def only(self, query: StreamingQuery) -> None:
        """Count this run of this query alone."""
        self.run = str(query.runId)

    def _counts(self, run: str) -> bool:
        return self.run is None or run == self.run

    @property
    def batches(self) -> list[tuple[int, dict]]:
        return [(batch_id, m) for run, batch_id, m in self._batches if self._counts(run)]

    @property
    def errors(self) -> int:
        return sum(failed for run, failed in self._ends if self._counts(run))

    @property
    def finished(self) -> int:
        return sum(self._counts(run) for run, _ in self._ends)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and row["total_records"]:
            self._batches.append((str(event.progress.runId), event.progress.batchId, row.asDict()))
            self._merge_old()

    def _merge_old(self) -> None:
        """Add the oldest record to the one before it of the same query run, once there are too many."""
        if len(self._batches) <= self.keep + len({run for run, _, _ in self._batches}):
            return
        for i, (run, batch_id, m) in enumerate(self._batches):
            before = [j for j in range(i) if self._batches[j][0] == run]
            if before:
                self._batches[before[0]] = (run, batch_id, _added(self._batches[before[0]][2], m))
                del self._batches[i]
                return

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ends.append((str(event.runId), event.exception is not None))

    def wait(self, finished: int = 1, seconds: float = 30) -> bool:
        """Listener events arrive asynchronously; wait for the end of ``finished`` queries."""
        until = time.monotonic() + seconds
        while self.finished < finished and time.monotonic() < until:
            time.sleep(0.05)
        return self.finished >= finished

    def reports(self, spark: SparkSession) -> DataFrame:
        """One report row per micro-batch; the query failures go on the last one.

        A failure before any batch is a row of its own, without records.
        """
        batches, errors = self.batches, self.errors
        if errors and not batches:
            batches = [(0, {f.name: 0 if isinstance(f.dataType, T.LongType) else None for f in RUN_REPORT})]
        rows = []
        for i, (batch_id, m) in enumerate(batches):
            failed = errors if i == len(batches) - 1 else 0
            rows.append({**m, "run_id": batch_id, "processing_errors": m["processing_errors"] + failed})
        return spark.createDataFrame(
            [tuple(r[f] for f in RUN_REPORT.fieldNames()) for r in rows], RUN_REPORT)
