"""Streams over several micro-batches give what the batch job gives."""

import json
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventwarden.operators import enrich as E, report as R
from eventwarden.plans import fixture as FX
from eventwarden.plans.remediation import TABLES, remediate
from eventwarden.sources import events as SRC
from eventwarden.streaming import jobs as J

from conftest import rows

WIRE = "key binary, value binary, timestamp timestamp, offset bigint, partition int, event_id bigint, run_id bigint"


@pytest.fixture(scope="module")
def wire_folder(spark, sf_dir, tmp_path_factory):
    """The wire form as three files, in event order."""
    path = str(tmp_path_factory.mktemp("wire"))
    raw = FX.raw_events(spark, sf_dir).orderBy("event_id")
    for lo, hi in ((0, 400), (400, 700), (700, 10**9)):
        raw.filter(F.col("event_id").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(path)
    return path


def wire_stream(spark, folder):
    return SRC.file_stream(spark, folder, spark.read.parquet(folder).schema, "parquet", {"maxFilesPerTrigger": "1"})


def test_stream_equals_batch(spark, wire_folder, tmp_path):
    clock = F.col("kafka_timestamp")
    batch = E.curate(SRC.decode(spark.read.parquet(wire_folder)), clock)
    report = J.ingest(wire_stream(spark, wire_folder), str(tmp_path / "out"), str(tmp_path / "ckpt"), 120,
                      processing=clock, every=None)
    got = spark.read.schema(batch.schema).parquet(str(tmp_path / "out")).select(*batch.columns)
    assert got.count() == 1000
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert report.count() == 3
    want = R.run_report(batch, [], F.col(SRC.CORRUPT).isNotNull()).first()
    total = report.agg(*[F.sum(c).alias(c) for c in (
        "total_records", "late_records", "dq_failures", "dq_unknown", "processing_errors")]).first()
    assert total.asDict() == {c: want[c] for c in total.asDict()}


def flagged_stream(spark, folder):
    return J.curated_stream(SRC.decode(wire_stream(spark, folder), keep=["event_id", "run_id"]),
                            F.col("kafka_timestamp"))


def flagged_batch(spark, folder):
    return E.curate(SRC.decode(spark.read.parquet(folder), keep=["event_id", "run_id"]), F.col("kafka_timestamp"))


def test_batch_outputs_split_and_report(spark, wire_folder, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("table", "late", "reports")}
    J.start_batches(flagged_stream(spark, wire_folder), J.batch_outputs(**paths), str(tmp_path / "ckpt"),
                    every=None).awaitTermination()
    on_time, late = spark.read.parquet(paths["table"]), spark.read.parquet(paths["late"])
    assert on_time.count() + late.count() == 1000
    assert late.count() == flagged_batch(spark, wire_folder).filter("is_late_arrival").count() == 49
    assert on_time.filter("is_late_arrival").count() == 0
    reports = spark.read.parquet(paths["reports"])
    assert reports.count() > 2  # a run is spread over micro-batches
    assert rows(J.merge_reports(reports)) == rows(R.run_report(flagged_batch(spark, wire_folder)))


def test_replayed_batch_changes_nothing(spark, wire_folder, tmp_path):
    handle = J.batch_outputs(str(tmp_path / "t"), reports=str(tmp_path / "r"))
    batch = flagged_batch(spark, wire_folder)
    handle(batch, 4)
    handle(batch, 4)
    handle(batch.filter("false"), 5)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_restart_goes_on_where_it_stopped(spark, wire_folder, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for _ in range(2):
        J.start_curated(flagged_stream(spark, wire_folder), out, ckpt, every=None).awaitTermination()
    assert spark.read.parquet(out).count() == 1000


def events_folder(spark, tmp_path, *batches):
    """JSON files of (id, minutes) events, one file and micro-batch each."""
    path = tmp_path / "in"
    path.mkdir()
    start = datetime(2024, 1, 1)
    for i, batch in enumerate(batches):
        lines = [json.dumps({"id": k, "at": (start + timedelta(minutes=m)).isoformat()}) for k, m in batch]
        (path / f"{i}.json").write_text("\n".join(lines), encoding="utf-8")
        # File streams take files by modification time.
        import os
        os.utime(path / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    return J.curated_stream(
        SRC.file_stream(spark, str(path), "id string, at timestamp", options={"maxFilesPerTrigger": "1"})
        .selectExpr("id", "'a@b.co' AS email", "'free' AS plan", "'US' AS country", "1 AS version",
                    "unix_millis(at) AS event_ts", "unix_millis(at) AS signup_ts"),
        F.timestamp_millis("event_ts"))


def drain(stream, tmp_path):
    out = str(tmp_path / "out")
    (stream.writeStream.format("parquet").outputMode("append").option("path", out)
     .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.parquet(out)


def test_window_waits_for_the_watermark(spark, tmp_path):
    stream = events_folder(spark, tmp_path, [("a", 0), ("b", 4)], [("c", 1), ("d", 19)], [("e", 21)])
    got = drain(J.windowed_report_stream(stream), tmp_path)
    # Watermark ends at 21 - 15 = 6: only the first window is complete, late-but-allowed "c" included.
    assert [(r.window_start, r.total_records) for r in got.collect()] == [(datetime(2024, 1, 1), 3)]


@pytest.mark.parametrize("spread", [None, F])
def test_deduplication_over_batches(spark, tmp_path, spread):
    stream = events_folder(spark, tmp_path, [("a", 0)] * 5 + [("b", 1)], [("a", 2), ("c", 3)], [("c", 3)])
    column = None if spread is None else F.pmod(F.hash("event_ts"), F.lit(4))
    got = drain(J.deduplicate_stream(stream, ["id"], spread=column).select("id"), tmp_path)
    assert rows(got) == [("a",), ("b",), ("c",)]


def test_windows_of_all_rows(spark, wire_folder, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("table", "windows")}
    J.start_batches(flagged_stream(spark, wire_folder), J.batch_outputs(**paths), str(tmp_path / "ckpt"),
                    every=None).awaitTermination()
    got = J.merge_windows(spark.read.parquet(paths["windows"]))
    want = R.windowed_report(flagged_batch(spark, wire_folder)).select(*got.columns)
    assert rows(got) == rows(want)


def test_batch_duplicates(spark):
    assert J.drop_batch_duplicates(spark.createDataFrame([("a",), ("a",)], "id string"), ["id"]).count() == 1


def test_bounded_run_stops(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = SRC.file_stream(spark, str(tmp_path / "in"), "id string")
    query = J.start_batches(stream, lambda b, i: None, str(tmp_path / "ckpt"), every="1 second")
    assert J.run_bounded(query, 2) is False
    assert not query.isActive


def test_failure_is_counted_and_raised(spark, tmp_path):
    stream = events_folder(spark, tmp_path, [("a", 0)])
    metrics = J.RunMetrics()
    spark.streams.addListener(metrics)
    try:
        def broken(batch, batch_id):
            raise RuntimeError("sink is down")
        with pytest.raises(StreamingQueryException):
            J.run_bounded(J.start_batches(stream, broken, str(tmp_path / "ckpt"), every=None), 60)
        assert metrics.wait()
    finally:
        spark.streams.removeListener(metrics)
    assert metrics.errors == 1
    report = metrics.reports(spark).first()
    assert (report.total_records, report.processing_errors) == (0, 1)


def test_failed_run_leaves_a_report_of_its_own(spark, wire_folder, tmp_path):
    other = J.start_batches(flagged_stream(spark, wire_folder), lambda b, i: None, str(tmp_path / "other"), every=None)
    with pytest.raises(StreamingQueryException):
        J.ingest(wire_stream(spark, wire_folder), str(tmp_path / "out"), str(tmp_path / "ckpt"), 60, every=None,
                 processing=F.raise_error(F.lit("no clock")).cast("timestamp"), reports=str(tmp_path / "reports"))
    other.awaitTermination()
    got = spark.read.json(str(tmp_path / "reports")).collect()
    assert [(r.total_records, r.processing_errors) for r in got] == [(0, 1)]


def test_remediation_chain(spark, sf_dir, tmp_path):
    flagged = FX.flagged_events(spark, sf_dir)
    paths = remediate(flagged, str(tmp_path), F.col("processing_timestamp"), F.expr(FX.DECODE_FAILED))
    assert list(paths) == TABLES
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert tables["run_reports"].count() == tables["decisions"].count() == 2
    assert tables["dq_results"].count() == 30
    assert tables["alerts"].count() == 8


def test_remediation_in_parts_and_repeated(spark, sf_dir, tmp_path):
    flagged = FX.flagged_events(spark, sf_dir)
    args = F.col("processing_timestamp"), F.expr(FX.DECODE_FAILED)
    whole = remediate(flagged, str(tmp_path / "whole"), *args)
    for run in (0, 1, 1):
        parts = remediate(flagged.filter(F.col("run_id") == run), str(tmp_path / "parts"), *args, batch_id=run)
    for name in ("run_reports", "dq_results", "decisions", "incident_events", "alerts"):
        a, b = (spark.read.parquet(p[name]).drop("batch_id") for p in (whole, parts))
        assert rows(a.select([F.to_json(F.struct(*a.columns)).alias("r")])) == rows(
            b.select(*a.columns).select([F.to_json(F.struct(*a.columns)).alias("r")])), name


def test_metrics_of_a_long_stream_are_bounded(spark):
    metrics = J.RunMetrics(keep=3)

    def progress(run, batch_id, **measures):
        row = type("Row", (dict,), {"asDict": lambda self: dict(self)})(measures)
        metrics.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(observedMetrics={J.REPORT_METRICS: row}, runId=run, batchId=batch_id)))

    base = dict(late_records=1, dq_failures=2, dq_unknown=0, schema_drift_count=1, processing_errors=0, watermark_delay="15 minutes")
    for i in range(50):
        progress("a" if i % 5 else "b", i, total_records=i + 1, schema_drift_detected=i == 7, start_time=datetime(2024, 1, 1) + timedelta(minutes=i),
                 end_time=datetime(2024, 1, 2) + timedelta(minutes=i), **base)
    assert len(metrics._batches) <= 3 + 2
    got = metrics.reports(spark).agg(F.sum("total_records"), F.sum("late_records"), F.sum("dq_failures"), F.min("start_time"), F.max("end_time"),
                                     F.bool_or("schema_drift_detected")).first()
    assert tuple(got) == (sum(range(1, 51)), 50, 100, datetime(2024, 1, 1), datetime(2024, 1, 2) + timedelta(minutes=49), True)
    assert {run for run, _, _ in metrics._batches} == {"a", "b"}


def test_a_chain_reads_no_incident_older_than_its_look_back(spark, sf_dir, tmp_path):
    from eventwarden.plans.remediation import CHANGE_DATE
    flagged = FX.flagged_events(spark, sf_dir)
    run = lambda batch_id: remediate(flagged, str(tmp_path), F.col("processing_timestamp"), F.expr(FX.DECODE_FAILED), batch_id=batch_id)
    run(0)
    old = tmp_path / "incident_events" / "batch_id=0" / f"{CHANGE_DATE}=2020-01-01"
    old.mkdir()
    (old / "part-0.parquet").write_text("no parquet: whoever reads this fails")
    run(1)
    assert spark.read.parquet(str(tmp_path / "decisions" / "batch_id=1")).count() == 2
