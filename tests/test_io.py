"""Sources and sinks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventwarden import schemas as S
from eventwarden.operators import report as R
from eventwarden.session import build_session, stage_table, work_folder
from eventwarden.sinks import tables as K
from eventwarden.sources import documents as DOC, events as SRC

from conftest import rows

T0 = datetime(2024, 1, 15, 12)
ENVELOPE = "key binary, value binary, timestamp timestamp, offset long, partition int"
GOOD = {"id": "c1", "email": "a@b.co", "signup_ts": 1, "event_ts": 2, "version": 2, "plan": "free",
        "marketing_opt_in": True, "unknown": 1}


def envelope(spark, *values):
    data = [(b"k", v.encode() if isinstance(v, str) else v, T0, i, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(data, ENVELOPE)


def test_decode(spark):
    r = SRC.decode(envelope(spark, json.dumps(GOOD))).first()
    assert (r.kafka_key, r.kafka_offset, r.id, r.version, r.marketing_opt_in, r.name) == ("k", 0, "c1", 2, True, None)
    assert r[SRC.CORRUPT] is None
    assert SRC.decode(envelope(spark)).columns == [*SRC.ENVELOPE, *S.CUSTOMER_EVENT.fieldNames(), SRC.CORRUPT]


def test_corrupt_side_output(spark):
    typed = json.dumps({**GOOD, "version": "two"})
    good, bad = SRC.decode_split(envelope(spark, json.dumps(GOOD), "{broken", typed, b"\x00\x01", None))
    assert rows(good.select("kafka_offset", "id")) == [(0, "c1"), (4, None)]
    assert good.columns == [*SRC.ENVELOPE, *S.CUSTOMER_EVENT.fieldNames()]
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert rows(bad.select("kafka_offset", "id")) == [(1, None), (2, "c1"), (3, None)]


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        SRC.decode(envelope(spark), "xml")


def test_avro_schema_follows_the_contract():
    fields = {f["name"]: f["type"] for f in json.loads(S.avro_schema())["fields"]}
    assert fields["event_ts"] == "long" and fields["version"] == "int"
    assert fields["customer_segment"] == ["null", "string"]
    assert fields["plan"]["type"] == "enum" and fields["plan"]["symbols"] == ["free", "basic", "premium", "enterprise"]
    assert list(fields) == S.CUSTOMER_EVENT.fieldNames()


def test_offset_audit(spark):
    df = SRC.decode(envelope(spark, *["{}"] * 10)).filter("kafka_offset NOT IN (3, 4)")
    r = R.offset_audit(df).first()
    assert (r.min_offset, r.max_offset, r.messages, r.missing_offsets) == (0, 9, 8, 2)


def test_documents(spark, tmp_path):
    (tmp_path / "report.json").write_text(json.dumps(
        {"run_id": 1, "total_records": 10, "schema_drift_detected": True, "start_time": "2024-01-15T10:00:00"},
        indent=2), encoding="utf-8")
    r = DOC.run_reports(spark, str(tmp_path / "report.json")).first()
    assert (r.total_records, r.schema_drift_detected, r.start_time) == (10, True, datetime(2024, 1, 15, 10))
    (tmp_path / "dq.json").write_text(json.dumps(
        {"run_id": 1, "status": "success", "summary": {"total_expectations": 15, "success_count": 14,
         "failure_count": 1, "overall_success_rate": 0.9333}}, indent=2), encoding="utf-8")
    r = DOC.quality_documents(spark, str(tmp_path / "dq.json")).first()
    assert (r.evaluated_expectations, r.unsuccessful_expectations, r.overall_success_rate) == (15, 1, 0.9333)


def test_missing_documents_are_empty(spark, tmp_path):
    assert DOC.run_reports(spark, str(tmp_path / "nothing.json")).count() == 0
    assert DOC.quality_documents(spark, str(tmp_path / "nothing.json")).count() == 0


def test_incident_lines_keep_their_context(spark, tmp_path):
    (tmp_path / "incidents.jsonl").write_text(json.dumps(
        {"id": "1", "incident_type": "t", "context": {"a": {"b": 1}}, "created_at": "2024-01-15T12:00:00",
         "escalated": False}) + "\n", encoding="utf-8")
    r = DOC.incident_lines(spark, str(tmp_path)).first()
    assert json.loads(r.context) == {"a": {"b": 1}} and r.created_at == T0


def test_load_validation(spark, tmp_path):
    path = str(tmp_path / "out")
    assert DOC.load_validation(spark, path).first().status == "no_output_directory"
    (tmp_path / "out").mkdir()
    empty = DOC.load_validation(spark, path).first()
    assert (empty.status, empty.file_count) == ("no_data", 0)
    df = spark.createDataFrame([(1, "US", "free"), (2, None, ""), (3, "", None)], "id int, country string, plan string")
    K.write_curated(df, path)
    r = DOC.load_validation(spark, path).first()
    assert r.status == "success" and r.file_count >= 2 and r.newest_bytes > 0 and r.total_bytes >= r.newest_bytes
    assert r.newest_file.endswith(".parquet")
    back = SRC.curated_table(spark, path, df.schema)
    assert rows(back.select("id", "country", "plan")) == [(1, "US", "free"), (2, None, None), (3, None, None)]


def test_load_validation_opens_no_file(spark, tmp_path):
    K.append_log(spark.range(3), str(tmp_path / "t"), "parquet")
    plan = DOC.load_validation(spark, str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_logs_append_and_documents_replace(spark, tmp_path):
    log, doc = str(tmp_path / "log"), str(tmp_path / "doc")
    for _ in range(2):
        K.append_log(spark.range(2), log)
        K.write_document(spark.range(2), doc)
    assert spark.read.json(log).count() == 4 and spark.read.json(doc).count() == 2


def test_quarantine_sink(spark, tmp_path):
    path = str(tmp_path / "q")
    held = spark.createDataFrame([(1, "a"), (2, "b")], "id int, why string")
    K.write_quarantine(held, path, "bad", F.lit(T0), "src", "id > 0")
    K.write_quarantine(held, path, F.col("why"), F.lit(T0), "src", "id > 0")
    back = spark.read.parquet(path)
    assert rows(back.groupBy("reason").count()) == [("a", 1), ("b", 1), ("bad", 2)]
    assert back.select("quarantine_ts", "source_path", "filter_condition").distinct().collect()[0][:] == (
        "20240115_120000", "src", "id > 0")


def test_batch_replay_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_batch(spark.range(5), 0, path)
    K.write_batch(spark.range(5), 0, path)
    K.write_batch(spark.range(3), 1, path)
    assert rows(spark.read.parquet(path).groupBy("batch_id").count()) == [(0, 5), (1, 3)]


def test_warehouse_options():
    full = {k: "x" for k in K.WAREHOUSE_OPTIONS}
    assert K.warehouse_options(full) == full
    with pytest.raises(ValueError, match="sfPassword"):
        K.warehouse_options({**full, "sfPassword": ""})


def test_warehouse_writer_skips_empty_batches(spark, tmp_path):
    path = str(tmp_path / "w")
    write = K.warehouse_writer("parquet", {"path": path})
    write(spark.range(0), 0)
    assert not (tmp_path / "w").exists()
    write(spark.range(2), 7)
    assert rows(spark.read.parquet(path).select("id", "batch_id")) == [(0, 7), (1, 7)]


def test_work_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b and a.startswith(root)


def test_stage_table(spark):
    staged = stage_table(spark.range(3).withColumn("t", F.lit(T0)), "x")
    assert rows(staged) == [(0, T0), (1, T0), (2, T0)]


def test_session_is_pinned(spark):
    assert build_session() is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_documents_without_a_run(spark, tmp_path):
    (tmp_path / "report.json").write_text('{"total_records": 5}')
    (tmp_path / "quality.json").write_text('{"status": "passed", "summary": {"total_expectations": 3}}')
    report = DOC.run_reports(spark, str(tmp_path / "report.json"), run_id=7)
    quality = DOC.quality_documents(spark, str(tmp_path / "quality.json"), run_id=7)
    assert [r.total_records for r in report.join(quality, "run_id").collect()] == [5]


def test_binary_records_that_cannot_be_read_go_aside(spark, monkeypatch):
    """The connector's decoder gives null for what it cannot read; its place is taken by JSON here."""
    record = "CASE WHEN value IS NOT NULL AND cast(value AS string) LIKE '{%' THEN from_json(cast(value AS string), 'id STRING, version INT') END"
    monkeypatch.setattr(SRC, "_payload", lambda codec, schema: F.expr(record))
    raw = envelope(spark, '{"id": "a", "version": 1}', "no record", '{"id": "b"}', "")
    raw = raw.unionByName(raw.limit(1).withColumn("value", F.lit(None).cast("binary")))
    good, bad = SRC.decode_split(raw, codec="avro")
    assert sorted(r.id for r in good.collect()) == ["a", "b"]
    assert sorted(r[SRC.CORRUPT] for r in bad.collect()) == ["", "bm8gcmVjb3Jk"]  # a record without a body is on neither side


def test_declared_rules_name_the_columns_of_the_curated_table():
    from eventwarden.sources import documents as DOC
    groups = DOC.declared_rules()
    assert {g: len(r) for g, r in groups.items()} == {"expectations": 1, "customer_data_quality": 10, "data_freshness": 1}
    assert groups["data_freshness"][0].kwargs["column"] == "event_timestamp"
    pair = groups["customer_data_quality"][-1].kwargs
    assert (pair["column_A"], pair["column_B"], pair["or_equal"]) == ("event_timestamp", "signup_timestamp", True)
    assert DOC.declared_rules({})["data_freshness"][0].kwargs["column"] == "event_ts"
