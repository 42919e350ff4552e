"""Retention and compaction: rows stay as they are, only what has to be is rewritten, and a broken call is made up for."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden.operators import report as R
from eventwarden.sinks import maintenance as M, tables as K

from conftest import rows

START = datetime(2024, 1, 20)


@pytest.fixture
def events(spark):
    made = [(i, START + timedelta(hours=i * 5) if i % 17 else None, "US" if i % 3 else None, f"0{i % 2}") for i in range(60)]
    return M.dated(spark.createDataFrame(made, "event_id long, event_timestamp timestamp, country string, plan string"))


def load(events, path, by, parts=3):
    for part in range(parts):
        K.append_rebalanced(events.filter(F.col("event_id") % parts == part), path, by)


def read(spark, path, events):
    return spark.read.schema(events.schema).parquet(path).select(*events.columns)


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_compaction_rewrites_only_crowded_partitions(spark, events, tmp_path):
    path = str(tmp_path / "t")
    load(events, path, [M.DATE])
    K.append_rebalanced(events.filter("event_id = 1").withColumn(M.DATE, F.lit("2024-03-01")), path, [M.DATE])
    alone = [f for f in files(path) if "2024-03-01" in f]
    before = rows(read(spark, path, events))
    names = M.compact(spark, path, events.schema, [M.DATE], min_files=2)
    assert rows(read(spark, path, events)) == before
    assert [f for f in files(path) if "2024-03-01" in f] == alone and "event_date=2024-03-01" not in names
    counts = {r.folder: r.files for r in M.table_files(spark, path, [M.DATE]).collect()}
    assert set(counts.values()) == {1} and "event_date=undated" in counts
    assert M.compact(spark, path, events.schema, [M.DATE], min_files=2) == []


def test_compaction_of_a_few_partitions_at_a_time(spark, events, tmp_path):
    path = str(tmp_path / "t")
    load(events, path, [M.DATE, "plan"])
    before, calls = rows(read(spark, path, events)), 0
    while names := M.compact(spark, path, events.schema, [M.DATE, "plan"], min_files=2, most=5):
        assert len(names) <= 5
        calls += 1
    assert calls > 1 and rows(read(spark, path, events)) == before  # plan values such as 01 stay text


def test_large_files_are_let_alone(spark, events, tmp_path):
    path = str(tmp_path / "t")
    load(events, path, [M.DATE])
    assert M.compact(spark, path, events.schema, [M.DATE], min_files=2, target_bytes=4) == []


class Died(Exception):
    pass


@pytest.mark.parametrize("call", [0, 1, 2, 3])
def test_a_compaction_that_dies_is_finished_by_the_next(spark, events, tmp_path, monkeypatch, call):
    """Dying before the journal's mark changes nothing; dying after it, at any step, loses and doubles nothing."""
    path = str(tmp_path / "t")
    load(events, path, [M.DATE])
    before, steps = rows(read(spark, path, events)), [0]

    def dying(name):
        whole = getattr(M, name)

        def step(*args):
            if args[1].endswith(M.JOURNAL) and not M.exists(spark, args[1]):
                return whole(*args)  # nothing there to remove yet
            if steps[0] == call:
                raise Died
            steps[0] += 1
            return whole(*args)
        return step

    with monkeypatch.context() as patch:
        for name in ("finish", "_replace", "remove"):
            patch.setattr(M, name, dying(name))
        try:
            M.compact(spark, path, events.schema, [M.DATE], min_files=2)
        except Died:
            pass
    M.finish(spark, path)
    assert rows(read(spark, path, events)) == before
    M.compact(spark, path, events.schema, [M.DATE], min_files=2)
    assert rows(read(spark, path, events)) == before and not M.exists(spark, f"{path}/{M.JOURNAL}")


def batches(events, path, n, by=("country",)):
    for i in range(n):
        K.append_rebalanced(events.filter(F.col("event_id") % n == i).withColumn("batch_id", F.lit(i).cast("bigint")), path, ["batch_id", *by])


def test_batch_folders_of_like_size_are_folded(spark, events, tmp_path):
    path, batched = str(tmp_path / "t"), events.withColumn("batch_id", F.lit(0).cast("bigint"))
    batches(events, path, 10)
    before = rows(read(spark, path, events))
    gone = M.fold_batches(spark, path, batched.schema, ["country"], below=9, fan=8)
    assert len(gone) >= 7 and 9 not in gone
    assert rows(read(spark, path, events)) == before
    left = M.folders(spark, path)
    assert len(left) == 10 - len(gone) and "batch_id=9" in left
    assert M.fold_batches(spark, path, batched.schema, ["country"], below=9, fan=8) == []


def test_folding_that_dies_between_write_and_delete(spark, events, tmp_path, monkeypatch):
    path, batched = str(tmp_path / "t"), events.withColumn("batch_id", F.lit(0).cast("bigint"))
    batches(events, path, 9)
    before, whole = rows(read(spark, path, events)), M.remove

    def dying(spark_, place):
        if "batch_id=" in place:
            raise Died
        whole(spark_, place)
    with monkeypatch.context() as patch, pytest.raises(Died):
        patch.setattr(M, "remove", dying)
        M.fold_batches(spark, path, batched.schema, ["country"], below=9, fan=8)
    assert read(spark, path, events).count() > len(before)  # written and not yet dropped
    assert M.finish(spark, path)
    assert rows(read(spark, path, events)) == before


@pytest.mark.parametrize("by", [None, ["plan"], ["country", "plan"]])
@pytest.mark.parametrize("as_of", [datetime(2024, 2, 4, 10, 30), datetime(2024, 2, 4), datetime(2024, 2, 4, 23, 59), datetime(2030, 1, 1), datetime(2020, 1, 1)])
def test_retention_deletes_exactly_the_old_rows(spark, events, tmp_path, by, as_of):
    path = str(tmp_path / "t")
    M.write_dated(events.drop(M.DATE), path, partitions=by)
    cutoff = as_of - timedelta(days=7)
    want = [r for r in rows(events) if r[1] is None or r[1] >= cutoff]
    day = cutoff.strftime("%Y-%m-%d")
    kept = [f for f in files(path) if f.split("=")[1][:10] > day]
    for again in range(2):
        fate = M.expire(spark, path, events.schema, F.lit(as_of), by)
        assert sorted(map(str, rows(read(spark, path, events)))) == sorted(map(str, want))
        assert [f for f in files(path) if f.split("=")[1][:10] > day] == kept  # later days are not touched
        assert not again or "dropped" not in fate.values()


def test_a_checkpoint_is_never_expired(spark, tmp_path):
    for name in ("offsets", "event_date=2020-01-01"):
        (tmp_path / "c" / name).mkdir(parents=True)
    with pytest.raises(ValueError, match="checkpoint"):
        M.expire(spark, str(tmp_path / "c"), spark.range(1).schema, F.current_timestamp())
    assert (tmp_path / "c" / "event_date=2020-01-01").exists()


def test_a_load_of_some_days_replaces_these_days(spark, events, tmp_path):
    path = str(tmp_path / "t")
    M.write_dated(events.drop(M.DATE), path)
    again = events.filter("event_date = '2024-01-22' AND event_id % 2 = 0")
    M.write_dated(again.drop(M.DATE), path)
    want = [r for r in rows(events) if r[4] != "2024-01-22"] + rows(again)
    assert sorted(map(str, rows(read(spark, path, events)))) == sorted(map(str, want))


def test_a_repeat_does_not_hide_a_loss(spark):
    seen = spark.createDataFrame([(0, n) for n in (0, 1, 1, 3)] + [(1, 5), (2, 7), (2, 7)], "kafka_partition int, kafka_offset long")
    got = {r.kafka_partition: (r.messages, r.redelivered, r.missing_offsets) for r in R.offset_audit(seen).collect()}
    assert got == {0: (4, 1, 1), 1: (1, 0, 0), 2: (2, 1, 0)}
    assert rows(R.offset_gaps(seen)) == [(0, 2, 2, 1)]
