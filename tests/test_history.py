"""Exact stream state: any cut into micro-batches, any order and any replay give the batch answer."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden.operators import report as R
from eventwarden.plans import fixture as FX
from eventwarden.streaming import history as H

from conftest import rows

EVENT = ("event_id long, kind string, event_timestamp timestamp, is_late_arrival boolean, dq_passed boolean, "
         "schema_drift_detected boolean")


def deliveries(seed=5, events=120, parts=5):
    """Batches of deliveries out of order; event 0 is a third of all rows, some have no time."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    made = [(i, rng.choice("ab"), None if i % 19 == 7 else start + timedelta(minutes=rng.randrange(4000)), i % 3 == 0,
             rng.choice([True, False, None]), i % 11 == 0) for i in range(events)]
    out = [list() for _ in range(parts)]
    for row in made:
        for _ in range(rng.randint(1, 3)):
            rng.choice(out).append(row)
    for _ in range(events):
        rng.choice(out).append(made[0])
    return made, out


@pytest.mark.parametrize("pages", [1, 64])
@pytest.mark.parametrize("keys", [{"event_id": "bigint"}, {"event_id": "bigint", "kind": "string"}])
def test_keys_are_kept_once_over_batches(spark, tmp_path, pages, keys):
    made, parts = deliveries()
    state = H.KeyHistory(spark, str(tmp_path), keys, pages=pages)
    found = []
    for batch_id, part in enumerate(parts):
        batch = spark.createDataFrame(part, EVENT).repartition(2)
        new = state.unseen(batch, batch_id).persist()
        found += rows(new)
        state.remember(new, batch_id)
        if batch_id in (1, 3):  # a replay sees the state of the batches before it, not its own
            again = state.unseen(batch, batch_id)
            assert rows(again) == rows(new)
            state.remember(again, batch_id)
    assert sorted(map(str, found)) == sorted(map(str, made))


def test_full_bitmaps_cost_comparisons_not_answers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "PAGE_BITS", 8)  # every key looks like a known one
    made, parts = deliveries(seed=8, events=60, parts=3)
    state = H.KeyHistory(spark, str(tmp_path), {"event_id": "bigint"}, pages=1)
    found = []
    for batch_id, part in enumerate(parts):
        new = state.unseen(spark.createDataFrame(part, EVENT), batch_id).persist()
        found += rows(new)
        state.remember(new, batch_id)
    assert sorted(map(str, found)) == sorted(map(str, made))


def test_a_new_key_reads_no_stored_key(spark, tmp_path):
    made, _ = deliveries()
    state = H.KeyHistory(spark, str(tmp_path), {"event_id": "bigint"})
    state.remember(state.unseen(spark.createDataFrame(made, EVENT), 0), 0)
    fresh = spark.createDataFrame([(10_000 + i, *r[1:]) for i, r in enumerate(made)], EVENT)
    asked = []
    before = state._keys_before
    state._keys_before = lambda batch_id, days: asked.append(days) or before(batch_id, days)
    assert state.unseen(fresh, 1).count() == len(made)
    assert len(asked[0]) <= 2  # bits that happen to be set: next to none of the days


def test_windows_are_corrected_not_cut(spark, tmp_path):
    made, parts = deliveries()
    dated = [[r for r in part if r[2] is not None] for part in parts]
    state = H.WindowHistory(spark, str(tmp_path))
    assert state.watermark() is None
    newest, late = None, 0
    for batch_id, part in enumerate(dated):
        batch = spark.createDataFrame(part, EVENT)
        state.add(batch, batch_id)
        state.add(batch, batch_id)  # replayed
        if newest is not None:
            mark = newest - timedelta(minutes=15)
            late += sum(datetime.min + timedelta(minutes=5) * ((r[2] - datetime.min) // timedelta(minutes=5) + 1) <= mark for r in part)
        newest = max([r[2] for r in part] + ([newest] if newest else []))
        assert state.watermark() == newest - timedelta(minutes=15)
    got = state.reports()
    want = R.windowed_report(spark.createDataFrame([r for part in dated for r in part], EVENT))
    assert rows(got.select(*want.columns)) == rows(want)
    assert got.agg(F.sum("corrected_records")).first()[0] == late > 0
    closed = {r.window_end: r.closed for r in got.collect()}
    assert all(c == (end <= newest - timedelta(minutes=15)) for end, c in closed.items())


def test_late_first_deliveries_land_in_their_table(spark, tmp_path):
    made, parts = deliveries()
    paths = {n: str(tmp_path / n) for n in ("table", "late")}
    handle = H.complete_outputs(H.KeyHistory(spark, str(tmp_path / "s"), {"event_id": "bigint"}), H.WindowHistory(spark, str(tmp_path / "s")), **paths)
    for batch_id, part in enumerate(parts):
        handle(spark.createDataFrame(part, EVENT), batch_id)
    handle(spark.createDataFrame([], EVENT), len(parts))
    sides = {n: spark.read.parquet(p).drop("batch_id").collect() for n, p in paths.items()}
    assert sorted(str(tuple(r)) for side in sides.values() for r in side) == sorted(map(str, made))
    assert len(sides["late"]) > 10 and all(r.event_timestamp is not None for r in sides["late"])


def test_a_small_batch_leaves_few_files(spark, tmp_path):
    made, parts = deliveries()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        handle = H.complete_outputs(H.KeyHistory(spark, str(tmp_path / "s"), {"event_id": "bigint"}), table=str(tmp_path / "table"))
        for batch_id, part in enumerate(parts[:2]):
            handle(spark.createDataFrame(part, EVENT), batch_id)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for batch_id in (0, 1):
        assert len(list((tmp_path / "table" / f"batch_id={batch_id}").glob("*.parquet"))) <= 4


def test_deliveries_are_dealt_over_more_files_as_events_grow(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(FX, "FILE_EVENTS", 300)
    FX.delivered_files(spark, sf_dir, str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name()).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_id") == 0).alias("hot")).collect()
    assert len(got) == 40 and sum(r.hot for r in got) == 1002 and max(r.hot for r in got) < 60  # four times as many files
    events = spark.read.parquet(str(tmp_path / "in")).groupBy("event_id").count().collect()
    assert {r["count"] for r in events if r.event_id} == {2} and len(events) == 1000
