"""The prefix scan and what is built on it against brute force, from one range to more ranges than rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden.operators import decisions as D, running as R


@pytest.fixture(scope="module")
def history():
    rng = random.Random(7)
    out = []
    for key, share in (("hot", 0.9), ("cold", 0.3)):
        for run in range(160):
            if rng.random() < share:
                out.append((key, run, rng.choice([True, False, None]), rng.randint(0, 9)))
    rng.shuffle(out)
    return out


SCHEMA = "key string, run_id long, failed boolean, n long"


def by_key(history):
    keys = {}
    for row in sorted(history, key=lambda r: r[1]):
        keys.setdefault(row[0], []).append(row)
    return keys


@pytest.mark.parametrize("ranges", [1, 3, 40, 500])
def test_running_sums(spark, history, ranges):
    df = spark.createDataFrame(history, SCHEMA)
    got = R.running_sums(df, ["key"], "run_id", {"total": F.col("n")}, ranges)
    want = {}
    for key, items in by_key(history).items():
        total = 0
        for _, run, _, n in items:
            total += n
            want[key, run] = total
    assert {(r.key, r.run_id): r.total for r in got.collect()} == want
    assert got.columns == ["key", "run_id", "failed", "n", "total"]


@pytest.mark.parametrize("ranges", [1, 3, 40, 500])
def test_streaks_ignore_runs_without_data(spark, history, ranges):
    df = spark.createDataFrame(history, SCHEMA).drop("n")
    got = D.failure_streaks(df, ["key"], ranges=ranges)
    want = {}
    for key, items in by_key(history).items():
        streak = 0
        for _, run, failed, _ in items:
            streak = streak + 1 if failed else streak if failed is None else 0
            want[key, run] = (streak, bool(failed) and streak >= 3)
    assert {(r.key, r.run_id): (r.streak, r.escalate) for r in got.collect()} == want


@pytest.mark.parametrize("block", [10, 13, 1000])
def test_trailing_rows(spark, history, block):
    df = spark.createDataFrame(history, SCHEMA)
    got = R.trailing_rows(df, ["key"], "run_id", 10,
                          {"rows": ("count", F.lit(1)), "total": ("sum", F.col("n")),
                           "top": ("max", F.col("n"))}, block=block)
    want = {}
    for key, items in by_key(history).items():
        for i, (_, run, _, _) in enumerate(items):
            last = [n for *_, n in items[max(0, i - 9): i + 1]]
            want[key, run] = (len(last), sum(last), max(last))
    assert {(r.key, r.run_id): (r.rows, r.total, r.top) for r in got.collect()} == want


def test_trailing_rows_needs_a_block_as_large_as_the_window(spark, history):
    with pytest.raises(ValueError):
        R.trailing_rows(spark.createDataFrame(history, SCHEMA), [], "run_id", 10, {}, block=9)


@pytest.mark.parametrize("ranges", [1, 4, 60])
def test_trailing_count_is_inclusive_at_both_ends(spark, ranges):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    # Half of the events share one instant.
    events = [(start + timedelta(seconds=500 if i % 2 else rng.randint(0, 1000)), i % 3) for i in range(300)]
    points = [(i, start + timedelta(seconds=rng.choice([0, 400, 500, 600, 1000, i * 11]))) for i in range(90)]
    points.append((90, None))
    got = R.trailing_count(
        spark.createDataFrame(points, "id long, at timestamp"), "id", "at",
        spark.createDataFrame(events, "seen timestamp, w long"), "seen", 100,
        {"n": F.lit(1), "weight": F.col("w")}, ranges)
    want = {}
    for i, at in points:
        hit = [] if at is None else [w for seen, w in events if at - timedelta(seconds=100) <= seen <= at]
        want[i] = (len(hit), sum(hit))
    assert {r.id: (r.n, r.weight) for r in got.collect()} == want


def test_last_runs_over_one_history(spark):
    runs = [(i, 10, i % 3, i % 5) for i in range(0, 60, 2)]
    df = spark.createDataFrame(runs, "run_id long, total_records long, late_records long, dq_failures long")
    got = {r.run_id: (r.window_runs, r.window_dq_failures, r.window_max_dq_failures)
           for r in D.last_runs(df, ranges=4).collect()}
    want = {}
    for k, (run, *_rest) in enumerate(runs):
        last = [dq for *_, dq in runs[max(0, k - 9): k + 1]]
        want[run] = (len(last), sum(last), max(last))
    assert got == want


@pytest.mark.parametrize("ranges", [1, 5, 300])
def test_the_row_before_is_seen_over_range_bounds(spark, history, ranges):
    df = spark.createDataFrame(history, SCHEMA)
    got = R.carried_values(df, ["key"], "run_id", {"before": "run_id", "n_before": "n"}, ranges)
    want = {}
    for key, items in by_key(history).items():
        for a, b in zip([None, *items], items):
            want[key, b[1]] = (a and a[1], a and a[3])
    assert {(r.key, r.run_id): (r.before, r.n_before) for r in got.collect()} == want


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_holes_between_numbers(spark, ranges):
    rng = random.Random(4)
    seen = {("a", 0): [0, 1, 1, 3], ("a", 1): [5], ("b", 0): sorted(rng.sample(range(400), 200)) * 2, ("c", 0): [7, 7, 7],
            ("d", 0): [-9, 10**12]}
    rows = [(k, p, n) for (k, p), ns in seen.items() for n in ns] + [(None, 0, 50), ("a", None, 50), ("a", 0, None)]
    rng.shuffle(rows)
    got = R.islands(spark.createDataFrame(rows, "k string, p int, n long"), ["k", "p"], "n", ranges)
    want = {(k, p, a + 1, b - 1) for (k, p), ns in seen.items() for a, b in zip(sorted(set(ns)), sorted(set(ns))[1:]) if b > a + 1}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_an_empty_history(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.running_sums(none, ["key"], "run_id", {"total": F.col("n")}).count() == 0
    assert R.islands(none, ["key"], "n").count() == 0


def test_hashed_run_ids_go_by_time(spark):
    rng = random.Random(6)
    runs = [(f"{rng.getrandbits(64):016x}", datetime(2024, 1, 1) + timedelta(minutes=5 * i), rng.random() < 0.6) for i in range(70)]
    df = spark.createDataFrame(runs, "run_id string, start_time timestamp, failed boolean").repartition(3)
    got = {r.run_id: r.streak for r in D.failure_streaks(df, [], ["start_time", "run_id"], ranges=9).collect()}
    streak, want = 0, {}
    for run, _, failed in runs:
        streak = streak + 1 if failed else 0
        want[run] = streak
    assert got == want


def test_the_scan_windows_no_totals(spark, history):
    """Windows stay within a range; ranges are folded, not windowed."""
    df = spark.createDataFrame(history, SCHEMA)
    plan = R.running_sums(df, ["key"], "run_id", {"total": F.col("n")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Window [sum(_v_total" in plan
