"""Iceberg cube, explaining segments, sketches and nested drift against brute force."""

import itertools
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.operators import drift_paths as DP, quality as Q, segments as SG, sketches as SK
from eventwarden.plans import fixture as FX

from conftest import rows

SCHEMA = "run_id long, a string, b string, c int, dq_passed boolean"


def made(seed=2, n=900):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.choice(["x", "y", None]), rng.choice("pqrst"), rng.choice([1, 2, None])
        bad = (a == "x" and b == "p") or (c == 2 and rng.random() < 0.3) or rng.random() < 0.05
        out.append((i % 3, a, b, c, None if rng.random() < 0.05 else not bad))
    return out + [(9, "x", "p", 1, True)] * 5  # a run without failures


def plain_cells(data, depth):
    cells = defaultdict(lambda: [0, 0])
    for run, a, b, c, ok in data:
        items = [("a", a), ("b", b), ("c", None if c is None else str(c))]
        for k in range(1, depth + 1):
            for cell in itertools.combinations(items, k):
                cells[run, cell][0] += 1
                cells[run, cell][1] += ok is False
    return cells


def totals(data):
    out = defaultdict(lambda: [0, 0])
    for run, *_, ok in data:
        out[run][0] += 1
        out[run][1] += ok is False
    return out


@pytest.mark.parametrize("least", [0.05, 0.1, 0.4])
@pytest.mark.parametrize("depth", [1, 2, 3])
def test_cube_has_every_cell_that_holds_enough(spark, least, depth):
    data = made()
    got = SG.iceberg_cube(SG.finest_segments(spark.createDataFrame(data, SCHEMA), ["run_id"], ["c", "a", "b"]), ["run_id"], least, depth)
    whole = totals(data)
    want = {(run, cell, n, f, *whole[run]) for (run, cell), (n, f) in plain_cells(data, depth).items() if f > 0 and f >= least * whole[run][1]}
    assert {(r.run_id, tuple((i.name, i.value) for i in r.cell), r.total_records, r.failures, r.all_records, r.all_failures) for r in got.collect()} == want
    assert got.count() == len(want)


def test_segments_explain_what_earlier_ones_do_not(spark):
    data = made()
    got = SG.explaining_segments(SG.finest_segments(spark.createDataFrame(data, SCHEMA), ["run_id"], ["a", "b", "c"]), ["run_id"], depth=2, rounds=3)
    whole, want, left = totals(data), set(), data
    text = lambda cell: " AND ".join(f"{n}={v if v is not None else '(none)'}" for n, v in cell)
    for place in (1, 2, 3):
        best = {}
        for (run, cell), (n, f) in plain_cells(left, 2).items():
            over = round(f - n * whole[run][1] / whole[run][0], 9)
            if f > 0 and f >= 0.1 * whole[run][1] and over > 0:
                best[run] = min(best.get(run, (0,)), (-over, len(cell), text(cell), cell, n, f)) if run in best else (-over, len(cell), text(cell), cell, n, f)
        want |= {(run, place, t, n, f, -o) for run, (o, _, t, _, n, f) in best.items()}
        inside = lambda r: r[0] in best and all(dict(a=r[1], b=r[2], c=None if r[3] is None else str(r[3]))[k] == v for k, v in best[r[0]][3])
        left = [r for r in left if r[0] in best and not inside(r)]
    found = {(r.run_id, r.place, r.text, r.total_records, r.failures, r.excess) for r in got.withColumn("text", SG.cell_text()).collect()}
    assert found == want
    named = {r.run_id: r for r in SG.named_segments(got, ["run_id"]).collect()}
    assert set(named) == {0, 1, 2} and all(r.segments and 0 < r.explained_share <= 1 for r in named.values())


def test_no_failures_no_segments(spark):
    finest = SG.finest_segments(spark.createDataFrame([(1, "x", "p", 1, True)], SCHEMA), ["run_id"], ["a", "b"])
    assert SG.explaining_segments(finest, ["run_id"]).count() == 0
    assert SG.iceberg_cube(finest.limit(0), ["run_id"]).count() == 0


def test_sketches_add_up_over_batches_in_any_order(spark, sf_dir):
    flagged = FX.flagged_events(spark, sf_dir).persist()
    parts = [flagged.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == i) for i in (3, 0, 4, 1, 2)]
    sketches = SK.run_sketches(parts[0], ["run_id"])
    for part in parts[1:]:
        sketches = sketches.unionByName(SK.run_sketches(part, ["run_id"]))
    merged = SK.estimates(SK.merge_sketches(sketches, ["run_id"]))
    exact = {r.run_id: r for r in flagged.groupBy("run_id").agg(F.countDistinct("id").alias("ids"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(r.records == exact[r.run_id].n and abs(r.distinct_ids - exact[r.run_id].ids) <= SK.DISTINCT_ERROR * exact[r.run_id].ids for r in merged.collect())
    checked = SK.within_error(merged, flagged, ["run_id"]).collect()
    assert all(r.p50_within and r.p95_within and r.ids_within and r.exact_ids == exact[r.run_id].ids for r in checked)
    wrong = SK.within_error(merged.withColumn("p50", F.col("p95") + 10**6).withColumn("distinct_ids", F.col("distinct_ids") * 2), flagged, ["run_id"])
    assert not any(r.p50_within or r.ids_within for r in wrong.collect())
    flagged.unpersist()


def test_sketches_of_nothing(spark, sf_dir):
    none = FX.flagged_events(spark, sf_dir).withColumn("id", F.lit(None).cast("string")).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    got = SK.estimates(SK.merge_sketches(SK.run_sketches(none, ["run_id"]), ["run_id"])).collect()
    assert all((r.distinct_ids, r.p50, r.p95) == (0, None, None) for r in got) and len(got) == 2


def plain_paths(value, path=""):
    kinds = {str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null", dict: "object", list: "array"}
    if path:
        yield path, kinds[type(value)]
    if isinstance(value, dict):
        for k, v in value.items():
            yield from plain_paths(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        seen = {kinds[type(v)] for v in value} - {"null"}
        if len(seen) > 1 and not seen <= {"integer", "number"}:
            yield f"{path}[]", "mixed"
        else:
            for v in value:
                yield from plain_paths(v, f"{path}[]")


def test_paths_of_nested_payloads(spark):
    docs = [{"a": 1, "b": {"c": [1, 2], "d": {"e": None}}}, {"a": 1.5, "b": {"c": ["x"], "d": {"e": True}}}, {"a": None, "b": None, "z": []},
            {"a": 2, "b": {"c": [], "d": {"e": False}}, "l": [{"m": 1}, {"m": 2, "n": "t"}, None]}, {"l": [1, "a"]}, {"l": [[1], [2, 3]]}] * 3
    raw = [(k % 2, json.dumps(d)) for k, d in enumerate(docs)] + [(0, "not json"), (1, None), (2, "[1"), (0, "7")]
    got = {(r.g, r.path): (r["class"], r.records) for r in DP.observed_paths(spark.createDataFrame(raw, "g int, raw string"), "raw", ["g"]).collect()}
    kinds, counts = defaultdict(set), defaultdict(int)
    for g, text in raw:
        try:
            found = set(plain_paths(json.loads(text)))
        except (ValueError, TypeError):
            continue
        for path in {p for p, _ in found}:
            counts[g, path] += 1
        for path, kind in found:
            kinds[g, path].add(kind)
    def bound(classes):
        known = classes - {"null"}
        return "null" if not known else known.pop() if len(known) == 1 else "number" if known <= {"integer", "number"} else "mixed"
    assert got == {key: (bound(set(c)), counts[key]) for key, c in kinds.items()}


def test_paths_below_the_last_level_are_named_deep(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":1}}}',)], "raw string")
    assert {(r.path, r["class"]) for r in DP.observed_paths(df, "raw", depth=3).collect()} == {("a", "object"), ("a.b", "deep")}


def test_paths_against_a_contract(spark):
    seen = spark.createDataFrame([(1, "a", "string", 5), (1, "b", "integer", 5), (1, "x.y", "boolean", 1), (2, "a", "null", 2)], "g int, path string, class string, records long")
    contract = {"a": ("integer", True), "b": ("number", False), "c.d": ("string", True)}
    got = {(r.g, r.path): (r.status, r.required) for r in DP.compare_paths(seen, ["g"], contract).collect()}
    assert got == {(1, "a"): ("type_change", True), (1, "b"): ("ok", False), (1, "c.d"): ("missing", True), (1, "x.y"): ("new", False),
                   (2, "a"): ("ok", True), (2, "b"): ("missing", False), (2, "c.d"): ("missing", True)}


def test_uniqueness_checks_share_one_pass(spark):
    data = [("r", "a", 1, 0.0), ("r", "a", 2, -0.0), ("r", None, 2, 1.0), ("s", "a", 1, None), ("s", "b", 1, None)]
    df = spark.createDataFrame(data, "batch string, k string, n int, x double")
    suite = [P.Expectation(Q.UNIQUE, {"column": c}) for c in ("k", "n", "x")]
    got = {(r.batch, r.column_name): (r.element_count, r.missing_count, r.unexpected_count) for r in Q.run_suite(df, suite, F.lit(0), "batch").collect()}
    assert got == {("r", "k"): (3, 1, 2), ("r", "n"): (3, 0, 2), ("r", "x"): (3, 0, 2), ("s", "k"): (2, 0, 0), ("s", "n"): (2, 0, 2), ("s", "x"): (2, 2, 0)}
    dup = Q.duplicate_rows(df, suite, F.lit(0), ["batch"], "batch")
    assert sorted((r.batch, r.column_name) for r in dup.collect()) == [("r", "k"), ("r", "k"), ("r", "n"), ("r", "n"), ("r", "x"), ("r", "x"), ("s", "n"), ("s", "n")]
    for out in (Q.run_suite(df, suite, F.lit(0), "batch"), dup):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") <= (1 if out is not dup else 2)
    assert rows(Q.run_suite(df.limit(0), suite, F.lit(0), "batch")) == []
