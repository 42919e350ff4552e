"""Schema drift, remaps and quarantine."""

import json

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.operators import drift as DR, quarantine as QU, remap as RM

from conftest import rows

BASE = {"id": "c", "name": "n", "email": "a@b.co", "signup_ts": 1, "country": "US", "plan": "free",
        "event_ts": 2, "version": 1}


def without(*keys):
    return {k: v for k, v in BASE.items() if k not in keys}


def classify(spark, payloads):
    df = spark.createDataFrame([(g, p if isinstance(p, str) else json.dumps(p)) for g, p in payloads],
                               "run string, raw string")
    return {r.run: r for r in DR.drift_class(DR.compare_fields(df, "raw", ["run"]), ["run"]).collect()}


@pytest.mark.parametrize("payload, drift, new, removed, changed", [
    (BASE, "none", [], [], []),
    ({**BASE, "marketing_opt_in": True}, "additive", ["marketing_opt_in"], [], []),
    (without("country"), "additive", [], ["country"], []),
    (without("email"), "breaking", [], ["email"], []),
    ({**BASE, "version": "1"}, "breaking", [], [], ["version"]),
    ({**BASE, "version": 1.5}, "breaking", [], [], ["version"]),
    ({**BASE, "name": None}, "none", [], [], []),                  # null is no type
    ({**BASE, "name": {"first": "x"}}, "breaking", [], [], ["name"]),
    ({**BASE, "value": 1, "key": [1]}, "additive", ["key", "value"], [], []),
])
def test_drift_class(spark, payload, drift, new, removed, changed):
    r = classify(spark, [("r", payload)])["r"]
    assert (r.drift_class, r.new_fields, r.removed_fields, r.type_changes) == (drift, new, removed, changed)


def test_drift_is_per_group_and_over_all_its_records(spark):
    got = classify(spark, [("a", BASE), ("a", without("country")), ("b", without("country")),
                           ("c", "not json"), ("c", "[1]"), ("d", BASE), ("d", "{broken")])
    assert {k: r.drift_class for k, r in got.items()} == {"a": "none", "b": "additive", "c": "breaking",
                                                        "d": "none"}


def test_field_counts(spark):
    df = spark.createDataFrame([(json.dumps(p),) for p in [BASE, BASE, {**BASE, "version": "2", "x": 1.25}]],
                               "raw string")
    got = {r.field: r for r in DR.compare_fields(df, "raw").collect()}
    assert (got["version"].observed, got["version"].records, got["version"].status) == (
        "integer,string", 3, "type_change")
    assert (got["x"].status, got["x"].observed, got["x"].records) == ("new", "number", 1)
    seen = {(r.field, r["class"]): r.records for r in DR.observed_fields(df, "raw").collect()}
    assert seen["version", "string"] == 1 and seen["version", "integer"] == 2


def test_payloads_are_parsed_once(spark):
    df = spark.createDataFrame([(json.dumps(BASE),)], "raw string").filter("length(raw) > 0")
    plan = DR.compare_fields(df, "raw")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("policy, additive", [
    (P.DecisionPolicy(), "remap"), (P.DecisionPolicy(auto_remap=False), "escalate"),
    (P.DecisionPolicy(drift_action="quarantine"), "quarantine"),
    (P.DecisionPolicy(drift_action="escalate"), "escalate"),
])
def test_drift_policy(spark, policy, additive):
    df = spark.createDataFrame([("additive",), ("breaking",), ("none",)], "c string")
    assert [r[0] for r in df.select(DR.drift_action(F.col("c"), policy)).collect()] == [
        additive, "quarantine_and_escalate", "none"]


def test_field_sets_differ_both_ways(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "field string")
    right = spark.createDataFrame([("b",), ("c",)], "field string")
    missing, new = DR.missing_and_new(left, right)
    assert rows(missing) == [("a",)] and rows(new) == [("c",)]


def test_remap_state(spark):
    calls = [(1, 10, "a", "string"), (2, 20, "a", "int"), (2, 20, "b", "long"), (3, 30, "c", "x")]
    history = spark.createDataFrame(calls, "call_id long, updated_at long, field string, spec string")
    first = RM.remap_config(history.filter("call_id = 1")).first()
    assert (first.version, first.applied, first.mappings) == (1, False, {"a": "string"})
    state = RM.remap_config(history).first()
    assert (state.version, state.updated_at, state.mappings) == (3, 30, {"a": "int", "b": "long", "c": "x"})
    assert rows(RM.merge_remap(history).select("field", "spec")) == [("a", "int"), ("b", "long"), ("c", "x")]


def test_apply_remap(spark):
    df = spark.createDataFrame([("A1", None, 49.9, None, "7"), (None, "A2", None, 59.0, "x")],
                               "order_id string, orderId string, amount double, amt double, qty string"
                               .replace("orderId", "old_id"))
    got = RM.apply_remap(df, {"old_id": "order_id", "amt": "amount", "qty": {"type": "int", "nullable": True},
                              "opt_in": {"type": "boolean", "nullable": True}, "auto_remap": True})
    assert got.columns == ["order_id", "amount", "qty", "opt_in"]
    assert rows(got) == [("A1", 49.9, 7, None), ("A2", 59.0, None, None)]


def test_remap_of_absent_columns_changes_nothing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(RM.apply_remap(df, {"x": "y"})) == [(1,)]


def test_quarantine_partitions_the_rows(spark):
    df = spark.createDataFrame([(1, "INVALID"), (2, "US"), (3, None)], "id int, country string")
    clean, held = QU.split_quarantine(df, "country = 'INVALID'")
    assert rows(held.select("id")) == [(1,)] and rows(clean.select("id")) == [(2,), (3,)]
    assert clean.columns == df.columns
    tagged = QU.quarantine_by_rules(df, [("bad", "country = 'INVALID'"), ("odd", "id % 2 = 1")])
    assert rows(tagged.select("id", "reason")) == [(1, "bad"), (1, "odd"), (3, "odd")]
