"""Effects of decisions: applied once, under the right intent, whatever fails or is repeated."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.operators import effects as EF, remap as RM
from eventwarden.plans import fixture as FX
from eventwarden.plans.queries import DIGESTS, _raw_text, CLOCK
from eventwarden.plans.remediation import EFFECT_TABLES, remediate
from eventwarden.sinks import tables as K

from conftest import rows

END = datetime(2024, 1, 1, 12)
WANTED = "action_key string, run_id long, decided_at timestamp, condition string, action string, priority int, escalate boolean, " \
         "mapping map<string,string>, country string, plan string"
EVENTS = "event_id long, run_id long, country string, plan string, dq_passed boolean"


def wanted(spark, *intents):
    full = [(k, run, END, cond, action, prio, True, mapping, c, p) for k, run, cond, action, prio, mapping, c, p in intents]
    return spark.createDataFrame(full, WANTED)


@pytest.fixture
def events(spark):
    return spark.createDataFrame([
        (1, 1, "US", "free", False), (2, 1, "US", "free", True), (3, 1, None, None, False), (4, 1, "US", None, False),
        (5, 2, "US", "free", True), (6, 2, "GB", "free", None), (7, 3, None, None, None), (8, 3, None, None, False), (9, None, "US", "free", False),
    ], EVENTS)


INTENTS = [
    ("k1", 1, "localised_dq", EF.QUARANTINE_SEGMENT, 6, None, "US", "free"),
    ("k2", 2, "breaking_drift", EF.QUARANTINE_RUN, 3, None, None, None),
    ("k3", 3, "localised_dq", EF.QUARANTINE_SEGMENT, 6, None, None, None),
    ("k4", 2, "localised_dq", EF.QUARANTINE_SEGMENT, 6, None, "GB", "free"),
    ("k5", 1, "additive_drift", EF.REMAP, 7, {"a": "string", "b": "bigint"}, None, None),
    ("k6", 3, "additive_drift", EF.REMAP, 7, {}, None, None),
    ("k7", 3, "tolerable_late", "retrigger_task", 9, None, None, None),
]


def states(store):
    return {r.action_key: (r.status, r.changed) for r in store.states().collect()}


FIRST = {"k1": ("applied", 1), "k2": ("applied", 2), "k3": ("applied", 1), "k4": ("failed", 0), "k5": ("applied", 2),
         "k6": ("failed", 0), "k7": ("advised", 0)}


def test_each_intent_has_its_effect(spark, events, tmp_path):
    store = EF.EffectStore(spark, str(tmp_path))
    store.apply(wanted(spark, *INTENTS), events, 0)
    assert states(store) == FIRST
    held = {(r.event_id, r.reason, r.action_key, r.quarantine_ts) for r in store.quarantined().collect()}
    assert held == {(1, "localised_dq", "k1", "20240101_120000"), (5, "breaking_drift", "k2", "20240101_120000"),
                    (6, "breaking_drift", "k2", "20240101_120000"), (8, "localised_dq", "k3", "20240101_120000")}
    assert {r.event_id for r in store.released(events, "event_id").collect()} == {2, 3, 4, 7, 9}
    assert store.mapping() == {"a": {"type": "string"}, "b": {"type": "bigint"}}


@pytest.mark.parametrize("again", [0, 1])
def test_a_second_call_changes_nothing(spark, events, tmp_path, again):
    store = EF.EffectStore(spark, str(tmp_path))
    store.apply(wanted(spark, *INTENTS), events, 0)
    held, fields = rows(store.quarantined().drop("batch_id")), rows(store.remap_history())
    entries = store.apply(wanted(spark, *INTENTS), events, again)
    assert states(store) == FIRST
    assert rows(store.quarantined().drop("batch_id")) == held and rows(store.remap_history()) == fields
    if again:  # only what failed was tried again
        assert {r.action_key for r in entries.collect()} == {"k4", "k6"}


def test_a_call_that_failed_before_its_ledger_is_made_up_for(spark, events, tmp_path):
    store = EF.EffectStore(spark, str(tmp_path))
    store._write(store._held(wanted(spark, *INTENTS).withColumn("done", F.lit(None).cast("boolean")), events, "events"), "quarantine", 0)
    assert not K.exists(spark, store.paths["action_ledger"])
    store.apply(wanted(spark, *INTENTS), events, 0)
    assert states(store) == FIRST and store.quarantined().count() == 4


def test_a_failed_intent_is_tried_again(spark, events, tmp_path):
    store = EF.EffectStore(spark, str(tmp_path))
    store.apply(wanted(spark, INTENTS[5]), events, 0)
    assert states(store)["k6"] == ("failed", 0)
    store.apply(wanted(spark, ("k6", 3, "additive_drift", EF.REMAP, 7, {"c": "double"}, None, None)), events, 1)
    assert states(store)["k6"] == ("applied", 1) and store.mapping() == {"c": {"type": "double"}}


def test_no_intents(spark, events, tmp_path):
    store = EF.EffectStore(spark, str(tmp_path))
    store.apply(wanted(spark), events, 0)
    assert states(store) == {} and store.mapping() == {} and store.released(events, "event_id").count() == 9


def test_worst_segment_breaks_ties_by_name_nulls_first(spark):
    shares = spark.createDataFrame([(1, "US", "free", 0.4), (1, None, "free", 0.4), (1, None, None, 0.4), (1, "A", "a", 0.1), (2, "B", None, 0.0)],
                                   "run_id long, country string, plan string, failure_share double")
    assert rows(EF.worst_segment(shares)) == [(1, None, None, 0.4), (2, "B", None, 0.0)]


def test_unknown_classes_are_not_mapped(spark):
    compared = spark.createDataFrame([(1, "x", "new", "string"), (1, "y", "new", "integer,string"), (1, "z", "ok", "string"), (2, "z", "ok", "string")],
                                     "run_id long, field string, status string, observed string")
    assert {r.run_id: r.mapping for r in EF.remap_details(compared).collect()} == {1: {"x": "string"}, 2: {}}


def test_a_widened_contract_reads_what_was_unknown(spark):
    from eventwarden.schemas import LONG, STRING, struct
    df = spark.createDataFrame([(1, '{"id": 5, "extra": "7", "old": "o"}'), (2, '{"id": 6, "extra": "x"}'), (3, None)], "n int, raw string")
    out = RM.decode_remapped(df, "raw", struct(("id", LONG), ("new", STRING)), {"extra": {"type": "bigint"}, "old": "new"})
    assert out.columns == ["n", "id", "new", "extra"]
    assert rows(out) == [(1, 5, "o", 7), (2, 6, None, None), (3, None, None, None)]


def test_chain_repeated_under_its_batch(spark, sf_dir, tmp_path):
    flagged, policy = FX.flagged_events(spark, sf_dir), P.DecisionPolicy(localised_share=0.1)
    found = []
    for _ in range(2):
        remediate(flagged, str(tmp_path), F.col(CLOCK), F.expr(FX.DECODE_FAILED), _raw_text(spark, sf_dir), policy, 3)
        found.append([rows(spark.read.parquet(f"{tmp_path}/{n}").select(F.to_json(F.struct("*")))) for n in EFFECT_TABLES])
    assert found[0] == found[1] and all(found[0][EFFECT_TABLES.index(n)] for n in ("action_ledger", "decision_matrix"))


def test_digests_name_columns_of_their_tables():
    from eventwarden.plans.remediation import TABLES
    assert set(DIGESTS) == set(TABLES)
