"""Rule engine, decision table, incidents, alerts and stored responses."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P, schemas as S
from eventwarden.operators import alerts as A, decisions as D, incidents as I, report as R, responses as RS

from conftest import rows

T0 = datetime(2024, 1, 15, 12)


def report(run=0, total=1000, late=10, dq=5, drift=False, errors=0, end=T0):
    return (run, total, late, dq, 0, int(drift), drift, errors, end - timedelta(minutes=5), end, "15 minutes")


def reports(spark, *items):
    return spark.createDataFrame(list(items), S.RUN_REPORT)


@pytest.mark.parametrize("kw, reasons, escalate, tools", [
    (dict(drift=True), "Schema drift detected; Applied automatic schema remapping", False,
     ["apply_schema_remap", "notify_ops"]),
    (dict(late=200), "High late arrival rate: 20.00%", True, ["notify_ops"]),
    (dict(dq=100), "High DQ failure rate: 10.00%", True, ["notify_ops"]),
    (dict(total=0, late=0, dq=0), "Pipeline running normally", False, ["notify_ops"]),
    (dict(late=5, dq=2), "Pipeline running normally", False, ["notify_ops"]),
    (dict(late=150, dq=50), "Pipeline running normally", False, ["notify_ops"]),  # at the thresholds
    (dict(late=180, dq=80, drift=True),
     "Schema drift detected; Applied automatic schema remapping; High late arrival rate: 18.00%; "
     "High DQ failure rate: 8.00%", True, ["apply_schema_remap", "notify_ops"]),
])
def test_rules(spark, kw, reasons, escalate, tools):
    r = D.rule_decisions(reports(spark, report(**kw))).first()
    assert (r.reasoning, r.escalation_required, r.confidence, [a.tool for a in r.actions_taken]) == (
        reasons, escalate, 0.8, tools)


def test_no_automatic_remap_by_policy(spark):
    r = D.rule_decisions(reports(spark, report(drift=True)), P.DecisionPolicy(auto_remap=False)).first()
    assert r.reasoning == "Schema drift detected" and len(r.actions_taken) == 1


def test_gate(spark):
    decided = D.rule_decisions(reports(spark, report()), P.DecisionPolicy(rule_confidence=0.69))
    assert D.gate_actions(decided).first().actions_taken == []
    decided = D.rule_decisions(reports(spark, report()), P.DecisionPolicy(rule_confidence=0.7))
    assert len(D.gate_actions(decided).first().actions_taken) == 1


def test_log_and_audit(spark):
    decided = D.rule_decisions(reports(spark, report(drift=True, late=200)))
    log = D.decision_log(decided).first()
    assert log.actions_count == 2 and log.context_summary.asDict() == {
        "total_records": 1000, "late_records": 200, "dq_failures": 5, "schema_drift": True}
    audit = D.action_audit(decided, ["run_id"]).orderBy("action_no").collect()
    assert [(a.tool, a.status) for a in audit] == [("apply_schema_remap", "advised"), ("notify_ops", "advised")]


def matrix(spark, drift="none", streak=0, share=0.0, policy=P.DecisionPolicy(), **kw):
    runs = reports(spark, report(**kw)).withColumns({
        "drift_class": F.lit(drift), "streak": F.lit(streak), "max_segment_share": F.lit(share)})
    return {(r.condition, r.action, r.escalate) for r in D.decision_matrix(runs, policy).collect()}


def test_decision_table(spark):
    assert matrix(spark, late=0, dq=0) == set()
    assert matrix(spark, late=10, dq=5) == {("tolerable_late", "retrigger_task", False),
                                            ("tolerable_dq", "log_and_continue", False)}
    assert matrix(spark, late=200, dq=0) == {("high_late_rate", "escalate_incident", True)}
    assert matrix(spark, late=0, dq=200) == {("critical_share", "escalate_incident", True),
                                             ("high_dq_rate", "escalate_incident", True)}
    assert matrix(spark, late=0, dq=60, share=0.9) == {("high_dq_rate", "escalate_incident", True),
                                                       ("localised_dq", "quarantine_records", False)}
    assert matrix(spark, late=0, dq=0, drift="additive") == {("additive_drift", "remap", False)}
    assert matrix(spark, late=0, dq=0, drift="breaking") == {("breaking_drift", "quarantine_and_escalate", True)}
    assert matrix(spark, late=0, dq=0, streak=3) == {("repeated_failures", "escalate_incident", True)}
    assert matrix(spark, late=0, dq=0, streak=2, errors=1) == {("processing_errors", "retrigger_task", False)}
    assert matrix(spark, total=0, late=0, dq=0, streak=9, drift="breaking") == set()


def test_context_defaults(spark):
    quality = spark.createDataFrame([(1, 15, 14, 1, 14 / 15), (2, 15, 15, 0, 1.0)],
                                    "run_id long, evaluated_expectations long, successful_expectations long, "
                                    "unsuccessful_expectations long, overall_success_rate double")
    incidents = spark.createDataFrame(
        [(T0 - timedelta(days=7), True), (T0, False), (T0 - timedelta(days=7, seconds=1), True)],
        "created_at timestamp, escalated boolean")
    got = {r.run_id: r for r in D.decision_context(
        reports(spark, report(0), report(1)), quality, incidents).collect()}
    assert (got[0].context_status, got[0].overall_success_rate, got[0].evaluated_expectations) == (
        "no_validation", 1.0, 0)
    assert (got[1].context_status, got[1].recent_incidents, got[1].recent_escalated) == ("ok", 2, 1)
    assert (got[2].context_status, got[2].total_records, got[2].recent_incidents) == ("no_data", 0, 0)


def test_run_rates(spark):
    r = R.run_rates(reports(spark, report(late=75, dq=30, errors=2))).first()
    assert (r.late_rate, r.dq_failure_rate, r.error_rate, r.late_exceeded, r.is_critical) == (
        0.075, 0.03, 0.002, False, False)
    assert not R.run_rates(reports(spark, report(late=101))).first().is_critical
    assert R.run_rates(reports(spark, report(dq=101))).first().is_critical
    assert R.run_rates(reports(spark, report(total=0, late=0, dq=0))).first().late_rate == 0.0


def test_latest_run(spark):
    assert R.latest_run(reports(spark, report(0, end=T0), report(1, end=T0 - timedelta(days=1)))).first().run_id == 0
    assert R.latest_run(reports(spark)).count() == 0


# -- incidents ------------------------------------------------------------------

def raised(spark, **kw):
    return I.log_incidents(I.raise_from_runs(R.run_rates(reports(spark, report(**kw)))), ["run_id"])


def test_incident_defaults(spark):
    df = spark.createDataFrame([(1, T0, "manual", "s", None)],
                               "run_id long, at timestamp, incident_type string, summary string, context string")
    r = I.fold_incidents(I.log_incidents(df, ["run_id"])).first()
    assert (r.severity, r.status, r.escalated, r.created_by, r.context, r.created_at, r.updated_at,
            r.resolved_at) == ("medium", "open", False, "pipeline_agent", "{}", T0, T0, None)


def test_ids_repeat_on_replay(spark):
    assert rows(raised(spark, late=200).select("id")) == rows(raised(spark, late=200).select("id"))


def test_run_incidents(spark):
    got = {r.incident_type: r.severity for r in raised(spark, late=200, dq=60, drift=True, errors=1).collect()}
    assert got == {"pipeline_failure": "high", "late_arrivals": "high", "data_quality": "medium",
                   "schema_drift": "low"}
    assert raised(spark, late=0, dq=0).count() == 0


def test_lifecycle(spark):
    opened = raised(spark, late=200, dq=60)
    hot = opened.filter(I.needs_escalation())
    assert [r.incident_type for r in hot.collect()] == ["late_arrivals"]
    minute = lambda n: F.lit(T0 + timedelta(minutes=n))
    log = (opened.unionByName(I.resolve_incidents(hot, minute(30), notes=F.lit("fixed")))
           .unionByName(I.escalate_incidents(hot, minute(10), notes=F.lit("look")))
           .unionByName(I.update_incidents(hot, minute(20), 1, {"severity": F.lit("critical")})))
    r = I.get_incident(I.fold_incidents(log), hot.first().id).first()
    assert (r.status, r.severity, r.escalated, r.resolution_notes) == ("resolved", "critical", True, "fixed")
    assert (r.escalated_at, r.resolved_at, r.updated_at, r.created_at) == (
        T0 + timedelta(minutes=10), T0 + timedelta(minutes=30), T0 + timedelta(minutes=30), T0)
    other = I.fold_incidents(log).filter("incident_type = 'data_quality'").first()
    assert (other.status, other.escalated, other.updated_at) == ("open", False, T0)
    notice = A.failure_alerts(I.escalation_notices(log, I.fold_incidents(log)), ["id"], F.col("summary"),
                              F.lit("incident_management"))
    assert notice.count() == 1


def test_later_change_of_the_same_instant_wins_by_sequence(spark):
    opened = raised(spark, late=200)
    at = F.lit(T0 + timedelta(minutes=1))
    log = (opened.unionByName(I.update_incidents(opened, at, 2, {"severity": F.lit("low")}))
           .unionByName(I.update_incidents(opened, at, 1, {"severity": F.lit("critical")})))
    assert I.fold_incidents(log).first().severity == "low"


def incident(id_, kind="a", severity="low", status="open", at=T0, escalated=False):
    return (id_, kind, "s", "{}", severity, status, at, at, None, escalated, None, None, "x")


def test_recent_and_stats(spark):
    df = spark.createDataFrame([
        incident("1", at=T0 - timedelta(days=7)), incident("2", "b", "high", escalated=True),
        incident("3", at=T0 - timedelta(days=8)), incident("4", "b", at=T0 - timedelta(days=31))], S.INCIDENT)
    assert [r.id for r in I.recent_incidents(df, F.lit(T0)).collect()] == ["2", "1"]
    assert [r.id for r in I.recent_incidents(df, F.lit(T0), 40, "b").collect()] == ["2", "4"]
    stats = {(r.grouping, r.value): (r.incidents, r.escalated_incidents)
             for r in I.incident_stats(df, F.lit(T0)).collect()}
    assert stats == {("total", "all"): (3, 1), ("incident_type", "a"): (2, 0), ("incident_type", "b"): (1, 1),
                     ("severity", "low"): (2, 0), ("severity", "high"): (1, 1), ("status", "open"): (3, 1)}
    none = I.incident_stats(df.filter("false"), F.lit(T0)).collect()
    assert [(r.grouping, r.incidents) for r in none] == [("total", 0)]


def test_fallback_store(spark):
    primary = spark.createDataFrame([incident("1", status="resolved")], S.INCIDENT)
    fallback = spark.createDataFrame([incident("1"), incident("2", at=T0), incident(
        "2", status="resolved", at=T0 + timedelta(days=1))], S.INCIDENT)
    assert rows(I.with_fallback(primary, fallback).select("id", "status")) == [("1", "resolved"), ("2", "open")]


# -- alerts -----------------------------------------------------------------------

def test_quality_alert(spark):
    df = spark.createDataFrame([(1, 12345, 100000)], "k int, bad long, total long")
    r = A.quality_alerts(df, ["k"], F.lit("validation_failure"), F.col("bad"), F.col("total"), F.lit("why")).first()
    assert r.title == "Data Quality Issue - Validation Failure" and r.severity == "critical"
    assert r.message == ("Issue Type: validation_failure\nAffected Records: 12,345 out of 100,000\n"
                         "Failure Rate: 12.35%\nDetails: why").replace("12.35", "12.35")


def test_empty_run_is_an_info_alert(spark):
    df = spark.createDataFrame([(1, 0, 0)], "k int, bad long, total long")
    assert A.quality_alerts(df, ["k"], F.lit("x"), F.col("bad"), F.col("total")).first().severity == "info"


def test_drift_alert(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [], ["c"], "breaking"), (2, [], [], [], "none")],
                               "k int, new_fields array<string>, removed_fields array<string>, "
                               "type_changes array<string>, drift_class string")
    (r,) = A.drift_alerts(df, ["k"], F.lit(2)).collect()
    assert r.message == ("Schema evolution detected in incoming data:\nNew Fields: a, b\nType Changes: c\n"
                         "Schema Version: 2")
    assert r.severity == "warning"


def test_failure_alert_and_fan_out(spark):
    df = spark.createDataFrame([(1, "boom")], "k int, error string")
    context = F.create_map(F.lit("run"), F.lit("7"), F.lit("notes"), F.lit(None).cast("string"))
    alerts = A.fan_out(A.failure_alerts(df, ["k"], F.col("error"), F.lit("kafka"), context))
    got = alerts.collect()
    assert {r.channel for r in got} == {"slack", "email"}
    assert got[0].title == "Pipeline Failure - Kafka"
    assert got[0].message == "Component: kafka\nError: boom\nAdditional Context:\n  run: 7"
    assert A.fan_out(A.failure_alerts(df, ["k"], F.col("error"), F.lit("x")), ["slack"]).count() == 1


def test_status_alert(spark):
    r = A.status_alerts(D.rule_decisions(reports(spark, report(late=200))), ["run_id"]).first()
    assert (r.message, r.severity) == ("Pipeline status: High late arrival rate: 20.00%", "warning")


# -- stored responses ----------------------------------------------------------------

TEXT = """Some preamble
ANALYSIS:
- Current pipeline status: degraded
- A line that ends in a colon but is long enough to be text:

DECISION:
  Apply remapping
REASONING:
Because of drift
and more
ACTIONS:
[{"tool": "apply_schema_remap", "params": {"mapping": "x"}}, {'tool': 'notify_ops'}]
{"note": "no tool"} {bad json}
CONFIDENCE:
0.85
ESCALATION:
TRUE"""


def responses(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "k int, text string")


def test_sections(spark):
    got = {r.name: r.body for r in RS.response_sections(responses(spark, TEXT), ["k"]).collect()}
    assert set(got) == {"analysis", "decision", "reasoning", "actions", "confidence", "escalation"}
    assert got["decision"] == "Apply remapping" and got["reasoning"] == "Because of drift\nand more"
    assert got["analysis"].endswith("to be text:\n")


def test_section_edge_cases(spark):
    text = "A:\n1\n:\nlost\nA:\n2\nB:"
    got = [(r.section_no, r.name, r.body) for r in RS.response_sections(responses(spark, text), ["k"]).collect()]
    assert got == [(0, "a", "1"), (2, "a", "2"), (3, "b", "")]
    assert RS.response_sections(responses(spark, "", None, "no sections"), ["k"]).count() == 0


def test_response_decision(spark):
    r = RS.response_decisions(responses(spark, TEXT), ["k"]).first()
    assert (r.decision, r.reasoning, r.confidence, r.escalation_required) == (
        "Apply remapping", "Because of drift\nand more", 0.85, True)
    assert [(a.tool, a.params) for a in r.actions] == [
        ("apply_schema_remap", '{"mapping":"x"}'), ("notify_ops", "{}")]


@pytest.mark.parametrize("text, confidence, actions", [
    ("CONFIDENCE:\n95%", 1.0, 1), ("CONFIDENCE:\nhigh", 0.5, 0), ("CONFIDENCE:\n0.69", 0.69, 0),
    ("DECISION:\nx", 0.7, 1), ("CONFIDENCE:\nabout 0.8 or 0.9", 0.8, 1), ("CONFIDENCE:\n.9", 1.0, 1),
])
def test_confidence_and_gate(spark, text, confidence, actions):
    r = RS.response_decisions(responses(spark, '{"tool": "notify_ops"}\n' + text), ["k"]).first()
    assert (r.confidence, len(r.actions)) == (confidence, actions)


def test_incomplete_and_missing_responses(spark):
    empty, missing = RS.response_decisions(responses(spark, "", None), ["k"]).orderBy("k").collect()
    assert (empty.decision, empty.reasoning, empty.confidence, empty.escalation_required, empty.actions) == (
        RS.NO_DECISION, RS.NO_REASONING, 0.7, False, [])
    assert (missing.decision, missing.confidence, missing.escalation_required, missing.actions) == (
        RS.FAILED_DECISION, 0.0, True, [])


def test_action_audit_of_responses(spark):
    text = ('{"tool": "quarantine_records", "params": {"filter_condition": "country = \'XX\'"}} '
            '{"tool": "reboot"} {"tool": ""}')
    got = RS.response_actions(responses(spark, text), ["k"]).collect()
    assert [(r.action_no, r.tool, r.success, r.message) for r in got] == [
        (0, "quarantine_records", True, "Quarantine configured for records matching: country = 'XX'"),
        (1, "reboot", False, "Unknown tool: reboot")]


@pytest.mark.parametrize("text, found", [
    ('{"tool": "a", "params": {"x": {"y": {"z": [{"w": {}}]}}}}', [("a", '{"x":{"y":{"z":[{"w":{}}]}}}')]),
    ('{"tool": "a", "params": {"message": "use } here {"}}', [("a", '{"message":"use } here {"}')]),
    ('{"tool": "a", "params": {"m": "say \\"}\\" it\'s"}} {"tool": "b"}', [("a", '{"m":"say \\"}\\" it\'s"}'), ("b", "{}")]),
    ("{'tool': 'a', 'params': {'m': 'x } y'}}", [("a", '{"m":"x } y"}')]),
    ('{ {"open {"tool": "a"} } {don\'t} {"tool": "b"}', [("b", "{}")]),
    ('{never "closed\n{"tool":\n "a"}', [("a", "{}")]),
    ('}} {"tool": "a"} {', [("a", "{}")]),
    ('{"tool":' + " " * 700 + '"a } b", "params": {"x":' + "\n" * 300 + '1}}', [("a } b", '{"x":1}')]),
    ('{' + "\t" * 900 + '"tool": "a"}', [("a", "{}")]),
    ("no object at all", []),
])
def test_nested_actions(spark, text, found):
    got = RS.response_actions(responses(spark, text), ["k"]).orderBy("action_no").collect()
    assert [(r.tool, r.params) for r in got] == found


def test_long_response(spark):
    text = "DECISION:\n" + "word { " * 50_000 + "\nCONFIDENCE:\n1"
    r = RS.response_decisions(responses(spark, text), ["k"]).first()
    assert r.confidence == 1.0 and len(r.decision) > 300_000


def test_a_change_log_is_that_of_the_single_changes(spark):
    opened = I.log_incidents(spark.createDataFrame(
        [(i, datetime(2024, 1, 1 + i), kind, "s", None, severity) for i, (kind, severity) in enumerate(
            [("a", "high"), ("b", "low"), ("a", None), ("b", "CRITICAL")])],
        "run_id long, at timestamp, incident_type string, summary string, context string, severity string"), ["run_id"])
    at = F.col("created_at")
    got = I.change_log(opened, [(I.needs_escalation(), at, 1, I.escalation(at, F.lit("n"))),
                                (F.col("incident_type") == "a", at, 2, I.resolution(at)), (F.lit(None).cast("boolean"), at, 3, {})])
    want = (opened.unionByName(I.escalate_incidents(opened.filter(I.needs_escalation()), at, 1, F.lit("n")))
            .unionByName(I.resolve_incidents(opened.filter("incident_type = 'a'"), at, 2)))
    assert got.schema == want.schema or [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 8
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_context_reads_its_inputs_a_few_times(spark, sf_dir):
    """Events for the suite's two aggregates, each with its dimension, and run-level tables: no more scans than that."""
    from eventwarden.plans import queries
    plan = queries.QUERIES["decision_context"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 7
    assert queries.QUERIES["incident_state"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
