"""Remediation decisions over run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X
from eventwarden.operators import running as R
from eventwarden.operators.drift import drift_action

REPORT_DEFAULTS = {
    "total_records": 0, "late_records": 0, "dq_failures": 0, "dq_unknown": 0,
    "schema_drift_count": 0, "schema_drift_detected": False, "processing_errors": 0,
}
QUALITY_DEFAULTS = {
    "evaluated_expectations": 0, "successful_expectations": 0,
    "unsuccessful_expectations": 0, "overall_success_rate": 1.0,
}


def decision_context(reports: DataFrame, quality: DataFrame, incidents: DataFrame,
                     lookback_days: int = P.INCIDENT_LOOKBACK_DAYS) -> DataFrame:
    """Run report, suite statistics and recent incidents of each run.

    A run without a report counts zero records; a run without a validation
    counts as fully successful.  Incidents are counted over the days up to the
    end of the run, both ends included.
    """
    joined = reports.join(quality.select("run_id", *QUALITY_DEFAULTS), "run_id", "full")
    status = (F.when(F.col("total_records").isNull(), "no_data")
              .when(F.col("evaluated_expectations").isNull(), "no_validation").otherwise("ok"))
    filled = joined.withColumn("context_status", status).withColumns({
        name: F.coalesce(name, F.lit(value))
        for name, value in {**REPORT_DEFAULTS, **QUALITY_DEFAULTS}.items()
    })
    return R.trailing_count(
        filled, "run_id", "end_time", incidents, "created_at", lookback_days * 86400,
        {"recent_incidents": F.lit(1),
         "recent_escalated": F.when(F.col("escalated"), 1).otherwise(0)})


def _action(tool: str, message: str) -> Column:
    """Advice: whether it was carried out is known to the ledger (``operators.effects``) alone."""
    return F.struct(F.lit(tool).alias("tool"), F.lit("advised").alias("status"), F.lit(message).alias("message"))


def rule_decisions(runs: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy()) -> DataFrame:
    """One decision per run: reasons, actions, confidence, escalation."""
    late, dq = X.rate("late_records", "total_records"), X.rate("dq_failures", "total_records")
    drifted = F.coalesce("schema_drift_detected", F.lit(False))
    remap = drifted & F.lit(policy.auto_remap)
    reasons = F.array_compact(F.array(
        F.when(drifted, "Schema drift detected"),
        F.when(remap, "Applied automatic schema remapping"),
        F.when(late > policy.late_rate,
               F.concat(F.lit("High late arrival rate: "), X.percent_text(late))),
        F.when(dq > policy.dq_rate,
               F.concat(F.lit("High DQ failure rate: "), X.percent_text(dq))),
    ))
    return (runs
            .withColumn("reasoning", F.when(F.size(reasons) == 0, "Pipeline running normally")
                        .otherwise(F.concat_ws("; ", reasons)))
            .withColumns({
                "decision": F.lit("Rule-based analysis"),
                "actions_taken": F.array_compact(F.array(
                    F.when(remap, _action("apply_schema_remap", "Schema remap advised")),
                    _action("notify_ops", "Notification advised"))),
                "confidence": F.lit(policy.rule_confidence),
                "escalation_required": (late > policy.late_rate) | (dq > policy.dq_rate),
                "decided_at": F.col("end_time"),
            }))


def gate_actions(decisions: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy(),
                 actions: str = "actions_taken") -> DataFrame:
    """Drop the actions of decisions whose confidence is below the gate."""
    return decisions.withColumn(actions, F.when(F.col("confidence") >= policy.min_confidence, F.col(actions))
                                .otherwise(F.slice(F.col(actions), 1, 0)))


def decision_log(decisions: DataFrame) -> DataFrame:
    """Audit row of a decision, with the counts it was based on."""
    return decisions.select(
        "run_id", F.col("decided_at").alias("timestamp"), "decision", "reasoning", "confidence",
        "escalation_required", F.size("actions_taken").alias("actions_count"),
        F.struct("total_records", "late_records", "dq_failures",
                 F.col("schema_drift_detected").alias("schema_drift")).alias("context_summary"))


def action_audit(decisions: DataFrame, key: list[str]) -> DataFrame:
    """One row per action advised, in order."""
    return (decisions.select(*key, "decided_at", F.posexplode("actions_taken").alias("action_no", "a"))
            .select(*key, "decided_at", "action_no", "a.*"))


def decision_matrix(runs: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy()) -> DataFrame:
    """All matching rows of the decision table per run, most urgent first.

    ``runs`` carries the report columns plus ``drift_class``, ``streak`` and
    ``max_segment_share`` where known.  The table is a literal array: matching is
    a projection, with no join against rules.
    """
    late, dq = X.rate("late_records", "total_records"), X.rate("dq_failures", "total_records")
    some = F.col("total_records") > 0
    drift = F.coalesce("drift_class", F.lit("none"))
    share = F.coalesce("max_segment_share", F.lit(0.0))
    has_dq = F.col("dq_failures") > 0
    table = [
        # priority, condition, predicate, action, escalate
        (1, "critical_share", dq > policy.critical_rate, F.lit("escalate_incident"), True),
        (2, "repeated_failures", F.coalesce("streak", F.lit(0)) >= policy.streak,
         F.lit("escalate_incident"), True),
        (3, "breaking_drift", drift == "breaking", drift_action(drift, policy), True),
        (4, "high_late_rate", late > policy.late_rate, F.lit("escalate_incident"), True),
        (5, "high_dq_rate", dq > policy.dq_rate, F.lit("escalate_incident"), True),
        (6, "localised_dq", has_dq & (share >= policy.localised_share), F.lit("quarantine_records"), False),
        (7, "additive_drift", drift == "additive", drift_action(drift, policy), False),
        (8, "processing_errors", F.col("processing_errors") > 0, F.lit("retrigger_task"), False),
        (9, "tolerable_late", (F.col("late_records") > 0) & (late < policy.late_rate),
         F.lit("retrigger_task"), False),
        (10, "tolerable_dq", has_dq & (dq < policy.dq_rate), F.lit("log_and_continue"), False),
    ]
    matched = F.array_compact(F.array(*[
        F.when(some & cond, F.struct(F.lit(prio).alias("priority"), F.lit(name).alias("condition"),
                                     action.alias("action"), F.lit(escalate).alias("escalate")))
        for prio, name, cond, action, escalate in table
    ]))
    return runs.select("run_id", F.explode(matched).alias("m")).select("run_id", "m.*")


def run_outcomes(runs: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy(), keep: list[str] | None = None) -> DataFrame:
    """(run, failure type, failed): null where the run had no data to judge; ``keep`` are columns to go along."""
    late, dq = X.rate("late_records", "total_records"), X.rate("dq_failures", "total_records")
    verdicts = {
        "late_arrivals": late > policy.late_rate,
        "data_quality": dq > policy.dq_rate,
        "schema_drift": F.col("schema_drift_detected"),
        "processing_error": F.col("processing_errors") > 0,
    }
    pairs = F.array(*[
        F.struct(F.lit(t).alias("failure_type"),
                 F.when(F.col("total_records") > 0, v).alias("failed")) for t, v in verdicts.items()
    ])
    kept = ["run_id", *(keep or [])]
    return runs.select(*kept, F.explode(pairs).alias("v")).select(*kept, "v.*")


def failure_streaks(outcomes: DataFrame, keys: list[str], order: str | list[str] = "run_id",
                    policy: P.DecisionPolicy = P.DecisionPolicy(), ranges: int | None = None) -> DataFrame:
    """Length of the current run of failures at every run, per failure type.

    Runs without data neither extend nor break a streak.  ``order`` tells the order of runs; ids that say
    nothing about it, such as hashes, go with a time before them.
    """
    counted = R.count_since(outcomes, keys, order, "streak", hit=F.col("failed"), reset=~F.col("failed"), ranges=ranges)
    return counted.withColumn(
        "escalate", F.coalesce("failed", F.lit(False)) & (F.col("streak") >= policy.streak))


def last_runs(runs: DataFrame, keys: list[str] | None = None, order: str | list[str] = "run_id",
              size: int = P.DECISION_WINDOW_RUNS, ranges: int | None = None) -> DataFrame:
    """Each run with its totals over the last ``size`` runs."""
    return R.trailing_rows(
        runs, keys or [], order, size,
        {"window_runs": ("count", F.lit(1)),
         "window_records": ("sum", F.col("total_records")),
         "window_late": ("sum", F.col("late_records")),
         "window_dq_failures": ("sum", F.col("dq_failures")),
         "window_max_dq_failures": ("max", F.col("dq_failures"))}, ranges=ranges)
