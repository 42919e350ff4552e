"""The scheduled chain as one batch job: tables, not files, between its steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventwarden import policies as P
from eventwarden.operators import (
    alerts as A, decisions as D, drift as DR, effects as EF, incidents as I, quality as Q, report as R,
)
from eventwarden.sinks import tables as K

TABLES = ["run_reports", "dq_results", "decisions", "decision_log", "action_audit",
          "incident_events", "alerts"]
CHANGE_DATE = "change_date"
#: What the effects of the decisions are worked out from, and what they leave.
EFFECT_TABLES = ["segment_shares", "drift_fields", "decision_matrix", "action_intents", "action_ledger", "remap_history", "quarantine"]


def remediate(flagged: DataFrame, out: str, as_of: Column, error: Column | None = None,
              raw: DataFrame | None = None,
              policy: P.DecisionPolicy = P.DecisionPolicy(), batch_id: int = 0) -> dict[str, str]:
    """Report, validate, decide, record and alert for every run in ``flagged``.

    Every step writes its part of a table, under ``batch_id``, and the next one
    reads that part, so the events are aggregated once for the reports and once
    for the suite.  A repeated call with the same ``batch_id`` replaces its parts
    and leaves those of other calls alone; only the incidents are read from all
    calls, since a run's context has those of the days before it.  ``raw``
    (run_id, raw text) adds drift alerts and remaps.  The decision table's remaps and quarantines are carried out
    and entered in the ledger (``operators.effects``).  Returns the paths of ``TABLES``.
    """
    spark = flagged.sparkSession
    paths = {name: f"{out.rstrip('/')}/{name}" for name in [*TABLES, *EFFECT_TABLES]}

    def store(df: DataFrame, name: str, partitions: list[str] | None = None) -> DataFrame:
        K.write_batch(df, batch_id, paths[name], partitions=partitions)
        return spark.read.schema(df.schema).parquet(f"{paths[name]}/batch_id={batch_id}")

    reports = store(R.run_report(flagged, error=error), "run_reports")
    rates = R.run_rates(reports, policy)
    results = store(Q.run_suite(flagged, P.CUSTOMER_SUITE, as_of, "run_id"), "dq_results")
    opened = I.log_incidents(I.raise_from_runs(rates, policy), ["run_id"])
    logged = I.change_log(opened, [(I.needs_escalation(), F.col("created_at"), 1, I.escalation(F.col("created_at")))])
    store(logged.withColumn(CHANGE_DATE, F.date_format("change_at", "yyyy-MM-dd")), "incident_events", [CHANGE_DATE])
    history = recent_changes(spark, paths["incident_events"], logged.schema, rates)
    context = D.decision_context(reports, Q.suite_stats(results, "run_id"), I.fold_incidents(history))
    decisions = store(D.gate_actions(D.rule_decisions(context, policy), policy), "decisions")
    store(D.decision_log(decisions), "decision_log")
    store(D.action_audit(decisions, ["run_id"]), "action_audit")
    alerts = A.quality_alerts(reports, ["run_id"], F.lit("validation_failure"),
                              F.col("dq_failures"), F.col("total_records"))
    alerts = alerts.unionByName(A.status_alerts(decisions, ["run_id"]))
    shares = store(R.failure_shares(flagged, ["run_id"]), "segment_shares")
    if raw is not None:
        compared = store(DR.compare_fields(raw, "raw", ["run_id"]), "drift_fields")
        drift, mappings = DR.drift_class(compared, ["run_id"]), EF.remap_details(compared)
        alerts = alerts.unionByName(A.drift_alerts(drift, ["run_id"]))
    else:
        drift = rates.select("run_id", F.lit("none").alias("drift_class"))
        mappings = rates.select("run_id", F.lit(None).cast("map<string,string>").alias("mapping"))
    store(A.fan_out(alerts), "alerts")
    streaks = (D.failure_streaks(D.run_outcomes(_recent(spark, paths["run_reports"], rates, policy)), ["failure_type"], policy=policy)
               .groupBy("run_id").agg(F.max(F.when(F.col("failed"), F.col("streak"))).alias("streak")))
    segments = EF.worst_segment(shares)
    runs = (rates.join(drift.select("run_id", "drift_class"), "run_id", "left")
            .join(segments.select("run_id", "max_segment_share"), "run_id", "left").join(streaks, "run_id", "left"))
    matrix = store(D.decision_matrix(runs, policy), "decision_matrix")
    EF.EffectStore(spark, out).apply(EF.intents(matrix, rates, mappings, segments), flagged, batch_id)
    return {name: paths[name] for name in TABLES}


def recent_changes(spark: SparkSession, path: str, schema: T.StructType, rates: DataFrame) -> DataFrame:
    """The changes that the runs' contexts can depend on, of all calls.

    A context counts incidents opened within the look-back of a run's end, and an incident's changes are never
    from before it was opened.  So the log is read from the first such day on, by its partitions, however old it is.
    """
    begin = rates.agg(F.min("end_time") - F.expr(f"INTERVAL {P.INCIDENT_LOOKBACK_DAYS} DAY")).first()[0]
    dated = T.StructType([*schema.fields, T.StructField(CHANGE_DATE, T.StringType())])
    changes = spark.read.schema(dated).parquet(path)
    since = F.date_format(F.lit(begin).cast("timestamp"), "yyyy-MM-dd")
    return changes.filter(F.col(CHANGE_DATE) >= since).select(*schema.fieldNames())


def _recent(spark: SparkSession, path: str, rates: DataFrame, policy: P.DecisionPolicy) -> DataFrame:
    """The runs of this call and those of other calls in the days before, once each: a streak may have begun there."""
    begin = rates.agg(F.min("end_time")).first()[0]
    stored = spark.read.parquet(path).drop("batch_id").filter(
        F.col("end_time") >= F.lit(begin).cast("timestamp") - F.expr(f"INTERVAL {P.INCIDENT_LOOKBACK_DAYS} DAY"))
    return R.run_rates(stored.dropDuplicates(["run_id"]), policy)
