"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Each runs over its whole tables.  Timestamps leave as text and nullable flags as
true/false/unknown, so that any two engines can be compared value by value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventwarden import policies as P, schemas as S
from eventwarden.functions import columns as X
from eventwarden.operators import (
    alerts as A, decisions as D, drift as DR, drift_paths as DP, effects as EF, enrich as E, incidents as I, quality as Q,
    quarantine as QU, remap as RM, report as R, responses as RS, segments as SG,
    sketches as SK,
)
from eventwarden.plans import fixture as FX
from eventwarden.plans.remediation import remediate
from eventwarden.session import work_folder
from eventwarden.sinks import maintenance as MT, tables as K
from eventwarden.sources import documents as DOC, events as SRC
from eventwarden.streaming import history as H, jobs as J

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The newest event of every table size lies in January 2024.
AS_OF = "2024-01-31 00:00:00"
CLOCK = "processing_timestamp"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def ts(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSS").alias(name)


def tri(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown")).alias(name)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


# -- projections ----------------------------------------------------------------

@query
def enrich_timestamps(spark, sf):
    out = E.with_timestamps(FX.customer_events(spark, sf), FX.clock())
    return out.select("event_id", ts("signup_timestamp"), ts("event_timestamp"),
                      ts("processing_timestamp"))


@query
def region_lookup(spark, sf):
    return FX.customer_events(spark, sf).select(
        "event_id", "country", X.region_of("country").alias("region"))


@query
def region_join(spark, sf):
    """Region from a dimension table: nation and region tables give the mapping's names."""
    dim = (FX.table(spark, sf, "nation").join(FX.table(spark, sf, "region"),
                                              F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_nationkey").cast("string").alias("country"), F.col("r_name").alias("region")))
    buyers = FX.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("country"))
    return E.join_region(buyers, dim).select("c_custkey", "country", "region")


@query
def email_domain(spark, sf):
    return FX.customer_events(spark, sf).select(
        "event_id", X.email_domain("email").alias("email_domain"))


@query
def customer_age(spark, sf):
    out = E.with_timestamps(FX.customer_events(spark, sf), FX.clock())
    return out.select("event_id", X.age_days(CLOCK, "signup_timestamp").alias("customer_age_days"))


@query
def field_rename(spark, sf):
    """Technical names to the business names and back is the identity; emit the former."""
    events = FX.customer_events(spark, sf).select("event_id", *P.BUSINESS_FIELDS.values())
    business = E.rename_to_business(events)
    return E.rename_to_business(E.rename_to_technical(business))


# -- flags ------------------------------------------------------------------------

@query
def dq_flags(spark, sf):
    return FX.flagged_events(spark, sf).select(
        "event_id", tri("dq_email_valid"), tri("dq_id_not_null"), tri("dq_timestamp_valid"),
        tri("dq_plan_valid"), tri("dq_passed"))


@query
def late_flag(spark, sf):
    return FX.flagged_events(spark, sf).select("event_id", "is_late_arrival")


@query
def drift_flag(spark, sf):
    return FX.flagged_events(spark, sf).select("event_id", "version", "schema_drift_detected")


@query
def curated_events(spark, sf):
    return FX.flagged_events(spark, sf).select(
        "event_id", "run_id", "id", "region", "email_domain", "customer_age_days",
        "schema_drift_detected", "is_late_arrival", tri("dq_passed"))


# -- reports ------------------------------------------------------------------------

def _report(df: DataFrame) -> DataFrame:
    return df.select("run_id", "total_records", "late_records", "dq_failures", "dq_unknown",
                     "schema_drift_count", "schema_drift_detected", "processing_errors",
                     ts("start_time"), ts("end_time"), "watermark_delay")


@query
def run_report(spark, sf):
    return _report(FX.run_reports(spark, sf))


@query
def run_rates(spark, sf):
    return R.run_rates(FX.run_reports(spark, sf)).select(
        "run_id", "late_rate", "dq_failure_rate", "error_rate", "late_exceeded", "dq_exceeded",
        "is_critical")


@query
def latest_run(spark, sf):
    return _report(R.latest_run(FX.run_reports(spark, sf)))


@query
def failure_by_segment(spark, sf):
    return R.failure_by_segment(FX.flagged_events(spark, sf))


@query
def failure_shares(spark, sf):
    return R.failure_shares(FX.flagged_events(spark, sf), ["run_id"])


@query
def worst_segments(spark, sf):
    return R.worst_segments(FX.flagged_events(spark, sf))


@query
def anomaly_counters(spark, sf):
    return R.anomaly_counters(FX.flagged_events(spark, sf), ["run_id"])


@query
def version_counts(spark, sf):
    return R.version_counts(FX.flagged_events(spark, sf))


@query
def windowed_report(spark, sf):
    return R.windowed_report(FX.flagged_events(spark, sf)).select(
        ts("window_start"), ts("window_end"), "total_records", "late_records", "dq_failures",
        "dq_unknown", "schema_drift_count")


# -- decoding and drift ----------------------------------------------------------------

@query
def json_decode(spark, sf):
    out = SRC.decode(FX.raw_events(spark, sf), keep=["event_id", "run_id"])
    text = ["signup_ts", "event_ts", "version", "marketing_opt_in"]
    return out.select("event_id", "run_id", "kafka_key", ts("kafka_timestamp"), "kafka_offset",
                      "kafka_partition", "id", "name", "email", "country", "plan", "customer_segment",
                      *[F.col(c).cast("string").alias(c) for c in text])


@query
def readable_records(spark, sf):
    good, _ = SRC.decode_split(FX.raw_events(spark, sf), keep=["event_id", "run_id"])
    return good.select("event_id", "run_id", "id", "email", "country", "plan", "version")


@query
def corrupt_records(spark, sf):
    _, bad = SRC.decode_split(FX.raw_events(spark, sf), keep=["event_id", "run_id"])
    return bad.select("event_id", "run_id", (F.col("id").isNull()).alias("unreadable"),
                      F.length(SRC.CORRUPT).cast("bigint").alias("corrupt_chars"))


def _raw_text(spark: SparkSession, sf: str) -> DataFrame:
    return FX.raw_events(spark, sf).select("run_id", F.col("value").cast("string").alias("raw"))


@query
def drift_fields(spark, sf):
    return DR.compare_fields(_raw_text(spark, sf), "raw").withColumn(
        "expected", F.coalesce("expected", F.lit("")))


@query
def drift_class(spark, sf):
    found = DR.drift_class(DR.compare_fields(_raw_text(spark, sf), "raw", ["run_id"]), ["run_id"])
    return found.select(
        "run_id", "drift_class", DR.drift_action(F.col("drift_class")).alias("drift_action"),
        *[F.array_join(c, ",").alias(c) for c in ("new_fields", "removed_fields", "type_changes")],
        "required_missing")


@query
def field_difference(spark, sf):
    """Fields of run payloads unknown to the contract, and contract fields never sent."""
    seen = DR.observed_fields(_raw_text(spark, sf), "raw").select("field")
    contract = spark.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in S.CUSTOMER_EVENT_V1.fieldNames()])).alias("field"))
    missing, new = DR.missing_and_new(contract, seen)
    return (missing.withColumn("status", F.lit("missing"))
            .unionByName(new.withColumn("status", F.lit("new"))))


# path: type, required
NESTED_CONTRACT = {
    "id": ("string", True), "customer": ("object", True), "customer.plan": ("string", False), "customer.place": ("object", True),
    "customer.place.country": ("string", True), "customer.place.zone": ("integer", False), "items": ("array", True),
    "items[]": ("object", False), "items[].sku": ("integer", True), "items[].price": ("number", True), "tags": ("array", False),
    "tags[]": ("string", False),
}


@query
def drift_paths(spark, sf):
    """Field paths of nested payloads, inside objects and arrays, against their contract, by run."""
    seen = DP.observed_paths(FX.nested_events(spark, sf), "raw", ["run_id"])
    return DP.compare_paths(seen, ["run_id"], NESTED_CONTRACT).withColumn("expected", F.coalesce("expected", F.lit("")))


@query
def props_fields(spark, sf):
    """Observed fields of the events table's own JSON column, by event type."""
    return DR.observed_fields(FX.table(spark, sf, "events").select("event_type", "props"),
                              "props", ["event_type"])


# -- expectations -----------------------------------------------------------------------

def _suite(spark: SparkSession, sf: str) -> DataFrame:
    return Q.run_suite(FX.flagged_events(spark, sf), P.CUSTOMER_SUITE, F.col(CLOCK), "run_id")


def _results(df: DataFrame, batch: str = "run_id") -> DataFrame:
    counts = ["element_count", "missing_count", "unexpected_count"]
    percents = ["missing_percent", "unexpected_percent", "unexpected_percent_total"]
    return df.select(batch, "position", "expectation_type", "column_name", "success",
                     *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                     *[F.coalesce(c, F.lit(0.0)).alias(c) for c in percents])


@query
def suite_results(spark, sf):
    return _results(_suite(spark, sf))


@query
def suite_unique(spark, sf):
    """A key that is unique by construction next to one that repeats, over the whole table."""
    suite = [P.Expectation(Q.UNIQUE, {"column": c}) for c in ("event_id", "id", "email")]
    events = FX.flagged_events(spark, sf).withColumn("batch", F.lit("all"))
    return _results(Q.run_suite(events, suite, F.col(CLOCK), "batch"), "batch")


@query
def suite_samples(spark, sf):
    events = FX.flagged_events(spark, sf)
    failed = Q.failed_rows(events, P.CUSTOMER_SUITE, F.col(CLOCK), ["event_id"])
    return Q.unexpected_samples(failed, "event_id").select(
        "position", "expectation_type", "column_name", "sample", "event_id")


@query
def failed_rows(spark, sf):
    return Q.failed_rows(FX.flagged_events(spark, sf), P.CUSTOMER_SUITE, F.col(CLOCK),
                         ["event_id", "run_id"]).select(
        "event_id", "run_id", "position", "expectation_type", "column_name")


@query
def duplicate_rows(spark, sf):
    return Q.duplicate_rows(FX.flagged_events(spark, sf), P.CUSTOMER_SUITE, F.col(CLOCK),
                            ["event_id"], "run_id").select("event_id", "column_name", "value")


@query
def suite_stats(spark, sf):
    return Q.suite_stats(_suite(spark, sf), "run_id")


@query
def quality_severity(spark, sf):
    return Q.result_severity(_suite(spark, sf)).select(
        "run_id", "position", "column_name", "failure_rate", "severity")


@query
def quality_dimensions(spark, sf):
    return Q.dimension_scores(_suite(spark, sf), "run_id").withColumn("score", F.round("score", 9))


def _overall(spark: SparkSession, sf: str) -> DataFrame:
    return Q.overall_quality(Q.dimension_scores(_suite(spark, sf), "run_id"), "run_id")


@query
def quality_overall(spark, sf):
    return _overall(spark, sf).withColumn("overall_score", F.round("overall_score", 9))


@query
def quality_trend(spark, sf):
    trend = Q.quality_trend(_overall(spark, sf), "run_id", "overall_score")
    return trend.select("periods", *[F.round(c, 9).alias(c) for c in
                                     ("first_score", "last_score", "mean_step", "slope")])


@query
def rule_coverage(spark, sf):
    return Q.rule_coverage(_suite(spark, sf))


@query
def field_summary(spark, sf):
    return Q.field_summary(FX.flagged_events(spark, sf), "run_id")


# -- order events: remap, then validate -----------------------------------------------------

ORDER_WIRE = S.struct(("event", S.STRING), ("order_id", S.STRING), ("orderId", S.STRING),
                      ("amount", S.DOUBLE), ("amt", S.DOUBLE), ("ts", S.LONG))
ORDER_REMAP = {"orderId": "order_id", "amt": "amount", "coupon": {"type": "string"},
               "amount": {"type": "double"}}


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    wire = FX.raw_orders(spark, sf).select(F.from_json("raw", ORDER_WIRE).alias("d")).select("d.*")
    return RM.apply_remap(wire, ORDER_REMAP)


@query
def remap_apply(spark, sf):
    return _orders(spark, sf).select("event", "order_id", "amount", "ts", "coupon")


@query
def order_amounts(spark, sf):
    orders = _orders(spark, sf).withColumn("batch", F.lit("orders"))
    return _results(Q.run_suite(orders, P.ORDER_SUITE, as_of(), "batch"), "batch")


@query
def declared_rules(spark, sf):
    """Every declared rule group over the table it is about: orders as one batch, customer events by run."""
    groups = DOC.declared_rules()
    events, orders = FX.flagged_events(spark, sf), _orders(spark, sf).withColumn("run_id", F.lit(-1).cast("bigint"))
    out = None
    for group, rules in groups.items():
        table, at = (orders, as_of()) if group == "expectations" else (events, F.col(CLOCK))
        part = _results(Q.run_suite(table, rules, at, "run_id")).withColumn("rule_group", F.lit(group))
        out = part if out is None else out.unionByName(part)
    return out.select("rule_group", "run_id", "position", "expectation_type", "column_name", "success", "element_count",
                      "missing_count", "unexpected_count")


def _remap_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every run that sees a new field asks for it to be added with the type it had."""
    fields = DR.compare_fields(_raw_text(spark, sf), "raw", ["run_id"])
    return fields.filter("status = 'new'").select(
        F.col("run_id").alias("call_id"), F.col("run_id").alias("updated_at"), "field",
        F.concat("observed", F.lit(" since run "), F.col("run_id").cast("string")).alias("spec"))


@query
def remap_merge(spark, sf):
    return RM.merge_remap(_remap_history(spark, sf))


@query
def remap_config(spark, sf):
    return RM.remap_config(_remap_history(spark, sf)).select(
        "version", "updated_at", "applied",
        F.array_join(F.transform(F.map_entries("mappings"),
                                 lambda e: F.concat(e.key, F.lit("="), e.value)), ";").alias("mappings"))


# -- quarantine and retention ---------------------------------------------------------------

QUARANTINE_RULES = [("invalid_country", "country = 'INVALID'"),
                    ("data_quality_failure", "NOT dq_passed"),
                    ("late_arrival", "is_late_arrival")]


@query
def quarantine_split(spark, sf):
    clean, held = QU.split_quarantine(FX.flagged_events(spark, sf), "country = 'INVALID'")
    return (clean.select("event_id", F.lit("clean").alias("side"))
            .unionByName(held.select("event_id", F.lit("quarantined").alias("side"))))


@query
def quarantine_written(spark, sf):
    """The split written from one tagging of the events, both sides read back."""
    clean, held = QU.write_split(FX.flagged_events(spark, sf), "country = 'INVALID' OR NOT dq_passed", work_folder(spark, "split"))
    side = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).withColumn("side", F.lit(name))
    return side(clean, "clean").unionByName(side(held, "quarantined"))


@query
def quarantine_rules(spark, sf):
    return QU.quarantine_by_rules(FX.flagged_events(spark, sf), QUARANTINE_RULES).select(
        "event_id", "reason")


@query
def quarantine_table(spark, sf):
    """Write the quarantine through its sink and report what landed, by reason."""
    path = work_folder(spark, "quarantine")
    held = QU.quarantine_by_rules(FX.flagged_events(spark, sf), QUARANTINE_RULES)
    K.write_quarantine(held, path, F.col("reason"), as_of(), "events", "rule table")
    return (spark.read.parquet(path).groupBy("reason", "quarantine_ts", "source_path")
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("events")))


@query
def retention(spark, sf):
    return QU.retain(FX.flagged_events(spark, sf), "event_timestamp", as_of()).select("event_id")


@query
def retention_plan(spark, sf):
    plan = QU.retention_plan(FX.flagged_events(spark, sf), "event_timestamp", as_of())
    return plan.withColumn("day", F.col("day").cast("string"))


def _dated_contents(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col(MT.DATE).cast("string").alias(MT.DATE)).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query
def retention_apply(spark, sf):
    """Load the curated table by date, expire it in the middle of a day, expire it again, and read what is left."""
    path, events = work_folder(spark, "dated"), FX.flagged_events(spark, sf)
    schema = MT.dated(events).schema
    MT.write_dated(events, path)
    at = F.lit(AS_OF).cast("timestamp") + F.expr("INTERVAL '10:30' HOUR TO MINUTE")
    for _ in range(2):
        MT.expire(spark, path, schema, at)
    return _dated_contents(spark.read.schema(schema).parquet(path))


@query
def compaction(spark, sf):
    """Four loads that each leave a file a day, compacted: the same rows in one file a day."""
    path, events = work_folder(spark, "small-files"), MT.dated(FX.flagged_events(spark, sf))
    for part in range(4):
        K.append_rebalanced(events.filter(F.col("event_id") % 4 == part), path, [MT.DATE])
    MT.compact(spark, path, events.schema, [MT.DATE], min_files=2)
    files = MT.table_files(spark, path, [MT.DATE]).select(
        F.substring_index("folder", "=", -1).alias(MT.DATE), F.col("files"))
    return _dated_contents(spark.read.schema(events.schema).parquet(path)).join(files, MT.DATE)


# -- incidents -------------------------------------------------------------------------------

def _opened(rates: DataFrame) -> DataFrame:
    return I.log_incidents(I.raise_from_runs(rates), ["run_id"])


def _changes(rates: DataFrame) -> DataFrame:
    """The change log: opened, some escalated, some re-rated, some resolved."""
    later = lambda minutes: F.col("created_at") + F.expr(f"INTERVAL '{minutes}' MINUTE")
    kind = F.col("incident_type")
    return I.change_log(_opened(rates), [
        (I.needs_escalation(), later(10), 1, I.escalation(later(10), F.lit("needs attention"))),
        (kind == "data_quality", later(60), 2, {"severity": F.lit("critical")}),
        (kind.isin("late_arrivals", "pipeline_failure"), later(120), 3, I.resolution(later(120), F.lit("fixed"))),
    ])


def _state(rates: DataFrame) -> DataFrame:
    return I.fold_incidents(_changes(rates))


def _incident_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: ts(c) for c in ("created_at", "updated_at", "resolved_at", "escalated_at")})


@query
def incident_log(spark, sf):
    return _opened(FX.staged_rates(spark, sf)).select(
        "id", "incident_type", "summary", "context", "severity", "status", ts("created_at"),
        "escalated", "created_by")


@query
def incident_state(spark, sf):
    return _incident_text(_state(FX.staged_rates(spark, sf)))


@query
def incident_lookup(spark, sf):
    """The pipeline-failure incident of run 0, by its id."""
    state = _state(FX.staged_rates(spark, sf))
    return _incident_text(I.get_incident(state, hashlib.md5(b"0|pipeline_failure").hexdigest()))


@query
def incident_recent(spark, sf):
    state = _state(FX.staged_rates(spark, sf))
    return I.recent_incidents(state, as_of()).select("id", "incident_type", ts("created_at"), "status")


@query
def incident_recent_quality(spark, sf):
    state = _state(FX.staged_rates(spark, sf))
    return I.recent_incidents(state, as_of(), 30, "data_quality").select(
        "id", "severity", ts("created_at"), "status")


@query
def incident_stats(spark, sf):
    return I.incident_stats(_state(FX.staged_rates(spark, sf)), as_of())


@query
def incident_fallback(spark, sf):
    """Store without its late-arrival incidents plus a JSON-lines file of all openings."""
    rates = FX.staged_rates(spark, sf)
    state = _state(rates)
    path = work_folder(spark, "incident_lines")
    K.append_log(_opened(rates).drop("change_at", "change_seq"), path)
    primary = state.filter("incident_type <> 'late_arrivals'")
    return I.with_fallback(primary, DOC.incident_lines(spark, path)).select(
        "id", "incident_type", "status", "severity", ts("updated_at"))


@query
def incident_escalations(spark, sf):
    """Failure alert of each escalation, joined with its own incident."""
    rates = FX.staged_rates(spark, sf)
    changes = _changes(rates)
    notices = I.escalation_notices(changes, I.fold_incidents(changes))
    context = F.create_map(
        F.lit("incident_id"), F.col("id"), F.lit("incident_type"), F.col("incident_type"),
        F.lit("severity"), F.col("severity"), F.lit("escalation_notes"), F.col("escalation_notes"))
    return A.failure_alerts(notices, ["id"], F.concat(F.lit("Incident escalated: "), F.col("summary")),
                            F.lit("incident_management"), context)


# -- decisions ---------------------------------------------------------------------------------

@query
def decision_context(spark, sf):
    rates = FX.staged_rates(spark, sf)
    quality = Q.suite_stats(_suite(spark, sf), "run_id")
    out = D.decision_context(rates, quality, _state(rates))
    return out.select("run_id", "context_status", "total_records", "late_records", "dq_failures",
                      "schema_drift_detected", "processing_errors", "evaluated_expectations",
                      "unsuccessful_expectations", "overall_success_rate", "recent_incidents",
                      "recent_escalated")


@query
def rule_decisions(spark, sf):
    out = D.gate_actions(D.rule_decisions(FX.run_reports(spark, sf)))
    return out.select("run_id", "decision", "reasoning", "confidence", "escalation_required",
                      F.concat_ws(",", "actions_taken.tool").alias("actions"))


@query
def decision_log(spark, sf):
    out = D.decision_log(D.rule_decisions(FX.run_reports(spark, sf)))
    return out.select("run_id", ts("timestamp"), "decision", "reasoning", "confidence",
                      "escalation_required", "actions_count", "context_summary.total_records",
                      "context_summary.late_records", "context_summary.dq_failures",
                      "context_summary.schema_drift")


@query
def action_audit(spark, sf):
    return D.action_audit(D.rule_decisions(FX.run_reports(spark, sf)), ["run_id"]).withColumn(
        "decided_at", ts("decided_at"))


@query
def decision_matrix(spark, sf):
    rates = FX.staged_rates(spark, sf)
    drift = DR.drift_class(DR.compare_fields(_raw_text(spark, sf), "raw", ["run_id"]), ["run_id"])
    share = (R.failure_shares(FX.flagged_events(spark, sf), ["run_id"])
             .groupBy("run_id").agg(F.max("failure_share").alias("max_segment_share")))
    streak = (D.failure_streaks(D.run_outcomes(rates), ["failure_type"])
              .groupBy("run_id").agg(F.max(F.when(F.col("failed"), F.col("streak"))).alias("streak")))
    runs = (rates.join(drift.select("run_id", "drift_class"), "run_id", "left")
            .join(share, "run_id", "left").join(streak, "run_id", "left"))
    return D.decision_matrix(runs, P.DecisionPolicy(localised_share=0.1))


ATTRIBUTES = ["country", "plan", "version"]


@query
def failure_cube(spark, sf):
    """Cells of country, plan and version that hold a tenth of their run's failures, whatever their number of attributes."""
    cells = SG.iceberg_cube(SG.finest_segments(FX.flagged_events(spark, sf), ["run_id"], ATTRIBUTES), ["run_id"])
    return cells.select("run_id", SG.cell_text().alias("segment"), "total_records", "failures", "all_records", "all_failures")


@query
def decision_segments(spark, sf):
    """The segments that explain each run's excess of failures, one after the other."""
    finest = SG.finest_segments(FX.flagged_events(spark, sf), ["run_id"], ATTRIBUTES)
    found = SG.explaining_segments(finest, ["run_id"], depth=2, rounds=2)
    return found.select("run_id", "place", SG.cell_text().alias("segment"), "total_records", "failures", "excess")


@query
def failure_streaks(spark, sf):
    out = D.failure_streaks(D.run_outcomes(FX.staged_rates(spark, sf)), ["failure_type"])
    return out.select("run_id", "failure_type", tri("failed"), "streak", "escalate")


@query
def last_runs(spark, sf):
    return D.last_runs(FX.staged_rates(spark, sf)).select(
        "run_id", "window_runs", "window_records", "window_late", "window_dq_failures",
        "window_max_dq_failures")


# -- alerts ------------------------------------------------------------------------------------

@query
def alert_outbox(spark, sf):
    rates = FX.staged_rates(spark, sf)
    drift = DR.drift_class(DR.compare_fields(_raw_text(spark, sf), "raw", ["run_id"]), ["run_id"])
    broken = rates.filter("processing_errors > 0")
    alerts = (
        A.quality_alerts(rates, ["run_id"], F.lit("validation_failure"), F.col("dq_failures"),
                         F.col("total_records"))
        .unionByName(A.drift_alerts(drift, ["run_id"]))
        .unionByName(A.failure_alerts(
            broken, ["run_id"],
            F.concat(F.col("processing_errors").cast("string"), F.lit(" processing errors")),
            F.lit("spark"), F.create_map(F.lit("run_id"), F.col("run_id").cast("string"))))
        .unionByName(A.status_alerts(D.rule_decisions(rates), ["run_id"])))
    return A.fan_out(alerts)


# What a table's digest is of: rows in any order, but with these values.
DIGESTS = {
    "run_reports": ["run_id", "total_records", "late_records", "dq_failures", "dq_unknown", "processing_errors"],
    "dq_results": ["run_id", "position", "column_name", "success", "element_count", "missing_count", "unexpected_count"],
    "decisions": ["run_id", "reasoning", "escalation_required", "recent_incidents", "recent_escalated"],
    "decision_log": ["run_id", "reasoning", "escalation_required", "actions_count"],
    "action_audit": ["run_id", "action_no", "tool", "status", "message"],
    "incident_events": ["id", "incident_type", "summary", "severity", "status", "change_seq"],
    "alerts": ["run_id", "alert_type", "title", "message", "severity", "channel"],
}


def _digest(columns: list[str]) -> Column:
    """The sum of the rows' hashes: the same in any order, another one if a row is lost, doubled or mixed up."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"))


def _contents(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and digest of each table."""
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), _digest(DIGESTS[name]).alias("digest")).select(
            F.lit(name).alias("table_name"), "rows", "digest")
        out = part if out is None else out.unionByName(part)
    return out


@query
def remediation_tables(spark, sf):
    """The whole scheduled chain; rows and content of each table it wrote."""
    paths = remediate(FX.flagged_events(spark, sf), work_folder(spark, "remediation"), F.col(CLOCK),
                      F.expr(FX.DECODE_FAILED), _raw_text(spark, sf))
    return _contents(spark, paths)


@query
def remediation_replay(spark, sf):
    """The chain in two calls, the second one repeated: the same rows as in one call."""
    flagged, raw = FX.flagged_events(spark, sf), _raw_text(spark, sf)
    half = (flagged.agg(F.max("run_id")).first()[0] + 1) // 2
    root = work_folder(spark, "remediation")
    for batch_id, later in ((0, False), (1, True), (1, True)):
        part = (F.col("run_id") >= half) == F.lit(later)
        paths = remediate(flagged.filter(part), root, F.col(CLOCK), F.expr(FX.DECODE_FAILED),
                          raw.filter(part), batch_id=batch_id)
    return _contents(spark, paths)


@query
def remediation_effects(spark, sf):
    """What the chain's decisions did to the data, after a second call that finds all of it done.

    The ledger's states, the merged remap, the quarantined records by run and reason, and the records left.
    """
    flagged, root = FX.flagged_events(spark, sf), work_folder(spark, "effects")
    for batch_id in (0, 1):
        remediate(flagged, root, F.col(CLOCK), F.expr(FX.DECODE_FAILED), _raw_text(spark, sf),
                  P.DecisionPolicy(localised_share=0.1), batch_id)
    store = EF.EffectStore(spark, root)
    rows = lambda df, kind, run, name, n, detail: df.select(
        F.lit(kind).alias("kind"), run.cast("bigint").alias("run_id"), name.alias("name"), n.cast("bigint").alias("n"),
        detail.cast("string").alias("detail"))
    none, count, ids = F.lit(-1), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    held = store.quarantined().groupBy("run_id", "reason").agg(count, ids)
    free = store.released(flagged.select("event_id"), "event_id").agg(count, ids)
    return (rows(store.states(), "ledger", F.col("run_id"), F.concat_ws(" ", "condition", "action", "status"), F.col("changed"), F.col("message"))
            .unionByName(rows(RM.merge_remap(store.remap_history()), "remap", none, F.col("field"), F.lit(1), F.col("spec")))
            .unionByName(rows(held, "quarantine", F.col("run_id"), F.col("reason"), F.col("n"), F.col("ids")))
            .unionByName(rows(free, "released", none, F.lit("events"), F.col("n"), F.col("ids"))))


@query
def remap_decoded(spark, sf):
    """The raw events decoded again under the contract that the applied remaps have widened."""
    root = work_folder(spark, "effects")
    remediate(FX.flagged_events(spark, sf), root, F.col(CLOCK), F.expr(FX.DECODE_FAILED), _raw_text(spark, sf))
    raw = FX.raw_events(spark, sf).select("event_id", F.col("value").cast("string").alias("raw"))
    out = RM.decode_remapped(raw, "raw", S.CUSTOMER_EVENT_V1, EF.EffectStore(spark, root).mapping())
    return out.select("event_id", "id", "plan", "email", F.col("marketing_opt_in").cast("string").alias("marketing_opt_in"),
                      "customer_segment")


@query
def country_membership(spark, sf):
    """Countries outside the accepted set, checked against a table."""
    allowed = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in P.COUNTRIES])).alias("code"))
    return Q.rows_outside_table(FX.customer_events(spark, sf).select("event_id", "country"),
                                "country", allowed, "code")


# -- responses ----------------------------------------------------------------------------------

TURN = ["conv_id", "turn"]


@query
def response_sections(spark, sf):
    return RS.response_sections(FX.responses(spark, sf), TURN)


@query
def response_actions(spark, sf):
    return RS.response_actions(FX.responses(spark, sf), TURN)


@query
def response_decisions(spark, sf):
    out = RS.response_decisions(FX.responses(spark, sf), TURN)
    return out.withColumn("actions", F.array_join(
        F.transform("actions", lambda a: F.concat(a["tool"], a["params"])), ";"))


# -- sources, sinks, streams -----------------------------------------------------------------------

def _redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """The decoded stream with every fifth record delivered twice and every 251st lost."""
    raw = FX.raw_events(spark, sf).filter("event_id % 251 <> 17")
    return SRC.decode(raw.unionByName(raw.filter("event_id % 5 = 0")))


@query
def offset_audit(spark, sf):
    return R.offset_audit(_redelivered(spark, sf))


@query
def offset_gaps(spark, sf):
    """Every stretch of offsets that is missing from its source partition."""
    return R.offset_gaps(_redelivered(spark, sf))


@query
def load_validation(spark, sf):
    """Write the curated table and validate the load; sizes and times vary, so only verdicts leave."""
    path = work_folder(spark, "curated")
    K.write_curated(FX.flagged_events(spark, sf), path)
    return DOC.load_validation(spark, path).select(
        "status", (F.col("file_count") > 0).alias("has_files"),
        (F.col("newest_bytes") > 0).alias("newest_has_bytes"))


@query
def curated_table(spark, sf):
    """Write the curated table by country and plan, read it back, count its segments."""
    path = work_folder(spark, "curated")
    events = FX.flagged_events(spark, sf)
    K.write_curated(events, path)
    return (SRC.curated_table(spark, path, events.schema).groupBy("country", "plan")
            .agg(F.count(F.lit(1)).alias("events"), F.count_if("dq_passed").alias("passed")))


@query
def stream_curated(spark, sf):
    path, state = work_folder(spark, "stream_curated"), work_folder(spark, "stream_state")
    stream = J.curated_stream(FX.customer_event_stream(spark, sf), FX.clock())
    J.start_curated(stream, path, state, every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select(
        "event_id", "run_id", "country", "plan", "region", "is_late_arrival", tri("dq_passed"))


def _drain(spark: SparkSession, sf: str, label: str, **outputs: bool) -> dict[str, str]:
    root = work_folder(spark, label)
    paths = {name: f"{root}/{name}" for name in ("table", *outputs)}
    stream = J.curated_stream(FX.customer_event_stream(spark, sf), FX.clock())
    J.start_batches(stream, J.batch_outputs(**paths), f"{root}/state", every=None).awaitTermination()
    return paths


@query
def stream_report(spark, sf):
    paths = _drain(spark, sf, "stream_report", reports=True)
    reports = spark.read.schema(S.RUN_REPORT).parquet(paths["reports"])
    return _report(J.merge_reports(reports))


@query
def stream_late_split(spark, sf):
    paths = _drain(spark, sf, "stream_late", late=True)
    side = lambda n: spark.read.parquet(paths[n]).select("event_id", F.lit(n).alias("side"))
    return side("table").unionByName(side("late"))


def _deliveries(spark: SparkSession, sf: str, label: str, **outputs: bool) -> tuple[H.WindowHistory, dict[str, str]]:
    """Drain bounded micro-batches of repeated, unordered deliveries into tables."""
    root = work_folder(spark, label)
    stream = J.curated_stream(FX.delivered_files(spark, sf, f"{root}/input"), FX.clock())
    windows = H.WindowHistory(spark, root)
    history = H.KeyHistory(spark, f"{root}/seen", {"event_id": "bigint"}, pages=16)
    paths = {name: f"{root}/{name}" for name in outputs}
    J.start_batches(stream, H.complete_outputs(history, windows, **paths), f"{root}/state", every=None).awaitTermination()
    return windows, paths


@query
def stream_windowed_report(spark, sf):
    """All windows over all first deliveries, whichever micro-batch they came in."""
    windows, _ = _deliveries(spark, sf, "stream_windows")
    return windows.reports().select(
        ts("window_start"), ts("window_end"), "total_records", "late_records", "dq_failures",
        "dq_unknown", "schema_drift_count")


@query
def stream_dedup(spark, sf):
    """Every event delivered at least twice, one of them in a third of the rows, over bounded micro-batches: kept once."""
    _, paths = _deliveries(spark, sf, "stream_dedup", table=True, late=True)
    side = lambda n: spark.read.parquet(paths[n]).select("event_id", "run_id", "id")
    return side("table").unionAll(side("late"))


@query
def stream_sketches(spark, sf):
    """Distinct customers and delay quantiles of each run, merged from micro-batches, against the exact figures."""
    _, paths = _deliveries(spark, sf, "stream_sketches", sketches=True)
    merged = SK.merge_sketches(spark.read.parquet(paths["sketches"]), ["run_id"])
    return SK.within_error(SK.estimates(merged), FX.flagged_events(spark, sf), ["run_id"])


@query
def stream_metrics(spark, sf):
    """The report a stream collects on the side, totalled over its micro-batches."""
    path, state = work_folder(spark, "stream_metrics"), work_folder(spark, "stream_state")
    stream = J.observe_report(J.curated_stream(FX.customer_event_stream(spark, sf), FX.clock()))
    metrics = J.RunMetrics()
    spark.streams.addListener(metrics)
    try:
        running = J.start_curated(stream, path, state, every=None)
        metrics.only(running)
        running.awaitTermination()
        metrics.wait()
    finally:
        spark.streams.removeListener(metrics)
    reports = metrics.reports(spark)
    return reports.agg(*[F.sum(c).alias(c) for c in (
        "total_records", "late_records", "dq_failures", "dq_unknown", "schema_drift_count")])
