"""Incidents as an append-only change log, folded to their current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X
from eventwarden.operators.skew import splittable
from eventwarden.schemas import INCIDENT, INCIDENT_CHANGE

ATTRIBUTES = [f.name for f in INCIDENT.fields if f.name != "id"]


def incident_id(*parts: Column) -> Column:
    """A repeatable id, so that replaying a batch raises the same incident."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def raise_from_runs(runs: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy()) -> DataFrame:
    """Incidents a run calls for; ``runs`` carries the rates of a run report."""
    def incident(kind: str, summary: Column, severity: Column) -> Column:
        return F.struct(F.lit(kind).alias("incident_type"), summary.alias("summary"),
                        severity.alias("severity"))

    run = F.col("run_id").cast("string")
    by_rate = lambda r: F.when(r > policy.critical_rate, "high").otherwise("medium")
    raised = F.array_compact(F.array(
        F.when(F.col("processing_errors") > 0, incident(
            "pipeline_failure",
            F.concat(F.lit("Run "), run, F.lit(" had "), F.col("processing_errors").cast("string"),
                     F.lit(" processing errors")),
            F.lit("high"))),
        F.when(F.col("late_exceeded"), incident(
            "late_arrivals",
            F.concat(F.lit("Run "), run, F.lit(" late rate "), X.percent_text(F.col("late_rate"))),
            by_rate(F.col("late_rate")))),
        F.when(F.col("dq_exceeded"), incident(
            "data_quality",
            F.concat(F.lit("Run "), run, F.lit(" failure rate "),
                     X.percent_text(F.col("dq_failure_rate"))),
            by_rate(F.col("dq_failure_rate")))),
        F.when(F.col("schema_drift_detected"), incident(
            "schema_drift",
            F.concat(F.lit("Run "), run, F.lit(" schema drift")),
            F.lit("low"))),
    ))
    context = F.to_json(F.struct("run_id", "total_records", "late_records", "dq_failures"))
    return (runs.select("run_id", F.col("end_time").alias("at"), context.alias("context"),
                        F.explode(raised).alias("i"))
            .select("run_id", "at", "i.*", "context"))


def log_incidents(raised: DataFrame, key: list[str], at: str = "at",
                  created_by: str = "pipeline_agent") -> DataFrame:
    """Opening change rows: open, not escalated, ``medium`` unless stated."""
    severity = F.coalesce("severity", F.lit("medium")) if "severity" in raised.columns else F.lit("medium")
    return _changes(raised, at, 0, {
        "id": incident_id(*[F.col(k) for k in key], F.col("incident_type")),
        "incident_type": F.col("incident_type"),
        "summary": F.col("summary"),
        "context": F.coalesce("context", F.lit("{}")),
        "severity": severity,
        "status": F.lit("open"),
        "created_at": F.col(at),
        "escalated": F.lit(False),
        "created_by": F.lit(created_by),
    })


def update_incidents(incidents: DataFrame, at: Column, seq: int,
                     values: dict[str, Column]) -> DataFrame:
    """Change rows that set ``values`` and stamp ``updated_at``."""
    return _changes(incidents.withColumn("_at", at), "_at", seq, {"id": F.col("id"), **values})


def needs_escalation(severity: str | Column = "severity") -> Column:
    return F.lower(severity).isin("high", "critical")


def escalate_incidents(incidents: DataFrame, at: Column, seq: int = 1,
                       notes: Column | None = None) -> DataFrame:
    values = {"escalated": F.lit(True), "escalated_at": F.col("_at")}
    return update_incidents(incidents, at, seq,
                            values if notes is None else {**values, "resolution_notes": notes})


def resolve_incidents(incidents: DataFrame, at: Column, seq: int = 2,
                      notes: Column | None = None) -> DataFrame:
    values = {"status": F.lit("resolved"), "resolved_at": F.col("_at")}
    return update_incidents(incidents, at, seq,
                            values if notes is None else {**values, "resolution_notes": notes})


def escalation(at: Column, notes: Column | None = None) -> dict[str, Column]:
    """What an escalation sets."""
    return {"escalated": F.lit(True), "escalated_at": at, **({} if notes is None else {"resolution_notes": notes})}


def resolution(at: Column, notes: Column | None = None) -> dict[str, Column]:
    """What a resolution sets."""
    return {"status": F.lit("resolved"), "resolved_at": at, **({} if notes is None else {"resolution_notes": notes})}


def change_log(opened: DataFrame, follow: list[tuple[Column, Column, int, dict[str, Column]]]) -> DataFrame:
    """Openings and the changes that follow from them, in one pass over the openings.

    ``follow`` lists (when, at, sequence number, values to set); a change whose condition is unknown does not happen.
    """
    def change(at: Column, seq: int, values: dict[str, Column]) -> Column:
        stamped = {"change_at": at, "change_seq": F.lit(seq), "id": F.col("id"), "updated_at": at, **values}
        return F.struct(*[stamped.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in INCIDENT_CHANGE.fields])

    own = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INCIDENT_CHANGE.fields])
    rows = F.array(own, *[F.when(when, change(at, seq, values)) for when, at, seq, values in follow])
    return opened.select(F.explode(rows).alias("c")).filter(F.col("c").isNotNull()).select("c.*")


def _changes(df: DataFrame, at: str, seq: int, values: dict[str, Column]) -> DataFrame:
    stamped = {"change_at": F.col(at), "change_seq": F.lit(seq), "updated_at": F.col(at), **values}
    return df.select(*[
        stamped[f.name].cast(f.dataType).alias(f.name) if f.name in stamped
        else F.expr(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}")
        for f in INCIDENT_CHANGE.fields
    ])


def fold_incidents(changes: DataFrame) -> DataFrame:
    """Current state: for each attribute the newest value that was set.

    One aggregation that combines before the shuffle, so an incident with very
    many changes still sends one row per task.
    """
    return changes.groupBy("id").agg(*[
        F.expr(f"max_by({a}, CASE WHEN {a} IS NOT NULL THEN struct(change_at, change_seq) END) AS {a}")
        for a in ATTRIBUTES
    ])


def get_incident(incidents: DataFrame, id_: str) -> DataFrame:
    return incidents.filter(F.col("id") == id_)


def recent_incidents(incidents: DataFrame, as_of: Column, days: int = P.INCIDENT_LOOKBACK_DAYS,
                     incident_type: str | None = None) -> DataFrame:
    """Created within ``days``, newest first."""
    out = incidents.filter(F.col("created_at") >= as_of - F.expr(f"INTERVAL '{int(days)}' DAY"))
    if incident_type is not None:
        out = out.filter(F.col("incident_type") == incident_type)
    return out.orderBy(F.desc("created_at"), "id")


def incident_stats(incidents: DataFrame, as_of: Column,
                   days: int = P.INCIDENT_STATS_DAYS) -> DataFrame:
    """Totals and counts by type, severity and status in a single pass.

    The grouping sets expand the few distinct combinations, not the incidents.
    An empty marker row keeps the total when there are none at all.
    """
    dims = ["incident_type", "severity", "status"]
    recent = incidents.filter(F.col("created_at") >= as_of - F.expr(f"INTERVAL '{int(days)}' DAY"))
    combos = recent.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if("escalated").alias("esc"))
    marker = incidents.sparkSession.range(1).select(
        *[F.lit(None).cast("string").alias(d) for d in dims],
        F.expr("0L AS n"), F.expr("0L AS esc"))
    sets = combos.unionByName(marker).groupingSets([[], *[[d] for d in dims]], *dims).agg(
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
        F.sum("n").alias("incidents"),
        F.sum("esc").alias("escalated_incidents"),
    )
    label, value = F.lit("total"), F.lit("all")
    for d in dims:
        label = F.when(F.col(f"_g_{d}") == 0, d).otherwise(label)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return (sets.select(label.alias("grouping"), value.alias("value"),
                        "incidents", "escalated_incidents")
            .filter((F.col("incidents") > 0) | (F.col("grouping") == "total")))


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Primary store plus the fallback's incidents it does not hold.

    A fallback file may repeat an id; its first record by creation time wins.
    Repeats collapse before the anti join, so no id is hot in it.
    """
    rest = [c for c in fallback.columns if c != "id"]
    first = (fallback.groupBy("id")
             .agg(F.min_by(F.struct(*rest), F.struct("created_at", "updated_at")).alias("r"))
             .select("id", "r.*"))
    extra = first.join(primary.select("id"), "id", "left_anti")
    return primary.unionByName(extra, allowMissingColumns=True)


def escalation_notices(changes: DataFrame, incidents: DataFrame) -> DataFrame:
    """Each escalation joined with its own incident, ready for a failure alert."""
    raised = changes.filter(F.col("escalated")).select(
        splittable("id").alias("_key"), F.col("escalated_at").alias("at"),
        F.col("resolution_notes").alias("escalation_notes"))
    owner = incidents.select(splittable("id").alias("_key"), "id", "incident_type", "severity", "summary")
    return raised.join(owner, "_key").drop("_key")
