"""Alert rows for an outbox table; delivery is somebody else's job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X


def _alert(kind: str, title: Column, message: Column, severity: Column) -> list[Column]:
    return [F.lit(kind).alias("alert_type"), title.alias("title"),
            message.alias("message"), severity.alias("severity")]


def quality_alerts(df: DataFrame, key: list[str], issue_type: Column, affected: Column,
                   total: Column, details: Column | None = None) -> DataFrame:
    """Data-quality alert; severity steps at 10, 5 and 1 percent."""
    percent = X.rate(affected, total) * 100
    message = X.lines(
        F.concat(F.lit("Issue Type: "), issue_type),
        F.concat(F.lit("Affected Records: "), X.thousands(affected), F.lit(" out of "), X.thousands(total)),
        F.concat(F.lit("Failure Rate: "), F.format_string("%.2f%%", percent)),
        *([] if details is None else [F.concat(F.lit("Details: "), details)]),
    )
    title = F.concat(F.lit("Data Quality Issue - "), X.title_words(issue_type))
    return df.select(*key, *_alert("data_quality", title, message, X.alert_severity(percent)))


def drift_alerts(drift: DataFrame, key: list[str], version: Column | None = None) -> DataFrame:
    """Schema-drift alert for every group that drifted; empty parts leave no line."""
    def part(label: str, fields: str) -> Column:
        return F.when(F.size(fields) > 0,
                      F.concat(F.lit(f"{label}: "), F.array_join(fields, ", ")))

    message = X.lines(
        F.lit("Schema evolution detected in incoming data:"),
        part("New Fields", "new_fields"),
        part("Removed Fields", "removed_fields"),
        part("Type Changes", "type_changes"),
        *([] if version is None else [F.concat(F.lit("Schema Version: "), version.cast("string"))]),
    )
    return (drift.filter(F.col("drift_class") != "none")
            .select(*key, *_alert("schema_drift", F.lit("Schema Drift Detected"), message,
                                  F.lit("warning"))))


def failure_alerts(df: DataFrame, key: list[str], error: Column, component: Column,
                   context: Column | None = None) -> DataFrame:
    """Failure alert with an optional context map, one indented line per entry."""
    extra = []
    if context is not None:
        filled = F.map_filter(context, lambda _, v: v.isNotNull())
        extra = [F.when(F.size(filled) > 0,
                        F.concat(F.lit("Additional Context:\n"), X.map_lines(filled)))]
    message = X.lines(F.concat(F.lit("Component: "), component),
                      F.concat(F.lit("Error: "), error), *extra)
    title = F.concat(F.lit("Pipeline Failure - "), X.title_words(component))
    return df.select(*key, *_alert("pipeline_failure", title, message, F.lit("error")))


def status_alerts(decisions: DataFrame, key: list[str]) -> DataFrame:
    """The status note every rule decision sends."""
    message = F.concat(F.lit("Pipeline status: "), F.col("reasoning"))
    severity = F.when(F.col("escalation_required"), "warning").otherwise("info")
    return decisions.select(*key, *_alert("status", F.lit("Data Pipeline Alert"), message, severity))


def fan_out(alerts: DataFrame, channels: list[str] = P.ALERT_CHANNELS) -> DataFrame:
    """One outbox row per alert and channel."""
    return alerts.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels])))
