"""Run reports and segment reports over flagged events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X
from eventwarden.operators.running import islands


EVENT_MEASURES = [
    "count(1) AS total_records",
    "count_if(is_late_arrival) AS late_records",
    "count_if(NOT dq_passed) AS dq_failures",
    "count_if(dq_passed IS NULL) AS dq_unknown",
    "count_if(schema_drift_detected) AS schema_drift_count",
]


def report_measures(error: Column | None = None) -> list[Column]:
    """The report's aggregates; every one combines map-side."""
    errors = F.expr("0L") if error is None else F.count_if(error)
    return [F.expr(m) for m in EVENT_MEASURES] + [
        F.expr("count_if(schema_drift_detected) > 0 AS schema_drift_detected"),
        errors.alias("processing_errors"),
        F.expr("min(processing_timestamp) AS start_time"),
        F.expr("max(processing_timestamp) AS end_time"),
        F.lit(P.WATERMARK_DELAY).alias("watermark_delay"),
    ]


def run_report(flagged: DataFrame, by: list[str] | None = None,
               error: Column | None = None) -> DataFrame:
    return flagged.groupBy(*(["run_id"] if by is None else by)).agg(*report_measures(error))


def run_rates(reports: DataFrame, policy: P.DecisionPolicy = P.DecisionPolicy()) -> DataFrame:
    """Rates per run and the threshold verdicts on them."""
    late, dq = X.rate("late_records", "total_records"), X.rate("dq_failures", "total_records")
    return reports.withColumns({
        "late_rate": late,
        "dq_failure_rate": dq,
        "error_rate": X.rate("processing_errors", "total_records"),
        "late_exceeded": late > policy.late_rate,
        "dq_exceeded": dq > policy.dq_rate,
        "is_critical": dq > policy.critical_rate,
    })


def _segments(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Rows and failures of each (country, plan): all the segment reports need of the events."""
    return flagged.groupBy(*by, "country", "plan").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~F.col("dq_passed")).alias("dq_failures"))


def failure_by_segment(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Quality failures overall, by country, by plan and by both.

    The grouping sets expand the finest segments, not the events.  ``segment``
    tells a rolled-up null from a null in the data.
    """
    by = by or []
    sets = _segments(flagged, by).groupingSets(
        [[*by], [*by, "country"], [*by, "plan"], [*by, "country", "plan"]],
        *by, "country", "plan",
    ).agg(
        (F.grouping("country") * 2 + F.grouping("plan")).cast("int").alias("_level"),
        F.sum("total_records").alias("total_records"),
        F.sum("dq_failures").alias("dq_failures"),
    )
    level = (F.when(F.col("_level") == 3, "all").when(F.col("_level") == 1, "country")
             .when(F.col("_level") == 2, "plan").otherwise("country_plan"))
    return sets.select(*by, level.alias("segment"), "country", "plan",
                       "total_records", "dq_failures",
                       X.rate("dq_failures", "total_records").alias("failure_rate"))


def failure_shares(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Each (country, plan) segment's share of its run's failures.

    The run totals come from the segment counts, in a window over the few
    segments of a run; the events are aggregated once.
    """
    run_failures = F.sum("dq_failures").over(Window.partitionBy(*by))
    return (_segments(flagged, by)
            .select(*by, "country", "plan", F.col("dq_failures").alias("segment_failures"),
                    run_failures.alias("run_failures"))
            .withColumn("failure_share", X.rate("segment_failures", "run_failures")))


def worst_segments(flagged: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` country/plan segments with the most failures."""
    return (_segments(flagged, [])
            .orderBy(F.desc("dq_failures"), F.asc_nulls_first("country"), F.asc_nulls_first("plan"))
            .limit(k))


def anomaly_counters(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Late, drifted and incomplete events with their rates."""
    counts = flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_late_arrival").alias("late_events"),
        F.count_if("schema_drift_detected").alias("schema_drift_events"),
        F.count_if(F.col("country").isNull() | F.col("plan").isNull()).alias("missing_field_events"),
    )
    return counts.withColumns({
        f"{name}_rate": X.rate(f"{name}_events", "total_events")
        for name in ("late", "schema_drift", "missing_field")
    })


def version_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("version").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("schema_drift_detected").alias("drifted_events"),
    )


def latest_run(reports: DataFrame) -> DataFrame:
    """The newest run as one row; a single aggregate, no sort."""
    row = F.struct(*reports.columns)
    return (reports.agg(F.max_by(row, F.struct("end_time", "run_id")).alias("r"))
            .filter(F.col("r").isNotNull()).select("r.*"))


def windowed_report(flagged: DataFrame, width: str = P.REPORT_WINDOW) -> DataFrame:
    """The run report per tumbling event-time window; valid on batch and streams."""
    return (flagged.groupBy(F.window("event_timestamp", width).alias("w"))
            .agg(*[F.expr(m) for m in EVENT_MEASURES])
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "total_records", "late_records", "dq_failures", "dq_unknown",
                    "schema_drift_count"))


def offset_audit(envelope: DataFrame) -> DataFrame:
    """Offset range, gaps and repeats per source partition; a record delivered again fills no gap."""
    once = envelope.groupBy("kafka_partition", "kafka_offset").agg(F.count(F.lit(1)).alias("_n"))
    return (once.groupBy("kafka_partition")
            .agg(F.min("kafka_offset").alias("min_offset"),
                 F.max("kafka_offset").alias("max_offset"),
                 F.sum("_n").alias("messages"), F.count("kafka_offset").alias("_offsets"))
            .withColumn("redelivered", F.col("messages") - F.col("_offsets"))
            .withColumn("missing_offsets", F.col("max_offset") - F.col("min_offset") + 1 - F.col("_offsets"))
            .drop("_offsets"))


def offset_gaps(envelope: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every missing stretch of offsets as (partition, first, last, size).

    Partitions of the source are cut by ranges of offsets, so one with most of the records is many tasks.
    """
    holes = islands(envelope, ["kafka_partition"], "kafka_offset", ranges)
    return holes.select("kafka_partition", F.col("first").alias("first_missing"), F.col("last").alias("last_missing"),
                        (F.col("last") - F.col("first") + 1).alias("missing"))
