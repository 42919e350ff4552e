"""Enrichment and flags over a flattened event frame, as one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X


def with_timestamps(df: DataFrame, processing: Column | None = None) -> DataFrame:
    """Add the signup, event and processing timestamps.

    ``processing`` is the processing clock; it defaults to the query's own
    start time, which Structured Streaming fixes per micro-batch.
    """
    return df.withColumns({
        "signup_timestamp": X.millis_to_timestamp("signup_ts"),
        "event_timestamp": X.millis_to_timestamp("event_ts"),
        "processing_timestamp": F.current_timestamp() if processing is None else processing,
    })


def enrich(df: DataFrame, processing: Column | None = None) -> DataFrame:
    """Timestamps, region, email domain and customer age."""
    return with_timestamps(df, processing).withColumns({
        "region": X.region_of("country"),
        "email_domain": X.email_domain("email"),
        "customer_age_days": X.age_days("processing_timestamp", "signup_timestamp"),
    })


def with_flags(df: DataFrame, late_seconds: int = P.LATE_SECONDS) -> DataFrame:
    """Drift, late and quality flags over an enriched frame."""
    return df.withColumns({
        "schema_drift_detected": X.is_drifted("version"),
        "is_late_arrival": X.is_late("processing_timestamp", "event_timestamp", late_seconds),
        **X.quality_flags(F.col("processing_timestamp")),
    })


def curate(df: DataFrame, processing: Column | None = None) -> DataFrame:
    """The whole per-row chain: enrich, then flag."""
    return with_flags(enrich(df, processing))


def join_region(df: DataFrame, regions: DataFrame, default: str = P.DEFAULT_REGION) -> DataFrame:
    """Region by dimension table (``country``, ``region``) instead of a literal map.

    No broadcast hint: the planner broadcasts the dimension while its size is
    under the threshold and shuffles it once it has outgrown that.
    """
    return (df.join(regions, "country", "left")
            .withColumn("region", F.coalesce("region", F.lit(default))))


def rename_to_technical(df: DataFrame, names: dict[str, str] = P.BUSINESS_FIELDS) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_to_business(df: DataFrame, names: dict[str, str] = P.BUSINESS_FIELDS) -> DataFrame:
    return df.withColumnsRenamed({technical: business for business, technical in names.items()})
