"""Column expressions shared by batch and streaming: enrichment, flags, rates, text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from eventwarden import policies as P
from eventwarden.functions.literals import literal_map


# -- enrichment ---------------------------------------------------------------

def millis_to_timestamp(millis: str | Column) -> Column:
    """Epoch milliseconds to a timestamp, keeping the milliseconds."""
    return F.timestamp_millis(_col(millis))


def region_of(country: str | Column, mapping: Mapping[str, str] = P.REGION_BY_COUNTRY,
              default: str = P.DEFAULT_REGION) -> Column:
    """Region by country code; null and unmapped codes get ``default``."""
    return F.coalesce(F.try_element_at(literal_map(mapping), _col(country)), F.lit(default))


def email_domain(email: str | Column) -> Column:
    """Everything after the first ``@``; empty when there is none, null for null."""
    return F.regexp_extract(_col(email), "@(.+)", 1)


def age_days(as_of: str | Column, since: str | Column) -> Column:
    return F.datediff(_col(as_of), _col(since))


# -- flags --------------------------------------------------------------------

def is_late(processing: str | Column, event: str | Column,
            threshold_seconds: int = P.LATE_SECONDS) -> Column:
    """Strictly more than the threshold, in whole seconds; null counts as not late."""
    lag = F.unix_timestamp(_col(processing)) - F.unix_timestamp(_col(event))
    return F.coalesce(lag > threshold_seconds, F.lit(False))


def is_drifted(version: str | Column, current: int = 1) -> Column:
    return F.coalesce(_col(version) > current, F.lit(False))


def quality_flags(as_of: Column, email: str = "email", id_: str = "id",
                  event_time: str = "event_timestamp", plan: str = "plan",
                  plans: Sequence[str] = P.PLANS) -> dict[str, Column]:
    """The per-row checks; null inputs stay null and the verdict is a Kleene AND."""
    flags = {
        "dq_email_valid": F.col(email).rlike(P.EMAIL_PATTERN),
        "dq_id_not_null": F.col(id_).isNotNull(),
        "dq_timestamp_valid": F.col(event_time) <= as_of,
        "dq_plan_valid": F.col(plan).isin(list(plans)),
    }
    verdict = None
    for flag in flags.values():
        verdict = flag if verdict is None else verdict & flag
    return {**flags, "dq_passed": verdict}


# -- numbers ------------------------------------------------------------------

def rate(part: str | Column, whole: str | Column) -> Column:
    """``part / whole`` and 0 for an empty whole or a missing side."""
    return F.coalesce(F.try_divide(_col(part).cast("double"), _col(whole)), F.lit(0.0))


def clamp01(x: Column) -> Column:
    """Clamp to [0, 1]; null stays null, which least and greatest alone would skip."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def failed_share_severity(share: Column, gate: P.SuiteGate = P.SuiteGate()) -> Column:
    """Strictest threshold first: a share above 1 % is already critical.

    The middle and upper steps stay reachable when a gate orders them otherwise.
    """
    return (F.when(share > gate.critical, "critical")
            .when(share > gate.warning, "warning")
            .otherwise("acceptable"))


def alert_severity(percent: Column) -> Column:
    out = F
    for limit, name in P.ALERT_SEVERITIES:
        out = out.when(percent > limit, name)
    return out.otherwise("info")


# -- text ---------------------------------------------------------------------

def thousands(n: str | Column) -> Column:
    return F.format_number(_col(n), 0)


def percent_text(fraction: Column) -> Column:
    """``0.2`` as ``20.00%``."""
    return F.format_string("%.2f%%", fraction * 100)


def title_words(text: str | Column) -> Column:
    """``schema_drift`` as ``Schema Drift``."""
    return F.initcap(F.replace(_col(text), F.lit("_"), F.lit(" ")))


def lines(*parts: Column) -> Column:
    """Join the non-null parts, one per line."""
    return F.concat_ws("\n", *parts)


def map_lines(entries: Column) -> Column:
    """A map as indented ``key: value`` lines."""
    return F.array_join(
        F.transform(F.map_entries(entries), lambda e: F.concat(F.lit("  "), e.key, F.lit(": "), e.value)),
        "\n",
    )


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
