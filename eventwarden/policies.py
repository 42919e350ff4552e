"""Domain constants and default policies.

All of these are plain data passed to operators as default arguments, so a
deployment can swap any of them without touching the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# The customer-event domain.
PLANS = ["free", "basic", "premium", "enterprise"]

COUNTRIES = [
    "US", "CA", "GB", "DE", "FR", "AU", "JP", "IN", "BR",
    "MX", "ES", "IT", "NL", "SE", "NO", "DK", "FI",
]

REGION_BY_COUNTRY = {
    "US": "North America",
    "CA": "North America",
    "MX": "North America",
    "GB": "Europe",
    "DE": "Europe",
    "FR": "Europe",
    "AU": "APAC",
    "JP": "APAC",
    "IN": "APAC",
    "BR": "South America",
}
DEFAULT_REGION = "Other"

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Business field name -> technical column name.
BUSINESS_FIELDS = {
    "customer_id": "id",
    "customer_email": "email",
    "subscription_plan": "plan",
    "registration_date": "signup_ts",
    "event_timestamp": "event_ts",
    "customer_name": "name",
    "customer_country": "country",
    "schema_version": "version",
}

# Stream settings.
WATERMARK_DELAY = "15 minutes"
LATE_SECONDS = 15 * 60
CURATED_TRIGGER = "30 seconds"
WAREHOUSE_TRIGGER = "60 seconds"
REPORT_WINDOW = "5 minutes"
RETENTION_DAYS = 7
INCIDENT_LOOKBACK_DAYS = 7
INCIDENT_STATS_DAYS = 30
DECISION_WINDOW_RUNS = 10
SAMPLE_LIMIT = 50


@dataclass(frozen=True)
class DecisionPolicy:
    """Thresholds of the rule engine (rates are fractions of a run's rows)."""

    late_rate: float = 0.15
    dq_rate: float = 0.05
    critical_rate: float = 0.10
    streak: int = 3
    min_confidence: float = 0.7
    rule_confidence: float = 0.8
    auto_remap: bool = True
    drift_action: str = "remap"  # remap | quarantine | escalate
    localised_share: float = 0.5


@dataclass(frozen=True)
class SuiteGate:
    """Suite-level gate and severity thresholds (fractions)."""

    max_failed_share: float = 0.10
    critical: float = 0.01
    warning: float = 0.05
    acceptable: float = 0.10


# Alert severity by failure rate in percent, first match wins.
ALERT_SEVERITIES = [(10, "critical"), (5, "error"), (1, "warning")]
ALERT_CHANNELS = ["slack", "email"]

# Remediation actions and the result text each one reports.
KNOWN_TOOLS = [
    "retrigger_task",
    "apply_schema_remap",
    "quarantine_records",
    "notify_ops",
    "escalate_incident",
]


@dataclass(frozen=True)
class Expectation:
    """One declared check: a type name plus its arguments."""

    type: str
    kwargs: dict[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str:
        if "column" in self.kwargs:
            return self.kwargs["column"]
        return f"{self.kwargs['column_A']},{self.kwargs['column_B']}"


# Parameters bound into a suite before it is compiled.
SUITE_PARAMETERS = {"max_event_delay_hours": 24, "min_signup_date": "2020-01-01"}

# The customer suite, in declaration order.
CUSTOMER_SUITE = [
    Expectation("expect_column_to_exist", {"column": "id"}),
    Expectation("expect_column_values_to_not_be_null", {"column": "id"}),
    Expectation("expect_column_values_to_be_unique", {"column": "id"}),
    Expectation("expect_column_to_exist", {"column": "email"}),
    Expectation("expect_column_values_to_not_be_null", {"column": "email"}),
    Expectation("expect_column_values_to_match_regex",
                {"column": "email", "regex": EMAIL_PATTERN}),
    Expectation("expect_column_values_to_be_in_set",
                {"column": "plan", "value_set": PLANS}),
    Expectation("expect_column_values_to_be_of_type",
                {"column": "signup_timestamp", "type_": "datetime64[ns]"}),
    Expectation("expect_column_values_to_be_between",
                {"column": "signup_timestamp", "min_value": "2020-01-01T00:00:00",
                 "max_value": None, "parse_strings_as_datetimes": True}),
    Expectation("expect_column_values_to_be_of_type",
                {"column": "event_timestamp", "type_": "datetime64[ns]"}),
    Expectation("expect_column_pair_values_A_to_be_greater_than_or_equal_to_B",
                {"column_A": "event_timestamp", "column_B": "signup_timestamp"}),
    Expectation("expect_column_values_to_be_between",
                {"column": "event_timestamp", "min_value": None,
                 "max_value": None, "parse_strings_as_datetimes": True}),
    Expectation("expect_column_values_to_be_in_set",
                {"column": "country", "value_set": COUNTRIES}),
    Expectation("expect_column_values_to_not_be_null", {"column": "name"}),
    Expectation("expect_column_values_to_be_between",
                {"column": "version", "min_value": 1, "max_value": 10}),
]

ORDER_SUITE = [
    Expectation("expect_column_values_to_be_between", {"column": "amount", "min_value": 0}),
]

# Quality dimensions and the checks of the customer suite that measure them; the event time's bounds measure two.
QUALITY_DIMENSIONS = [
    ("completeness", "expect_column_values_to_not_be_null", "id"),
    ("completeness", "expect_column_values_to_not_be_null", "email"),
    ("completeness", "expect_column_values_to_not_be_null", "name"),
    ("validity", "expect_column_values_to_match_regex", "email"),
    ("validity", "expect_column_values_to_be_in_set", "plan"),
    ("validity", "expect_column_values_to_be_between", "signup_timestamp"),
    ("validity", "expect_column_values_to_be_between", "event_timestamp"),
    ("consistency", "expect_column_pair_values_A_to_be_greater_than_or_equal_to_B",
     "event_timestamp,signup_timestamp"),
    ("timeliness", "expect_column_values_to_be_between", "event_timestamp"),
    ("uniqueness", "expect_column_values_to_be_unique", "id"),
]

# Business rule category, rule, check type; the column is ours.
BUSINESS_RULES = [
    ("customer_identification", "id_not_null", "expect_column_values_to_not_be_null", "id"),
    ("customer_identification", "id_unique", "expect_column_values_to_be_unique", "id"),
    ("customer_identification", "email_not_null", "expect_column_values_to_not_be_null", "email"),
    ("customer_identification", "email_valid", "expect_column_values_to_match_regex", "email"),
    ("subscription_integrity", "plan_valid", "expect_column_values_to_be_in_set", "plan"),
    ("subscription_integrity", "signup_date_valid", "expect_column_values_to_be_between",
     "signup_timestamp"),
    ("temporal_consistency", "event_after_signup",
     "expect_column_pair_values_A_to_be_greater_than_or_equal_to_B",
     "event_timestamp,signup_timestamp"),
    ("temporal_consistency", "recent_events", "expect_column_values_to_be_between",
     "event_timestamp"),
    ("geographic_validity", "country_code_valid", "expect_column_values_to_be_in_set", "country"),
]
