"""Declared record shapes."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from eventwarden import policies as P

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
BOOL, DOUBLE, TS = T.BooleanType(), T.DoubleType(), T.TimestampType()


def struct(*fields: tuple) -> T.StructType:
    """``(name, type)`` is nullable, ``(name, type, False)`` is required."""
    return T.StructType([T.StructField(*f) for f in fields])


CUSTOMER_EVENT = struct(
    ("id", STRING, False),
    ("name", STRING),
    ("email", STRING, False),
    ("signup_ts", LONG, False),
    ("country", STRING),
    ("plan", STRING),
    ("event_ts", LONG, False),
    ("version", INT),
    ("marketing_opt_in", BOOL),
    ("customer_segment", STRING),
)

# The contract before versions 2 and 3 added their nullable fields.
CUSTOMER_EVENT_V1 = T.StructType(CUSTOMER_EVENT.fields[:8])

ORDER_EVENT = struct(
    ("event", STRING), ("order_id", STRING), ("amount", DOUBLE), ("ts", LONG),
)

RUN_REPORT = struct(
    ("run_id", LONG),
    ("total_records", LONG),
    ("late_records", LONG),
    ("dq_failures", LONG),
    ("dq_unknown", LONG),
    ("schema_drift_count", LONG),
    ("schema_drift_detected", BOOL),
    ("processing_errors", LONG),
    ("start_time", TS),
    ("end_time", TS),
    ("watermark_delay", STRING),
)

# A validation document as external tools write it: one per run.
DQ_DOCUMENT = struct(
    ("run_id", LONG),
    ("timestamp", STRING),
    ("status", STRING),
    ("summary", struct(
        ("total_expectations", LONG),
        ("success_count", LONG),
        ("failure_count", LONG),
        ("overall_success_rate", DOUBLE),
    )),
)

INCIDENT = struct(
    ("id", STRING),
    ("incident_type", STRING),
    ("summary", STRING),
    ("context", STRING),
    ("severity", STRING),
    ("status", STRING),
    ("created_at", TS),
    ("updated_at", TS),
    ("resolved_at", TS),
    ("escalated", BOOL),
    ("escalated_at", TS),
    ("resolution_notes", STRING),
    ("created_by", STRING),
)

# One row per change; unset attributes are null and leave the state untouched.
INCIDENT_CHANGE = T.StructType(
    [T.StructField("change_at", TS), T.StructField("change_seq", INT)] + INCIDENT.fields
)

SUITE_DOCUMENT = struct(
    ("expectation_suite_name", STRING),
    ("expectations", T.ArrayType(struct(
        ("expectation_type", STRING),
        ("kwargs", T.VariantType()),
        ("meta", T.VariantType()),
    ))),
)


def avro_schema(contract: T.StructType = CUSTOMER_EVENT, record: str = "CustomerEvent") -> str:
    """Avro record schema of a contract; nullable additions become null unions."""
    names = {"string": "string", "bigint": "long", "int": "int",
             "boolean": "boolean", "double": "double"}
    fields = []
    for f in contract.fields:
        kind = names[f.dataType.simpleString()]
        if f.name == "plan":  # on the wire an enum's value is its place among the symbols
            kind = {"type": "enum", "name": "SubscriptionPlan", "symbols": list(P.PLANS)}
        if f.name not in CUSTOMER_EVENT_V1.fieldNames():
            fields.append({"name": f.name, "type": ["null", kind], "default": None})
        else:
            fields.append({"name": f.name, "type": kind})
    return json.dumps({"type": "record", "name": record, "fields": fields})
