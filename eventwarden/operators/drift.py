"""Schema drift: what was actually sent, compared with a declared contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventwarden import policies as P
from eventwarden.functions.literals import literal_map, literal_rows
from eventwarden.schemas import CUSTOMER_EVENT_V1

# Variant type name (up to its parameters) -> class of the contract.
VARIANT_CLASSES = {
    "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number",
    "STRING": "string", "BOOLEAN": "boolean", "VOID": "null",
    "OBJECT": "object", "ARRAY": "array",
}


def contract_class(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return "integer"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "number"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    return "string"


def payload_shape(raw: Column) -> Column:
    """Top-level ``(field, type)`` pairs of a JSON object; null for anything else.

    Types are variant type names without parameters: a shape must not differ by
    the digits of a number or the inside of a nested value.
    """
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    base = lambda t: F.substring_index(F.substring_index(t, "(", 1), "<", 1)
    return F.transform(F.map_entries(fields), lambda e: F.struct(
        e.key.alias("field"), base(F.schema_of_variant(e.value)).alias("type")))


def _class_of(type_name: str) -> Column:
    return F.coalesce(F.try_element_at(literal_map(VARIANT_CLASSES), type_name), F.lit("other"))


def payload_shapes(df: DataFrame, raw: str, by: list[str] | None = None) -> DataFrame:
    """Distinct payload shapes with their record counts; shape is null for non-objects.

    Variant objects keep their keys sorted, so equal field sets give equal
    shapes.  Unreadable records are grouped rather than filtered: a filter on
    the shape would be pushed below the aggregation and parse every payload twice.
    """
    by = by or []
    return (df.select(*by, payload_shape(F.col(raw)).alias("shape"))
            .groupBy(*by, "shape").agg(F.count(F.lit(1)).alias("n")))


def observed_fields(df: DataFrame, raw: str, by: list[str] | None = None) -> DataFrame:
    """Field, class and record count, per ``by`` group.

    Records collapse to their distinct shapes before the fields are exploded, so
    the explode sees one row per shape and task, not one per record and field.
    """
    by = by or []
    fields = F.transform("shape", lambda f: f)  # an expression: explode infers no filter from it
    return (payload_shapes(df, raw, by).select(*by, "n", F.explode(fields).alias("f"))
            .groupBy(*by, "f.field", _class_of("f.type").alias("class"))
            .agg(F.sum("n").alias("records")))


def compare_fields(df: DataFrame, raw: str, by: list[str] | None = None,
                   contract: T.StructType = CUSTOMER_EVENT_V1) -> DataFrame:
    """Observed fields against the contract, per group: ok, new, missing or type_change.

    Every shape contributes its own fields plus one zero-count marker per
    contract field, so a single aggregation answers the full outer comparison;
    neither the payloads nor the groups are read a second time.  A field that
    was only ever null is evidence of presence, not of a type.  In a group
    without one readable payload every field of the contract is missing.
    """
    by = by or []
    markers = literal_rows(["field", "type", "n"], [(f.name, "VOID", ("0L",)) for f in contract.fields])
    expected = literal_map({f.name: contract_class(f.dataType) for f in contract.fields})
    required = [f.name for f in contract.fields if not f.nullable]
    own = F.transform("shape", lambda f: F.struct(f["field"].alias("field"), f["type"].alias("type"),
                                                  F.col("n").alias("n")))
    seen = (payload_shapes(df, raw, by)
            .select(*by, F.explode(F.when(F.col("shape").isNull(), markers).otherwise(F.concat(own, markers))).alias("f"))
            .select(*by, "f.field", "f.n", _class_of("f.type").alias("class"))
            .groupBy(*by, "field")
            .agg(F.sum("n").alias("records"),
                 F.array_sort(F.collect_set(F.when(F.col("class") != "null", F.col("class"))))
                 .alias("classes"))
            .withColumn("expected", F.try_element_at(expected, "field")))
    status = (F.when(F.col("expected").isNull(), "new")
              .when(F.col("records") == 0, "missing")
              .when(F.exists("classes", lambda c: c != F.col("expected")), "type_change")
              .otherwise("ok"))
    return seen.select(*by, "field", status.alias("status"),
                       F.col("field").isin(required).alias("required"), "expected",
                       F.array_join("classes", ",").alias("observed"), "records")


def missing_and_new(left: DataFrame, right: DataFrame, key: str = "field") -> tuple[DataFrame, DataFrame]:
    """Field-set difference both ways, as two anti joins."""
    return (left.select(key).distinct().join(right.select(key), key, "left_anti"),
            right.select(key).distinct().join(left.select(key), key, "left_anti"))


def drift_class(compared: DataFrame, by: list[str]) -> DataFrame:
    """Breaking, additive or none per group, with the fields behind it."""
    def fields(status: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("status") == status, F.col("field"))))

    agg = compared.groupBy(*by).agg(
        fields("new").alias("new_fields"),
        fields("missing").alias("removed_fields"),
        fields("type_change").alias("type_changes"),
        F.coalesce(F.bool_or((F.col("status") == "missing") & F.col("required")), F.lit(False))
        .alias("required_missing"),
    )
    breaking = F.col("required_missing") | (F.size("type_changes") > 0)
    additive = (F.size("new_fields") > 0) | (F.size("removed_fields") > 0)
    return agg.withColumn(
        "drift_class", F.when(breaking, "breaking").when(additive, "additive").otherwise("none"))


def drift_action(drift_class_: Column, policy: P.DecisionPolicy = P.DecisionPolicy()) -> Column:
    """What to do about a drift class: remap additive drift, never breaking drift.

    A policy of ``quarantine`` or ``escalate`` overrides the automatic remap.
    """
    additive = ("escalate" if policy.drift_action == "remap" and not policy.auto_remap
                else policy.drift_action)
    return (F.when(drift_class_ == "breaking", "quarantine_and_escalate")
            .when(drift_class_ == "additive", additive)
            .otherwise("none"))
