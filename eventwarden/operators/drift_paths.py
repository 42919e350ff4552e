"""Drift inside nested payloads: every field path with its type, against a contract of paths.

A payload collapses to its nested schema, one expression over the parsed value, and payloads of one schema are
counted with one of them as their specimen.  Only specimens are taken apart, level by level, so the explode sees a
few rows per schema and task, not one per record and field.  Paths are written ``a.b`` for a field of an
object and ``a[]`` for the elements of an array.

A path's type is the least upper bound of all it was seen with: a null says nothing, integers and numbers are numbers,
anything else that differs is mixed.  The elements of an array that is not of one type are mixed and not taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden.functions.literals import literal_map, literal_rows
from eventwarden.session import stage_table

CLASSES = {
    "STRING": "string", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "BOOLEAN": "boolean",
    "VOID": "null", "OBJECT": "object", "ARRAY": "array", "VARIANT": "mixed",
}
#: Levels of nesting that are taken apart; what lies deeper is reported as one path of type ``deep``.
DEPTH = 16


def nested_shape(raw: Column) -> Column:
    """The nested schema of a payload without the digits of its numbers; null where it cannot be read."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(raw)), r"DECIMAL\(\d+,\s*\d+\)", "DECIMAL")


def _class(value: Column) -> Column:
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(F.try_element_at(literal_map(CLASSES), name), F.lit("other"))


def join_classes(classes: Column) -> Column:
    """The least upper bound of a set of classes; null alone stays null."""
    known = F.array_distinct(F.filter(classes, lambda c: c != "null"))
    numbers = F.forall(known, lambda c: c.isin("integer", "number"))
    return (F.when(F.size(known) == 0, "null").when(F.size(known) == 1, F.element_at(known, 1))
            .when(numbers, "number").otherwise("mixed"))


def observed_paths(df: DataFrame, raw: str, by: list[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """(by, ``path``, ``class``, ``records``): in how many payloads a path is, and the type it has over them all."""
    by = by or []
    shapes = (df.select(*by, nested_shape(F.col(raw)).alias("shape"), F.col(raw).alias("raw"))
              .groupBy(*by, "shape").agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("specimen")))
    shapes = stage_table(shapes.filter(F.col("shape").isNotNull()), "shapes")
    level = shapes.select(*by, "shape", "n", F.lit("").alias("path"), F.try_parse_json("specimen").alias("v"))
    found = None
    for k in range(depth):
        kind = _class(F.col("v"))
        whole = level.withColumn("class", kind)
        fields = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))
        named = F.transform(fields, lambda e: F.struct(
            F.concat(F.col("path"), F.when(F.col("path") == "", "").otherwise("."), e["key"]).alias("path"), e["value"].alias("v")))
        items = F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda x: F.struct(F.concat(F.col("path"), F.lit("[]")).alias("path"), x.alias("v")))
        mixed = F.schema_of_variant("v").startswith("ARRAY<VARIANT")
        inside = F.when(F.col("class") == "object", named).when((F.col("class") == "array") & ~mixed, items)
        below = whole.select(*by, "shape", "n", F.explode(inside).alias("x")).select(*by, "shape", "n", "x.path", "x.v")
        odd = whole.filter((F.col("class") == "array") & mixed).select(
            *by, "shape", "n", F.concat("path", F.lit("[]")).alias("path"), F.lit("mixed").alias("class"))
        own = whole.filter(F.col("path") != "").select(
            *by, "shape", "n", "path", F.when(F.lit(k == depth - 1) & F.col("class").isin("object", "array"), "deep").otherwise(F.col("class")).alias("class"))
        part = own.unionByName(odd)
        found = part if found is None else found.unionByName(part)
        level = stage_table(below, "shape-level")
        if level.isEmpty():
            break
    per_shape = found.groupBy(*by, "shape", "path").agg(F.max("n").alias("n"), F.collect_set("class").alias("classes"))
    return per_shape.groupBy(*by, "path").agg(
        join_classes(F.flatten(F.collect_list("classes"))).alias("class"), F.sum("n").alias("records"))


def compare_paths(observed: DataFrame, by: list[str], contract: dict[str, tuple[str, bool]]) -> DataFrame:
    """Observed paths against ``contract`` (path to type and whether it is required): ok, new, missing or type_change.

    Every group of ``observed`` is held against the whole contract.  Where a path is missing, so are the paths inside
    it; they are reported each.
    """
    expected = literal_map({p: kind for p, (kind, _) in contract.items()})
    required = literal_map({p: str(need).lower() for p, (_, need) in contract.items()})
    marks = literal_rows(["path", "class", "records"], [(p, "null", ("0L",)) for p in contract])
    groups = observed.select(*by).distinct() if by else observed.sparkSession.range(1).select()
    markers = groups.select(*by, F.explode(marks).alias("m")).select(*by, "m.*")
    seen = observed.select(*by, "path", "class", "records").unionByName(markers).groupBy(*by, "path").agg(
        F.sum("records").alias("records"), join_classes(F.collect_list("class")).alias("class"))
    seen = seen.withColumn("expected", F.try_element_at(expected, "path"))
    status = (F.when(F.col("expected").isNull(), "new").when(F.col("records") == 0, "missing")
              .when(~F.col("class").isin("null") & (F.col("class") != F.col("expected"))
                    & ~((F.col("class") == "integer") & (F.col("expected") == "number")), "type_change").otherwise("ok"))
    return seen.select(*by, "path", status.alias("status"),
                       (F.coalesce(F.try_element_at(required, "path"), F.lit("false")) == "true").alias("required"),
                       "expected", F.col("class").alias("observed"), "records")
