"""Declarative expectation suites, compiled into as few passes as possible.

All value checks of a suite become conditional counts of one aggregate.  Only
uniqueness needs its own shuffle, on a narrow (batch, value) projection, and it
is pre-aggregated per task so that a hot value costs one row per task.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from eventwarden import policies as P
from eventwarden.functions import columns as X
from eventwarden.functions.literals import literal_map, literal_rows, sql_literal
from eventwarden.operators.skew import splittable
from eventwarden.policies import Expectation

# Type names that a suite may use -> Spark type names.
TYPE_ALIASES = {
    "datetime64[ns]": "timestamp", "TimestampType": "timestamp",
    "str": "string", "object": "string", "StringType": "string",
    "int": "int", "IntegerType": "int", "int64": "bigint", "LongType": "bigint",
    "float": "double", "float64": "double", "DoubleType": "double",
    "bool": "boolean", "BooleanType": "boolean",
}

UNIQUE = "expect_column_values_to_be_unique"
EXISTS = "expect_column_to_exist"
OF_TYPE = "expect_column_values_to_be_of_type"
PAIRS = (
    "expect_column_pair_values_A_to_be_greater_than_or_equal_to_B",
    "expect_column_pair_values_A_to_be_greater_than_B",
)


@dataclass(frozen=True)
class Check:
    """A compiled expectation."""

    position: int
    type: str
    column: str
    kind: str  # schema | value | unique
    holds: bool | None = None          # schema checks: the answer
    missing: Column | None = None      # value checks: not judged
    unexpected: Column | None = None   # value checks: judged and failed
    value: Column | None = None        # the offending value as text


def compile_suite(suite: Sequence[Expectation], schema: T.StructType, as_of: Column,
                  params: dict[str, Any] | None = None) -> list[Check]:
    """Bind parameters and ``as_of`` and turn each expectation into a check.

    A check on a column that does not exist, or a date bound on a column that
    holds no time, fails as a schema check, the way a caught exception would,
    instead of failing the whole suite.
    """
    params = {**P.SUITE_PARAMETERS, **(params or {})}
    return [_compile(i, e, schema, as_of, params) for i, e in enumerate(suite)]


def _compile(i: int, e: Expectation, schema: T.StructType, as_of: Column,
             params: dict[str, Any]) -> Check:
    names = schema.fieldNames()
    kw = e.kwargs
    if e.type == EXISTS:
        return Check(i, e.type, e.column, "schema", holds=kw["column"] in names)
    used = e.column.split(",")
    if any(c not in names for c in used):
        return Check(i, e.type, e.column, "schema", holds=False)
    if e.type == OF_TYPE:
        want = TYPE_ALIASES.get(kw["type_"], kw["type_"])
        return Check(i, e.type, e.column, "schema",
                     holds=schema[kw["column"]].dataType.simpleString() == want)
    if e.type in PAIRS:
        a, b = F.col(kw["column_A"]), F.col(kw["column_B"])
        or_equal = e.type == PAIRS[0] or kw.get("or_equal", False)
        return Check(i, e.type, e.column, "value", missing=a.isNull() | b.isNull(),
                     unexpected=(a < b) if or_equal else (a <= b),
                     value=F.concat_ws(",", a.cast("string"), b.cast("string")))

    c = F.col(kw["column"])
    text = c.cast("string")
    if e.type == UNIQUE:
        return Check(i, e.type, e.column, "unique", missing=c.isNull(), value=text)
    if e.type == "expect_column_values_to_not_be_null":
        return Check(i, e.type, e.column, "value", missing=F.lit(False),
                     unexpected=c.isNull(), value=text)
    if e.type == "expect_column_values_to_match_regex":
        bad = ~c.rlike(kw["regex"])
    elif e.type == "expect_column_values_to_be_in_set":
        bad = ~c.isin(list(kw["value_set"]))
    elif e.type == "expect_column_values_to_be_between":
        judged = _as_time(c, schema[kw["column"]].dataType) if kw.get("parse_strings_as_datetimes") else c
        if judged is None:
            return Check(i, e.type, e.column, "schema", holds=False)
        # what cannot be read as a time is not between the bounds
        bad = F.coalesce(_outside(judged, kw, as_of, params), c.isNotNull())
    else:
        raise ValueError(f"unknown expectation type: {e.type}")
    return Check(i, e.type, e.column, "value", missing=c.isNull(), unexpected=bad, value=text)


def _as_time(c: Column, kind: T.DataType) -> Column | None:
    """A column as a time: whole numbers are epoch milliseconds; None for types that hold no time."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c
    if isinstance(kind, T.IntegralType):
        return F.timestamp_millis(c.cast("long"))
    return c.try_cast("timestamp") if isinstance(kind, T.StringType) else None


def _outside(c: Column, kw: dict[str, Any], as_of: Column, params: dict[str, Any]) -> Column:
    """Out of bounds.  Open date bounds are relative to ``as_of``: an open upper
    bound is ``as_of`` itself, and fully open bounds mean the freshness window."""
    low, high = kw.get("min_value"), kw.get("max_value")
    if kw.get("parse_strings_as_datetimes"):
        hours = params["max_event_delay_hours"]
        if low is None and high is None:
            low_c = as_of - F.expr(f"INTERVAL '{int(hours)}' HOUR")
        else:
            low_c = None if low is None else F.lit(low).cast("timestamp")
        high_c = as_of if high is None else F.lit(high).cast("timestamp")
    else:
        low_c = None if low is None else F.lit(low)
        high_c = None if high is None else F.lit(high)
    bad = F.lit(False)
    if low_c is not None:
        bad = bad | (c < low_c)
    if high_c is not None:
        bad = bad | (c > high_c)
    return bad


def run_suite(df: DataFrame, suite: Sequence[Expectation], as_of: Column, batch: str,
              params: dict[str, Any] | None = None) -> DataFrame:
    """One result row per batch and expectation.

    Value and schema checks come from a single aggregate of the frame, all
    uniqueness checks together from one more pass over their columns.
    """
    checks = compile_suite(suite, df.schema, as_of, params)
    plain = [c for c in checks if c.kind != "unique"]
    out = None
    if plain:
        aggs = [F.count(F.lit(1)).alias("element_count")]
        for c in plain:
            if c.kind == "value":
                aggs += [F.count_if(c.missing).alias(f"_m{c.position}"),
                         F.count_if(c.unexpected).alias(f"_u{c.position}")]
        rows = literal_rows(RESULT_NAMES, [_result_row(c) for c in plain])
        out = (df.groupBy(batch).agg(*aggs)
               .select(batch, F.explode(rows).alias("r")).select(batch, "r.*"))
    unique = [c for c in checks if c.kind == "unique"]
    if unique:
        part = _unique_results(df, unique, batch)
        out = part if out is None else out.unionByName(part)
    return _finish(out, batch)


RESULT_NAMES = ["position", "expectation_type", "column_name", "success",
                "element_count", "missing_count", "unexpected_count"]


def _result_row(c: Check) -> tuple:
    """Result of a schema check, or the aggregates that hold a value check's result."""
    if c.kind == "schema":
        none = ("CAST(NULL AS BIGINT)",)
        return (c.position, c.type, c.column, c.holds, none, none, none)
    return (c.position, c.type, c.column, (f"_u{c.position} = 0",),
            ("element_count",), (f"_m{c.position}",), (f"_u{c.position}",))


def value_text(df: DataFrame, column: str) -> Column:
    """A value as text that is equal where the values are: a negative zero is a zero."""
    floating = df.schema[column].dataType.simpleString() in ("double", "float")
    return (F.col(column) + F.lit(0.0) if floating else F.col(column)).cast("string")


def value_counts(df: DataFrame, checks: Sequence[Check], batch: str) -> DataFrame:
    """Rows per (batch, check, value): the only high-cardinality shuffle of a suite, and one for all its checks."""
    pairs = F.array(*[F.struct(F.lit(c.position).alias("position"), value_text(df, c.column).alias("value")) for c in checks])
    return (df.select(batch, F.explode(pairs).alias("p"))
            .groupBy(batch, F.col("p.position").alias("position"), F.col("p.value").alias("_value"))
            .agg(F.count(F.lit(1)).alias("_n")))


def _unique_results(df: DataFrame, checks: Sequence[Check], batch: str) -> DataFrame:
    judged = F.col("_value").isNotNull()
    zero = F.lit(0).cast("bigint")
    sums = value_counts(df, checks, batch).groupBy(batch, "position").agg(
        F.sum("_n").alias("element_count"),
        F.sum(F.when(~judged, F.col("_n")).otherwise(zero)).alias("missing_count"),
        F.sum(F.when(judged & (F.col("_n") > 1), F.col("_n")).otherwise(zero)).alias("unexpected_count"),
    )
    column = literal_map({str(c.position): c.column for c in checks})
    return sums.select(batch, "position", F.lit(checks[0].type).alias("expectation_type"),
                       F.element_at(column, F.col("position").cast("string")).alias("column_name"),
                       (F.col("unexpected_count") == 0).alias("success"),
                       "element_count", "missing_count", "unexpected_count")


def _finish(results: DataFrame, batch: str) -> DataFrame:
    def percent(part: str, whole: Column) -> Column:
        return F.when(F.col("element_count").isNotNull(), X.rate(part, whole) * 100)

    judged = F.col("element_count") - F.col("missing_count")
    return results.withColumns({
        "missing_percent": percent("missing_count", F.col("element_count")),
        "unexpected_percent": percent("unexpected_count", judged),
        "unexpected_percent_total": percent("unexpected_count", F.col("element_count")),
    })


def failed_rows(df: DataFrame, suite: Sequence[Expectation], as_of: Column, keys: list[str],
                params: dict[str, Any] | None = None) -> DataFrame:
    """Key columns of every failing row, once per failed value check.

    A map-side projection without a shuffle, compiled as a whole: the checks are
    plain columns and the array is exploded with its gaps, which the last filter
    drops.  Array functions would be interpreted, and an earlier filter would be
    pushed below the projection and evaluate every check twice.
    """
    checks = [c for c in compile_suite(suite, df.schema, as_of, params) if c.kind == "value"]
    judged = df.select(*keys, *[
        col for c in checks for col in (
            c.unexpected.alias(f"_u{c.position}"),
            F.when(c.unexpected, c.value).alias(f"_v{c.position}"))])
    failed = "array(" + ", ".join(
        f"CASE WHEN _u{c.position} THEN named_struct('position', {c.position}, 'expectation_type', "
        f"{sql_literal(c.type)}, 'column_name', {sql_literal(c.column)}, 'value', _v{c.position}) END"
        for c in checks) + ")"
    return (judged.select(*keys, F.explode(F.expr(failed)).alias("f"))
            .filter(F.col("f").isNotNull()).select(*keys, "f.*"))


def duplicate_rows(df: DataFrame, suite: Sequence[Expectation], as_of: Column,
                   keys: list[str], batch: str) -> DataFrame:
    """Rows that break a uniqueness check, in the shape of :func:`failed_rows`.

    The repeated values are joined back, one row each; a value that most rows
    share is split over tasks by adaptive execution.
    """
    checks = [c for c in compile_suite(suite, df.schema, as_of) if c.kind == "unique"]
    if not checks:
        return None
    key = lambda position, value: splittable(F.col(batch).alias("b"), position.alias("p"), value.alias("v"))
    repeated = value_counts(df, checks, batch).filter("_n > 1 AND _value IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(c.position).alias("position"), F.lit(c.type).alias("expectation_type"), F.lit(c.column).alias("column_name"),
                               value_text(df, c.column).alias("value")) for c in checks])
    return (df.select(*keys, batch, F.explode(pairs).alias("p")).withColumn("_key", key(F.col("p.position"), F.col("p.value")))
            .join(repeated.select(key(F.col("position"), F.col("_value")).alias("_key")), "_key", "left_semi")
            .select(*keys, "p.*"))


def rows_outside_table(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """Membership check against a table instead of a literal set; nulls are not judged.

    The planner broadcasts the table while its size is under the threshold.
    """
    return (df.filter(F.col(column).isNotNull())
            .join(allowed.select(F.col(allowed_column).alias(column)), column, "left_anti"))


def unexpected_samples(failed: DataFrame, order: str, batch: list[str] | None = None,
                       limit: int = P.SAMPLE_LIMIT) -> DataFrame:
    """The first ``limit`` unexpected values per expectation.

    The rank filter is planned as a group limit on both sides of the shuffle:
    each task forwards at most ``limit`` rows per expectation.
    """
    w = Window.partitionBy(*(batch or []), "position").orderBy(order)
    return (failed.withColumn("sample", F.row_number().over(w))
            .filter(F.col("sample") <= limit))


def suite_stats(results: DataFrame, batch: str, gate: P.SuiteGate = P.SuiteGate()) -> DataFrame:
    """Evaluated, passed and failed expectations per batch, with the gate's verdict."""
    stats = results.groupBy(batch).agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
    )
    share = X.rate("unsuccessful_expectations", "evaluated_expectations")
    return stats.withColumns({
        "success": F.col("unsuccessful_expectations") == 0,
        "success_percent": X.rate("successful_expectations", "evaluated_expectations") * 100,
        "overall_success_rate": X.rate("successful_expectations", "evaluated_expectations"),
        "gate_failed": share > gate.max_failed_share,
    })


def result_severity(results: DataFrame, gate: P.SuiteGate = P.SuiteGate()) -> DataFrame:
    """Severity of each expectation by its share of unexpected elements."""
    share = X.rate("unexpected_count", "element_count")
    return (results.filter(F.col("element_count").isNotNull())
            .withColumns({"failure_rate": share, "severity": X.failed_share_severity(share, gate)}))


def _small_table(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A literal table, written into the plan rather than shipped as data."""
    return (df.sparkSession.range(1)
            .select(F.explode(literal_rows(names, rows)).alias("r")).select("r.*"))


def dimension_scores(results: DataFrame, batch: str,
                     dimensions: list[tuple] = P.QUALITY_DIMENSIONS) -> DataFrame:
    """Score, failures and total per quality dimension and batch."""
    names = _small_table(results, dimensions, ["dimension", "expectation_type", "column_name"])
    return (results.filter(F.col("element_count").isNotNull())
            .join(names, ["expectation_type", "column_name"])
            .groupBy(batch, "dimension")
            .agg(F.sum("unexpected_count").alias("failures"), F.sum("element_count").alias("total"))
            .withColumn("score", 1 - X.rate("failures", "total")))


def overall_quality(scores: DataFrame, batch: str) -> DataFrame:
    """Mean dimension score and pooled failure rate per batch."""
    return (scores.groupBy(batch)
            .agg(F.avg("score").alias("overall_score"), F.sum("failures").alias("failures"),
                 F.sum("total").alias("total"))
            .withColumn("overall_failure_rate", X.rate("failures", "total")))


def quality_trend(history: DataFrame, at: str, score: str) -> DataFrame:
    """Mean step from the first to the last score and the least-squares slope per period."""
    ends = history.agg(
        F.count(F.lit(1)).alias("periods"),
        F.min_by(score, at).alias("first_score"),
        F.max_by(score, at).alias("last_score"),
        F.regr_slope(F.col(score), F.col(at).cast("double")).alias("slope"),
    )
    return ends.withColumn("mean_step", F.try_divide(
        F.col("last_score") - F.col("first_score"), F.col("periods") - 1))


def rule_coverage(results: DataFrame, rules: list[tuple] = P.BUSINESS_RULES) -> DataFrame:
    """Which business rules were evaluated, and how often they failed, by category."""
    table = _small_table(results, rules, ["category", "rule", "expectation_type", "column_name"])
    seen = results.groupBy("expectation_type", "column_name").agg(
        F.count(F.lit(1)).alias("evaluations"), F.count_if(~F.col("success")).alias("failures"))
    return (table.join(seen, ["expectation_type", "column_name"], "left")
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("rules"),
                 F.count("evaluations").alias("covered_rules"),
                 F.sum(F.coalesce("evaluations", F.lit(0))).alias("evaluations"),
                 F.sum(F.coalesce("failures", F.lit(0))).alias("failures")))


def uncovered_rules(suite: Sequence[Expectation], results: DataFrame,
                    rules: list[tuple] = P.BUSINESS_RULES) -> DataFrame:
    """Rules whose check type and column the suite never evaluates."""
    table = _small_table(results, rules, ["category", "rule", "expectation_type", "column_name"])
    done = _small_table(results, sorted({(e.type, e.column) for e in suite}),
                        ["expectation_type", "column_name"])
    return table.join(done, ["expectation_type", "column_name"], "left_anti")


def field_summary(flagged: DataFrame, batch: str, countries: Sequence[str] = P.COUNTRIES) -> DataFrame:
    """Per-rule success rates of one table.

    Distinct ids come from a second, two-column aggregate: counting them next to
    the other measures would expand every row.
    """
    counts = flagged.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("dq_email_valid").alias("valid_emails"),
        F.count_if("dq_plan_valid").alias("valid_plans"),
        F.count_if(F.col("country").isin(list(countries))).alias("valid_countries"),
        F.count_if(F.col("signup_timestamp") <= F.col("processing_timestamp")).alias("valid_signup_dates"),
        F.count_if(F.col("event_timestamp") >= F.col("signup_timestamp")).alias("valid_event_sequence"),
    )
    per_id = flagged.groupBy(batch, F.col("id").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    ids = per_id.groupBy(batch).agg(
        F.count_if(F.col("_value").isNotNull()).alias("unique_ids"))
    joined = counts.join(ids, batch)
    return joined.withColumns({
        name: X.rate(part, "total_records") for name, part in {
            "email_success_rate": "valid_emails", "plan_success_rate": "valid_plans",
            "country_success_rate": "valid_countries",
            "signup_date_success_rate": "valid_signup_dates",
            "event_sequence_success_rate": "valid_event_sequence",
            "id_uniqueness_rate": "unique_ids",
        }.items()
    })


def suite_from_json(text: str) -> list[Expectation]:
    """A suite document's expectations; suites are small configuration files."""
    return [Expectation(e["expectation_type"], dict(e.get("kwargs", {})))
            for e in json.loads(text)["expectations"]]
