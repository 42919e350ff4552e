"""Suite compilation and evaluation on small tables."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.operators import quality as Q
from eventwarden.policies import Expectation
from eventwarden.sources import documents as DOC

from conftest import rows

NOW = datetime(2024, 1, 15, 12)
SCHEMA = ("batch string, id string, name string, email string, signup_timestamp timestamp, "
          "event_timestamp timestamp, country string, plan string, version int")


def event(id_="c1", name="n", email="a@b.co", signup=datetime(2023, 1, 1), at=NOW - timedelta(hours=1),
          country="US", plan="free", version=1, batch="b"):
    return (batch, id_, name, email, signup, at, country, plan, version)


@pytest.fixture(scope="module")
def curated(spark):
    return spark.createDataFrame([
        event("c1"),
        event("c2", email="invalid-email"),
        event("c3", signup=datetime(2025, 1, 1)),                    # after its event and after now
        event("c4", country="XX", email=None),
        event("c5", plan="gold", at=NOW - timedelta(hours=30), name=None),
    ], SCHEMA)


def results(df, suite, **kw):
    return {(r.expectation_type, r.column_name): r for r in Q.run_suite(df, suite, F.lit(NOW), "batch", **kw).collect()}


def test_customer_suite(curated):
    got = results(curated, P.CUSTOMER_SUITE)
    assert len(got) == 15
    failed = {c: r.unexpected_count for (t, c), r in got.items() if not r.success and t != "x"}
    assert failed == {"email": 1, "plan": 1, "signup_timestamp": 1, "country": 1, "name": 1,
                      "event_timestamp,signup_timestamp": 1, "event_timestamp": 1}
    regex = got["expect_column_values_to_match_regex", "email"]
    assert (regex.element_count, regex.missing_count, regex.unexpected_count) == (5, 1, 1)
    assert (regex.missing_percent, regex.unexpected_percent, regex.unexpected_percent_total) == (20.0, 25.0, 20.0)
    exists = got["expect_column_to_exist", "id"]
    assert exists.success and exists.element_count is None


def test_uniqueness_skips_nulls_and_counts_every_copy(spark):
    df = spark.createDataFrame([event(i) for i in ["a", "a", "a", "b", None, None]], SCHEMA)
    r = results(df, [Expectation(Q.UNIQUE, {"column": "id"})])[Q.UNIQUE, "id"]
    assert (r.element_count, r.missing_count, r.unexpected_count, r.success) == (6, 2, 3, False)


def test_uniqueness_is_per_batch(spark):
    df = spark.createDataFrame([event("a", batch="x"), event("a", batch="y")], SCHEMA)
    assert {r.success for r in Q.run_suite(df, P.CUSTOMER_SUITE[2:3], F.lit(NOW), "batch").collect()} == {True}


def test_missing_column_fails_its_check_only(spark, curated):
    got = results(curated.drop("plan"), P.CUSTOMER_SUITE)
    assert got["expect_column_values_to_be_in_set", "plan"].success is False
    assert got["expect_column_values_to_be_in_set", "country"].element_count == 5


@pytest.mark.parametrize("type_, holds", [("datetime64[ns]", True), ("TimestampType", True), ("string", False)])
def test_type_names(spark, curated, type_, holds):
    e = Expectation(Q.OF_TYPE, {"column": "event_timestamp", "type_": type_})
    assert results(curated, [e])[Q.OF_TYPE, "event_timestamp"].success is holds


@pytest.mark.parametrize("type_, extra, bad", [
    (Q.PAIRS[0], {}, 1), (Q.PAIRS[1], {}, 2), (Q.PAIRS[1], {"or_equal": True}, 1)])
def test_pair_spellings(spark, type_, extra, bad):
    df = spark.createDataFrame([("b", 1, 1), ("b", 2, 1), ("b", 0, 1), ("b", None, 1)], "batch string, a int, b int")
    r = results(df, [Expectation(type_, {"column_A": "a", "column_B": "b", **extra})])[type_, "a,b"]
    assert (r.unexpected_count, r.missing_count) == (bad, 1)


def test_bounds(spark):
    df = spark.createDataFrame([("b", v) for v in [0.0, 5.0, -0.01, None]], "batch string, amount double")
    kind = "expect_column_values_to_be_between"
    assert results(df, P.ORDER_SUITE)[kind, "amount"].unexpected_count == 1
    both = Expectation(kind, {"column": "amount", "min_value": 0, "max_value": 4})
    assert results(df, [both])[kind, "amount"].unexpected_count == 2


def test_freshness_window_is_a_parameter(curated):
    suite = [P.CUSTOMER_SUITE[11]]
    kind = suite[0].type, "event_timestamp"
    assert results(curated, suite)[kind].unexpected_count == 1
    assert results(curated, suite, params={"max_event_delay_hours": 48})[kind].unexpected_count == 0


def test_unknown_type_is_an_error(curated):
    with pytest.raises(ValueError):
        Q.run_suite(curated, [Expectation("expect_magic", {"column": "id"})], F.lit(NOW), "batch")


def test_failed_rows_and_samples(spark):
    df = spark.createDataFrame([event(f"c{i:03d}", email="bad") for i in range(120)], SCHEMA)
    failed = Q.failed_rows(df, P.CUSTOMER_SUITE, F.lit(NOW), ["id"])
    assert failed.count() == 120
    samples = Q.unexpected_samples(failed, "id").collect()
    assert sorted(r.id for r in samples) == [f"c{i:03d}" for i in range(50)]
    assert {r.value for r in samples} == {"bad"}
    assert "WindowGroupLimit" in Q.unexpected_samples(failed, "id")._jdf.queryExecution().toString()


def test_duplicate_rows_split_a_hot_value(spark):
    df = spark.createDataFrame([event("hot")] * 50 + [event(f"c{i}") for i in range(50)], SCHEMA)
    dup = Q.duplicate_rows(df, P.CUSTOMER_SUITE, F.lit(NOW), ["id"], "batch")
    assert [tuple(r) for r in dup.groupBy("id").count().collect()] == [("hot", 50)]
    plan = dup._jdf.queryExecution().executedPlan().toString()
    # Both sides of the semi join come out of a shuffle of their own.
    assert plan.count("hashpartitioning(_key") == 2 or "BroadcastHashJoin" in plan


def test_stats_and_gate(spark):
    def stats(failed, total):
        rs = spark.createDataFrame([("b", i >= failed) for i in range(total)], "batch string, success boolean")
        return Q.suite_stats(rs, "batch").first()
    s = stats(3, 15)
    assert (s.evaluated_expectations, s.successful_expectations, s.unsuccessful_expectations,
            s.success_percent, s.success, s.gate_failed) == (15, 12, 3, 80.0, False, True)
    assert stats(1, 15).gate_failed is False
    assert stats(1, 10).gate_failed is False  # exactly ten percent passes


def test_dimension_arithmetic(spark):
    scores = spark.createDataFrame([
        ("b", 0.95, 50, 1000), ("b", 0.88, 120, 1000), ("b", 0.92, 80, 1000), ("b", 0.85, 150, 1000),
        ("b", 0.99, 10, 1000)], "batch string, score double, failures long, total long")
    r = Q.overall_quality(scores, "batch").first()
    assert r.overall_score == pytest.approx(0.918) and r.overall_failure_rate == 0.082


def test_dimension_scores_cover_the_suite(curated):
    got = {r.dimension: (r.failures, r.total)
           for r in Q.dimension_scores(Q.run_suite(curated, P.CUSTOMER_SUITE, F.lit(NOW), "batch"), "batch").collect()}
    assert got == {"completeness": (2, 15), "validity": (4, 20), "consistency": (1, 5),
                   "timeliness": (1, 5), "uniqueness": (0, 5)}


def test_trend(spark):
    history = spark.createDataFrame(
        [(i + 1, s) for i, s in enumerate([0.95, 0.93, 0.90, 0.87, 0.85])], "period int, score double")
    r = Q.quality_trend(history, "period", "score").first()
    assert r.mean_step == pytest.approx(-0.025) and r.slope == pytest.approx(-0.026)
    assert Q.quality_trend(history.limit(1), "period", "score").first().mean_step is None


def test_rules_are_covered(spark, curated):
    res = Q.run_suite(curated, P.CUSTOMER_SUITE, F.lit(NOW), "batch")
    assert Q.uncovered_rules(P.CUSTOMER_SUITE, res).count() == 0
    assert rows(Q.uncovered_rules(P.CUSTOMER_SUITE[3:], res).select("rule")) == [("id_not_null",), ("id_unique",)]
    got = {r.category: (r.rules, r.covered_rules, r.failures) for r in Q.rule_coverage(res).collect()}
    assert got["customer_identification"] == (4, 4, 2)


def test_field_summary(curated):
    flagged = curated.withColumns({
        "dq_email_valid": F.col("email").rlike(P.EMAIL_PATTERN), "dq_plan_valid": F.col("plan").isin(P.PLANS),
        "processing_timestamp": F.lit(NOW)})
    r = Q.field_summary(flagged, "batch").first()
    assert (r.email_success_rate, r.plan_success_rate, r.country_success_rate, r.signup_date_success_rate,
            r.event_sequence_success_rate, r.id_uniqueness_rate) == (0.6, 0.8, 0.8, 0.8, 0.8, 1.0)


def test_rows_outside_table(spark, curated):
    allowed = spark.createDataFrame([("US",), ("CA",)], "code string")
    assert rows(Q.rows_outside_table(curated, "country", allowed, "code").select("id")) == [("c4",)]


def test_suite_documents(spark, tmp_path):
    text = json.dumps({"expectation_suite_name": "s", "expectations": [
        {"expectation_type": e.type, "kwargs": e.kwargs, "meta": {"notes": "x"}} for e in P.CUSTOMER_SUITE]})
    (tmp_path / "suite.json").write_text(text, encoding="utf-8")
    assert Q.suite_from_json(text) == P.CUSTOMER_SUITE
    table = DOC.suite_rows(spark, str(tmp_path / "suite.json")).orderBy("position").collect()
    assert [(r.expectation_type, r.column_name) for r in table] == [(e.type, e.column) for e in P.CUSTOMER_SUITE]


def test_yaml_rules(curated):
    pytest.importorskip("yaml")
    groups = DOC.rules_from_yaml("""
expectations:
  - name: amount
    type: expect_column_values_to_be_between
    kwargs: {column: amount, min_value: 0}
business_rules:
  core:
    description: core
    expectations:
      - expectation_type: expect_column_values_to_not_be_null
        column: email
        meta: {notes: x}
      - expectation_type: expect_column_pair_values_A_to_be_greater_than_B
        column_A: event_timestamp
        column_B: signup_timestamp
        or_equal: true
""")
    assert groups["expectations"] == P.ORDER_SUITE
    got = results(curated, groups["core"])
    assert {c: r.unexpected_count for (_, c), r in got.items()} == {
        "email": 1, "event_timestamp,signup_timestamp": 1}


def test_retention_days(spark):
    from eventwarden.operators import quarantine as QU
    df = spark.createDataFrame([(NOW - timedelta(days=d),) for d in (0, 7, 8)] + [(None,)], "at timestamp")
    assert QU.retain(df, "at", F.lit(NOW)).count() == 3
    plan = {r.day: (r.rows, r.expired) for r in QU.retention_plan(df, "at", F.lit(NOW)).collect()}
    assert plan[date(2024, 1, 7)] == (1, True) and plan[date(2024, 1, 8)] == (1, False)
    assert plan[None] == (1, False)


def test_date_bounds_by_column_type(spark):
    bounds = {"min_value": "2024-01-01", "max_value": "2024-12-31", "parse_strings_as_datetimes": True}
    between = "expect_column_values_to_be_between"
    df = spark.sql("""SELECT 0 AS batch, * FROM VALUES
        (1704067200000, '2024-05-01', true), (1, 'no date', true), (NULL, NULL, true) AS t(millis, words, flag)""")
    suite = [Expectation(between, {"column": c, **bounds}) for c in ("millis", "words", "flag")]
    got = {r.column_name: (r.success, r.missing_count, r.unexpected_count)
           for r in Q.run_suite(df, suite, F.lit(NOW), "batch").collect()}
    assert got == {"millis": (False, 1, 1), "words": (False, 1, 1), "flag": (False, None, None)}
