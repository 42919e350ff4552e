"""Golden cases of the enrichment and flag expressions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.functions import columns as X
from eventwarden.functions.literals import literal_map, literal_rows
from eventwarden.operators import enrich as E

from conftest import rows


def one(spark, schema, value, col):
    return spark.createDataFrame([value if isinstance(value, tuple) else (value,)], schema).select(col).first()[0]


@pytest.mark.parametrize("country, region", [
    ("US", "North America"), ("CA", "North America"), ("MX", "North America"), ("GB", "Europe"),
    ("DE", "Europe"), ("JP", "APAC"), ("IN", "APAC"), ("BR", "South America"),
    ("UNKNOWN", "Other"), ("ES", "Other"), (None, "Other"),
])
def test_region(spark, country, region):
    assert one(spark, "country string", country, X.region_of("country")) == region


@pytest.mark.parametrize("email, domain", [
    ("user@subdomain.example.org", "subdomain.example.org"), ("test+tag@domain.co.uk", "domain.co.uk"),
    ("a@b@c", "b@c"), ("no-at", ""), ("", ""), (None, None),
])
def test_domain(spark, email, domain):
    assert one(spark, "email string", email, X.email_domain("email")) == domain


@pytest.mark.parametrize("seconds, late", [
    (300, False), (1200, True), (7200, True), (600, False), (900, False), (900.999, False), (901, True), (-60, False),
])
def test_late_is_strict_and_in_whole_seconds(spark, seconds, late):
    event = datetime(2024, 1, 15, 10)
    got = one(spark, "e timestamp, p timestamp", (event, event + timedelta(seconds=seconds)), X.is_late("p", "e"))
    assert got is late


def test_late_without_a_time_is_not_late(spark):
    assert one(spark, "e timestamp, p timestamp", (None, datetime(2024, 1, 1)), X.is_late("p", "e")) is False


@pytest.mark.parametrize("version, drifted", [(1, False), (2, True), (3, True), (None, False)])
def test_version_drift(spark, version, drifted):
    assert one(spark, "v int", version, X.is_drifted("v")) is drifted


@pytest.mark.parametrize("email, valid", [
    ("user@example.com", True), ("test.email+tag@domain.co.uk", True), ("user123@sub.domain.org", True),
    ("invalid-email", False), ("@example.com", False), ("user@", False),
    ("user space@example.com", False), ("", False), (None, None),
])
def test_email(spark, email, valid):
    assert one(spark, "email string", email, F.col("email").rlike(P.EMAIL_PATTERN)) is valid


@pytest.mark.parametrize("record, passed", [
    (("cust_001", "valid@example.com", "premium", -1), True),
    ((None, "invalid-email", "invalid_plan", 86400), False),
    (("cust_001", None, "premium", -1), None),        # unknown email
    (("cust_001", None, "gold", -1), False),          # unknown and false is false
    (("cust_001", "a@b.co", None, -1), None),
    (("cust_001", "a@b.co", "free", 0), True),        # exactly now is not the future
])
def test_verdict_is_kleene(spark, record, passed):
    now = datetime(2024, 1, 15, 12)
    id_, email, plan, offset = record
    df = spark.createDataFrame([(id_, email, plan, now + timedelta(seconds=offset))],
                               "id string, email string, plan string, event_timestamp timestamp")
    assert df.select(X.quality_flags(F.lit(now))["dq_passed"].alias("p")).first()[0] is passed


def test_millis_are_kept(spark):
    got = spark.range(1).select(
        F.date_format(X.millis_to_timestamp(F.lit(1705312800123)), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert got == "2024-01-15 10:00:00.123"


def test_age_in_days(spark):
    events = spark.createDataFrame([(1672531200000, 1705312800000)], "signup_ts long, event_ts long")
    df = E.with_timestamps(events, F.expr("TIMESTAMP '2024-01-15 12:00:00'"))
    assert df.select(X.age_days("processing_timestamp", "signup_timestamp")).first()[0] == 379


def test_default_clock_is_the_query_time(spark):
    events = spark.createDataFrame([(0, 0)], "signup_ts long, event_ts long")
    df = E.with_timestamps(events).select(
        F.abs(F.unix_timestamp("processing_timestamp") - F.unix_timestamp(F.current_timestamp())))
    assert df.first()[0] < 60


@pytest.mark.parametrize("part, whole, rate", [
    (75, 1000, 0.075), (30, 1000, 0.03), (2, 1000, 0.002), (0, 0, 0.0), (None, 10, 0.0), (1, None, 0.0),
])
def test_rate(spark, part, whole, rate):
    assert one(spark, "a long, b long", (part, whole), X.rate("a", "b")) == rate


@pytest.mark.parametrize("x, y", [(95.0, 1.0), (-1.0, 0.0), (0.4, 0.4)])
def test_clamp(spark, x, y):
    assert one(spark, "x double", x, X.clamp01(F.col("x"))) == y


@pytest.mark.parametrize("share, severity", [(0.005, "acceptable"), (0.01, "acceptable"), (0.03, "critical"),
                                             (0.15, "critical")])
def test_share_severity(spark, share, severity):
    assert one(spark, "x double", share, X.failed_share_severity(F.col("x"))) == severity


@pytest.mark.parametrize("percent, severity", [(10.0, "error"), (10.1, "critical"), (5.0, "warning"),
                                               (5.1, "error"), (1.0, "info"), (1.1, "warning"), (0.0, "info")])
def test_alert_severity(spark, percent, severity):
    assert one(spark, "x double", percent, X.alert_severity(F.col("x"))) == severity


def test_text(spark):
    df = spark.createDataFrame([(1234567, "schema_drift", 0.2)], "n long, t string, r double")
    got = df.select(X.thousands("n"), X.title_words("t"), X.percent_text(F.col("r")),
                    X.lines(F.lit("a"), F.lit(None), F.lit("b"))).first()
    assert tuple(got) == ("1,234,567", "Schema Drift", "20.00%", "a\nb")


def test_region_by_table_equals_region_by_map(spark):
    codes = spark.createDataFrame([(c,) for c in ["US", "JP", "ES", None]], "country string")
    dim = spark.createDataFrame(list(P.REGION_BY_COUNTRY.items()), "country string, region string")
    by_map = codes.select("country", X.region_of("country").alias("region"))
    assert rows(E.join_region(codes, dim).select("country", "region")) == rows(by_map)


def test_renames_are_inverse(spark):
    df = spark.createDataFrame([("c1", "a@b.co")], "id string, email string")
    business = E.rename_to_business(df)
    assert business.columns == ["customer_id", "customer_email"]
    assert E.rename_to_technical(business).columns == df.columns


def test_literals_quote_their_text(spark):
    got = spark.range(1).select(
        literal_map({"a'b": "c\\d"}).alias("m"),
        literal_rows(["x", "y"], [("q'", 3), (("concat('a', 'b')",), ("1 + 1",))]).alias("r")).first()
    assert got.m == {"a'b": "c\\d"}
    assert [tuple(r) for r in got.r] == [("q'", 3), ("ab", 2)]
