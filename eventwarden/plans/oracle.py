"""SQL twins of the registered queries, for an independent engine.

The texts restate the semantics over the same base tables; they share no code
with the DataFrame operators.  Queries without a twin are tested by fixtures.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_BASE = """
ce AS (
  SELECT n AS event_id, run_id, concat('cust_', k) AS id,
    CASE WHEN n % 41 = 0 THEN NULL ELSE c_name END AS name,
    CASE WHEN n % 61 = 0 THEN 'invalid-email' WHEN n % 97 = 0 THEN NULL
         ELSE concat('u', k, '@', lower(c_mktsegment), '.example.com') END AS email,
    CASE WHEN n % 59 = 0 THEN ms + 172800000 ELSE ms - (k * 37 % 1700) * 86400000 END AS signup_ts,
    CASE c_nationkey % 13 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'MX' WHEN 3 THEN 'GB'
      WHEN 4 THEN 'DE' WHEN 5 THEN 'FR' WHEN 6 THEN 'AU' WHEN 7 THEN 'JP' WHEN 8 THEN 'IN'
      WHEN 9 THEN 'BR' WHEN 10 THEN 'ES' WHEN 11 THEN 'INVALID' END AS country,
    CASE WHEN n % 53 = 0 THEN NULL WHEN run_id % 3 = 1 AND n % 31 = 0 THEN 'invalid_plan'
      WHEN k % 4 = 0 THEN 'free' WHEN k % 4 = 1 THEN 'basic' WHEN k % 4 = 2 THEN 'premium'
      ELSE 'enterprise' END AS plan,
    ms AS event_ts,
    CASE WHEN n % 200 = 100 THEN 3 WHEN n % 100 = 0 AND n > 0 THEN 2 ELSE 1 END AS version,
    ms + CASE WHEN n % 20 = 0 OR (run_id % 4 = 3 AND n % 5 = 0) THEN 7200000
              WHEN n % 37 = 0 THEN -3600000 ELSE (n % 16) * 60000 END AS processing_ts
  FROM (SELECT e.event_id AS n, c.c_custkey AS k, c.c_name, c.c_nationkey, c.c_mktsegment,
          epoch_us(e.ts) // 1000 AS ms, CAST(floor(e.event_id / 500.0) AS BIGINT) AS run_id
        FROM events e JOIN customer c ON c.c_custkey = e.user_id)),
fl0 AS (
  SELECT *, epoch_ms(signup_ts) AS signup_timestamp, epoch_ms(event_ts) AS event_timestamp,
    epoch_ms(processing_ts) AS processing_timestamp,
    CASE WHEN country IN ('US', 'CA', 'MX') THEN 'North America'
         WHEN country IN ('GB', 'DE', 'FR') THEN 'Europe'
         WHEN country IN ('AU', 'JP', 'IN') THEN 'APAC'
         WHEN country = 'BR' THEN 'South America' ELSE 'Other' END AS region,
    CASE WHEN email IS NULL THEN NULL WHEN position('@' IN email) = 0 THEN ''
         ELSE substr(email, position('@' IN email) + 1) END AS email_domain,
    CAST(date_diff('day', epoch_ms(signup_ts), epoch_ms(processing_ts)) AS INTEGER) AS customer_age_days,
    version > 1 AS schema_drift_detected,
    processing_ts // 1000 - event_ts // 1000 > 900 AS is_late_arrival,
    regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$') AS dq_email_valid,
    id IS NOT NULL AS dq_id_not_null,
    event_ts <= processing_ts AS dq_timestamp_valid,
    plan IN ('free', 'basic', 'premium', 'enterprise') AS dq_plan_valid
  FROM ce),
fl AS (SELECT *, dq_email_valid AND dq_id_not_null AND dq_timestamp_valid AND dq_plan_valid AS dq_passed
       FROM fl0)
"""

_REPORT = """
rr AS (
  SELECT run_id, count(*) AS total_records,
    count(*) FILTER (WHERE is_late_arrival) AS late_records,
    count(*) FILTER (WHERE NOT dq_passed) AS dq_failures,
    count(*) FILTER (WHERE dq_passed IS NULL) AS dq_unknown,
    count(*) FILTER (WHERE schema_drift_detected) AS schema_drift_count,
    count(*) FILTER (WHERE schema_drift_detected) > 0 AS schema_drift_detected,
    count(*) FILTER (WHERE event_id % 613 = 0) AS processing_errors,
    min(processing_timestamp) AS start_time, max(processing_timestamp) AS end_time,
    '15 minutes' AS watermark_delay
  FROM fl GROUP BY run_id),
ra AS (
  SELECT *, late_records / total_records AS late_rate, dq_failures / total_records AS dq_failure_rate,
    processing_errors / total_records AS error_rate FROM rr)
"""


def _ts(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%g') AS {name}"


def _tri(name: str) -> str:
    return f"coalesce(CAST({name} AS VARCHAR), 'unknown') AS {name}"


def _add(name: str, body: str, *ctes: str) -> None:
    parts = [_BASE, *ctes]
    ORACLES[name] = "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


# -- projections and flags -------------------------------------------------------

_add("enrich_timestamps", f"""
SELECT event_id, {_ts('signup_timestamp')}, {_ts('event_timestamp')}, {_ts('processing_timestamp')} FROM fl
""")
_add("region_lookup", "SELECT event_id, country, region FROM fl")
_add("email_domain", "SELECT event_id, email_domain FROM fl")
_add("customer_age", "SELECT event_id, customer_age_days FROM fl")
_add("field_rename", """
SELECT event_id, id AS customer_id, email AS customer_email, plan AS subscription_plan,
  signup_ts AS registration_date, event_ts AS event_timestamp, name AS customer_name,
  country AS customer_country, version AS schema_version FROM ce
""")
ORACLES["region_join"] = """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS country, coalesce(r_name, 'Other') AS region
FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
  ON n_nationkey = c_nationkey
"""
_add("dq_flags", f"""
SELECT event_id, {_tri('dq_email_valid')}, {_tri('dq_id_not_null')}, {_tri('dq_timestamp_valid')},
  {_tri('dq_plan_valid')}, {_tri('dq_passed')} FROM fl
""")
_add("late_flag", "SELECT event_id, is_late_arrival FROM fl")
_add("drift_flag", "SELECT event_id, version, schema_drift_detected FROM fl")
_add("curated_events", f"""
SELECT event_id, run_id, id, region, email_domain, customer_age_days, schema_drift_detected,
  is_late_arrival, {_tri('dq_passed')} FROM fl
""")

# -- reports -----------------------------------------------------------------------

_REPORT_COLUMNS = f"""run_id, total_records, late_records, dq_failures, dq_unknown, schema_drift_count,
  schema_drift_detected, processing_errors, {_ts('start_time')}, {_ts('end_time')}, watermark_delay"""

_add("run_report", f"SELECT {_REPORT_COLUMNS} FROM rr", _REPORT)
_add("run_rates", """
SELECT run_id, late_rate, dq_failure_rate, error_rate, late_rate > 0.15 AS late_exceeded,
  dq_failure_rate > 0.05 AS dq_exceeded, dq_failure_rate > 0.1 AS is_critical FROM ra
""", _REPORT)
_add("latest_run", f"""
SELECT {_REPORT_COLUMNS} FROM (SELECT * FROM rr ORDER BY rr.end_time DESC, run_id DESC LIMIT 1)
""", _REPORT)
_add("failure_by_segment", """
SELECT CASE WHEN grouping(country) = 1 AND grouping(plan) = 1 THEN 'all'
            WHEN grouping(plan) = 1 THEN 'country' WHEN grouping(country) = 1 THEN 'plan'
            ELSE 'country_plan' END AS segment,
  country, plan, count(*) AS total_records, count(*) FILTER (WHERE NOT dq_passed) AS dq_failures,
  count(*) FILTER (WHERE NOT dq_passed) / count(*) AS failure_rate
FROM fl GROUP BY GROUPING SETS ((), (country), (plan), (country, plan))
""")
_SHARES = """
sh AS (
  SELECT run_id, country, plan, count(*) FILTER (WHERE NOT dq_passed) AS segment_failures,
    CAST(sum(count(*) FILTER (WHERE NOT dq_passed)) OVER (PARTITION BY run_id) AS BIGINT) AS run_failures
  FROM fl GROUP BY run_id, country, plan),
ss AS (SELECT *, CASE WHEN run_failures = 0 THEN 0.0 ELSE segment_failures / run_failures END
         AS failure_share FROM sh)
"""
_add("failure_shares", "SELECT * FROM ss", _SHARES)
_add("worst_segments", """
SELECT country, plan, count(*) AS total_records, count(*) FILTER (WHERE NOT dq_passed) AS dq_failures
FROM fl GROUP BY country, plan
ORDER BY dq_failures DESC, country NULLS FIRST, plan NULLS FIRST LIMIT 10
""")
_add("anomaly_counters", """
SELECT *, late_events / total_events AS late_rate, schema_drift_events / total_events AS schema_drift_rate,
  missing_field_events / total_events AS missing_field_rate
FROM (SELECT run_id, count(*) AS total_events, count(*) FILTER (WHERE is_late_arrival) AS late_events,
        count(*) FILTER (WHERE schema_drift_detected) AS schema_drift_events,
        count(*) FILTER (WHERE country IS NULL OR plan IS NULL) AS missing_field_events
      FROM fl GROUP BY run_id)
""")
_add("version_counts", """
SELECT version, count(*) AS events, count(*) FILTER (WHERE schema_drift_detected) AS drifted_events
FROM fl GROUP BY version
""")
_WINDOWS = """
wr AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes' AS window_end,
    count(*) AS total_records, count(*) FILTER (WHERE is_late_arrival) AS late_records,
    count(*) FILTER (WHERE NOT dq_passed) AS dq_failures,
    count(*) FILTER (WHERE dq_passed IS NULL) AS dq_unknown,
    count(*) FILTER (WHERE schema_drift_detected) AS schema_drift_count
  FROM fl GROUP BY ALL)
"""
_WINDOW_COLUMNS = f"""{_ts('window_start')}, {_ts('window_end')}, total_records, late_records,
  dq_failures, dq_unknown, schema_drift_count"""
_add("windowed_report", f"SELECT {_WINDOW_COLUMNS} FROM wr", _WINDOWS)

# -- decoding and drift ----------------------------------------------------------------

_WIRE = """
wire AS (
  SELECT *, event_id % 73 = 0 AS is_cut, run_id % 5 = 2 AS text_version,
    CASE WHEN run_id % 11 = 5 THEN NULL ELSE email END AS sent_email,
    CASE WHEN run_id % 11 = 5 THEN email END AS sent_address,
    CASE WHEN run_id % 7 = 3 THEN NULL ELSE country END AS sent_country,
    CASE WHEN version >= 2 THEN event_id % 3 = 0 END AS opt_in,
    CASE WHEN version >= 3 THEN 'standard' END AS customer_segment
  FROM fl)
"""
_add("json_decode", f"""
SELECT event_id, run_id, id AS kafka_key, {_ts('processing_timestamp').replace('AS processing_timestamp', 'AS kafka_timestamp')},
  event_id // 4 + 3 * (event_id // 1000) AS kafka_offset, CAST(event_id % 4 AS INTEGER) AS kafka_partition,
  CASE WHEN NOT is_cut THEN id END AS id, CASE WHEN NOT is_cut THEN name END AS name,
  CASE WHEN NOT is_cut THEN sent_email END AS email, CASE WHEN NOT is_cut THEN sent_country END AS country,
  CASE WHEN NOT is_cut THEN plan END AS plan, CASE WHEN NOT is_cut THEN customer_segment END AS customer_segment,
  CASE WHEN NOT is_cut THEN CAST(signup_ts AS VARCHAR) END AS signup_ts,
  CASE WHEN NOT is_cut THEN CAST(event_ts AS VARCHAR) END AS event_ts,
  CASE WHEN NOT is_cut AND NOT text_version THEN CAST(version AS VARCHAR) END AS version,
  CASE WHEN NOT is_cut THEN CAST(opt_in AS VARCHAR) END AS marketing_opt_in
FROM wire
""", _WIRE)
_add("readable_records", """
SELECT event_id, run_id, id, sent_email AS email, sent_country AS country, plan, version
FROM wire WHERE NOT is_cut AND NOT text_version
""", _WIRE)
_add("corrupt_records", """
SELECT event_id, run_id, is_cut AS unreadable,
  length(concat('{"id":"', id, '"',
    CASE WHEN name IS NOT NULL THEN concat(',"name":"', name, '"') ELSE '' END,
    CASE WHEN sent_email IS NOT NULL THEN concat(',"email":"', sent_email, '"') ELSE '' END,
    CASE WHEN sent_address IS NOT NULL THEN concat(',"email_address":"', sent_address, '"') ELSE '' END,
    ',"signup_ts":', signup_ts,
    CASE WHEN sent_country IS NOT NULL THEN concat(',"country":"', sent_country, '"') ELSE '' END,
    CASE WHEN plan IS NOT NULL THEN concat(',"plan":"', plan, '"') ELSE '' END,
    ',"event_ts":', event_ts,
    CASE WHEN text_version THEN concat(',"version":"', version, '"') ELSE concat(',"version":', version) END,
    CASE WHEN opt_in IS NOT NULL THEN concat(',"marketing_opt_in":', opt_in) ELSE '' END,
    CASE WHEN customer_segment IS NOT NULL THEN ',"customer_segment":"standard"' ELSE '' END,
    '}')) - CASE WHEN is_cut THEN 5 ELSE 0 END AS corrupt_chars
FROM wire WHERE is_cut OR text_version
""", _WIRE)

_FIELDS = [
    # field, class when sent, rows that send it
    ("id", "string", "id IS NOT NULL"), ("name", "string", "name IS NOT NULL"),
    ("email", "string", "sent_email IS NOT NULL"), ("email_address", "string", "sent_address IS NOT NULL"),
    ("signup_ts", "integer", "true"), ("country", "string", "sent_country IS NOT NULL"),
    ("plan", "string", "plan IS NOT NULL"), ("event_ts", "integer", "true"),
    ("version", "integer", "NOT text_version"), ("version", "string", "text_version"),
    ("marketing_opt_in", "boolean", "opt_in IS NOT NULL"),
    ("customer_segment", "string", "customer_segment IS NOT NULL"),
]
_CONTRACT = [("id", "string", True), ("name", "string", False), ("email", "string", True),
             ("signup_ts", "integer", True), ("country", "string", False), ("plan", "string", False),
             ("event_ts", "integer", True), ("version", "integer", False)]

_SEEN = "seen AS (" + "\nUNION ALL ".join(
    f"SELECT run_id, '{f}' AS field, '{c}' AS class, count(*) AS n FROM wire "
    f"WHERE NOT is_cut AND {cond} GROUP BY run_id" for f, c, cond in _FIELDS) + ")"
_CONTRACT_CTE = "contract AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{f}', '{c}', {str(r).lower()})" for f, c, r in _CONTRACT) + ") t(field, expected, required))"
_STATUS = """CASE WHEN expected IS NULL THEN 'new' WHEN records IS NULL THEN 'missing'
  WHEN observed <> expected THEN 'type_change' ELSE 'ok' END"""
_COMPARED = f"""
cmp AS (
  SELECT coalesce(e.run_id, s.run_id) AS run_id, coalesce(e.field, s.field) AS field, {_STATUS} AS status,
    coalesce(required, false) AS required, expected, coalesce(observed, '') AS observed,
    coalesce(records, 0) AS records
  FROM (SELECT run_id, field, expected, required FROM (SELECT DISTINCT run_id FROM seen), contract) e
  FULL JOIN (SELECT run_id, field, CAST(sum(n) AS BIGINT) AS records,
               string_agg(DISTINCT class, ',' ORDER BY class) AS observed FROM seen GROUP BY run_id, field) s
    ON e.run_id = s.run_id AND e.field = s.field)
"""
_DRIFT = """
dr AS (
  SELECT run_id,
    coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE status = 'new'), '') AS new_fields,
    coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE status = 'missing'), '') AS removed_fields,
    coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE status = 'type_change'), '') AS type_changes,
    count(*) FILTER (WHERE status = 'missing' AND required) > 0 AS required_missing
  FROM cmp GROUP BY run_id),
dc AS (
  SELECT *, CASE WHEN required_missing OR type_changes <> '' THEN 'breaking'
    WHEN new_fields <> '' OR removed_fields <> '' THEN 'additive' ELSE 'none' END AS drift_class FROM dr)
"""
_RAW = (_WIRE, _SEEN, _CONTRACT_CTE, _COMPARED)

_add("drift_fields", f"""
SELECT coalesce(e.field, s.field) AS field, {_STATUS} AS status, coalesce(required, false) AS required,
  coalesce(expected, '') AS expected, coalesce(observed, '') AS observed, coalesce(records, 0) AS records
FROM contract e FULL JOIN (
  SELECT field, CAST(sum(n) AS BIGINT) AS records,
    string_agg(DISTINCT class, ',' ORDER BY class) AS observed FROM seen GROUP BY field) s ON e.field = s.field
""", _WIRE, _SEEN, _CONTRACT_CTE)
_add("drift_class", """
SELECT run_id, drift_class, CASE drift_class WHEN 'breaking' THEN 'quarantine_and_escalate'
    WHEN 'additive' THEN 'remap' ELSE 'none' END AS drift_action,
  new_fields, removed_fields, type_changes, required_missing FROM dc
""", *_RAW, _DRIFT)
_add("field_difference", """
SELECT field, 'missing' AS status FROM (SELECT field FROM contract EXCEPT SELECT field FROM seen)
UNION ALL SELECT field, 'new' FROM (SELECT field FROM seen EXCEPT SELECT field FROM contract)
""", _WIRE, _SEEN, _CONTRACT_CTE)
_PATHS = [
    # path, type when sent, rows that send it
    ("id", "string", "true"), ("customer", "object", "true"), ("customer.plan", "string", "plan IS NOT NULL"), ("customer.plan", "null", "plan IS NULL"),
    ("customer.place", "object", "true"), ("customer.place.country", "string", "run_id % 7 <> 3 AND country IS NOT NULL"),
    ("customer.place.country", "null", "run_id % 7 <> 3 AND country IS NULL"),
    ("customer.place.zone", "string", "run_id % 5 = 2 AND event_id % 2 = 0"), ("customer.place.zone", "integer", "NOT (run_id % 5 = 2 AND event_id % 2 = 0)"),
    ("items", "array", "true"), ("items[]", "object", "event_id % 4 <> 0"), ("items[].sku", "integer", "event_id % 4 <> 0"),
    ("items[].price", "number", "event_id % 4 <> 0 AND run_id % 3 = 1"), ("items[].price", "integer", "event_id % 4 <> 0 AND run_id % 3 <> 1"),
    ("items[].gift", "boolean", "event_id % 4 = 3"), ("tags", "array", "true"),
    ("tags[]", "mixed", "run_id % 11 = 5"), ("tags[]", "string", "run_id % 11 <> 5"),
]
_NESTED = [("id", "string", True), ("customer", "object", True), ("customer.plan", "string", False), ("customer.place", "object", True),
           ("customer.place.country", "string", True), ("customer.place.zone", "integer", False), ("items", "array", True),
           ("items[]", "object", False), ("items[].sku", "integer", True), ("items[].price", "number", True), ("tags", "array", False),
           ("tags[]", "string", False)]
_add("drift_paths", """
SELECT coalesce(e.run_id, s.run_id) AS run_id, coalesce(e.path, s.path) AS path,
  CASE WHEN expected IS NULL THEN 'new' WHEN records IS NULL THEN 'missing'
    WHEN s.kind <> 'null' AND s.kind <> expected AND NOT (s.kind = 'integer' AND expected = 'number') THEN 'type_change' ELSE 'ok' END AS status,
  coalesce(required, false) AS required, coalesce(expected, '') AS expected, coalesce(s.kind, 'null') AS observed, coalesce(records, 0) AS records
FROM (SELECT run_id, path, expected, required FROM (SELECT DISTINCT run_id FROM paths), nested) e
FULL JOIN seen_paths s ON e.run_id = s.run_id AND e.path = s.path
""", "paths AS (" + "\nUNION ALL ".join(
    f"SELECT run_id, '{p}' AS path, '{kind}' AS kind, count(*) AS n FROM ce WHERE event_id % 73 <> 0 AND {cond} GROUP BY run_id" for p, kind, cond in _PATHS) + ")",
     "nested AS (SELECT * FROM (VALUES " + ", ".join(f"('{p}', '{k}', {str(r).lower()})" for p, k, r in _NESTED) + ") t(path, expected, required))", """
seen_paths AS (
  SELECT run_id, path, CAST(sum(n) AS BIGINT) AS records,
    CASE count(DISTINCT kind) FILTER (WHERE kind <> 'null') WHEN 0 THEN 'null' WHEN 1 THEN max(kind) FILTER (WHERE kind <> 'null')
      ELSE CASE WHEN bool_and(kind IN ('null', 'integer', 'number')) THEN 'number' ELSE 'mixed' END END AS kind
  FROM paths GROUP BY run_id, path)
""")
ORACLES["props_fields"] = """
SELECT event_type, field, CASE json_type(props, concat('$.', field))
    WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'other' END AS class,
  count(*) AS records
FROM (SELECT event_type, props, unnest(json_keys(props)) AS field FROM events) GROUP BY ALL
"""

# -- expectations ------------------------------------------------------------------------

_NOT_NULL, _UNIQUE = "expect_column_values_to_not_be_null", "expect_column_values_to_be_unique"
_EXISTS, _TYPE = "expect_column_to_exist", "expect_column_values_to_be_of_type"
_REGEX, _SET = "expect_column_values_to_match_regex", "expect_column_values_to_be_in_set"
_BETWEEN = "expect_column_values_to_be_between"
_PAIR = "expect_column_pair_values_A_to_be_greater_than_or_equal_to_B"
_COUNTRIES = "('US','CA','GB','DE','FR','AU','JP','IN','BR','MX','ES','IT','NL','SE','NO','DK','FI')"

# position, type, column, missing, unexpected (value checks only)
_CHECKS = [
    (0, _EXISTS, "id", None, None),
    (1, _NOT_NULL, "id", "false", "id IS NULL"),
    (2, _UNIQUE, "id", "id IS NULL", "copies > 1"),
    (3, _EXISTS, "email", None, None),
    (4, _NOT_NULL, "email", "false", "email IS NULL"),
    (5, _REGEX, "email", "email IS NULL", "NOT dq_email_valid"),
    (6, _SET, "plan", "plan IS NULL", "NOT dq_plan_valid"),
    (7, _TYPE, "signup_timestamp", None, None),
    (8, _BETWEEN, "signup_timestamp", "signup_timestamp IS NULL",
     "signup_timestamp < TIMESTAMP '2020-01-01' OR signup_timestamp > processing_timestamp"),
    (9, _TYPE, "event_timestamp", None, None),
    (10, _PAIR, "event_timestamp,signup_timestamp", "false", "event_timestamp < signup_timestamp"),
    (11, _BETWEEN, "event_timestamp", "event_timestamp IS NULL",
     "event_timestamp < processing_timestamp - INTERVAL 24 HOUR OR event_timestamp > processing_timestamp"),
    (12, _SET, "country", "country IS NULL", f"country NOT IN {_COUNTRIES}"),
    (13, _NOT_NULL, "name", "false", "name IS NULL"),
    (14, _BETWEEN, "version", "version IS NULL", "version < 1 OR version > 10"),
]


def _check_sql(pos: int, kind: str, column: str, missing: str | None, bad: str | None) -> str:
    head = f"SELECT run_id, {pos} AS position, '{kind}' AS expectation_type, '{column}' AS column_name, "
    if bad is None:
        return head + ("true AS success, 0 AS element_count, 0 AS missing_count, 0 AS unexpected_count, "
                       "false AS judged FROM fc GROUP BY run_id")
    return head + (f"count(*) FILTER (WHERE {bad}) = 0 AS success, count(*) AS element_count, "
                   f"count(*) FILTER (WHERE {missing}) AS missing_count, "
                   f"count(*) FILTER (WHERE {bad}) AS unexpected_count, true AS judged FROM fc GROUP BY run_id")


_COPIES = "fc AS (SELECT *, count(*) OVER (PARTITION BY run_id, id) AS copies FROM fl)"
_RESULTS = "res AS (" + "\nUNION ALL ".join(_check_sql(*c) for c in _CHECKS) + ")"
_PERCENTS = """
  CASE WHEN element_count = 0 THEN 0.0 ELSE missing_count / element_count * 100 END AS missing_percent,
  CASE WHEN element_count = missing_count THEN 0.0
       ELSE unexpected_count / (element_count - missing_count) * 100 END AS unexpected_percent,
  CASE WHEN element_count = 0 THEN 0.0 ELSE unexpected_count / element_count * 100 END AS unexpected_percent_total
"""
_add("suite_results", f"""
SELECT run_id, position, expectation_type, column_name, success, element_count, missing_count,
  unexpected_count, {_PERCENTS} FROM res
""", _COPIES, _RESULTS)
_add("suite_unique", f"""
SELECT batch, position, expectation_type, column_name, unexpected_count = 0 AS success, element_count,
  missing_count, unexpected_count, {_PERCENTS}
FROM (
  SELECT 'all' AS batch, p AS position, '{_UNIQUE}' AS expectation_type, c AS column_name,
    CAST(sum(n) AS BIGINT) AS element_count,
    CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS missing_count,
    CAST(coalesce(sum(n) FILTER (WHERE v IS NOT NULL AND n > 1), 0) AS BIGINT) AS unexpected_count
  FROM (SELECT 0 AS p, 'event_id' AS c, CAST(event_id AS VARCHAR) AS v, count(*) AS n FROM fl GROUP BY event_id
        UNION ALL SELECT 1, 'id', id, count(*) FROM fl GROUP BY id
        UNION ALL SELECT 2, 'email', email, count(*) FROM fl GROUP BY email)
  GROUP BY p, c)
""")
_FAILED = "fr AS (" + "\nUNION ALL ".join(
    f"SELECT event_id, run_id, {p} AS position, '{k}' AS expectation_type, '{c}' AS column_name "
    f"FROM fl WHERE {bad}" for p, k, c, _, bad in _CHECKS if bad is not None and k != _UNIQUE) + ")"
_add("failed_rows", "SELECT * FROM fr", _FAILED)
_add("suite_samples", """
SELECT position, expectation_type, column_name, CAST(sample AS INTEGER) AS sample, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY position ORDER BY event_id) AS sample FROM fr)
WHERE sample <= 50
""", _FAILED)
_add("duplicate_rows", """
SELECT event_id, 'id' AS column_name, id AS value FROM fc WHERE copies > 1
""", _COPIES)
_STATS = """
st AS (
  SELECT run_id, count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
    count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations FROM res GROUP BY run_id)
"""
_add("suite_stats", """
SELECT *, unsuccessful_expectations = 0 AS success,
  successful_expectations / evaluated_expectations * 100 AS success_percent,
  successful_expectations / evaluated_expectations AS overall_success_rate,
  unsuccessful_expectations / evaluated_expectations > 0.1 AS gate_failed FROM st
""", _COPIES, _RESULTS, _STATS)
_add("quality_severity", """
SELECT run_id, position, column_name, unexpected_count / element_count AS failure_rate,
  CASE WHEN unexpected_count / element_count > 0.01 THEN 'critical'
       WHEN unexpected_count / element_count > 0.05 THEN 'warning' ELSE 'acceptable' END AS severity
FROM res WHERE judged
""", _COPIES, _RESULTS)
_DIMENSIONS = """
dm AS (
  SELECT run_id, dimension, CAST(sum(unexpected_count) AS BIGINT) AS failures, CAST(sum(element_count) AS BIGINT) AS total,
    1 - sum(unexpected_count) / sum(element_count) AS score
  FROM res JOIN (VALUES ('completeness', 1), ('completeness', 4), ('completeness', 13), ('validity', 5), ('validity', 6),
    ('validity', 8), ('validity', 11), ('consistency', 10), ('timeliness', 11), ('uniqueness', 2)) d(dimension, position)
    USING (position) GROUP BY run_id, dimension),
ov AS (
  SELECT run_id, avg(score) AS overall_score, CAST(sum(failures) AS BIGINT) AS failures,
    CAST(sum(total) AS BIGINT) AS total, sum(failures) / sum(total) AS overall_failure_rate
  FROM dm GROUP BY run_id)
"""
_add("quality_dimensions", """
SELECT run_id, dimension, failures, total, round(score, 9) AS score FROM dm
""", _COPIES, _RESULTS, _DIMENSIONS)
_add("quality_overall", """
SELECT run_id, round(overall_score, 9) AS overall_score, failures, total, overall_failure_rate FROM ov
""", _COPIES, _RESULTS, _DIMENSIONS)
_add("quality_trend", """
SELECT count(*) AS periods, round(min_by(overall_score, run_id), 9) AS first_score,
  round(max_by(overall_score, run_id), 9) AS last_score,
  round((max_by(overall_score, run_id) - min_by(overall_score, run_id)) / (count(*) - 1), 9) AS mean_step,
  round(regr_slope(overall_score, run_id), 9) AS slope FROM ov
""", _COPIES, _RESULTS, _DIMENSIONS)
_add("rule_coverage", """
SELECT category, count(DISTINCT position) AS rules, count(DISTINCT position) AS covered_rules,
  count(*) AS evaluations, count(*) FILTER (WHERE NOT success) AS failures
FROM (SELECT *, CASE WHEN position IN (1, 2, 4, 5) THEN 'customer_identification'
        WHEN position IN (6, 8) THEN 'subscription_integrity'
        WHEN position IN (10, 11) THEN 'temporal_consistency'
        WHEN position = 12 THEN 'geographic_validity' END AS category FROM res)
WHERE category IS NOT NULL GROUP BY category
""", _COPIES, _RESULTS)
_add("field_summary", f"""
SELECT *, valid_emails / total_records AS email_success_rate, valid_plans / total_records AS plan_success_rate,
  valid_countries / total_records AS country_success_rate,
  valid_signup_dates / total_records AS signup_date_success_rate,
  valid_event_sequence / total_records AS event_sequence_success_rate,
  unique_ids / total_records AS id_uniqueness_rate
FROM (SELECT run_id, count(*) AS total_records, count(*) FILTER (WHERE dq_email_valid) AS valid_emails,
        count(*) FILTER (WHERE dq_plan_valid) AS valid_plans,
        count(*) FILTER (WHERE country IN {_COUNTRIES}) AS valid_countries,
        count(*) FILTER (WHERE signup_ts <= processing_ts) AS valid_signup_dates,
        count(*) FILTER (WHERE event_ts >= signup_ts) AS valid_event_sequence,
        count(DISTINCT id) AS unique_ids FROM fl GROUP BY run_id)
""")

# -- orders, remaps -----------------------------------------------------------------------

_ORDERS = """SELECT 'order_created' AS event, concat('A', o_orderkey) AS order_id,
  CASE WHEN o_orderkey % 89 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
  CAST(epoch(o_orderdate) AS BIGINT) AS ts, CAST(NULL AS VARCHAR) AS coupon FROM orders"""
ORACLES["remap_apply"] = _ORDERS
ORACLES["order_amounts"] = f"""
SELECT 'orders' AS batch, 0 AS position, '{_BETWEEN}' AS expectation_type, 'amount' AS column_name,
  unexpected_count = 0 AS success, *, {_PERCENTS}
FROM (SELECT count(*) AS element_count, count(*) FILTER (WHERE amount IS NULL) AS missing_count,
        count(*) FILTER (WHERE amount < 0) AS unexpected_count FROM ({_ORDERS}))
"""
_REMAP = """
lat AS (
  SELECT field, run_id AS updated_at, run_id AS call_id, concat(observed, ' since run ', run_id) AS spec
  FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY run_id DESC) AS r FROM cmp WHERE status = 'new')
  WHERE r = 1)
"""
_add("remap_merge", "SELECT field, spec, updated_at, call_id FROM lat", *_RAW, _REMAP)
_add("remap_config", """
SELECT (SELECT count(DISTINCT run_id) FROM cmp WHERE status = 'new') AS version, max(updated_at) AS updated_at,
  false AS applied, string_agg(concat(field, '=', spec), ';' ORDER BY field) AS mappings FROM lat
""", *_RAW, _REMAP)

# -- quarantine, retention --------------------------------------------------------------------

_RULES = [("customer_data_quality", i, p) for i, p in enumerate([0, 1, 2, 3, 4, 5, 6, 7, 8, 10])] + [("data_freshness", 0, 11)]
_add("declared_rules", f"""
SELECT rule_group, run_id, r.position, CASE WHEN res.position = 10 THEN 'expect_column_pair_values_A_to_be_greater_than_B'
    ELSE expectation_type END AS expectation_type, column_name, success,
  CASE WHEN judged THEN element_count ELSE 0 END AS element_count, missing_count, unexpected_count
FROM res JOIN (VALUES {", ".join(f"('{g}', {i}, {p})" for g, i, p in _RULES)}) r(rule_group, position, checked) ON res.position = checked
UNION ALL
SELECT 'expectations', -1, position, expectation_type, column_name, success, element_count, missing_count, unexpected_count
FROM ({ORACLES["order_amounts"]})
""", _COPIES, _RESULTS)
_add("quarantine_split", """
SELECT event_id, CASE WHEN country = 'INVALID' THEN 'quarantined' ELSE 'clean' END AS side FROM fl
""")
_HELD = """
held AS (
  SELECT event_id, 'invalid_country' AS reason FROM fl WHERE country = 'INVALID'
  UNION ALL SELECT event_id, 'data_quality_failure' FROM fl WHERE NOT dq_passed
  UNION ALL SELECT event_id, 'late_arrival' FROM fl WHERE is_late_arrival)
"""
_add("quarantine_written", """
SELECT CASE WHEN coalesce(country = 'INVALID' OR NOT dq_passed, false) THEN 'quarantined' ELSE 'clean' END AS side,
  count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM fl GROUP BY 1
""")
_add("quarantine_rules", "SELECT event_id, reason FROM held", _HELD)
_add("quarantine_table", """
SELECT reason, '20240131_000000' AS quarantine_ts, 'events' AS source_path, count(*) AS rows,
  count(DISTINCT event_id) AS events FROM held GROUP BY reason
""", _HELD)
_add("retention", """
SELECT event_id FROM fl WHERE event_timestamp >= TIMESTAMP '2024-01-24 00:00:00'
""")
_add("retention_apply", """
SELECT strftime(event_timestamp, '%Y-%m-%d') AS event_date, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids
FROM fl WHERE event_timestamp >= TIMESTAMP '2024-01-24 10:30:00' GROUP BY 1
""")
_add("compaction", """
SELECT strftime(event_timestamp, '%Y-%m-%d') AS event_date, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, 1 AS files
FROM fl GROUP BY 1
""")
_add("retention_plan", """
SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS day, count(*) AS rows,
  CAST(event_timestamp AS DATE) < DATE '2024-01-24' AS expired FROM fl GROUP BY CAST(event_timestamp AS DATE)
""")

# -- incidents ------------------------------------------------------------------------------------

_INCIDENTS = """
raised AS (
  SELECT *, 'pipeline_failure' AS incident_type,
    concat('Run ', run_id, ' had ', processing_errors, ' processing errors') AS summary, 'high' AS severity
  FROM ra WHERE processing_errors > 0
  UNION ALL SELECT *, 'late_arrivals', concat('Run ', run_id, ' late rate ', printf('%.2f%%', late_rate * 100)),
    CASE WHEN late_rate > 0.1 THEN 'high' ELSE 'medium' END FROM ra WHERE late_rate > 0.15
  UNION ALL SELECT *, 'data_quality',
    concat('Run ', run_id, ' failure rate ', printf('%.2f%%', dq_failure_rate * 100)),
    CASE WHEN dq_failure_rate > 0.1 THEN 'high' ELSE 'medium' END FROM ra WHERE dq_failure_rate > 0.05
  UNION ALL SELECT *, 'schema_drift', concat('Run ', run_id, ' schema drift'), 'low'
  FROM ra WHERE schema_drift_detected),
opened AS (
  SELECT md5(concat(run_id, '|', incident_type)) AS id, incident_type, summary,
    concat('{"run_id":', run_id, ',"total_records":', total_records, ',"late_records":', late_records,
           ',"dq_failures":', dq_failures, '}') AS context,
    severity, end_time AS created_at FROM raised),
inc AS (
  SELECT id, incident_type, summary, context,
    CASE WHEN incident_type = 'data_quality' THEN 'critical' ELSE severity END AS severity,
    CASE WHEN incident_type IN ('late_arrivals', 'pipeline_failure') THEN 'resolved' ELSE 'open' END AS status,
    created_at,
    created_at + CASE WHEN incident_type IN ('late_arrivals', 'pipeline_failure') THEN INTERVAL 120 MINUTE
      WHEN incident_type = 'data_quality' THEN INTERVAL 60 MINUTE ELSE INTERVAL 0 MINUTE END AS updated_at,
    CASE WHEN incident_type IN ('late_arrivals', 'pipeline_failure')
         THEN created_at + INTERVAL 120 MINUTE END AS resolved_at,
    severity IN ('high', 'critical') AS escalated,
    CASE WHEN severity IN ('high', 'critical') THEN created_at + INTERVAL 10 MINUTE END AS escalated_at,
    CASE WHEN incident_type IN ('late_arrivals', 'pipeline_failure') THEN 'fixed'
         WHEN severity IN ('high', 'critical') THEN 'needs attention' END AS resolution_notes,
    'pipeline_agent' AS created_by, severity AS first_severity
  FROM opened)
"""
_INCIDENT_COLUMNS = f"""id, incident_type, summary, context, severity, status, {_ts('created_at')},
  {_ts('updated_at')}, {_ts('resolved_at')}, escalated, {_ts('escalated_at')}, resolution_notes, created_by"""
_INC = (_REPORT, _INCIDENTS)

_add("incident_log", f"""
SELECT id, incident_type, summary, context, severity, 'open' AS status, {_ts('created_at')},
  false AS escalated, 'pipeline_agent' AS created_by FROM opened
""", *_INC)
_add("incident_state", f"SELECT {_INCIDENT_COLUMNS} FROM inc", *_INC)
_add("incident_lookup", f"""
SELECT {_INCIDENT_COLUMNS} FROM inc WHERE inc.id = md5('0|pipeline_failure')
""", *_INC)
_add("incident_recent", f"""
SELECT id, incident_type, {_ts('created_at')}, status FROM inc
WHERE inc.created_at >= TIMESTAMP '2024-01-24 00:00:00'
""", *_INC)
_add("incident_recent_quality", f"""
SELECT id, severity, {_ts('created_at')}, status FROM inc
WHERE inc.created_at >= TIMESTAMP '2024-01-01 00:00:00' AND incident_type = 'data_quality'
""", *_INC)
_add("incident_stats", """
SELECT CASE WHEN grouping(incident_type) = 0 THEN 'incident_type' WHEN grouping(severity) = 0 THEN 'severity'
    WHEN grouping(status) = 0 THEN 'status' ELSE 'total' END AS grouping,
  coalesce(incident_type, severity, status, 'all') AS value, count(*) AS incidents,
  count(*) FILTER (WHERE escalated) AS escalated_incidents
FROM inc WHERE created_at >= TIMESTAMP '2024-01-01 00:00:00'
GROUP BY GROUPING SETS ((), (incident_type), (severity), (status))
""", *_INC)
_add("incident_fallback", f"""
SELECT id, incident_type, CASE WHEN incident_type = 'late_arrivals' THEN 'open' ELSE status END AS status,
  CASE WHEN incident_type = 'late_arrivals' THEN first_severity ELSE severity END AS severity,
  strftime(CASE WHEN incident_type = 'late_arrivals' THEN created_at ELSE updated_at END,
           '%Y-%m-%d %H:%M:%S.%g') AS updated_at FROM inc
""", *_INC)
_add("incident_escalations", """
SELECT id, 'pipeline_failure' AS alert_type, 'Pipeline Failure - Incident Management' AS title,
  concat('Component: incident_management', chr(10), 'Error: Incident escalated: ', summary, chr(10),
    'Additional Context:', chr(10), '  incident_id: ', id, chr(10), '  incident_type: ', incident_type, chr(10),
    '  severity: ', severity, chr(10), '  escalation_notes: needs attention') AS message, 'error' AS severity
FROM inc WHERE escalated
""", *_INC)

# -- decisions --------------------------------------------------------------------------------------

_add("decision_context", """
SELECT run_id, 'ok' AS context_status, total_records, late_records, dq_failures, schema_drift_detected,
  processing_errors, evaluated_expectations, unsuccessful_expectations,
  successful_expectations / evaluated_expectations AS overall_success_rate,
  (SELECT count(*) FROM inc i WHERE i.created_at BETWEEN rr.end_time - INTERVAL 7 DAY AND rr.end_time)
    AS recent_incidents,
  (SELECT count(*) FROM inc i WHERE i.escalated
     AND i.created_at BETWEEN rr.end_time - INTERVAL 7 DAY AND rr.end_time) AS recent_escalated
FROM rr JOIN st USING (run_id)
""", *_INC, _COPIES, _RESULTS, _STATS)
_REASONS = """
rd AS (
  SELECT *, coalesce(nullif(concat_ws('; ',
      CASE WHEN schema_drift_detected THEN 'Schema drift detected; Applied automatic schema remapping' END,
      CASE WHEN late_rate > 0.15 THEN concat('High late arrival rate: ', printf('%.2f%%', late_rate * 100)) END,
      CASE WHEN dq_failure_rate > 0.05
           THEN concat('High DQ failure rate: ', printf('%.2f%%', dq_failure_rate * 100)) END), ''),
    'Pipeline running normally') AS reasoning,
    late_rate > 0.15 OR dq_failure_rate > 0.05 AS escalation_required FROM ra)
"""
_add("rule_decisions", """
SELECT run_id, 'Rule-based analysis' AS decision, reasoning, CAST(0.8 AS DOUBLE) AS confidence,
  escalation_required,
  CASE WHEN schema_drift_detected THEN 'apply_schema_remap,notify_ops' ELSE 'notify_ops' END AS actions FROM rd
""", _REPORT, _REASONS)
_add("decision_log", """
SELECT run_id, strftime(end_time, '%Y-%m-%d %H:%M:%S.%g') AS timestamp, 'Rule-based analysis' AS decision,
  reasoning, CAST(0.8 AS DOUBLE) AS confidence, escalation_required,
  CASE WHEN schema_drift_detected THEN 2 ELSE 1 END AS actions_count, total_records, late_records,
  dq_failures, schema_drift_detected AS schema_drift FROM rd
""", _REPORT, _REASONS)
_add("action_audit", """
SELECT run_id, strftime(end_time, '%Y-%m-%d %H:%M:%S.%g') AS decided_at, 0 AS action_no,
  'apply_schema_remap' AS tool, 'advised' AS status, 'Schema remap advised' AS message
FROM rd WHERE schema_drift_detected
UNION ALL
SELECT run_id, strftime(end_time, '%Y-%m-%d %H:%M:%S.%g'), CASE WHEN schema_drift_detected THEN 1 ELSE 0 END,
  'notify_ops', 'advised', 'Notification advised' FROM rd
""", _REPORT, _REASONS)
_STREAKS = """
oc AS (
  SELECT run_id, 'late_arrivals' AS failure_type, late_rate > 0.15 AS failed FROM ra
  UNION ALL SELECT run_id, 'data_quality', dq_failure_rate > 0.05 FROM ra
  UNION ALL SELECT run_id, 'schema_drift', schema_drift_detected FROM ra
  UNION ALL SELECT run_id, 'processing_error', processing_errors > 0 FROM ra),
sk AS (
  SELECT run_id, failure_type, failed,
    CAST(count(*) FILTER (WHERE failed) OVER (PARTITION BY failure_type, island ORDER BY run_id) AS BIGINT) AS streak
  FROM (SELECT *, count(*) FILTER (WHERE NOT failed) OVER (PARTITION BY failure_type ORDER BY run_id) AS island
        FROM oc))
"""
_TEXT = {"country": "concat('country=', coalesce(country, '(none)'))", "plan": "concat('plan=', coalesce(plan, '(none)'))",
         "version": "concat('version=', coalesce(CAST(version AS VARCHAR), '(none)'))"}
_SETS = [["country"], ["plan"], ["version"], ["country", "plan"], ["country", "version"], ["plan", "version"],
         ["country", "plan", "version"]]


def _cells(source: str, depth: int) -> str:
    """Records and failures of every cell of at most ``depth`` attributes, each set of attributes grouped by itself."""
    return "\nUNION ALL ".join(
        f"SELECT run_id, concat_ws(' AND ', {', '.join(_TEXT[a] for a in names)}) AS segment, {len(names)} AS size, "
        f"count(*) AS total_records, count(*) FILTER (WHERE NOT dq_passed) AS failures FROM {source} GROUP BY run_id, {', '.join(names)}"
        for names in _SETS if len(names) <= depth)


_WHOLE = "whole AS (SELECT run_id, count(*) AS all_records, count(*) FILTER (WHERE NOT dq_passed) AS all_failures FROM fl GROUP BY run_id)"
_add("failure_cube", f"""
SELECT run_id, segment, total_records, failures, all_records, all_failures FROM ({_cells("fl", 3)}) JOIN whole USING (run_id)
WHERE failures > 0 AND failures >= 0.1 * all_failures
""", _WHOLE)


def _best(source: str, place: int) -> str:
    return f"""
  SELECT * FROM (
    SELECT run_id, {place} AS place, segment, total_records, failures,
      round(failures - total_records * all_failures / all_records, 9) AS excess,
      row_number() OVER (PARTITION BY run_id ORDER BY round(failures - total_records * all_failures / all_records, 9) DESC, size, segment) AS r
    FROM ({_cells(source, 2)}) JOIN whole USING (run_id)
    WHERE failures > 0 AND failures >= 0.1 * all_failures)
  WHERE r = 1 AND excess > 0"""


_INSIDE = " OR ".join("b.segment = concat_ws(' AND ', " + ", ".join(_TEXT[a] for a in names) + ")" for names in _SETS if len(names) <= 2)
_add("decision_segments", """
SELECT run_id, place, segment, total_records, failures, excess FROM b1
UNION ALL SELECT run_id, place, segment, total_records, failures, excess FROM b2
""", _WHOLE, f"b1 AS ({_best('fl', 1)})", f"""
rest AS (SELECT fl.* FROM fl JOIN b1 b USING (run_id) WHERE NOT coalesce({_INSIDE}, false))""", f"b2 AS ({_best('rest', 2)})")
_add("failure_streaks", f"""
SELECT run_id, failure_type, {_tri('failed')}, streak, sk.failed AND streak >= 3 AS escalate FROM sk
""", _REPORT, _STREAKS)
_add("last_runs", """
SELECT run_id, count(*) OVER w AS window_runs, CAST(sum(total_records) OVER w AS BIGINT) AS window_records,
  CAST(sum(late_records) OVER w AS BIGINT) AS window_late,
  CAST(sum(dq_failures) OVER w AS BIGINT) AS window_dq_failures,
  max(dq_failures) OVER w AS window_max_dq_failures
FROM rr WINDOW w AS (ORDER BY run_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
""", _REPORT)
_MATRIX = """
mx AS (
  SELECT ra.*, drift_class, max_share, coalesce(streak, 0) AS streak FROM ra LEFT JOIN dc USING (run_id)
  LEFT JOIN (SELECT run_id, max(failure_share) AS max_share FROM ss GROUP BY run_id) USING (run_id)
  LEFT JOIN (SELECT run_id, max(streak) FILTER (WHERE failed) AS streak FROM sk GROUP BY run_id) USING (run_id)),
mt AS (
SELECT run_id, 1 AS priority, 'critical_share' AS condition, 'escalate_incident' AS action, true AS escalate
  FROM mx WHERE dq_failure_rate > 0.1
UNION ALL SELECT run_id, 2, 'repeated_failures', 'escalate_incident', true FROM mx WHERE streak >= 3
UNION ALL SELECT run_id, 3, 'breaking_drift', 'quarantine_and_escalate', true FROM mx WHERE drift_class = 'breaking'
UNION ALL SELECT run_id, 4, 'high_late_rate', 'escalate_incident', true FROM mx WHERE late_rate > 0.15
UNION ALL SELECT run_id, 5, 'high_dq_rate', 'escalate_incident', true FROM mx WHERE dq_failure_rate > 0.05
UNION ALL SELECT run_id, 6, 'localised_dq', 'quarantine_records', false FROM mx
  WHERE dq_failures > 0 AND max_share >= 0.1
UNION ALL SELECT run_id, 7, 'additive_drift', 'remap', false FROM mx WHERE drift_class = 'additive'
UNION ALL SELECT run_id, 8, 'processing_errors', 'retrigger_task', false FROM mx WHERE processing_errors > 0
UNION ALL SELECT run_id, 9, 'tolerable_late', 'retrigger_task', false FROM mx
  WHERE late_records > 0 AND late_rate < 0.15
UNION ALL SELECT run_id, 10, 'tolerable_dq', 'log_and_continue', false FROM mx
  WHERE dq_failures > 0 AND dq_failure_rate < 0.05)
"""
_add("decision_matrix", "SELECT * FROM mt", _REPORT, _STREAKS, _SHARES, *_RAW, _DRIFT, _MATRIX)

# -- alerts -----------------------------------------------------------------------------------------

_add("alert_outbox", """
SELECT a.*, channel FROM (
  SELECT run_id, 'data_quality' AS alert_type, 'Data Quality Issue - Validation Failure' AS title,
    concat('Issue Type: validation_failure', chr(10), 'Affected Records: ', format('{:,}', dq_failures),
      ' out of ', format('{:,}', total_records), chr(10), 'Failure Rate: ',
      printf('%.2f%%', dq_failure_rate * 100)) AS message,
    CASE WHEN dq_failure_rate * 100 > 10 THEN 'critical' WHEN dq_failure_rate * 100 > 5 THEN 'error'
         WHEN dq_failure_rate * 100 > 1 THEN 'warning' ELSE 'info' END AS severity FROM rd
  UNION ALL
  SELECT run_id, 'schema_drift', 'Schema Drift Detected',
    concat('Schema evolution detected in incoming data:',
      CASE WHEN new_fields <> '' THEN concat(chr(10), 'New Fields: ', replace(new_fields, ',', ', ')) ELSE '' END,
      CASE WHEN removed_fields <> ''
           THEN concat(chr(10), 'Removed Fields: ', replace(removed_fields, ',', ', ')) ELSE '' END,
      CASE WHEN type_changes <> ''
           THEN concat(chr(10), 'Type Changes: ', replace(type_changes, ',', ', ')) ELSE '' END), 'warning'
  FROM dc WHERE drift_class <> 'none'
  UNION ALL
  SELECT run_id, 'pipeline_failure', 'Pipeline Failure - Spark',
    concat('Component: spark', chr(10), 'Error: ', processing_errors, ' processing errors', chr(10),
      'Additional Context:', chr(10), '  run_id: ', run_id), 'error' FROM rd WHERE processing_errors > 0
  UNION ALL
  SELECT run_id, 'status', 'Data Pipeline Alert', concat('Pipeline status: ', reasoning),
    CASE WHEN escalation_required THEN 'warning' ELSE 'info' END FROM rd) a,
  (VALUES ('slack'), ('email')) c(channel)
""", _REPORT, _REASONS, *_RAW, _DRIFT)



def _digest(name: str, columns: list[str], source: str) -> str:
    """Rows and the sum of their hashes, over the text of the columns' values."""
    text = ", '|', ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return (f"SELECT '{name}' AS table_name, count(*) AS rows, "
            f"CAST(sum(CAST(concat('0x', substr(md5(concat({text})), 1, 8)) AS BIGINT)) AS BIGINT) AS digest FROM ({source})")


_AUDIT = """
SELECT run_id, 0 AS action_no, 'apply_schema_remap' AS tool, 'advised' AS status, 'Schema remap advised' AS message
FROM rd WHERE schema_drift_detected
UNION ALL SELECT run_id, CASE WHEN schema_drift_detected THEN 1 ELSE 0 END, 'notify_ops', 'advised', 'Notification advised' FROM rd
"""
# The chain escalates at once and resolves nothing.
_EVENTS = """
SELECT id, incident_type, summary, severity, 'open' AS status, 0 AS change_seq FROM opened
UNION ALL SELECT id, NULL, NULL, NULL, NULL, 1 FROM opened WHERE severity IN ('high', 'critical')
"""
_CONTEXT = """
SELECT rd.*, (SELECT count(*) FROM opened i WHERE i.created_at BETWEEN rd.end_time - INTERVAL 7 DAY AND rd.end_time) AS recent_incidents,
  (SELECT count(*) FROM opened i WHERE i.severity IN ('high', 'critical')
     AND i.created_at BETWEEN rd.end_time - INTERVAL 7 DAY AND rd.end_time) AS recent_escalated FROM rd
"""
_ALERTS = ORACLES["alert_outbox"][ORACLES["alert_outbox"].index("SELECT a.*, channel FROM ("):].replace("SELECT a.*, channel", "SELECT *", 1)
_add("remediation_tables", "\nUNION ALL ".join([
    _digest("run_reports", ["run_id", "total_records", "late_records", "dq_failures", "dq_unknown", "processing_errors"], "SELECT * FROM rr"),
    _digest("dq_results", ["run_id", "position", "column_name", "success", "element_count", "missing_count", "unexpected_count"],
            "SELECT * REPLACE (CASE WHEN judged THEN element_count END AS element_count, "
            "CASE WHEN judged THEN missing_count END AS missing_count, "
            "CASE WHEN judged THEN unexpected_count END AS unexpected_count) FROM res"),
    _digest("decisions", ["run_id", "reasoning", "escalation_required", "recent_incidents", "recent_escalated"], _CONTEXT),
    _digest("decision_log", ["run_id", "reasoning", "escalation_required", "actions_count"],
            "SELECT *, CASE WHEN schema_drift_detected THEN 2 ELSE 1 END AS actions_count FROM rd"),
    _digest("action_audit", ["run_id", "action_no", "tool", "status", "message"], _AUDIT),
    _digest("incident_events", ["id", "incident_type", "summary", "severity", "status", "change_seq"], _EVENTS),
    _digest("alerts", ["run_id", "alert_type", "title", "message", "severity", "channel"],
            f"SELECT * FROM ({_ALERTS}) WHERE alert_type <> 'pipeline_failure'"),
]), *_INC, _REASONS, _COPIES, _RESULTS, *_RAW, _DRIFT)

# Whole runs of breaking drift and the worst segment's failures of localised ones are held; additive runs add their new fields.
_EFFECTS = """
sg AS (
  SELECT run_id, country, plan FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY failure_share DESC, country NULLS FIRST, plan NULLS FIRST) AS r FROM ss)
  WHERE r = 1),
fd AS (
  SELECT m.run_id, md5(concat_ws('|', m.run_id, condition, action)) AS call_id, field,
    CASE observed WHEN 'string' THEN 'string' WHEN 'integer' THEN 'bigint' WHEN 'number' THEN 'double' WHEN 'boolean' THEN 'boolean' END AS spec,
    end_time FROM mt m JOIN cmp USING (run_id) JOIN rr USING (run_id) WHERE action = 'remap' AND status = 'new'),
hd AS (
  SELECT fl.run_id, event_id, first(condition ORDER BY priority) AS reason, first(action ORDER BY priority) AS action
  FROM fl JOIN mt ON mt.run_id = fl.run_id LEFT JOIN sg ON sg.run_id = fl.run_id
  WHERE action = 'quarantine_and_escalate' OR (action = 'quarantine_records' AND NOT dq_passed
    AND fl.country IS NOT DISTINCT FROM sg.country AND fl.plan IS NOT DISTINCT FROM sg.plan)
  GROUP BY fl.run_id, event_id),
done AS (
  SELECT run_id, condition, action, CASE action
      WHEN 'remap' THEN (SELECT count(*) FROM fd WHERE fd.run_id = mt.run_id AND spec IS NOT NULL)
      WHEN 'quarantine_records' THEN (SELECT count(*) FROM hd WHERE hd.run_id = mt.run_id AND reason = condition)
      WHEN 'quarantine_and_escalate' THEN (SELECT count(*) FROM hd WHERE hd.run_id = mt.run_id AND reason = condition) END AS n
  FROM mt)
"""
_add("remediation_effects", """
SELECT 'ledger' AS kind, run_id, concat_ws(' ', condition, action, CASE WHEN n IS NULL THEN 'advised' WHEN n > 0 THEN 'applied' ELSE 'failed' END) AS name,
  coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN concat('Advised: ', action)
    WHEN n > 0 THEN concat(n, CASE WHEN action = 'remap' THEN ' fields' ELSE ' records' END)
    ELSE concat('Nothing to change: no ', CASE WHEN action = 'remap' THEN 'fields' ELSE 'records' END) END AS detail FROM done
UNION ALL
SELECT 'remap', -1, field, 1, max_by(spec, (end_time, call_id)) FROM fd WHERE spec IS NOT NULL GROUP BY field
UNION ALL SELECT 'quarantine', run_id, reason, count(*), CAST(CAST(sum(event_id) AS BIGINT) AS VARCHAR) FROM hd GROUP BY run_id, reason
UNION ALL SELECT 'released', -1, 'events', count(*), CAST(CAST(sum(event_id) AS BIGINT) AS VARCHAR) FROM fl WHERE event_id NOT IN (SELECT event_id FROM hd)
""", _REPORT, _STREAKS, _SHARES, *_RAW, _DRIFT, _MATRIX, _EFFECTS)
_add("remap_decoded", """
SELECT event_id, CASE WHEN NOT is_cut THEN id END AS id, CASE WHEN NOT is_cut THEN plan END AS plan,
  CASE WHEN NOT is_cut THEN sent_email END AS email,
  CASE WHEN NOT is_cut THEN CAST(opt_in AS VARCHAR) END AS marketing_opt_in,
  CASE WHEN NOT is_cut THEN customer_segment END AS customer_segment FROM wire
""", _WIRE)
_add("country_membership", f"""
SELECT event_id, country FROM ce WHERE country IS NOT NULL AND country NOT IN {_COUNTRIES}
""")

# -- responses ---------------------------------------------------------------------------------------

_SPACE = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_STRIP = f"^{_SPACE}+|{_SPACE}+$"
_RESPONSES = f"""
rsp AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 50 = 49 AND turn = 0 THEN NULL ELSE concat(
    'Preamble of turn ', turn, chr(10), 'ANALYSIS:', chr(10), '- Current status: degraded', chr(10),
    '- Risk: low', chr(10),
    CASE WHEN turn % 4 = 3 THEN '' ELSE concat('DECISION:', chr(10), '  Act on conversation ', conv_id, '  ', chr(10)) END,
    'REASONING:', chr(10), text, chr(10), 'ACTIONS:', chr(10),
    CASE turn % 4
      WHEN 0 THEN '[{{"params": {{"message": "turn"}}, "tool": "notify_ops"}}, {{''tool'': ''apply_schema_remap''}}]'
      WHEN 1 THEN concat('{{"params": {{"filter_condition": "conv_id = ', conv_id, '"}}, "tool": "quarantine_records"}}')
      WHEN 2 THEN '{{"tool": "reboot"}} and {{not json}} and {{"params": {{"a": 1}}}}' ELSE '' END, chr(10),
    CASE WHEN conv_id % 7 = 6 THEN '' ELSE concat('CONFIDENCE:', chr(10),
      CASE conv_id % 5 WHEN 0 THEN '95%' WHEN 1 THEN 'high' WHEN 2 THEN '0.65' WHEN 3 THEN '0.9 of 1'
        ELSE '.5' END, chr(10)) END,
    CASE WHEN conv_id % 3 = 2 THEN '' ELSE concat('Escalation:', chr(10),
      CASE WHEN turn % 2 = 0 THEN 'True' ELSE 'false' END) END) END AS text
  FROM conversations),
ln AS (
  SELECT conv_id, turn, line_no, regexp_replace(line, '{_STRIP}', '', 'g') AS line
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM rsp WHERE text IS NOT NULL)),
mk AS (
  SELECT *, ends_with(line, ':') AND length(line) < 20 AS header,
    count(*) FILTER (WHERE ends_with(line, ':') AND length(line) < 20)
      OVER (PARTITION BY conv_id, turn ORDER BY line_no) AS part FROM ln),
sec AS (
  SELECT conv_id, turn, CAST(part - 1 AS INTEGER) AS section_no,
    lower(max(CASE WHEN header THEN line[:-2] END)) AS name,
    coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT header), '') AS body
  FROM mk WHERE part > 0 GROUP BY conv_id, turn, part),
lastsec AS (
  SELECT conv_id, turn, name, body
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, name ORDER BY section_no DESC) AS r FROM sec)
  WHERE r = 1 AND name <> '')
"""
ORACLES["response_sections"] = "WITH " + _RESPONSES.strip() + """
SELECT conv_id, turn, section_no, name, body FROM sec WHERE name <> ''
"""
# Every turn but the last kind calls known tools with fixed texts; params in the order they were sent.
_CALLS = """
calls AS (
  SELECT conv_id, turn, action_no, tool, CASE WHEN params IS NULL THEN '{}' ELSE CAST(params AS VARCHAR) END AS params
  FROM (
    SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY m_no) - 1 AS INTEGER) AS action_no,
      json_extract_string(j, '$.tool') AS tool, json_extract(j, '$.params') AS params
    FROM (
      SELECT conv_id, turn, m_no, CASE WHEN json_valid(m) THEN m
          WHEN json_valid(replace(m, '''', '"')) THEN replace(m, '''', '"') END AS j
      FROM (
        SELECT conv_id, turn, unnest(f) AS m, generate_subscripts(f, 1) AS m_no
        FROM (SELECT conv_id, turn,
                regexp_extract_all(text, '\\{[^{}]*(?:\\{[^{}]*\\}[^{}]*)*\\}') AS f FROM rsp)))
    WHERE j IS NOT NULL AND coalesce(json_extract_string(j, '$.tool'), '') <> ''))
"""
ORACLES["response_actions"] = "WITH " + _RESPONSES.strip() + "," + _CALLS + """
SELECT conv_id, turn, action_no, tool, params,
  tool IN ('retrigger_task', 'apply_schema_remap', 'quarantine_records', 'notify_ops', 'escalate_incident') AS success,
  CASE tool WHEN 'apply_schema_remap' THEN 'Schema remap applied successfully'
    WHEN 'quarantine_records' THEN concat('Quarantine configured for records matching: ',
      coalesce(json_extract_string(params, '$.filter_condition'), ''))
    WHEN 'notify_ops' THEN 'Notification sent successfully' WHEN 'retrigger_task' THEN 'Retrigger advised'
    WHEN 'escalate_incident' THEN 'Incident logged' ELSE concat('Unknown tool: ', tool) END AS message
FROM calls
"""
ORACLES["response_decisions"] = "WITH " + _RESPONSES.strip() + "," + _CALLS.strip() + f""",
dec AS (
  SELECT conv_id, turn, text IS NULL AS failed,
    coalesce(max(body) FILTER (WHERE name = 'decision'), 'No decision made') AS decision,
    coalesce(max(body) FILTER (WHERE name = 'reasoning'), 'No reasoning provided') AS reasoning,
    coalesce(max(body) FILTER (WHERE name = 'confidence'), '0.7') AS confidence,
    coalesce(max(body) FILTER (WHERE name = 'escalation'), 'false') AS escalation
  FROM rsp LEFT JOIN lastsec USING (conv_id, turn) GROUP BY conv_id, turn, text IS NULL),
sure AS (
  SELECT *, CASE WHEN failed THEN 0.0
      WHEN regexp_extract(confidence, '\\d+\\.?\\d*') = '' THEN 0.5
      ELSE least(CAST(regexp_extract(confidence, '\\d+\\.?\\d*') AS DOUBLE), 1.0) END AS c FROM dec)
SELECT conv_id, turn,
  CASE WHEN failed THEN 'Error in decision making - manual review required'
       ELSE regexp_replace(decision, '{_STRIP}', '', 'g') END AS decision,
  CASE WHEN failed THEN 'Failed to parse LLM response'
       ELSE regexp_replace(reasoning, '{_STRIP}', '', 'g') END AS reasoning,
  CAST(c AS DOUBLE) AS confidence, failed OR contains(lower(escalation), 'true') AS escalation_required,
  CASE WHEN c >= 0.7 THEN coalesce((SELECT string_agg(concat(tool, params), ';' ORDER BY action_no) FROM calls k
    WHERE k.conv_id = sure.conv_id AND k.turn = sure.turn), '') ELSE '' END AS actions
FROM sure
"""

# -- sources, sinks, streams ----------------------------------------------------------------------------

_OFFSETS = """
off AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id // 4 + 3 * (event_id // 1000) AS o, unnest(range(copies)) AS copy
  FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS copies FROM ce WHERE event_id % 251 <> 17))
"""
_add("offset_audit", """
SELECT kafka_partition, min(o) AS min_offset, max(o) AS max_offset, count(*) AS messages,
  count(*) - count(DISTINCT o) AS redelivered, max(o) - min(o) + 1 - count(DISTINCT o) AS missing_offsets
FROM off GROUP BY kafka_partition
""", _OFFSETS)
_add("offset_gaps", """
SELECT kafka_partition, before + 1 AS first_missing, o - 1 AS last_missing, o - before - 1 AS missing
FROM (SELECT kafka_partition, o, lag(o) OVER (PARTITION BY kafka_partition ORDER BY o) AS before
      FROM (SELECT DISTINCT kafka_partition, o FROM off)) WHERE o > before + 1
""", _OFFSETS)
_add("load_validation", """
SELECT CASE WHEN count(*) > 0 THEN 'success' ELSE 'no_data' END AS status, count(*) > 0 AS has_files,
  count(*) > 0 AS newest_has_bytes FROM ce
""")
_add("curated_table", """
SELECT country, plan, count(*) AS events, count(*) FILTER (WHERE dq_passed) AS passed FROM fl GROUP BY country, plan
""")
_add("stream_curated", f"""
SELECT event_id, run_id, country, plan, region, is_late_arrival, {_tri('dq_passed')} FROM fl
""")
# Streams count no undecodable records: the fixture stream arrives decoded.
_add("stream_report", f"""
SELECT {_REPORT_COLUMNS.replace('processing_errors', 'CAST(0 AS BIGINT) AS processing_errors')} FROM rr
""", _REPORT)
_add("stream_late_split", """
SELECT event_id, CASE WHEN is_late_arrival THEN 'late' ELSE 'table' END AS side FROM fl
""")
_add("stream_windowed_report", f"SELECT {_WINDOW_COLUMNS} FROM wr", _WINDOWS)
_add("stream_dedup", "SELECT event_id, run_id, id FROM ce")
_add("stream_sketches", """
SELECT run_id, count(DISTINCT id) AS exact_ids, count(*) AS records, true AS p50_within, true AS p95_within, true AS ids_within
FROM fl GROUP BY run_id
""")
_add("stream_metrics", """
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_late_arrival) AS late_records,
  count(*) FILTER (WHERE NOT dq_passed) AS dq_failures, count(*) FILTER (WHERE dq_passed IS NULL) AS dq_unknown,
  count(*) FILTER (WHERE schema_drift_detected) AS schema_drift_count FROM fl
""")

# Two calls, one of them repeated, leave the tables of one call.
ORACLES["remediation_replay"] = ORACLES["remediation_tables"]
