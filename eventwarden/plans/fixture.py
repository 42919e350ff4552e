"""Customer events derived from the star-schema tables, for tests, oracles and the bench.

See FIXTURES.md, sections B and D.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwarden.operators import enrich as E, report as R
from eventwarden.session import pin_session, stage_table
from eventwarden.sources.events import ENVELOPE  # noqa: F401  (documented column order)

# Undecodable records of the derived stream, counted as processing errors of a run.
DECODE_FAILED = "event_id % 613 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_events(events: DataFrame, customer: DataFrame) -> DataFrame:
    """One customer event per row of ``events`` (which may be a stream)."""
    base = (events.join(customer, F.col("user_id") == F.col("c_custkey"))
            .selectExpr("event_id AS n", "c_custkey AS k", "c_name", "c_nationkey", "c_mktsegment",
                        "unix_millis(CAST(ts AS TIMESTAMP)) AS ms",
                        "CAST(floor(event_id / 500.0) AS BIGINT) AS run_id"))
    return base.selectExpr(
        "n AS event_id",
        "run_id",
        "concat('cust_', k) AS id",
        "CASE WHEN n % 41 = 0 THEN NULL ELSE c_name END AS name",
        """CASE WHEN n % 61 = 0 THEN 'invalid-email' WHEN n % 97 = 0 THEN NULL
                ELSE concat('u', k, '@', lower(c_mktsegment), '.example.com') END AS email""",
        """CASE WHEN n % 59 = 0 THEN ms + 172800000
                ELSE ms - (k * 37 % 1700) * 86400000 END AS signup_ts""",
        """CASE c_nationkey % 13 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'MX' WHEN 3 THEN 'GB'
                WHEN 4 THEN 'DE' WHEN 5 THEN 'FR' WHEN 6 THEN 'AU' WHEN 7 THEN 'JP' WHEN 8 THEN 'IN'
                WHEN 9 THEN 'BR' WHEN 10 THEN 'ES' WHEN 11 THEN 'INVALID' END AS country""",
        """CASE WHEN n % 53 = 0 THEN NULL WHEN run_id % 3 = 1 AND n % 31 = 0 THEN 'invalid_plan'
                WHEN k % 4 = 0 THEN 'free' WHEN k % 4 = 1 THEN 'basic'
                WHEN k % 4 = 2 THEN 'premium' ELSE 'enterprise' END AS plan""",
        "ms AS event_ts",
        """CASE WHEN n % 200 = 100 THEN 3 WHEN n % 100 = 0 AND n > 0 THEN 2 ELSE 1 END AS version""",
        """ms + CASE WHEN n % 20 = 0 OR (run_id % 4 = 3 AND n % 5 = 0) THEN 7200000
                     WHEN n % 37 = 0 THEN -3600000 ELSE (n % 16) * 60000 END AS processing_ts""",
    )


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return derive_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))


def customer_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream over the events files."""
    pin_session(spark)
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    return derive_events(spark.readStream.schema(schema).parquet(f"{path}*"),
                         table(spark, sf_dir, "customer"))


#: Events whose deliveries fill two files of each micro-batch.
FILE_EVENTS = 1_000_000


def delivered_files(spark: SparkSession, sf_dir: str, folder: str, parts: int = 5) -> DataFrame:
    """A stream of deliveries in ``parts`` micro-batches, two files to each, or more where events are many.

    Events arrive out of order, every event twice and event 0 in a third of all rows.
    """
    once = customer_events(spark, sf_dir)
    n = once.count()
    per_batch = 2 * max(-(-n // FILE_EVENTS), 1)
    files = per_batch * parts
    slot = lambda salt: F.pmod(F.xxhash64("event_id", F.lit(salt)), F.lit(parts))
    twice = once.withColumn("slot", F.explode(F.array(slot(0), slot(1)))).withColumn("copy", F.lit(0).cast("bigint"))
    # the repeats in blocks, so that no task makes all of them
    repeats, block = max(n, 1), 100_000
    hot = (once.filter("event_id = 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((repeats - 1) // block).cast("bigint"))))
           .repartition(files, "block")
           .withColumn("copy", F.explode(F.sequence(F.col("block") * block + 1, F.least((F.col("block") + 1) * block, F.lit(repeats)))))
           .withColumn("slot", F.pmod("copy", F.lit(parts)).cast("bigint")).drop("block"))
    (twice.unionByName(hot).repartition(files, F.xxhash64("event_id", "slot", "copy")).drop("slot", "copy")
     .write.mode("append").parquet(folder))
    return spark.readStream.schema(once.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def clock():
    """The fixture's processing clock."""
    return F.timestamp_millis("processing_ts")


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.curate(customer_events(spark, sf_dir), clock())


def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.run_report(flagged_events(spark, sf_dir), error=F.expr(DECODE_FAILED))


def staged_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run reports with rates, written once: the later steps of a chain share them."""
    return R.run_rates(stage_table(run_reports(spark, sf_dir), "run_reports"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's wire form: one JSON payload per event inside a source envelope.

    Some runs rename, drop or retype a field, and some payloads are cut short.
    """
    payload = F.expr("""
        to_json(named_struct(
            'id', id, 'name', name,
            'email', CASE WHEN run_id % 11 = 5 THEN NULL ELSE email END,
            'email_address', CASE WHEN run_id % 11 = 5 THEN email END,
            'signup_ts', signup_ts,
            'country', CASE WHEN run_id % 7 = 3 THEN NULL ELSE country END,
            'plan', plan, 'event_ts', event_ts,
            'version', CASE WHEN run_id % 5 = 2 THEN NULL ELSE version END,
            'marketing_opt_in', CASE WHEN version >= 2 THEN event_id % 3 = 0 END,
            'customer_segment', CASE WHEN version >= 3 THEN 'standard' END))
    """)
    # to_json has one type per field, so a textual version is spliced in.
    spliced = F.expr("""
        CASE WHEN run_id % 5 = 2
             THEN concat(left(payload, length(payload) - 1), ',"version":"', version, '"}')
             ELSE payload END
    """)
    cut = F.expr("CASE WHEN event_id % 73 = 0 THEN left(payload, length(payload) - 5) ELSE payload END")
    return (customer_events(spark, sf_dir)
            .withColumn("payload", payload).withColumn("payload", spliced).withColumn("payload", cut)
            .select("event_id", "run_id",
                    F.col("id").cast("binary").alias("key"),
                    F.col("payload").cast("binary").alias("value"),
                    clock().alias("timestamp"),
                    F.expr("CAST(event_id DIV 4 + 3 * (event_id DIV 1000) AS BIGINT)").alias("offset"),
                    F.expr("CAST(event_id % 4 AS INT)").alias("partition")))


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested payloads; some runs change a type, add a field or leave one out below the top."""
    return customer_events(spark, sf_dir).selectExpr("event_id", "run_id", """
        CASE WHEN event_id % 73 = 0 THEN left(id, 4) ELSE concat(
            '{"id":"', id, '","customer":{"plan":', coalesce(concat('"', plan, '"'), 'null'), ',"place":{',
            CASE WHEN run_id % 7 = 3 THEN '' ELSE concat('"country":', coalesce(concat('"', country, '"'), 'null'), ',') END,
            '"zone":', CASE WHEN run_id % 5 = 2 AND event_id % 2 = 0 THEN concat('"', event_id % 9, '"') ELSE cast(event_id % 9 AS string) END, '}},',
            '"items":[', CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('{"sku":', event_id,
                CASE WHEN run_id % 3 = 1 THEN ',"price":1.5}' ELSE ',"price":2}' END,
                CASE WHEN event_id % 4 = 3 THEN ',{"sku":7,"price":3,"gift":true}' ELSE '' END) END, '],',
            '"tags":[', CASE WHEN run_id % 11 = 5 THEN '1,"a"' ELSE '"a","b"' END, ']}') END AS raw""")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events; every tenth order uses the drifted field names."""
    pin_session(spark)
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_key",
        """CASE WHEN o_orderkey % 10 = 0 THEN
               to_json(named_struct('event', 'order_created', 'orderId', concat('A', o_orderkey),
                                    'amt', CASE WHEN o_orderkey % 89 = 0 THEN -o_totalprice
                                                ELSE o_totalprice END,
                                    'ts', unix_seconds(CAST(o_orderdate AS TIMESTAMP))))
           ELSE
               to_json(named_struct('event', 'order_created', 'order_id', concat('A', o_orderkey),
                                    'amount', CASE WHEN o_orderkey % 89 = 0 THEN -o_totalprice
                                                   ELSE o_totalprice END,
                                    'ts', unix_seconds(CAST(o_orderdate AS TIMESTAMP))))
           END AS raw""")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses: every conversation turn as the reasoning of one response."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn",
        r"""CASE WHEN conv_id % 50 = 49 AND turn = 0 THEN NULL ELSE concat(
            'Preamble of turn ', turn, '\nANALYSIS:\n- Current status: degraded\n- Risk: low\n',
            CASE WHEN turn % 4 = 3 THEN '' ELSE concat('DECISION:\n  Act on conversation ', conv_id, '  \n') END,
            'REASONING:\n', text, '\n',
            'ACTIONS:\n',
            CASE turn % 4
                WHEN 0 THEN '[{"params": {"message": "turn"}, "tool": "notify_ops"}, {''tool'': ''apply_schema_remap''}]'
                WHEN 1 THEN concat('{"params": {"filter_condition": "conv_id = ', conv_id,
                                   '"}, "tool": "quarantine_records"}')
                WHEN 2 THEN '{"tool": "reboot"} and {not json} and {"params": {"a": 1}}'
                ELSE '' END, '\n',
            CASE WHEN conv_id % 7 = 6 THEN '' ELSE concat('CONFIDENCE:\n',
                CASE conv_id % 5 WHEN 0 THEN '95%' WHEN 1 THEN 'high' WHEN 2 THEN '0.65'
                                 WHEN 3 THEN '0.9 of 1' ELSE '.5' END, '\n') END,
            CASE WHEN conv_id % 3 = 2 THEN '' ELSE concat('Escalation:\n',
                CASE WHEN turn % 2 = 0 THEN 'True' ELSE 'false' END) END) END AS text""")
