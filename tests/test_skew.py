"""Hot values are split by adaptive execution, and no plan pairs rows or forces a broadcast."""

import pathlib

import pytest
from pyspark.sql import functions as F

from eventwarden import policies as P
from eventwarden.operators import incidents as I, quality as Q
from eventwarden.plans import queries

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small(spark):
    """Thresholds at which a few thousand rows count as skew."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_duplicate_is_split(small):
    events = small.range(0, 120_000, 1, 16).selectExpr(
        "id AS event_id", "'b' AS batch", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id) END AS id")
    dup = Q.duplicate_rows(events, P.CUSTOMER_SUITE[2:3], F.lit(0), ["event_id"], "batch")
    assert len(dup.collect()) == 40_000
    assert "SortMergeJoin(skew=true)" in dup._jdf.queryExecution().executedPlan().toString()


def test_hot_incident_keeps_every_notice(small):
    opened = I.log_incidents(small.range(0, 2_000, 1, 8).selectExpr(
        "id AS run_id", "timestamp_seconds(id) AS at", "'t' AS incident_type", "'s' AS summary",
        "'{}' AS context", "'high' AS severity"), ["run_id"])
    hot = opened.filter("change_at = timestamp_seconds(7)")
    again = hot.crossJoin(small.range(0, 60_000, 1, 16).withColumnRenamed("id", "n"))
    changes = opened.unionByName(I.escalate_incidents(opened, F.col("created_at"))).unionByName(
        I.escalate_incidents(again, F.timestamp_seconds("n")))
    state = I.fold_incidents(changes)
    notices = I.escalation_notices(changes, state)
    assert len(notices.select("id", "at").collect()) == 62_000


BANNED = ["localCheckpoint", "broadcast(", "crossJoin", ".rdd", "toPandas", ".collect()", "monotonically_increasing"]


def test_library_avoids_what_does_not_scale():
    root = pathlib.Path(queries.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue  # tests/llm looks at the text operators' broadcasts and collects
        text = path.read_text(encoding="utf-8")
        for word in BANNED:
            assert word not in text, f"{word} in {path}"


@pytest.mark.parametrize("name", [
    n for n in queries.QUERIES
    if not n.startswith("stream_") and n not in ("remediation_tables",)])
def test_no_cartesian_plans(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
