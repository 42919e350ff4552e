"""What decisions do to the data: intents, their effects, and a ledger of both.

An intent is an action of the decision table with everything its effect needs: a remap its fields, a quarantine its
segment.  Its key is a digest of run and action, so the same advice has the same key whenever it is given again.  The
ledger only grows: ``advised`` when an intent is first seen, then ``applied`` with the number of records or fields
it changed, or ``failed`` with the reason.  Success is never stated by whoever advises; it is read off what the
effect has written.  An applied intent is never applied again; a failed one is tried again by the next call.

Every table is written by batch.  A call that is repeated under its own batch replaces its own rows and only looks at
the ledger of the other batches; a later call finds the intents applied and leaves all tables as they are.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventwarden.operators import remap as RM
from eventwarden.operators.skew import splittable
from eventwarden.sinks import tables as K

#: Actions of the decision table that change data, and the tool that does it.
REMAP, QUARANTINE_SEGMENT, QUARANTINE_RUN = "remap", "quarantine_records", "quarantine_and_escalate"
#: Spark types of the observed classes a remap can add.
FIELD_TYPES = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}

LEDGER = "action_key string, run_id bigint, condition string, action string, status string, changed bigint, message string"
HISTORY = "call_id string, updated_at timestamp, field string, spec string"


def remap_details(compared: DataFrame) -> DataFrame:
    """(run_id, mapping): the new fields of a run with the type they were seen with; unknown types are left out."""
    kinds = F.create_map(*[F.lit(x) for pair in FIELD_TYPES.items() for x in pair])
    entry = F.when(F.col("status") == "new", F.struct(F.col("field"), F.try_element_at(kinds, F.col("observed")).alias("spec")))
    listed = F.filter(F.array_sort(F.collect_list(entry)), lambda e: e["spec"].isNotNull())
    return compared.groupBy("run_id").agg(F.map_from_entries(listed).alias("mapping"))


def worst_segment(shares: DataFrame) -> DataFrame:
    """(run_id, country, plan, max_segment_share): the segment with the largest share of a run's failures.

    Of equal shares the first by country, then plan, nulls first.
    """
    none_first = lambda c: F.struct(F.col(c).isNotNull().alias("some"), F.col(c).alias("value"))
    order = F.struct((-F.col("failure_share")).alias("share"), none_first("country").alias("c"), none_first("plan").alias("p"))
    return (shares.groupBy("run_id").agg(F.min(order).alias("m"))
            .select("run_id", F.col("m.c.value").alias("country"), F.col("m.p.value").alias("plan"),
                    (-F.col("m.share")).alias("max_segment_share")))


def intents(matrix: DataFrame, runs: DataFrame, mappings: DataFrame, segments: DataFrame) -> DataFrame:
    """The decision table's rows as intents of their run's end; a segment is named where the quarantine is of one."""
    of_segment = F.col("action") == QUARANTINE_SEGMENT
    details = (runs.select("run_id", F.col("end_time").alias("decided_at")).join(mappings, "run_id", "left")
               .join(segments.select("run_id", "country", "plan"), "run_id", "left"))
    joined = matrix.join(details, "run_id", "left")
    return joined.select(
        F.md5(F.concat_ws("|", F.col("run_id").cast("string"), "condition", "action")).alias("action_key"),
        "run_id", "decided_at", "condition", "action", "priority", "escalate",
        F.when(F.col("action") == REMAP, F.col("mapping")).alias("mapping"),
        F.when(of_segment, F.col("country")).alias("country"), F.when(of_segment, F.col("plan")).alias("plan"))


class EffectStore:
    """The tables under ``root``: ``action_ledger``, ``remap_history`` and ``quarantine``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.paths = {n: f"{root.rstrip('/')}/{n}" for n in ("action_intents", "action_ledger", "remap_history", "quarantine")}

    def _write(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        K.write_batch(df, batch_id, self.paths[name])
        return self.spark.read.schema(df.schema).parquet(f"{self.paths[name]}/batch_id={batch_id}")

    def ledger(self, but: int | None = None) -> DataFrame:
        """All entries, or those of all batches ``but`` one."""
        if not K.exists(self.spark, self.paths["action_ledger"]):
            return self.spark.createDataFrame([], f"{LEDGER}, batch_id bigint")
        rows = self.spark.read.schema(f"{LEDGER}, batch_id bigint").parquet(self.paths["action_ledger"])
        return rows if but is None else rows.filter(F.col("batch_id") != but)

    def states(self) -> DataFrame:
        """The state of each intent: applied if it ever was, else failed if it was tried, else advised."""
        rank = F.when(F.col("status") == "applied", 2).when(F.col("status") == "failed", 1).otherwise(0)
        last = F.struct(rank.alias("rank"), F.col("batch_id"), "run_id", "condition", "action", "status", "changed", "message")
        return (self.ledger().groupBy("action_key").agg(F.max(last).alias("m"))
                .select("action_key", "m.run_id", "m.condition", "m.action", "m.status", "m.changed", "m.message"))

    def apply(self, wanted: DataFrame, flagged: DataFrame, batch_id: int, source: str = "events") -> DataFrame:
        """Apply what no other batch has applied, then enter advice and outcomes in the ledger; returns this batch's entries.

        The order of writing makes a call that fails on the way safe to repeat: without its ledger entries its
        effects count as not done and are written over.
        """
        done = self.ledger(but=batch_id)
        applied = done.filter("status = 'applied'").select("action_key").distinct()
        known = done.select("action_key").distinct()
        wanted = self._write(wanted, "action_intents", batch_id)
        marked = wanted.join(applied.withColumn("done", F.lit(True)), "action_key", "left")
        pending = wanted.join(applied, "action_key", "left_anti")
        fields = self._write(self._remaps(pending), "remap_history", batch_id)
        held = self._write(self._held(marked, flagged, source), "quarantine", batch_id)
        entry = lambda df, status, changed, message: df.select(
            "action_key", "run_id", "condition", "action", status.alias("status"), changed.cast("bigint").alias("changed"),
            message.alias("message"))
        advised = entry(wanted.join(known, "action_key", "left_anti"), F.lit("advised"), F.lit(0), F.concat(F.lit("Advised: "), "action"))
        changed = (fields.groupBy(F.col("call_id").alias("action_key")).agg(F.count(F.lit(1)).alias("n"))
                   .unionByName(held.groupBy("action_key").agg(F.count(F.lit(1)).alias("n"))))
        tried = (pending.filter(F.col("action").isin(REMAP, QUARANTINE_SEGMENT, QUARANTINE_RUN))
                 .join(changed, "action_key", "left").withColumn("n", F.coalesce("n", F.lit(0))))
        worked = F.col("n") > 0
        what = F.when(F.col("action") == REMAP, "fields").otherwise("records")
        outcome = entry(tried, F.when(worked, "applied").otherwise("failed"), F.col("n"),
                        F.when(worked, F.concat(F.col("n").cast("string"), F.lit(" "), what))
                        .otherwise(F.concat(F.lit("Nothing to change: no "), what)))
        return self._write(advised.unionByName(outcome), "action_ledger", batch_id)

    def _remaps(self, pending: DataFrame) -> DataFrame:
        return pending.filter(F.col("action") == REMAP).select(
            F.col("action_key").alias("call_id"), F.col("decided_at").alias("updated_at"), F.explode("mapping").alias("field", "spec"))

    def _held(self, marked: DataFrame, flagged: DataFrame, source: str) -> DataFrame:
        """Each record to quarantine once, under its most urgent intent; left out where that was applied before.

        A run has at most one intent per kind, so the runs' intents are collected and the events joined once, on the
        run; a run with a large share of the events is split by adaptive execution.
        """
        whole = F.col("action") == QUARANTINE_RUN
        asked = marked.filter(F.col("action").isin(QUARANTINE_SEGMENT, QUARANTINE_RUN)).groupBy("run_id").agg(
            F.array_sort(F.collect_list(F.struct("priority", "action_key", "condition", "country", "plan", whole.alias("whole"), "decided_at", "done"))).alias("_asked"))
        asked = asked.withColumnRenamed("run_id", "_run")
        fits = F.filter("_asked", lambda i: i["whole"] | (F.col("country").eqNullSafe(i["country"]) & F.col("plan").eqNullSafe(i["plan"])
                                                          & F.coalesce(~F.col("dq_passed"), F.lit(False))))
        joined = flagged.join(asked, splittable(F.col("run_id").alias("k")) == splittable(F.col("_run").alias("k")))
        first = F.try_element_at(fits, F.lit(1))
        return (joined.withColumn("_intent", first).filter(F.col("_intent").isNotNull() & F.col("_intent.done").isNull())
                .withColumns({"action_key": F.col("_intent.action_key"), "reason": F.col("_intent.condition"),
                              "quarantine_ts": F.date_format("_intent.decided_at", "yyyyMMdd_HHmmss"), "source_path": F.lit(source)})
                .drop("_asked", "_run", "_intent"))

    def quarantined(self) -> DataFrame:
        return self.spark.read.parquet(self.paths["quarantine"])

    def released(self, flagged: DataFrame, key: str) -> DataFrame:
        """The records that no quarantine holds."""
        held = self.quarantined().select(F.col(key).alias("_held")).distinct()
        return flagged.join(held, splittable(F.col(key).alias("k")) == splittable(F.col("_held").alias("k")), "left_anti")

    def remap_history(self) -> DataFrame:
        return self.spark.read.schema(HISTORY).parquet(self.paths["remap_history"])

    def mapping(self) -> dict[str, Any]:
        """The merged mapping in the form :func:`remap.apply_remap` takes: an entry per remapped field."""
        row = RM.remap_config(self.remap_history()).first()
        return {field: {"type": spec} for field, spec in (row.mappings or {}).items()} if row else {}
