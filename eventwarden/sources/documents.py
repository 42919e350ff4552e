"""Scans of the JSON and YAML documents around the event stream."""

from __future__ import annotations

import pathlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventwarden import schemas as S
from eventwarden.policies import Expectation

# Results of a load validation.
LOADED, EMPTY, NO_FOLDER = "success", "no_data", "no_output_directory"


def _documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file; a missing path is an empty table, not an error."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _with_run(docs: DataFrame, run_id: int | None) -> DataFrame:
    """Documents that name no run belong to the one given."""
    if run_id is None:
        return docs
    return docs.withColumn("run_id", F.coalesce("run_id", F.lit(run_id).cast(docs.schema["run_id"].dataType)))


def run_reports(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """Run reports as JSON documents; ``run_id`` is the run of those that name none."""
    return _with_run(_documents(spark, path, S.RUN_REPORT), run_id)


def quality_documents(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """Validation summaries in the columns :func:`decision_context` joins on."""
    docs = _with_run(_documents(spark, path, S.DQ_DOCUMENT), run_id)
    return docs.select(
        "run_id", "status",
        F.col("summary.total_expectations").alias("evaluated_expectations"),
        F.col("summary.success_count").alias("successful_expectations"),
        F.col("summary.failure_count").alias("unsuccessful_expectations"),
        F.col("summary.overall_success_rate").alias("overall_success_rate"))


def incident_lines(spark: SparkSession, path: str) -> DataFrame:
    """Incidents from JSON lines; the context object stays JSON text."""
    return spark.read.schema(S.INCIDENT).json(path)


def suite_rows(spark: SparkSession, path: str) -> DataFrame:
    """An expectation suite as rows; arguments stay a variant."""
    docs = _documents(spark, path, S.SUITE_DOCUMENT)
    return (docs.select("expectation_suite_name",
                        F.posexplode("expectations").alias("position", "e"))
            .select("expectation_suite_name", "position", "e.expectation_type",
                    F.coalesce(F.try_variant_get("e.kwargs", "$.column", "string"),
                               F.concat_ws(",", F.try_variant_get("e.kwargs", "$.column_A", "string"),
                                           F.try_variant_get("e.kwargs", "$.column_B", "string")))
                    .alias("column_name"),
                    F.to_json("e.kwargs").alias("kwargs")))


def rules_from_yaml(text: str) -> dict[str, list[Expectation]]:
    """Rule groups of a YAML rule file: name -> expectations."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML rules needs PyYAML") from e
    doc = yaml.safe_load(text)
    out = {}
    if doc.get("expectations"):
        out["expectations"] = [Expectation(e["type"], dict(e.get("kwargs", {})))
                               for e in doc["expectations"]]
    for name, group in (doc.get("business_rules") or {}).items():
        out[name] = [
            Expectation(e["expectation_type"],
                        {k: v for k, v in e.items() if k not in ("expectation_type", "meta")})
            for e in group["expectations"]
        ]
    return out


#: The declared rules that ship with the package.
DECLARED_RULES = pathlib.Path(__file__).parent.parent / "rules.yml"
#: Rules name the wire's epoch columns; on the curated table the same values are times.
CURATED_NAMES = {"signup_ts": "signup_timestamp", "event_ts": "event_timestamp"}


def declared_rules(names: dict[str, str] | None = None) -> dict[str, list[Expectation]]:
    """The shipped rule groups, their columns renamed by ``names``."""
    renamed = CURATED_NAMES if names is None else names
    columns = ("column", "column_A", "column_B")
    return {group: [Expectation(e.type, {k: renamed.get(v, v) if k in columns else v for k, v in e.kwargs.items()}) for e in rules]
            for group, rules in rules_from_yaml(DECLARED_RULES.read_text(encoding="utf-8")).items()}


def load_validation(spark: SparkSession, path: str) -> DataFrame:
    """File count, bytes and newest file of a Parquet output, with a status.

    Only the file listing is read: the content column is pruned, so no file is
    opened however large the table.
    """
    none = F.lit(None)
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .option("recursiveFileLookup", "true").load(path)
                 .select("path", "length", "modificationTime"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(
            F.lit(NO_FOLDER).alias("status"), F.lit(path).alias("output_path"),
            F.lit(0).cast("bigint").alias("file_count"), F.lit(0).cast("bigint").alias("total_bytes"),
            none.cast("string").alias("newest_file"), none.cast("bigint").alias("newest_bytes"),
            none.cast("timestamp").alias("newest_at"))
    newest = F.max_by(F.struct("path", "length", "modificationTime"),
                      F.struct("modificationTime", "path"))
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        newest.alias("n"),
    ).select(
        F.when(F.col("file_count") > 0, LOADED).otherwise(EMPTY).alias("status"),
        F.lit(path).alias("output_path"), "file_count", "total_bytes",
        F.col("n.path").alias("newest_file"), F.col("n.length").alias("newest_bytes"),
        F.col("n.modificationTime").alias("newest_at"))
