"""A corpus pipeline: each stage reads what the one before it wrote.

All stages but the last return the columns of ``documents``; the last one returns the ids.

A stage's output is written before the next stage is called, as its ``docs``.  So a stage begins by deleting what
the stage before it had staged, and the disk holds one stage's tables at a time.  (A stage that is handed the very
DataFrame that the one before it returned, not yet written, leaves that one's tables alone.)

Defined cases: an empty table passes through all stages as one; nulls, odd texts, repeated rows and further columns as
stated by the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from weakref import ref

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwarden.llm import decontaminate, pieces, pii, quality_rules, simhash
from eventwarden.llm.common import recorded, remove, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality_rules.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return decontaminate.filter_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the terms that disclose it; n_chars follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


class _Leftovers:
    """What the stage called last has staged, and the DataFrame it returned."""

    paths: list[str] = []
    returned = staticmethod(lambda: None)

    @classmethod
    def clear(cls, spark: SparkSession, docs: DataFrame | None = None) -> None:
        if docs is None or cls.returned() is not docs:
            for path in cls.paths:
                remove(spark, path)
            cls.paths = []


def _cleared(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _Leftovers.clear(spark, docs)
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        _Leftovers.paths, _Leftovers.returned = [*_Leftovers.paths, *paths], ref(out)
        return out
    return run_stage


STAGES = [(name, _cleared(stage)) for name, stage in [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("sentencepiece", sentencepiece),
]]

#: Majority fingerprints, fitted votes and path folds have no SQL; the tests hold the result
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    Once a stage's output is written, its staged tables and the output before it go.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        _Leftovers.clear(spark)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
