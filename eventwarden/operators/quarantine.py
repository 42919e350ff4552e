"""Quarantine splits and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden import policies as P


def tag_quarantine(df: DataFrame, condition: str | Column, flag: str = "quarantined") -> DataFrame:
    """Mark rows matching a predicate; an unknown predicate keeps the row clean."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumn(flag, F.coalesce(cond, F.lit(False)))


def split_quarantine(df: DataFrame, condition: str | Column) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined); every row goes to exactly one side."""
    tagged = tag_quarantine(df, condition, "_q")
    return tagged.filter(~F.col("_q")).drop("_q"), tagged.filter("_q").drop("_q")


def write_split(df: DataFrame, condition: str | Column, path: str, flag: str = "quarantined") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined), from one pass: rows are tagged once and written by their tag, and each side reads its folder."""
    tag_quarantine(df, condition, flag).write.mode("overwrite").partitionBy(flag).parquet(path)
    schema = tag_quarantine(df.limit(0), condition, flag).schema
    both = df.sparkSession.read.schema(schema).parquet(path)
    return both.filter(~F.col(flag)).drop(flag), both.filter(F.col(flag)).drop(flag)


def quarantine_by_rules(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Rows matching any ``(reason, condition)`` rule, once per matched reason."""
    matched = F.array(*[
        F.when(F.expr(cond), F.lit(reason)) for reason, cond in rules  # unknown matches nothing
    ])
    return df.withColumn("reason", F.explode(matched)).filter(F.col("reason").isNotNull())


def retain(df: DataFrame, at: str, as_of: Column, days: int = P.RETENTION_DAYS) -> DataFrame:
    """Rows inside the retention period; undated rows are kept."""
    return df.filter(F.coalesce(F.col(at) >= as_of - F.expr(f"INTERVAL '{int(days)}' DAY"), F.lit(True)))


def retention_plan(df: DataFrame, at: str, as_of: Column,
                   days: int = P.RETENTION_DAYS) -> DataFrame:
    """Rows per day and whether the whole day has left the retention period."""
    cutoff = F.to_date(as_of - F.expr(f"INTERVAL '{int(days)}' DAY"))
    return (df.groupBy(F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("expired", F.coalesce(F.col("day") < cutoff, F.lit(False))))
