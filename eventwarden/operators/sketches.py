"""Distinct counts and quantiles of runs as sketches that add up over micro-batches.

A distinct count or a quantile of a run cannot be put together from those of its micro-batches; their sketches can,
in any order.  A sketch is a few kilobytes whatever the number of records, so a run's statistics are kept and
merged without its events.  Bounds of the error (with 99 percent confidence or better):

- distinct count: ``DISTINCT_ERROR`` of the count, three standard errors at 2 ** 12 registers;
- quantile: ``RANK_ERROR`` in rank, for k = 200: the value given for the median lies between the exact quantiles at
  0.5 - RANK_ERROR and 0.5 + RANK_ERROR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_REGISTERS = 12
QUANTILE_K = 200
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_REGISTERS / 2)
RANK_ERROR = 0.0165
QUANTILES = {"p50": 0.5, "p95": 0.95}


def delay_ms() -> Column:
    """How long after the event a record was processed."""
    return F.unix_millis("processing_timestamp") - F.unix_millis("event_timestamp")


def run_sketches(flagged: DataFrame, by: list[str], distinct: dict[str, str] | None = None, value: Column | None = None) -> DataFrame:
    """Per group: records, a distinct sketch per column of ``distinct`` (name to column), a quantile sketch of ``value``.

    Sketches combine before the shuffle.  Null values are in none.
    """
    columns = {"ids": "id"} if distinct is None else distinct
    return flagged.withColumn("_value", delay_ms() if value is None else value).groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), F.count("_value").alias("values"),
        *[F.hll_sketch_agg(c, F.lit(LG_REGISTERS)).alias(f"sketch_{n}") for n, c in columns.items()],
        F.kll_sketch_agg_bigint("_value", F.lit(QUANTILE_K)).alias("sketch_value"))


def merge_sketches(parts: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of several micro-batches as those of the whole; parts that never came are simply not in it."""
    named = [c for c in parts.columns if c.startswith("sketch_") and c != "sketch_value"]
    return parts.groupBy(*by).agg(
        F.sum("records").alias("records"), F.sum("values").alias("values"),
        *[F.hll_union_agg(c).alias(c) for c in named], F.kll_merge_agg_bigint("sketch_value").alias("sketch_value"))


def estimates(sketches: DataFrame) -> DataFrame:
    """``distinct_*`` and the quantiles; a group without a value has null quantiles."""
    named = [c for c in sketches.columns if c.startswith("sketch_") and c != "sketch_value"]
    some = F.col("values") > 0
    read = {f"distinct_{c.removeprefix('sketch_')}": F.hll_sketch_estimate(c) for c in named}
    read |= {n: F.when(some, F.kll_sketch_get_quantile_bigint("sketch_value", F.lit(q))) for n, q in QUANTILES.items()}
    return sketches.withColumns(read).drop(*named, "sketch_value")


def within_error(estimated: DataFrame, exact: DataFrame, by: list[str], name: str = "ids", column: str = "id", value: Column | None = None) -> DataFrame:
    """Per group the exact figures and whether the estimates keep their stated errors.

    Ranks are counted against the exact values, in one pass over the records beside the groups' estimates.
    """
    rows = exact.withColumn("_value", delay_ms() if value is None else value)
    joined = rows.join(estimated.select(*by, *QUANTILES, F.col(f"distinct_{name}").alias("_estimate")), by)
    n = F.count("_value")
    keeps = lambda q, p: F.coalesce((F.count_if(F.col("_value") < F.col(q)) <= (p + RANK_ERROR) * n)
                                    & (F.count_if(F.col("_value") <= F.col(q)) >= (p - RANK_ERROR) * n), n == 0)
    counted = joined.groupBy(*by, column).agg(F.first("_estimate").alias("_estimate")).groupBy(*by).agg(
        F.count(column).alias(f"exact_{name}"), F.first("_estimate").alias("_estimate"))
    ranks = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), *[keeps(q, p).alias(f"{q}_within") for q, p in QUANTILES.items()])
    return counted.join(ranks, by).withColumn(
        f"{name}_within", F.abs(F.col("_estimate") - F.col(f"exact_{name}")) <= F.greatest(F.lit(DISTINCT_ERROR) * F.col(f"exact_{name}"), F.lit(0.5))).drop("_estimate")
