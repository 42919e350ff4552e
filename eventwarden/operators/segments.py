"""Where failures are: an iceberg cube over any attributes, and the few segments that explain a group's excess.

The events are aggregated once, to the finest segments that occur.  Everything after that works on these.  The cube is
grown level by level: a cell of k attributes is only built on a cell of k - 1 attributes that holds at least ``least``
of its group's failures, since a part cannot hold more than the whole.  So a group has at most 1 / least cells for each
choice of attributes, whatever the number of attributes and values.

A cell's excess is its failures beyond what the group's rate gives for its records.  Explaining takes the cell of
largest excess, sets its segments aside, and goes on with the rest, so that segments named later explain what the ones
named before did not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwarden.session import stage_table

LEAST = 0.1
DEPTH = 3
ROUNDS = 3
CELL = "array<struct<name:string,value:string>>"


def finest_segments(flagged: DataFrame, by: list[str], attributes: list[str]) -> DataFrame:
    """(by, ``items``, ``total_records``, ``failures``): the segments that occur, a value for every attribute."""
    items = F.array(*[F.struct(F.lit(a).alias("name"), F.col(a).cast("string").alias("value")) for a in sorted(attributes)])
    return (flagged.select(*by, items.cast(CELL).alias("items"), "dq_passed").groupBy(*by, "items")
            .agg(F.count(F.lit(1)).alias("total_records"), F.count_if(~F.col("dq_passed")).alias("failures")))


def _totals(finest: DataFrame, by: list[str]) -> DataFrame:
    return finest.groupBy(*by).agg(F.sum("total_records").alias("all_records"), F.sum("failures").alias("all_failures"))


def _measured(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, "cell").agg(F.sum("total_records").alias("total_records"), F.sum("failures").alias("failures"))


def iceberg_cube(finest: DataFrame, by: list[str], least: float = LEAST, depth: int = DEPTH, totals: DataFrame | None = None) -> DataFrame:
    """(by, ``cell``, ``total_records``, ``failures``, ``all_records``, ``all_failures``) of every cell with enough failures.

    ``totals`` are the group's own, where ``finest`` is only a part of it.  A group without failures has no cell.
    """
    whole = _totals(finest, by) if totals is None else totals
    grown = finest.withColumn("cell", F.array().cast(CELL))
    found = None
    for _ in range(depth):
        # the next attributes by name, so that every set of attributes is reached in one way
        last = F.coalesce(F.try_element_at("cell", F.lit(-1))["name"], F.lit(""))
        more = F.filter("items", lambda i: i["name"] > last)
        grown = grown.withColumn("more", F.explode(more)).withColumn("cell", F.concat("cell", F.array("more"))).drop("more")
        level = (_measured(grown, by).join(whole, by)
                 .filter((F.col("failures") > 0) & (F.col("failures") >= F.lit(least) * F.col("all_failures"))))
        level = stage_table(level, "cube-level")
        found = level if found is None else found.unionByName(level)
        kept = level.select(*by, "cell")
        grown = grown.join(kept, [*by, "cell"], "left_semi")
    return found


def excess() -> Column:
    return F.col("failures") - F.col("total_records") * F.col("all_failures") / F.col("all_records")


def cell_text(cell: str = "cell") -> Column:
    return F.array_join(F.transform(cell, lambda i: F.concat(i["name"], F.lit("="), F.coalesce(i["value"], F.lit("(none)")))), " AND ")


def explaining_segments(finest: DataFrame, by: list[str], least: float = LEAST, depth: int = DEPTH, rounds: int = ROUNDS) -> DataFrame:
    """(by, ``place``, ``cell``, ``total_records``, ``failures``, ``excess``): at most ``rounds`` cells a group, the largest excess first.

    Records and failures are those not in an earlier cell of the group.  Of equal excess the cell with fewer
    attributes, then the first by name.  A group ends with its last cell of positive excess and ``least`` of its failures.
    """
    finest = stage_table(finest, "segments")
    totals = stage_table(_totals(finest, by), "segment-totals")
    left, named = finest, None
    order = Window.partitionBy(*by).orderBy(F.desc("excess"), F.size("cell"), cell_text())
    for place in range(1, rounds + 1):
        cells = iceberg_cube(left, by, least, depth, totals).withColumn("excess", F.round(excess(), 9)).filter("excess > 0")
        best = cells.withColumn("_r", F.row_number().over(order)).filter("_r = 1").select(
            *by, F.lit(place).alias("place"), "cell", "total_records", "failures", "excess", "all_failures")
        best = stage_table(best, "segment")
        named = best if named is None else named.unionByName(best)
        if place < rounds:
            taken = best.select(*by, F.col("cell").alias("_taken"))
            inside = F.forall("_taken", lambda t: F.exists("items", lambda i: (i["name"] == t["name"]) & i["value"].eqNullSafe(t["value"])))
            left = left.join(taken, by).filter(~inside).drop("_taken")  # a group without a cell is done
    return named


def named_segments(explained: DataFrame, by: list[str]) -> DataFrame:
    """(by, ``segments``, ``explained_share``): what to quarantine, in words, and how much of the failures it holds."""
    text = F.array_sort(F.collect_list(F.struct("place", cell_text().alias("text"))))
    return explained.groupBy(*by).agg(
        F.array_join(F.transform(text, lambda s: s["text"]), "; ").alias("segments"),
        F.round(F.sum("failures") / F.first("all_failures"), 9).alias("explained_share"))
