"""Running totals, streaks and trailing windows over one long ordered history: a parallel prefix scan.

A plain window over "all runs in order" has no partition key, or one key that holds most rows, and so runs in
a single task.  Here rows are dealt by range of (keys, order), whatever the type and density of the order's values.
Each range is windowed by itself.  Only one summary row per range goes on: its first and last key and what
that last key hands to the next range.  One fold over the summaries gives what each range takes over (their number
is the number of ranges, whatever the number of rows), and it is added back to the rows of the range's first key;
all other keys of a range begin in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwarden.session import stage_table

RANGE = "_range"
_KEY = "_scan_key"


def dealt(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """Rows by range of (keys, order) with the range's number, written once so that the ranges stay as they are."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(n, *keys, *order)
    return stage_table(spread.withColumn(RANGE, F.spark_partition_id()), "ranges")


def _local(keys: list[str], order: list[str]):
    return Window.partitionBy(RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _carried(rows: DataFrame, keys: list[str], order: list[str], handed: dict[str, Column], start: dict[str, Column],
             combine: dict[str, object]) -> DataFrame:
    """What each range takes over: (range, first key, ``_in_*`` per name of ``start``), a row for each range.

    ``handed`` are aggregates of a (range, key) piece.  ``combine[name](taken, piece)`` gives what is handed on
    by a piece that took over ``taken``, both structs.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    pieces = rows.withColumn(_KEY, key).groupBy(RANGE, _KEY).agg(*[c.alias(n) for n, c in handed.items()])
    named = F.struct(F.col(_KEY).alias("key"), *handed)
    # the smallest and the largest key of a range are the ends of its pieces, as the ranges are in key order
    ends = pieces.groupBy(RANGE).agg(F.min_by(named, F.col(_KEY)).alias("head"), F.max_by(named, F.col(_KEY)).alias("tail"))
    listed = ends.agg(F.array_sort(F.collect_list(F.struct(RANGE, "head", "tail"))).alias("all"))

    def step(acc, end):
        before = F.element_at(acc, -1)
        goes_on = before["last"] == end["head"]["key"]
        taken = F.struct(*[F.when(goes_on, before["out"][n]).otherwise(c).alias(n) for n, c in start.items()])
        through = F.struct(*[f(taken, end["tail"]).alias(n) for n, f in combine.items()])
        fresh = F.struct(*[f(F.struct(*[c.alias(m) for m, c in start.items()]), end["tail"]).alias(n) for n, f in combine.items()])
        out = F.when(end["head"]["key"] == end["tail"]["key"], through).otherwise(fresh)
        return F.concat(acc, F.array(F.struct(end[RANGE].alias(RANGE), end["head"]["key"].alias("first"), taken.alias("taken"),
                                              end["tail"]["key"].alias("last"), out.alias("out"))))

    zero = F.struct(*[c.alias(n) for n, c in start.items()])
    begin = F.array(F.struct(F.lit(-1).alias(RANGE), F.element_at("all", 1)["head"]["key"].alias("first"), zero.alias("taken"),
                             F.element_at("all", 1)["head"]["key"].alias("last"), zero.alias("out")))
    folded = listed.filter(F.size("all") > 0).select(F.explode(F.aggregate("all", begin, step)).alias("r"))
    return folded.filter(f"r.{RANGE} >= 0").select(
        F.col(f"r.{RANGE}").alias("_in_range"), F.col("r.first").alias("_in_key"),
        *[F.col(f"r.taken.{n}").alias(f"_in_{n}") for n in start])


def _taken_over(rows: DataFrame, carried: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    joined = rows.join(carried, F.col(RANGE) == F.col("_in_range"), "left")
    first = F.col("_in_key") == key
    return joined.withColumns({f"_in_{n}": F.when(first, F.col(f"_in_{n}")) for n in names}).drop("_in_range", "_in_key")


def running_sums(df: DataFrame, keys: list[str], order: str | list[str], sums: dict[str, Column],
                 ranges: int | None = None) -> DataFrame:
    """Add inclusive running sums in ``order`` within ``keys``.

    ``order`` must be unique within ``keys``, unless rows alike in it may stand in any order; neither may be null.
    """
    order = [order] if isinstance(order, str) else order
    cut = dealt(df.withColumns({f"_v_{n}": F.coalesce(v, F.lit(0)).cast("bigint") for n, v in sums.items()}), keys, order, ranges)
    carried = _carried(cut, keys, order, {n: F.sum(f"_v_{n}") for n in sums}, {n: F.lit(0).cast("bigint") for n in sums},
                       {n: (lambda taken, piece, n=n: taken[n] + piece[n]) for n in sums})
    rows = cut.withColumns({n: F.sum(f"_v_{n}").over(_local(keys, order)) for n in sums})
    return (_taken_over(rows, carried, keys, list(sums))
            .withColumns({n: F.col(n) + F.coalesce(F.col(f"_in_{n}"), F.lit(0)) for n in sums})
            .drop(RANGE, *[f"_v_{n}" for n in sums], *[f"_in_{n}" for n in sums]))


def count_since(df: DataFrame, keys: list[str], order: str | list[str], out: str, hit: Column, reset: Column,
                ranges: int | None = None) -> DataFrame:
    """Add the number of ``hit`` rows since the last ``reset`` row, this row included.

    A piece hands on its hits since its last reset or, where it has none, all its hits and what it took over.
    Requirements on ``order`` as in :func:`running_sums`.
    """
    order = [order] if isinstance(order, str) else order
    flags = {"_hit": F.coalesce(hit, F.lit(False)).cast("bigint"), "_reset": F.coalesce(reset, F.lit(False))}
    cut = dealt(df.withColumns(flags), keys, order, ranges)
    local = _local(keys, order)
    hits = F.sum("_hit").over(local)
    rows = cut.withColumn("_hits", hits).withColumn("_at_reset", F.max(F.when(F.col("_reset"), F.col("_hits"))).over(local))
    handed = {"hits": F.max("_hits"), "at_reset": F.max("_at_reset")}
    carried = _carried(rows, keys, order, handed, {"count": F.lit(0).cast("bigint")}, {
        "count": lambda taken, piece: F.when(piece["at_reset"].isNull(), taken["count"] + piece["hits"])
        .otherwise(piece["hits"] - piece["at_reset"])})
    since = F.when(F.col("_at_reset").isNull(), F.col("_hits") + F.coalesce("_in_count", F.lit(0).cast("bigint")))
    return (_taken_over(rows, carried, keys, ["count"])
            .withColumn(out, since.otherwise(F.col("_hits") - F.col("_at_reset")))
            .drop(RANGE, "_hit", "_reset", "_hits", "_at_reset", "_in_count"))


def carried_values(df: DataFrame, keys: list[str], order: str | list[str], last: dict[str, str],
                   ranges: int | None = None) -> DataFrame:
    """Add the value that a column had in the row before, over the bounds of ranges; null in a key's first row."""
    order = [order] if isinstance(order, str) else order
    cut = dealt(df, keys, order, ranges)
    at = F.struct(*[F.col(c) for c in order])
    kinds = {c: df.schema[c].dataType for c in last.values()}
    carried = _carried(cut, keys, order, {c: F.max_by(c, at) for c in kinds}, {c: F.lit(None).cast(k) for c, k in kinds.items()},
                       {c: (lambda taken, piece, c=c: piece[c]) for c in kinds})
    before = Window.partitionBy(RANGE, *keys).orderBy(*order)
    rows = cut.withColumn("_first", F.row_number().over(before) == 1).withColumns(
        {n: F.lag(c).over(before) for n, c in last.items()})
    return (_taken_over(rows, carried, keys, list(kinds))
            .withColumns({n: F.when(F.col("_first"), F.col(f"_in_{c}")).otherwise(F.col(n)) for n, c in last.items()})
            .drop(RANGE, "_first", *[f"_in_{c}" for c in kinds]))


def trailing_rows(df: DataFrame, keys: list[str], order: str | list[str], size: int,
                  measures: dict[str, tuple[str, Column]], block: int = 100_000, ranges: int | None = None) -> DataFrame:
    """Aggregates over the last ``size`` rows, each row included.

    Rows get a dense position, blocks of ``block`` positions become the window
    partitions, and the last ``size - 1`` rows of a block are copied into the
    next one so that no window is cut short.
    """
    if block < size:
        raise ValueError("block must be at least size")
    pos = running_sums(df, keys, order, {"_pos": F.lit(1)}, ranges)
    home = F.expr(f"(_pos - 1) DIV {block}")
    spill = (F.col("_pos") - 1) % block >= block - (size - 1)
    halo = pos.withColumn("_home", home).withColumn(
        "_block",
        F.explode(F.when(spill, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    last = (Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-(size - 1), 0))
    funcs = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}
    return (halo
            .withColumns({n: funcs[f](c).over(last) for n, (f, c) in measures.items()})
            .filter(F.col("_home") == F.col("_block"))
            .drop("_pos", "_home", "_block"))


def trailing_count(points: DataFrame, key: str, point: str, events: DataFrame, at: str,
                   span_seconds: int, sums: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """Sum event measures over ``[point - span, point]`` for every row of ``points``, which ``key`` tells apart.

    A range join by subtraction: events are first reduced to one row per instant, both ends of every range are put
    among them, and a range's answer is the running total at its upper end less the one before its lower end.  The
    timeline is ordered once and no pair of rows is ever built.  Points without a time take no part in it.
    """
    none = F.lit(0).cast("bigint")
    per_instant = (events.filter(F.col(at).isNotNull()).groupBy(F.unix_millis(at).alias("_at"))
                   .agg(*[F.sum(c).cast("bigint").alias(f"_m_{n}") for n, c in sums.items()])
                   .withColumns({"_end": F.lit(0), "_point": F.lit(None).cast(points.schema[key].dataType)}))
    upper = F.unix_millis(point)
    lower = upper - span_seconds * 1000 - 1  # inclusive lower end at millisecond precision
    # an instant's events come before the ends that fall on it
    ends = F.array(F.struct(lower.alias("_at"), F.lit(-1).alias("_end")), F.struct(upper.alias("_at"), F.lit(1).alias("_end")))
    probes = (points.filter(F.col(point).isNotNull()).select(F.col(key).alias("_point"), F.explode(ends).alias("e"))
              .select("e._at", "e._end", "_point", *[none.alias(f"_m_{n}") for n in sums]))
    timeline = per_instant.unionByName(probes).withColumn("_turn", F.abs("_end"))
    totals = running_sums(timeline, [], ["_at", "_turn"], {n: F.col(f"_m_{n}") for n in sums}, ranges).filter("_end <> 0")
    found = totals.groupBy("_point").agg(*[F.sum(F.col("_end") * F.col(n)).alias(f"_n_{n}") for n in sums])
    return (points.join(found, F.col(key) == F.col("_point"), "left")
            .withColumns({n: F.coalesce(f"_n_{n}", none) for n in sums}).drop("_point", *[f"_n_{n}" for n in sums]))


def islands(df: DataFrame, keys: list[str], value: str, ranges: int | None = None) -> DataFrame:
    """Holes in whole numbers: (keys, ``first``, ``last``) of every stretch that is missing between two values.

    Repeated values count once.
    """
    once = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])).select(*keys, value).distinct()
    before = carried_values(once, keys, value, {"_before": value}, ranges)
    return (before.filter(F.col(value) > F.col("_before") + 1)
            .select(*keys, (F.col("_before") + 1).alias("first"), (F.col(value) - 1).alias("last")))
