"""Hard negatives: for an anchor and each of its positives, the best rows of other labels in a window of scores.

Scores are integer inner products.  The positives of an anchor are its best rows of the same label.  A positive
with score p asks for negatives with ``low``/100 * p <= score <= p, so the windows of one anchor overlap.  Their
upper ends cut the scores into slots that do not: slot j reaches from above the next lower end up to the j-th.
Each task keeps the best ``k`` per anchor and slot, the tasks' lists are merged by (anchor, slot), and one pass from
the lowest slot to the highest builds the best ``k`` of "this slot and all below"; a window is the head of
the one that starts at its upper end, down to its lower end.

The product of anchors and rows is cut into a grid: blocks of anchors meet groups of rows, each pair in a task with
bounded memory.  Anchors are sent once to each group of rows, rows once to each block of anchors.  For the
positives rows and anchors only meet within a label; a label's rows are spread over the groups, so a
frequent label is many tasks.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no part; of the rows
that share an id the one with the smallest label, then vector, takes part; a missing component counts as 0 where
vectors differ in length; scores outside 64 bits are held at their ends; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwarden.llm.common import partitions, stage

LOW = 80
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Components of a group's rows and of a block's anchors at most (their bytes are eight times that), and the rows of a group
#: below which no further groups are made.
ROWS, ANCHORS, FEWEST = 1 << 23, 1 << 21, 1 << 9
#: Scores that are held at once, and candidates that are gathered before they are cut down to the best.
TILE, GATHERED = 1 << 22, 1 << 20
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and ``v`` (bigint components) of the rows that take part, one per id."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce((c > float("-inf")) & (c < float("inf")) & ~F.isnan(c), F.lit(False)))
    whole = F.transform("x", lambda c: F.greatest(F.least(F.floor(F.lit(float(scale)) * c), F.lit(float(1 << 62))), F.lit(-float(1 << 62))).cast("bigint"))
    taken = (rows.select(F.col(f"`{vec_id}`").alias("id"), label.alias("label"), x.alias("x"), fine.alias("fine"))
             .filter("id IS NOT NULL AND label IS NOT NULL AND fine").select("id", "label", whole.alias("v")))
    return taken.groupBy("id").agg(F.min(F.struct("label", "v")).alias("m")).select("id", "m.label", "m.v")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as int64, filled up with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def _width(*columns: pa.Array) -> int:
    most = [np.max(n) for c in columns if len(n := c.combine_chunks().value_lengths().to_numpy(zero_copy_only=False))]
    return int(max(most, default=0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, held within 64 bits."""
    if not a.shape[1] or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = lambda m: max(int(m.max()), -int(m.min()))
    most = top(a) * top(b) * a.shape[1]
    if most < 1 << 53:  # every partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), _LOW, _HIGH).astype(np.int64)


class Best:
    """The best ``k`` (score, id) per key of those given so far."""

    def __init__(self, keys: int, k: int) -> None:
        self.k, self.bar = k, np.full(keys, _LOW, np.int64)  # the k-th best score of a full key
        self.full = np.zeros(keys, bool)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((key, score, ids))
        self.n += len(key)
        if self.n > GATHERED:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, score, ids = (np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((ids, ~score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        place = np.arange(len(key)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        self.bar[key[place == self.k - 1]] = score[place == self.k - 1]
        self.full[key[place == self.k - 1]] = True
        keep = place < self.k
        self.parts, self.n = [(key[keep], score[keep], ids[keep])], int(keep.sum())
        return self.parts[0]


def _tiles(a: int, b: int) -> Iterator[tuple[slice, slice]]:
    wide = max(1, min(b, TILE // max(1, min(a, 1024))))
    for i in range(0, a, 1024):
        for j in range(0, b, wide):
            yield slice(i, min(i + 1024, a)), slice(j, min(j + wide, b))


def _grid(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int, within: list[str], run, schema: str) -> DataFrame:
    """Every group of rows with every block of anchors, one task each; with ``within`` only those of equal columns."""
    spread = rows.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)))
    apart = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own: both sides are read from one table
    blocked = apart.withColumn("b", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)))
    left = spread.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    right = blocked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    keys = [*within, "g", "b"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def positives(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int, k: int = POSITIVES) -> DataFrame:
    """``anchor``, ``id``, ``score``, ``place`` (from 1): the best ``k`` other rows of the anchor's label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        width = _width(left["v"], right["v"])
        a, b = _matrix(right["v"], width), _matrix(left["v"], width)
        a_id, b_id = (t["id"].to_numpy().astype(np.int64) for t in (right, left))
        best = Best(len(a), k)
        for i, j in _tiles(len(a), len(b)):
            s = products(a[i], b[j])
            ok = (b_id[None, j] != a_id[i, None]) & ((s >= best.bar[i, None]) | ~best.full[i, None])
            x, y = np.nonzero(_heads(s, ok, k))
            best.add(x + i.start, s[x, y], b_id[j][y])
        key, score, ids = best.cut()
        return pa.table({"anchor": a_id[key], "id": ids, "score": score})

    found = _grid(rows, anchors, groups, blocks, ["label"], run, "anchor bigint, id bigint, score bigint")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _heads(s: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Of ``ok`` only what can be among a line's best ``k``: scores not below its k-th best, ties included."""
    if s.shape[1] <= 4 * k:
        return ok
    masked = np.where(ok, s, _LOW)
    bar = np.partition(masked, -k, axis=1)[:, -k]
    return ok & (masked >= bar[:, None])


def slot_limits(found: DataFrame, low: int = LOW) -> DataFrame:
    """``anchor``, ``tops`` (the positives' scores, each once, descending) and ``floor`` (the lowest window's lower end)."""
    tops = F.array_sort(F.collect_set("score"), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0))
    return found.groupBy("anchor").agg(tops.alias("tops"), F.min("score").alias("least"))


def slots(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int, k: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """``anchor``, ``slot``, ``score``, ``id``: the best ``k`` of other labels per slot.  ``anchors`` have ``tops``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        width = _width(left["v"], right["v"])
        a, b = _matrix(right["v"], width), _matrix(left["v"], width)
        a_id, b_id = (t["id"].to_numpy().astype(np.int64) for t in (right, left))
        names = {x: n for n, x in enumerate({*left["label"].to_pylist(), *right["label"].to_pylist()})}
        a_label, b_label = (np.array([names[x] for x in t["label"].to_pylist()], np.int64) for t in (right, left))
        lists = right["tops"].to_pylist()
        n = max(map(len, lists), default=0)
        tops = np.array([x + [None] * (n - len(x)) for x in lists], object).reshape(len(lists), n)
        last = np.array([x[-1] for x in lists], object)
        floor = np.array([min(max(-(-low * x // 100), _LOW), _HIGH) for x in last], np.int64)
        used = tops != None  # noqa: E711
        tops = np.where(used, tops, _LOW).astype(np.int64)
        best = Best(len(a) * max(n, 1), k)
        for i, j in _tiles(len(a), len(b)):
            s = products(a[i], b[j])
            fit = (a_label[i, None] != b_label[None, j]) & (s >= floor[i, None])
            for slot in range(n):
                ok = fit & (s <= tops[i, slot, None]) & used[i, slot, None]
                if slot + 1 < n:
                    ok &= ~used[i, slot + 1, None] | (s > tops[i, slot + 1, None])
                at = np.arange(i.start, i.stop) * n + slot
                ok &= (s >= best.bar[at][:, None]) | ~best.full[at][:, None]
                if ok.any():
                    x, y = np.nonzero(_heads(s, ok, k))
                    best.add(at[x], s[x, y], b_id[j][y])
        key, score, ids = best.cut()
        return pa.table({"anchor": a_id[key // max(n, 1)], "slot": (key % max(n, 1)).astype(np.int32), "score": score, "id": ids})

    found = _grid(rows, anchors, groups, blocks, [], run, "anchor bigint, slot int, score bigint, id bigint")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def suffixes(found: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """``anchor``, ``slot``, ``best``: the best ``k`` of this slot and all below, for every slot up to the lowest one found.

    Lists are merged from the lowest slot up; all scores of a slot are above those of the next.
    """
    item = F.struct((-F.col("place")).alias("order"), "score", "id")
    lists = found.groupBy("anchor", "slot").agg(F.sort_array(F.collect_list(item), asc=False).alias("best"))
    per = lists.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("by_slot"),
                                      F.max("slot").alias("last"))
    # (slot, best k from there on), lowest slot first, each built from the one before it
    merged = F.expr(f"""
        aggregate(reverse(sequence(0, last)),
                  cast(array() AS array<struct<slot:int, best:array<struct<order:int, score:bigint, id:bigint>>>>),
                  (acc, s) -> concat(acc, array(named_struct('slot', s, 'best', slice(
                      concat(coalesce(try_element_at(by_slot, s), array()),
                             coalesce(try_element_at(acc, -1).best, array())), 1, {int(k)})))))""")
    return per.select("anchor", F.explode(merged).alias("m")).select("anchor", "m.slot", "m.best")


def hard_negatives(rows: DataFrame, anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
                   n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, scale: int = SCALE,
                   most_rows: int = ROWS, most_anchors: int = ANCHORS, fewest: int = FEWEST) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` says of a row's ``id`` whether it is an anchor, ``label`` gives a row's label.
    """
    spark = rows.sparkSession
    table = stage(whole_vectors(rows, vec_id, vector, label, scale), "whole-vectors")
    anchors = table.filter(anchor)
    size = F.coalesce(F.sum(F.size("v") + 1), F.lit(0))
    n, all_rows, all_anchors = table.agg(F.count(F.lit(1)), size, F.coalesce(F.sum(F.when(anchor, F.size("v") + 1)), F.lit(0))).first()
    groups = max(1, -(-all_rows // most_rows), min(partitions(spark), -(-n // fewest)))
    blocks = max(1, -(-all_anchors // most_anchors))
    found = stage(positives(table, anchors, groups, blocks, n_positives), "positives")
    limits = slot_limits(found, low)
    asked = anchors.join(limits, F.col("id") == F.col("anchor")).select("id", "label", "v", "tops")
    tails = suffixes(slots(table, asked, groups, blocks, n_negatives, low), n_negatives)
    place = F.array_position("tops", F.col("score")).cast("int") - 1
    wanted = found.join(limits, "anchor").select("anchor", F.col("id").alias("positive"), F.col("score").alias("top"), place.alias("slot"))
    floor = F.expr(f"CAST({int(low)} AS decimal(38,0)) * top")
    window = F.filter("best", lambda x: (F.lit(100).cast("decimal(38,0)") * x["score"]) >= floor)
    out = wanted.join(tails, ["anchor", "slot"]).select("anchor", "positive", "top", F.posexplode(window).alias("rank", "x"))
    return out.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), (F.col("rank") + 1).alias("rank"),
        F.col("x.id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("x.score").alias("negative_score"))
