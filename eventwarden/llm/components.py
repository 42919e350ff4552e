"""Connected components of an edge table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventwarden.llm.common import stage

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its smallest neighbour."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them (here a > b always)."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Alternates large and small stars until every node is linked to its root alone.  Minima
    combine before their shuffle, and the joins' hot side can be split, so a node with very
    many neighbours is no bottleneck.  Each round's edges are written to the shared folder.
    """
    flat = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current, seen = stage(flat, "edges"), None
    for _ in range(MAX_ROUNDS):
        current = stage(_small_star(_large_star(current)), "edges")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionAll(roots.select("node", F.col("node").alias("root")))
