"""Joins of many rows against an aggregate of the same key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def splittable(*keys: str | Column) -> Column:
    """A join key that lets adaptive execution split a hot value over several tasks.

    Adaptive execution splits a skewed partition only where both sides of the
    join come straight out of a shuffle made for it.  A side that is aggregated
    by the very join key is already partitioned and brings no such shuffle, so
    one hot value would keep its rows in one task.  Wrapping the key on both
    sides makes the planner shuffle the aggregate once more; it is the narrow,
    one-row-per-key side.
    """
    return F.struct(*keys)
