"""Literal maps and tables as one parsed expression.

Building them from single literals costs a driver round trip per element; a
parsed text costs one, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.expr("map(" + ", ".join(sql_literal(x) for pair in mapping.items() for x in pair) + ")")


def literal_rows(names: Sequence[str], rows: Iterable[Sequence]) -> Column:
    """``array<struct>``; a value may be raw SQL wrapped in a one-element tuple."""
    return F.expr("array(" + ", ".join(
        "named_struct(" + ", ".join(
            f"'{n}', {v[0] if isinstance(v, tuple) else sql_literal(v)}" for n, v in zip(names, row)) + ")"
        for row in rows) + ")")
