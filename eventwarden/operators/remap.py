"""Schema remaps: merging mapping histories and applying a mapping to data."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T


def merge_remap(history: DataFrame) -> DataFrame:
    """Current mapping state from a history of calls.

    ``history`` holds (call_id, updated_at, field, spec).  For every field the
    newest call wins; the version is the number of calls so far.
    """
    latest = history.groupBy("field").agg(
        F.max_by("spec", F.struct("updated_at", "call_id")).alias("spec"),
        F.max(F.struct("updated_at", "call_id")).alias("last"),
    )
    return latest.select("field", "spec", F.col("last.updated_at").alias("updated_at"),
                         F.col("last.call_id").alias("call_id"))


def remap_config(history: DataFrame) -> DataFrame:
    """The state as one configuration row; ``applied`` starts false.

    The map holds one entry per remapped field name, so its size follows the
    schema, not the data.
    """
    sets = history.groupingSets([["field"], ["call_id"]], "field", "call_id").agg(
        F.max_by("spec", F.struct("updated_at", "call_id")).alias("spec"),
        F.max("updated_at").alias("updated_at"),
        F.grouping("field").alias("is_call"),
    )
    entry = F.when(F.col("is_call") == 0, F.struct("field", "spec"))
    return sets.agg(
        F.count_if(F.col("is_call") == 1).alias("version"),
        F.max("updated_at").alias("updated_at"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("mappings"),
        F.lit(False).alias("applied"),
    )


def decode_remapped(df: DataFrame, raw: str, contract: T.StructType, mapping: dict[str, Any]) -> DataFrame:
    """Decode JSON text under a contract widened by a mapping, then apply the mapping.

    Old names and added fields are read from the payload beside the contract's own, so what earlier decoding
    dropped as unknown comes back.  The other columns of ``df`` stay.
    """
    added = [n for n in mapping if n not in contract.fieldNames()]
    wide = [T.StructField(f.name, f.dataType) for f in contract] + [T.StructField(n, T.StringType()) for n in added]
    others = [c for c in df.columns if c != raw]
    decoded = df.select(*others, F.from_json(raw, T.StructType(wide)).alias("_d")).select(*others, "_d.*")
    return apply_remap(decoded, mapping)


def apply_remap(df: DataFrame, mapping: dict[str, Any]) -> DataFrame:
    """Apply a mapping to a frame, in one projection.

    ``{"old": "new"}`` folds a renamed column into its target;
    ``{"name": {"type": t}}`` casts an existing column or adds a null one.
    Unreadable values become null instead of failing the batch.
    """
    renames: dict[str, list[str]] = {}
    typed: dict[str, str] = {}
    for name, spec in mapping.items():
        if isinstance(spec, str):
            renames.setdefault(spec, []).append(name)
        elif isinstance(spec, dict) and "type" in spec:
            typed[name] = spec["type"]

    old_names = {old for olds in renames.values() for old in olds}
    names = [c for c in df.columns if c not in old_names]
    names += [n for n in [*renames, *typed] if n not in names]

    out = []
    for name in dict.fromkeys(names):
        sources = [c for c in [name, *renames.get(name, [])] if c in df.columns]
        if not sources:
            if name not in typed:
                continue
            col = F.lit(None)
        else:
            col = F.coalesce(*[F.col(s) for s in sources])
        if name in typed:
            col = col.try_cast(typed[name])
        out.append(col.alias(name))
    return df.select(*out)
