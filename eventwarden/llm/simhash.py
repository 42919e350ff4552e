"""SimHash near-duplicates over pivot distance tables.

A fingerprint is 64 majority bits of a document's shingle hashes.  For each of eight reference
fingerprints the table holds a fingerprint's Hamming distances, over each of seven blocks of
bits and in all.  Fingerprints at ``max_bits`` differing bits or fewer leave at least three of
the seven blocks alone, and on an untouched block all distances are the same: pairs with three
equal blocks of coordinates are the candidates.  Those whose largest coordinate difference
exceeds ``max_bits`` go (distances to one reference differ by no more than the two fingerprints
do), and the rest is verified bit by bit.

A bucket with many fingerprints is not paired: its fingerprints meet at the points within half
the distance instead.  Two of them are within ``max_bits`` if and only if some point is within
``max_bits`` / 2 of both, and all that share a point are linked to the smallest there.

Defined cases: a null, empty or blank text has fingerprint 0 and links like any other; a null
doc_id gets the component of its fingerprint, whose number is the smallest doc_id that is not
null; repeated rows and exact copies share a fingerprint and are one node.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import packed, stage, unpacked
from eventwarden.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCKS = 7
EQUAL_BLOCKS = BLOCKS - MAX_BITS
REFERENCES = 8
#: Buckets of more fingerprints than this are linked through shared points instead of pairs.
BUCKET = 48
_STEP = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def references() -> list[int]:
    """The reference fingerprints: hashes of 0, 1, 2, ..."""
    return [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(REFERENCES)]


def masks() -> list[int]:
    """The blocks' bits: seven runs of 9 or 10 bits."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hash_of = xxhash.xxh64_intdigest
    ones, count = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, count, _STEP):
        spans = zip(starts[at:min(at + _STEP, count)].tolist(), ends[at + size - 1:min(at + _STEP, count) + size - 1].tolist())
        hashes = np.array([hash_of(body[s:e], SEED) for s, e in spans], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as a bigint column."""

    @arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_signed(fingerprint(t.as_py(), shingle)) for t in texts], pa.int64())

    return run(text)


def pivot_table(nodes: DataFrame) -> DataFrame:
    """``fp``, ``far`` (its distances to the references, 7 bits each) and ``keys``.

    A key stands for the distances to all references over three blocks, for each choice of them.
    """
    refs, blocks = np.array(references(), np.uint64), np.array(masks(), np.uint64)
    choices = list(combinations(range(BLOCKS), EQUAL_BLOCKS))

    @arrow_udf("struct<far:bigint,keys:array<bigint>>")
    def run(fps: pa.Array) -> pa.Array:
        fp = fps.to_numpy(zero_copy_only=False).view(np.uint64)
        near = np.bitwise_count((fp[:, None, None] ^ refs[None, None, :]) & blocks[None, :, None])  # row, block, reference
        total = near.sum(1, dtype=np.uint64)
        far = (total << (np.arange(REFERENCES, dtype=np.uint64) * np.uint64(7))).sum(1, dtype=np.uint64)
        keys = [xxhash.xxh64_intdigest(bytes([i]) + row[list(c)].tobytes()) for row in near for i, c in enumerate(choices)]
        ends = pa.array(np.arange(len(fp) + 1) * len(choices), pa.int32())
        keys = pa.ListArray.from_arrays(ends, pa.array(np.array(keys, np.uint64).view(np.int64)))
        return pa.StructArray.from_arrays([pa.array(far.view(np.int64)), keys], ["far", "keys"])

    return nodes.withColumn("pivots", run("fp")).select("fp", "pivots.far", "pivots.keys")


def _coordinate_gap(a: str, b: str) -> Column:
    """The largest difference of two rows' distances to one reference."""
    part = lambda c, i: F.shiftrightunsigned(F.col(c), 7 * i).bitwiseAND(F.lit(127))
    return F.greatest(*[F.abs(part(a, i) - part(b, i)) for i in range(REFERENCES)])


def _meeting_points(radius: int) -> list[int]:
    """All 64-bit words with ``radius`` bits or fewer."""
    bits = [1 << i for i in range(64)]
    return [_signed(sum(c)) for r in range(radius + 1) for c in combinations(bits, r)]


def links(nodes: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``max_bits``.

    ``nodes``: distinct fingerprints ``fp``.  All pairs of smaller buckets are there; a large
    bucket's fingerprints have edges to the smallest one at each shared point.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"the blocks are laid out for {MAX_BITS} bits")
    table = stage(pivot_table(nodes.select("fp")), "pivots")
    entries = table.select("fp", "far", F.explode("keys").alias("key"))
    full = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("key"), "full-buckets")
    small = entries.join(full, "key", "left_anti")
    a = small.select("key", F.col("fp").alias("a"), F.col("far").alias("far_a"))
    b = small.select("key", F.col("fp").alias("b"), F.col("far").alias("far_b"))
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (_coordinate_gap("far_a", "far_b") <= max_bits)
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    crowded = entries.join(full, "key", "left_semi").select("fp").distinct()
    points = F.array(*map(F.lit, _meeting_points(max_bits // 2)))
    met = crowded.withColumn("flip", F.explode(points)).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    # a point has at most as many fingerprints as there are flips, so the window is bounded
    low = met.select(F.col("fp").alias("b"), F.min("fp").over(Window.partitionBy("point")).alias("a")).filter("a < b")
    return pairs.unionAll(low.select("a", "b")).distinct()


def near_duplicates(rows: DataFrame) -> DataFrame:
    """Adds ``component`` (a fingerprint that stands for it) to staged rows with ``fp``."""
    nodes = rows.select("fp").distinct()
    found = components(links(nodes)).withColumnRenamed("node", "fp")
    return rows.join(found, "fp", "left").withColumn("component", F.coalesce("root", "fp")).drop("root")


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``fingerprint`` (16 hex digits), ``component_id``, ``component_size``."""
    rows = stage(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprints(F.col(f"`{text}`")).alias("fp")), "simhash")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    placed = stage(near_duplicates(nodes), "simhash-placed")
    named = placed.groupBy("component").agg(F.min("lead").alias("component_id"), F.sum("n").alias("component_size"))
    by_fp = placed.select("fp", "component").join(named, "component").drop("component")
    return rows.join(by_fp, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the smallest doc_id, nulls last; of equal ones, one row."""
    rows = packed(docs)
    keyed = rows.select("doc", fingerprints(F.col("doc").getField(text)).alias("fp"), F.monotonically_increasing_id().alias("row"))
    table = stage(keyed, "simhash-docs")
    thin = table.select("fp", F.struct(F.col("doc").getField(doc_id).isNull().alias("none"),
                                       F.col("doc").getField(doc_id).alias("id"), "row").alias("first"))
    nodes = stage(thin.groupBy("fp").agg(F.min("first").alias("first")), "simhash-nodes")
    kept = near_duplicates(nodes).groupBy("component").agg(F.min("first").alias("first")).select("first.row")
    return unpacked(table.join(kept, "row", "left_semi"), docs)
