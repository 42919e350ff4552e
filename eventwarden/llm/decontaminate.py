"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of ten words (a shorter item is one window), a window into
three-word shingles.  A document can only hold a window if it holds every shingle of it, so one
shingle per window is a sufficient prefix: the rarest, by the number of documents that hold
it.  Documents are joined with these prefix shingles; a match fixes where the window would
have to lie, which must be inside the document (position and length bounds), and there the
document's words are compared with the window's.

The benchmark is read in blocks of a bounded number of words, each small enough to be sent to
all tasks; the documents stream past each block and are never shuffled.

Defined cases: a null or empty text, of a document or an item, has no words and no windows; an
item without id marks words but is not listed; repeated items count once; a null doc_id stays
null; repeated rows are judged each by itself; empty tables give no hits; other columns are
passed through or ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import packed, stage, unpacked

WINDOW = 10
SHINGLE = 3
#: Words of benchmark items that are sent to all tasks at a time.
BLOCK_WORDS = 500_000
FOUND = "struct<n_words:bigint,spans:array<int>,items:array<string>>"
#: A-Z to a-z, other ASCII but digits and a-z to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def windows(item: list[bytes], window: int = WINDOW) -> set[tuple]:
    if not item:
        return set()
    return {tuple(item[i:i + window]) for i in range(max(1, len(item) - window + 1))}


def shingles(seq, size: int):
    """The ``size``-word shingles of a sequence, in order."""
    return zip(*[seq[i:] for i in range(size)])


class Block:
    """The windows of some items: what they are made of and whom they belong to."""

    def __init__(self, rows):
        self.owners: dict[tuple, set] = defaultdict(set)
        for item_id, text in rows:
            for w in windows(_words(text)):
                self.owners[w] |= {item_id} - {None}
        sizes = {min(SHINGLE, len(w)) for w in self.owners}
        self.parts = {n: frozenset(s for w in self.owners if min(SHINGLE, len(w)) == n for s in shingles(w, n)) for n in sizes}

    def order(self) -> list[tuple]:
        return sorted(s for part in self.parts.values() for s in part)

    def prefixes(self, rarity: dict[tuple, int]) -> dict[int, dict[tuple, list]]:
        """size -> rarest shingle -> (window, places of the shingle in it); windows that no document can hold go."""
        out: dict[int, dict] = {n: defaultdict(list) for n in self.parts}
        for w in self.owners:
            n = min(SHINGLE, len(w))
            inside = list(shingles(w, n))
            least = min(inside, key=lambda s: (rarity.get(s, 0), s))
            if rarity.get(least, 0):
                out[n][least].append((w, inside.index(least)))
        return {n: dict(x) for n, x in out.items() if x}


def _rarity(docs: DataFrame, text: Column, block: Block) -> dict[tuple, int]:
    """How many documents hold each shingle of the block, over all documents."""
    order = block.order()
    shared = docs.sparkSession.sparkContext.broadcast((block.parts, {s: i for i, s in enumerate(order)}))

    def count(batches):
        parts, number = shared.value
        for batch in batches:
            seen = Counter()
            for t in batch.column(0):
                w = _words(t.as_py())
                for n, part in parts.items():
                    seen.update(part.intersection(shingles(w, n)))
            yield pa.RecordBatch.from_pydict({"s": pa.array([number[s] for s in seen], pa.int32()),
                                              "n": pa.array(list(seen.values()), pa.int64())})

    counts = docs.select(text.alias("text")).mapInArrow(count, "s int, n long").groupBy("s").agg(F.sum("n").alias("n"))
    # one row per shingle of the block at most
    return {order[r.s]: r.n for r in counts.collect()}


def _search(spark, block: Block, prefixes: dict) -> callable:
    shared = spark.sparkContext.broadcast((prefixes, dict(block.owners)))

    def search(text: str | None, spans: list[int], items: list[str]) -> tuple[int, list[int], list[str]]:
        prefixes, owners = shared.value
        w = _words(text)
        hit = None
        for n, table in prefixes.items():
            if table.keys().isdisjoint(shingles(w, n)):
                continue
            for at, s in enumerate(shingles(w, n)):
                for window, offset in table.get(s, ()):
                    start = at - offset
                    if start < 0 or start + len(window) > len(w) or tuple(w[start:start + len(window)]) != window:
                        continue
                    if hit is None:
                        hit, names = bytearray(len(w)), set(items)
                        for a, b in zip(spans[::2], spans[1::2]):
                            hit[a:b] = b"\x01" * (b - a)
                    hit[start:start + len(window)] = b"\x01" * len(window)
                    names |= owners[window]
        if hit is None:
            return len(w), spans, items
        out, at = [], hit.find(1)
        while at >= 0:
            end = hit.find(0, at)
            end = len(hit) if end < 0 else end
            out += [at, end]
            at = hit.find(1, end)
        return len(w), out, sorted(names)

    @arrow_udf(FOUND)
    def run(texts: pa.Array, spans: pa.Array, items: pa.Array) -> pa.Array:
        rows = [search(t.as_py(), s.as_py() or [], i.as_py() or []) for t, s, i in zip(texts, spans, items)]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
             pa.array([r[2] for r in rows], pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return run


def search_benchmark(rows: DataFrame, text: Column, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``found``: the number of words, the hit spans [start, end, ...) and the items' ids.

    ``text`` is an expression over ``rows``.  With one block the documents are read twice, to
    count and to search; each further block adds as much, over a written table.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("body")).filter("body IS NOT NULL").distinct()
    size = items.select(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    found = F.lit(None).cast(FOUND)
    current = rows.withColumn("found", found)
    for i in range(blocks):
        # by id and text, so that items with one text are dealt to all blocks
        own = items.filter(F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)) == i).collect() if blocks > 1 else items.collect()
        block = Block(own)
        prefixes = block.prefixes(_rarity(rows, text, block)) if block.owners else {}
        run = _search(rows.sparkSession, block, prefixes)
        current = current.withColumn("found", run(text, F.col("found.spans"), F.col("found.items")))
        if i + 1 < blocks:
            current = stage(current, "benchmark-block")
    return current


def hit_words() -> Column:
    """The number of words in ``found.spans``."""
    return F.expr("aggregate(sequence(0, size(found.spans), 2), 0L, (a, i) -> "
                  "a + IF(i < size(found.spans), get(found.spans, i + 1) - get(found.spans, i), 0))")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, hit words, items found and their digest."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    found = search_benchmark(rows, F.col("body"), benchmark).drop("body").withColumn("n_hit", hit_words())
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), "n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def filter_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no window of the benchmark, with the columns they came with."""
    found = search_benchmark(packed(docs), F.col("doc").getField(text), benchmark)
    return unpacked(found.filter(F.size("found.spans") == 0), docs)
