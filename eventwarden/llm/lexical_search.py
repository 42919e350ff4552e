"""Ranked lexical search by the Best Position Algorithm over impact lists.

A term's impact list holds the documents with the term by falling impact (its share of their score).  For an item all
lists of its terms are read in parallel from the top; every document met is looked up in all the other lists at once
(direct access), which gives its whole score and its places there.  A list's best position is the end of the
stretch from its top that has been seen in full, by reading or by direct access.  No document that was not met scores
above the sum of the impacts at the best positions; the search of an item stops when that sum is strictly below the
score of the k-th best document, so that ties at the k-th place are all met.  Best positions are never above the
last positions read, so this bound is never looser than the one of the plain threshold method.

Documents are dealt as they lie: a task reads documents until their postings fill a bounded index (``POSTINGS``), builds
the lists, runs all items, keeps each item's best k with the scores they must beat, and goes on.  Only k rows an item and
task are shuffled.  Statistics (documents, terms, document frequencies) are of all documents.  Items go in blocks of
bounded size (``ITEM_TERMS``); each block reads the documents once more.

Defined cases: null, empty and blank texts have no terms and are neither counted nor found; items without terms, or
whose terms are in no document, give no rows; each row of ``items`` is an item of its own, rows with one item_id too;
repeated documents are ranked each; equal scores go by ascending doc_id, a null doc_id first, then by place; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from eventwarden.llm.common import stage

TOP = 20
#: Postings of an index (24 bytes each, and as much again while it is built).
POSTINGS = 1 << 22
#: Terms of a block of items, repeats included; its vocabulary is smaller.
ITEM_TERMS = 1 << 20
#: Positions of each list that are read in the first step; every further step reads twice as many.
STEP = 32
# ASCII bytes that belong to no term become spaces, capital letters small ones.
_TABLE = bytes(32 if not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(128)) + bytes(range(128, 256))


def terms(text: bytes | None) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and of all other characters, A-Z lower-cased."""
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """The items of a block: term numbers with the number of times they are asked for."""

    def __init__(self, texts: list[tuple[int, bytes | None]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.numbers, self.terms, self.times = [], [], []
        for number, text in texts:
            asked = Counter(terms(text))
            self.numbers.append(number)
            self.terms.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in asked], np.int64))
            self.times.append(np.array(list(asked.values()), np.int64))


def postings(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n`` (terms in all), ``terms`` and ``tfs`` (of the vocabulary) of the documents with terms."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           *T._parse_datatype_string("n bigint, terms array<int>, tfs array<bigint>").fields])

    def run(batches):
        number = vocabulary.value.get
        for batch in batches:
            keep, n, ends, found, times = [], [], [0], [], []
            for i, body in enumerate(batch.column("text")):
                words = terms(body.as_py())
                if words:
                    held = Counter(map(number, words))
                    held.pop(None, None)
                    keep.append(i)
                    n.append(len(words))
                    found += held.keys()
                    times += held.values()
                    ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
                     for x, kind in ((found, pa.int32()), (times, pa.int64()))]
            ids = batch.column("doc_id").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, schema)


class Index:
    """Impact lists over some documents, which are numbered in the order in which ties go."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        by_doc = np.lexsort((doc, term))
        self.doc, self.impact, term = doc[by_doc], impact[by_doc], term[by_doc]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        self.fall = np.lexsort((self.doc, -self.impact, term))  # place in the impact order -> posting
        self.place = np.empty(len(doc), np.int64)
        self.place[self.fall] = np.arange(len(doc))
        self.place -= self.start[term]

    def search(self, asked: np.ndarray, times: np.ndarray, k: int, bar: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with every one of the best ``k``; scores below ``bar`` are of no interest."""
        spans = [(int(self.start[t]), int(self.start[t + 1]), int(f)) for t, f in zip(asked, times)]
        lists = [(a, b, f, self.doc[a:b], np.zeros(b - a, bool)) for a, b, f in spans if b > a]
        best = [0] * len(lists)  # the length of each list's seen head
        met, docs, scores = set(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        read = 0
        while lists:
            new = np.unique(np.concatenate([self.doc[self.fall[a + read:min(a + read + step, b)]] for a, b, *_ in lists]))
            new = np.array([d for d in new.tolist() if d not in met], np.int64)
            met.update(new.tolist())
            score = np.zeros(len(new), np.int64)
            for i, (a, b, f, held, seen) in enumerate(lists):  # direct access
                at = np.minimum(np.searchsorted(held, new), b - a - 1)
                hit = held[at] == new
                score[hit] += f * self.impact[a + at[hit]]
                seen[self.place[a + at[hit]]] = True
                gap = np.flatnonzero(~seen[best[i]:best[i] + max(4 * step, 1024)])
                while not len(gap) and best[i] < b - a:
                    best[i] = min(best[i] + max(4 * step, 1024), b - a)
                    gap = np.flatnonzero(~seen[best[i]:best[i] + max(4 * step, 1024)])
                best[i] += int(gap[0]) if len(gap) else 0
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            if len(docs) > 4 * k + 1024:  # equal scores go by document
                top = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[top], scores[top]
            if len(scores) >= k:
                bar = max(bar, int(np.partition(scores, -k)[-k]))
            # a list seen in full has nothing left; else the impact at its best position bounds what was not met
            bound = sum(f * int(self.impact[self.fall[a + best[i] - 1]]) if best[i] else f * int(self.impact[self.fall[a]])
                        for i, (a, b, f, _, _) in enumerate(lists) if best[i] < b - a)
            read, step = read + step, step * 2
            if bound < bar or bound == 0:
                break
        top = np.lexsort((docs, -scores))[:k]
        return docs[top], scores[top]


def _ranked(batches, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int, most: int, id_field: pa.Field):
    """The best ``k`` of every item over all rows of a task."""
    kept: list[list[tuple[int, object]]] = [[] for _ in items.numbers]  # (-score, doc_id), the best first

    def settle(tables: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(tables).combine_chunks()
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_start")
        table = table.take(order).combine_chunks()
        whole = lambda x: np.concatenate([np.zeros(0, np.int64), *[c.to_numpy(zero_copy_only=False).astype(np.int64) for c in x.chunks]])
        doc = np.repeat(np.arange(len(table)), whole(pc.list_value_length(table["terms"])))
        term, tf = whole(pc.list_flatten(table["terms"])), whole(pc.list_flatten(table["tfs"]))
        n = whole(table["n"])
        m = 75 + np.array([25 * x * n_docs // n_terms for x in n.tolist()], np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        index, ids = Index(doc, term, impact, len(weights)), table["doc_id"]
        for i, (asked, times) in enumerate(zip(items.terms, items.times)):
            bar = -kept[i][-1][0] if len(kept[i]) >= k else 0
            docs, scores = index.search(asked, times, k, bar)
            rows = [(-s, ids[d].as_py()) for d, s in zip(docs.tolist(), scores.tolist()) if s > 0 and s >= bar]
            if rows:
                kept[i] = sorted(kept[i] + rows, key=lambda r: (r[0], r[1] is not None, r[1] if r[1] is not None else 0))[:k]

    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most - size, side="right")))
            stop = min(stop, len(batch))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - base
            start = stop
            if size >= most:
                settle(held)
                held, size = [], 0
    if held:
        settle(held)
    rows = [(i, -s, d) for i, found in zip(items.numbers, kept) for s, d in found]
    yield pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], id_field.type),
        pa.array([r[1] for r in rows], pa.int64())], ["item", "doc_id", "score"])


def _block(docs: DataFrame, texts: list[tuple[int, bytes | None]], k: int, doc_id: str, text: str, most: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items(texts)
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)  # at most ITEM_TERMS terms
    rows = stage(postings(docs, vocabulary, doc_id, text), "postings")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(items.vocabulary), np.int64)
    for term, df in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        weights[term] = weight(n_docs, df)
    shared = spark.sparkContext.broadcast((items, weights))  # as many numbers as the block has terms
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def run(batches):
        first = next(batches, None)
        if first is not None:
            asked, w = shared.value
            yield from _ranked((b for part in ([first], batches) for b in part), asked, w, n_docs, n_terms, k, most,
                               first.schema.field("doc_id"))

    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", most: int = POSTINGS, block_terms: int = ITEM_TERMS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best documents of each item."""
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    asked = stage(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    found, texts, size = [], [], 0
    for row in asked.select("item", "text").toLocalIterator():
        n = len(terms(row.text))
        if texts and size + n > block_terms:
            found.append(_block(docs, texts, k, doc_id, text, most))
            texts, size = [], 0
        texts.append((row.item, bytes(row.text) if row.text is not None else None))
        size += n
    found.append(_block(docs, texts, k, doc_id, text, most))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
