"""Removal of passages that an earlier document holds, with an FM-index per shard.

A window is 50 consecutive words.  Equal windows have the same smallest hash among their
eight-word grams, so documents are cut into runs of windows with the same smallest hash (the
run's anchor), and only anchors that two documents share can hold a repeat.  Runs are dealt by
anchor; a task indexes a bounded shard of whole anchor groups at a time and streams the shard's
runs through a backward search, which gives for every window the suffixes that begin with it
and so the smallest doc_id that holds it.

Equal runs are sent once per task with their text and are indexed once.  An anchor that more
than MANY runs share, a run counting once for each RUN_WINDOWS begun, is not brought together: its windows are grouped by a 128-bit digest of
their words instead, with minima that combine before the shuffle.

Defined cases: a null or empty text has no words; a null doc_id counts as larger than any other,
and such documents don't remove from each other; repeated rows with the same doc_id don't either
and have the same result; texts shorter than a window stay whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha256
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventwarden.llm.common import chunks, partitions, stage, text_bytes
from eventwarden.llm.fm_index import FmIndex

WINDOW = 50
GRAM = 8
#: Runs of one anchor that are brought together; more are compared by digest.
MANY = 20_000
#: Windows that count as one run: in a text that repeats a short phrase a run can be as long as the text.
RUN_WINDOWS = 50
#: Words of distinct runs in one index.
SHARD_WORDS = 300_000
#: Windows of a run that one query of the search covers.
LANE = 256
_STEP = 2_000_000
_LAST = (1 << 63) - 1
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FACTOR = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size, tables = max(n, _STEP), []
        inverse = pow(_FACTOR, -1, 1 << 64)
        for x in (_FACTOR, inverse):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all rows, and the first word of each row and the end."""
    white = _SPACE[body]
    after = np.concatenate([[True], white[:-1]])
    after[offsets[:-1][offsets[:-1] < len(body)]] = True
    before = np.concatenate([white[1:], [True]])
    ends = offsets[1:][offsets[1:] > 0]
    before[ends - 1] = True
    start, end = np.flatnonzero(~white & after), np.flatnonzero(~white & before) + 1
    power, inverse = _power_tables(len(body) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((body.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    return _mixed((sums[end] - sums[start]) * inverse[start]), np.searchsorted(start, offsets)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def window_runs(body: np.ndarray, offsets: np.ndarray):
    """(row, anchor, first, last): runs of windows with the same smallest gram hash, by word in the row."""
    words, firsts = word_hashes(body, offsets)
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = words[:len(words) - GRAM + 1].copy()
    for i in range(1, GRAM):
        grams = grams * np.uint64(_FACTOR) + words[i:len(words) - GRAM + 1 + i]
    low = _sliding_min(_mixed(grams), WINDOW - GRAM + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    at = np.flatnonzero(row[:len(low)] == row[WINDOW - 1:])
    value = low[at]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (value[1:] != value[:-1])])) if len(at) else at
    end = np.append(new[1:], len(at)) - 1
    rows = row[at[new]]
    return rows, value[new].view(np.int64), at[new] - firsts[rows], at[end] - firsts[rows]


def _runs(batches):
    for batch in batches:
        body, offsets = text_bytes(batch.column("text"))
        doc, key = batch.column("doc"), batch.column("key")
        for start, end in chunks(offsets, _STEP):
            rows, anchor, first, last = window_runs(body[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start])
            take = pa.array(rows + start)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), doc.take(take), key.take(take), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                                             ["anchor", "doc", "key", "first", "last"])


def _sent_runs(batches):
    """One row per shared run; of equal runs in a task only the first brings its text along."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        out = defaultdict(list)
        for text, doc, key, marks in zip(batch.column("text"), batch.column("doc").to_pylist(), batch.column("key").to_pylist(), batch.column("marks").to_pylist()):
            words = text.as_py().encode().split()
            for m in marks:
                body = b" ".join(words[m["first"]:m["last"] + WINDOW])
                run = xxhash.xxh64_intdigest(body) - (1 << 63)
                known = not m["many"] and (m["anchor"], run) in seen
                if not known:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add((m["anchor"], run))
                for name, value in (("anchor", m["anchor"]), ("run", run), ("doc", doc), ("key", key), ("first", m["first"]),
                                    ("n", m["last"] - m["first"] + 1), ("many", m["many"]), ("text", None if known else body)):
                    out[name].append(value)
        if out:
            schema = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("first", pa.int32()),
                                ("n", pa.int32()), ("many", pa.bool_()), ("text", pa.binary())])
            yield pa.RecordBatch.from_pydict(dict(out), schema)


_SENT = "anchor long, run long, doc long, key long, first int, n int, many boolean, text binary"
_COVER = "doc long, key long, start int, stop int"


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def shard_covers(table: pa.Table) -> pa.RecordBatch:
    """The word ranges to remove from the documents of one shard: whole anchor groups, sorted by anchor and run."""
    anchor, run, doc, first, n = (table[c].to_numpy() for c in ("anchor", "run", "doc", "first", "n"))
    starts = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])]))
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(run))))
    owner = np.minimum.reduceat(doc, starts)
    ids: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    parts, places, at = [], [], 0
    for text in table["text"].take(pa.array(starts)).to_pylist():
        words = [ids[w] for w in text.split(b" ")]
        places.append(at)
        parts += words
        parts.append(0)
        at += len(words) + 1
    text, places, windows = np.array(parts, np.int64), np.array(places), n[starts].astype(np.int64)
    index = FmIndex(text, WINDOW)
    lanes = -(-windows // LANE)
    begin = np.repeat(places, lanes) + _ranges(lanes) * LANE
    end = np.minimum(begin + LANE, np.repeat(places + windows, lanes)) - 1
    found = index.match(text, begin, end)
    # the smallest owner among the suffixes of each group
    owner_at = np.repeat(owner, windows + WINDOW)
    lowest = np.minimum.reduceat(owner_at[index.order], index.whole[1][:-1])
    # each row's windows, and whether a smaller doc_id holds them
    size = windows[number]
    gone = lowest[found[np.repeat(places[number], size) + _ranges(size)]] < np.repeat(doc, size)
    of, inside = np.repeat(np.arange(len(doc)), size), _ranges(size)
    edge = np.concatenate([[True], (of[1:] != of[:-1]) | (gone[1:] != gone[:-1])])
    new = np.flatnonzero(edge)
    last = np.append(new[1:], len(gone)) - 1
    keep = gone[new]
    new, last = new[keep], last[keep]
    rows = of[new]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[rows]), table["key"].combine_chunks().take(pa.array(rows)) if len(rows) else pa.array([], pa.int64()),
         pa.array(first[rows] + inside[new], pa.int32()), pa.array(first[rows] + inside[last] + WINDOW, pa.int32())],
        ["doc", "key", "start", "stop"])


def _covers(shard_words: int):
    def run(batches):
        held, words = [], 0

        def shard(upto: pa.Table):
            return shard_covers(upto.combine_chunks())

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            words += pa.compute.sum(pa.compute.add(batch.column("n"), WINDOW)).as_py()
            if words < shard_words:
                continue
            table = pa.Table.from_batches(held)
            anchors = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchors != anchors[-1], False)) if anchors[0] == anchors[-1] else int(np.flatnonzero(anchors != anchors[-1])[-1]) + 1
            if anchors[0] == anchors[-1]:
                cut = 0  # the group may go on; it has MANY times RUN_WINDOWS windows at most
            if cut:
                yield shard(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                held = rest.to_batches()
                words = int((rest["n"].to_numpy().astype(np.int64) + WINDOW).sum())
        if held:
            yield shard(pa.Table.from_batches(held))

    return run


def _digests(batches):
    """One row per window of the runs with too common an anchor."""
    for batch in batches:
        out = defaultdict(list)
        for text, doc, key, first in zip(*(batch.column(c).to_pylist() for c in ("text", "doc", "key", "first"))):
            words = text.split(b" ")
            for i in range(len(words) - WINDOW + 1):
                for name, value in (("digest", xxhash.xxh3_128_digest(b" ".join(words[i:i + WINDOW]))), ("doc", doc), ("key", key), ("start", first + i)):
                    out[name].append(value)
            if len(out["digest"]) > 50_000:
                yield _digest_rows(out)
                out = defaultdict(list)
        if out:
            yield _digest_rows(out)


def _digest_rows(out: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(out), pa.schema([("digest", pa.binary()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int32())]))


def _kept(batches):
    """The counts and the digest of what is left of each document."""
    for batch in batches:
        n_words, n_removed, digests = [], [], []
        for text, covers in zip(batch.column("text"), batch.column("covers").to_pylist()):
            words = (text.as_py() or "").encode().split()
            left = words
            if covers:
                gone = bytearray(len(words))
                for c in covers:
                    gone[c["start"]:c["stop"]] = b"\x01" * (c["stop"] - c["start"])
                left = [w for w, g in zip(words, gone) if not g]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            digests.append(sha256(b" ".join(left)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def shared_anchors(runs: DataFrame, many: int) -> DataFrame:
    """(anchor, many): the anchors that two documents share, and whether they are too common to be brought together."""
    size = F.ceil((F.col("last") - F.col("first") + 1) / RUN_WINDOWS)
    return runs.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.sum(size).alias("n")) \
        .filter("low < high").select("anchor", (F.col("n") > many).alias("many"))


def repeated_ranges(docs: DataFrame, many: int = MANY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc, key, start, stop): word ranges of ``docs`` (doc, key, text) that a smaller ``doc`` holds.

    ``docs`` is dealt by doc and key already; both of its readings here and the caller's share that shuffle.
    """
    spark = docs.sparkSession
    runs = docs.select("doc", "key", "text").mapInArrow(_runs, "anchor long, doc long, key long, first int, last int")
    shared = stage(shared_anchors(runs, many), "anchors")
    common = bool(shared.filter("many").limit(1).count())
    marks = runs.join(shared, "anchor").groupBy("doc", "key").agg(F.collect_set(F.struct("anchor", "first", "last", "many")).alias("marks"))
    sent = docs.join(marks, ["doc", "key"]).select("doc", "key", "text", "marks").mapInArrow(_sent_runs, _SENT)
    dealt = sent.filter("NOT many").repartition(partitions(spark), "anchor").sortWithinPartitions("anchor", "run", F.col("text").isNull())
    covers = dealt.mapInArrow(_covers(shard_words), _COVER)
    if common:
        windows = sent.filter("many").select("text", "doc", "key", "first").mapInArrow(_digests, "digest binary, doc long, key long, start int")
        low = windows.groupBy("digest").agg(F.min("doc").alias("low"))
        covers = covers.unionAll(windows.join(low, "digest").filter("low < doc")
                                 .select("doc", "key", "start", (F.col("start") + WINDOW).alias("stop")))
    return covers


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", many: int = MANY,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: n_words, n_removed and the digest of the words kept."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")) \
        .select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("key"), "text")
    dealt = rows.repartition(partitions(docs.sparkSession), "doc", "key")
    covers = repeated_ranges(dealt, many, shard_words).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("covers"))
    joined = dealt.join(covers, ["doc", "key"], "left").select("doc_id", "text", "covers")
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
