"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece crosses.  The distinct units' substrings, up to the
longest piece, are joined with the piece table: each match is an edge of the unit's lattice.
Edges are grouped by unit, and a higher-order fold over the end positions keeps the best path
to each (Viterbi).  A character without a piece is an edge of its UTF-8 byte pieces.

Scores are log-probabilities.  A unigram model has them; a byte-pair model has merge ranks
instead, and a rank r is read as Zipf's law does, -log(r + 1).  The library merges greedily with
such a model, so its ids differ for some units; both decode to the same text.

Documents are dealt into blocks of a bounded size.  A block sends its distinct units to the
lattice, in buckets by unit, and gets back their ids in the units' order.  So each document is
shuffled once, each distinct unit is solved once, and no table of all units is held anywhere.

Defined cases: a null or empty text has no pieces; a null doc_id stays null; repeated rows are
encoded each by itself; letters without a break for over MAX_UNIT characters are cut there; the
model's own space mark in a text is read as a space; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from hashlib import sha256
from itertools import chain, count, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import chunks

SPACE = "▁"
BREAK = "\n"
MAX_UNIT = 1024
BLOCK_BYTES = 8_000_000
#: Buckets of units for each block: a task solves at most this share of a block's text at a time.
BUCKETS_A_BLOCK = 6
#: Ids that are decoded at a time.
DECODED_IDS = 200_000
#: What a character without a piece scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
_ENCODED = "doc_id long, n_pieces long, ids array<int>"


class Model:
    """Pieces, scores and byte ids of a model file, and the pattern of units that none crosses."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in range(size) if m.is_byte(i)}
        plain = [i for i in range(size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.pieces = {m.id_to_piece(i): i for i in plain}
        raw = {i: m.get_score(i) for i in plain}
        # ranks 0, -1, -2, ... are no log-probabilities
        ranked = sum(raw[i] == int(raw[i]) for i in plain) > 0.99 * len(plain)
        self.scores = {i: -math.log(1 - s) if ranked else s for i, s in raw.items()}
        self.longest = max(map(len, self.pieces))
        self.encoded = {i: p.encode() for p, i in self.pieces.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.pattern = self._pattern()

    def _pattern(self) -> str:
        """Letters, marks and single digits apart, each with the spaces before, if no piece crosses that."""
        loose: set[str] = set()
        for _ in range(3):
            also = "".join(sorted(map(re.escape, loose)))
            letters = f"[^\\W\\d_{also}]"
            marks = f"(?:[^\\w\\s]|[{also}])" if also else "[^\\w\\s]"
            most = f"{{1,{MAX_UNIT}}}"
            pattern = f" *{letters}{most}| *{marks}{most}| *\\d| +|\\s|\\w"
            if BREAK in loose:
                break
            crossed = [p for p in self.pieces if not re.fullmatch(pattern, p.replace(SPACE, " "))]
            if not crossed:
                return pattern
            loose |= {c for p in crossed for c in p if not (c.isalpha() or c.isdecimal() or c == SPACE)}
        return f" *\\S{{1,{MAX_UNIT}}}| +|\\s"  # nothing but white space parts units

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, id, score), one row per piece of the model."""
        ids = list(self.pieces.values())
        return spark.createDataFrame(pa.table({"piece": list(self.pieces), "id": pa.array(ids, pa.int32()),
                                               "score": [self.scores[i] for i in ids]}))

    def unknown(self) -> float:
        return min(self.scores.values()) - UNKNOWN_PENALTY

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        text = b"".join(map(self.encoded.__getitem__, ids)).decode(errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def split_units(pattern: re.Pattern, text: str | None) -> list[str]:
    """The units of a text after the space that the model puts in front of it."""
    return pattern.findall(" " + text.replace(SPACE, " ")) if text else []


def _byte_ids(model: Model, char: Column) -> Column:
    table = F.array(*[F.lit(model.bytes[b]) for b in range(256)])
    code = F.hex(F.encode(char, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")),
                       lambda k: table[F.conv(F.substring(code, (k * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")])


def solve(units: DataFrame, model: Model) -> DataFrame:
    """Adds the best path's ``ids`` to distinct units (bucket, unit, places) that are dealt by bucket.

    The piece table has as many rows as the model file has pieces, so it is broadcast.  Edges carry
    the unit's number in its task; the unit and its places go along with its first edge only, which
    every unit has.  An edge without an id is a character that has no piece.
    """
    numbered = units.select("bucket", F.monotonically_increasing_id().alias("number"), F.translate("unit", " ", SPACE).alias("body"),
                            F.struct("unit", "places").alias("own"))
    stops = numbered.select("bucket", "number", "body", "own", F.explode(F.sequence(F.lit(1), F.length("body"))).alias("stop"))
    subs = stops.select("bucket", "number", "body", "own", "stop", F.explode(
        F.sequence(F.lit(1), F.least(F.lit(model.longest), F.col("stop")))).alias("size")) \
        .select("bucket", "number", "stop", "size", F.when(F.col("stop") == 1, F.col("own")).alias("own"),
                F.substring(F.col("body"), F.col("stop") - F.col("size") + 1, F.col("size")).alias("piece"))
    edges = subs.join(F.broadcast(model.table(units.sparkSession)), "piece", "left").filter("id IS NOT NULL OR size = 1")
    edge = F.struct("stop", "size", F.coalesce("score", F.lit(model.unknown())).alias("score"), "id")
    lattice = edges.groupBy("number", "bucket").agg(F.sort_array(F.collect_list(edge)).alias("edges"), F.first("own", ignorenulls=True).alias("own"))
    # one character is always an edge, and a stop's edges begin with it: the stop before it is done by then.
    # Each stop keeps the last of the edges with its best score: the longest piece wins ties
    kind = "struct<stop: int, size: int, score: double, id: int>"
    kept = (f"aggregate(edges, named_struct('done', CAST(array() AS array<struct<score: double, edge: {kind}>>), 'score', 0D, 'edge', CAST(NULL AS {kind})), "
            "(p, e) -> IF(e.size = 1, "
            "named_struct('done', concat(p.done, array(named_struct('score', p.score, 'edge', p.edge))), 'score', p.score + e.score, 'edge', e), "
            "IF(p.done[e.stop - e.size].score + e.score >= p.score, "
            "named_struct('done', p.done, 'score', p.done[e.stop - e.size].score + e.score, 'edge', e), p)), "
            "p -> concat(p.done.edge, array(p.edge)))")
    # backwards from the end; a character without a piece is its place below zero
    path = ("aggregate(reverse(kept), named_struct('at', length(own.unit), 'path', CAST(array() AS array<int>)), "
            "(p, e) -> IF(e.stop = p.at, named_struct('at', p.at - e.size, 'path', concat(p.path, array(coalesce(e.id, -e.stop)))), p), "
            "p -> reverse(p.path))")
    solved = lattice.withColumn("kept", F.expr(kept)).select("bucket", "own", F.expr(path).alias("path"))
    spelt = F.flatten(F.transform("path", lambda i: F.when(i >= 0, F.array(i)).otherwise(
        _byte_ids(model, F.substring(F.translate("own.unit", " ", SPACE), -i, F.lit(1))))))
    return solved.select("bucket", "own.*", F.when(F.array_min("path") < 0, spelt).otherwise(F.col("path")).alias("ids"))


class _Block:
    """Numbers the tokens of a block's texts, and the units of the distinct tokens only.

    A token is what stands between two spaces, read with the space before it; a text with other
    spaces than single ones inside is cut into units right away, which are its tokens.
    """

    def __init__(self, pattern: str, texts):
        split, own = re.compile(pattern), defaultdict(count().__next__)
        parts: list[np.ndarray | None] = []
        spaced = []
        for text in texts:
            text = (text or "").replace(SPACE, " ")
            if not text or "  " in text or text[0] == " " or text[-1] == " ":
                found = split_units(split, text)
                parts.append(np.fromiter(map(own.__getitem__, found), np.int32, len(found)))
            else:
                parts.append(None)
                spaced.append(text)
        lists = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        del spaced
        coded = lists.flatten().dictionary_encode()
        tokens, numbers, ends = coded.dictionary, coded.indices.to_numpy(), lists.offsets.to_numpy()
        at = iter(zip(ends, ends[1:]))
        #: The numbers of each text's tokens: those between spaces come first, then units.
        self.parts = [numbers[slice(*next(at))] if p is None else p + len(tokens) for p in parts]
        # letters alone are one unit
        whole = pc.and_(pc.ascii_is_alpha(tokens), pc.less_equal(pc.binary_length(tokens), MAX_UNIT))
        found = [split.findall(" " + t) for t in tokens.filter(pc.invert(whole)).to_numpy(zero_copy_only=False)]
        space, empty = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        units = pa.concat_arrays([pc.binary_join_element_wise(empty, tokens.filter(whole), space),
                                  pa.array(chain.from_iterable(found), pa.large_string()), pa.array(list(own), pa.large_string())]).dictionary_encode()
        whole = whole.to_numpy(zero_copy_only=False)
        #: How many units each token has, all tokens' units by number, and the units.
        self.counts = np.ones(len(tokens) + len(own), np.int64)
        self.counts[:len(tokens)][~whole] = list(map(len, found))
        single = (np.cumsum(self.counts) - self.counts)[:len(tokens)][whole]
        self.flat, other = np.empty(len(units), np.int32), np.ones(len(units), bool)
        other[single] = False
        self.flat[single], self.flat[other] = units.indices[:len(single)].to_numpy(), units.indices[len(single):].to_numpy()
        self.units = units.dictionary


def _compressed(batches):
    """Texts as zstd frames: a document as a whole packs better than the shuffle's small blocks do."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [None if t.as_py() is None else pack(t.as_py().encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("block"), pa.array(texts, pa.binary())], ["doc_id", "block", "text"])


def _texts(packed):
    unpack = zstandard.ZstdDecompressor().decompress
    return (None if t is None else unpack(t).decode() for t in packed)


def _block_units(pattern: str, buckets: int):
    """A block's distinct units, one row per bucket: in order, and joined by the one character that
    is a unit by itself only (written as an empty one).  Blocks come one after the other.
    """

    def run(batches):
        packed = ((number, text) for batch in batches for number, text in
                  zip(batch.column("block").to_pylist(), batch.column("text").to_pylist()))
        for block, of_block in groupby(packed, itemgetter(0)):
            yield rows_of(block, _Block(pattern, _texts(t for _, t in of_block)).units)

    def rows_of(block: int, units: pa.Array) -> pa.RecordBatch:
        used, order, ends = in_buckets(units, buckets)
        written = pc.if_else(pc.equal(units, BREAK), pa.scalar("", pa.large_string()), units).to_numpy(zero_copy_only=False)[order]
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int32()),
            "units": pa.array([BREAK.join(written[start:end]) for start, end in zip(ends, ends[1:])], pa.string())})

    return run


def in_buckets(units: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of distinct units, the units' numbers by bucket in an order that depends on nothing
    but the units, and where each bucket's begin, and the end."""
    raw = units.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    code = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw))
    key = code % buckets << 32 | code
    order = np.argsort(key)
    same = np.flatnonzero(np.diff(key[order]) == 0)
    for run in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1) if len(same) else ():  # one code: by their bytes
        order[run[0]:run[-1] + 2] = sorted(order[run[0]:run[-1] + 2], key=raw.__getitem__)
    used, first = np.unique(key[order] >> 32, return_index=True)
    return used, order, np.append(first, len(order))


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``at`` of ``flat`` one after the other, and their sizes."""
    n = size[at]
    return flat[np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))], n


def _encode_block(pattern: str, buckets: int, pieces: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
    """Documents of a block and its units' ids, by bucket in the units' order.  With the bytes of the
    pieces, the ids are decoded again and the digest of each text goes with them."""

    def run(docs: pa.Table, solved: pa.Table) -> pa.Table:
        block = _Block(pattern, _texts(docs["text"].to_pylist()))
        texts, units, counts, n_units = block.parts, block.flat, block.counts, len(block.units)
        used, order, ends = in_buckets(block.units, buckets)
        del block
        mine = {b: order[start:end] for b, start, end in zip(used.tolist(), ends, ends[1:])}
        place, sizes, flat = np.zeros(n_units, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        done = 0
        for bucket, n, ids in zip(solved["bucket"].to_pylist(), solved["sizes"], solved["ids"]):
            own = mine.pop(bucket)
            place[own] = np.arange(done, done + len(own))
            done += len(own)
            sizes.append(n.values.to_numpy())
            flat.append(ids.values.to_numpy())
        size, flat = np.concatenate(sizes).astype(np.int64), np.concatenate(flat).astype(np.int32)
        if len(size) != n_units or done != n_units:
            raise RuntimeError("a block's units and their ids don't match")
        # ids by unit, then by token, then by text
        flat, n = _gather(flat, np.cumsum(size) - size, size, place[units])
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        first, size = ends[:-1], np.diff(ends)
        parts = [_gather(flat, first, size, at)[0] for at in texts]
        ends = np.cumsum([0, *map(len, parts)])
        ids = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate(parts) if parts else flat[:0], pa.int32()))
        del parts, flat, first, size
        out = {"doc_id": docs["doc_id"], "n_pieces": pa.array(np.diff(ends), pa.int64()), "ids": ids.cast(pa.list_(pa.int32()))}
        if pieces is not None:
            digests = [sha256(t.as_buffer()).hexdigest() for texts in _decoded(ids, *pieces) for t in texts]
            out["decoded_sha256"] = pa.array(digests, pa.string())
        return pa.table(out)

    return run


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """One row per document: doc_id, n_pieces and ids.

    ``decoded``: also the SHA-256 of the text that the ids decode to.  It is made where the ids
    are, as workers of a second function would need an executor's memory beside the first.
    """
    spark = docs.sparkSession
    model = Model(model_path)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(-(-size // block_bytes), spark.sparkContext.defaultParallelism)
    buckets = BUCKETS_A_BLOCK * blocks
    # by id and text, so that copies of one text are dealt to many blocks
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")) \
        .mapInArrow(_compressed, "doc_id long, block int, text binary").repartition(blocks, "block")
    sent = dealt.sortWithinPartitions("block").mapInArrow(_block_units(model.pattern, buckets), "bucket int, block int, units string").repartition(buckets, "bucket")
    width = "smallint" if max(model.encoded) < 2 ** 15 else "int"
    # a place is the block and, in the lower 32 bits, where the unit stands in the block's row
    units = sent.select("bucket", "block", F.posexplode(F.split("units", BREAK)).alias("at", "unit")) \
        .select("bucket", F.when(F.col("unit") == "", BREAK).otherwise(F.col("unit")).alias("unit"),
                F.shiftleft(F.col("block").cast("long"), 32).bitwiseOR(F.col("at")).alias("place"))
    # the hash comes first: long keys are sorted by their bits, where the bucket is the same for all
    where = units.groupBy(F.xxhash64("unit").alias("hash"), "bucket", "unit").agg(F.collect_list("place").alias("places"))
    back = solve(where, model).select("bucket", F.explode("places").alias("place"), "ids") \
        .groupBy("bucket", F.shiftright("place", 32).cast("int").alias("block")) \
        .agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("x")) \
        .select("bucket", "block", F.transform("x", lambda u: F.size(u["ids"]).cast("smallint")).alias("sizes"),
                F.flatten("x.ids").cast(f"array<{width}>").alias("ids"))
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _encode_block(model.pattern, buckets, _piece_bytes(model) if decoded else None), _ENCODED + ", decoded_sha256 string" * decoded)


def _piece_bytes(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces, and by id where each begins and its size."""
    listed = [model.encoded.get(i, b"") for i in range(max(model.encoded) + 1)]
    size = np.array(list(map(len, listed)))
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum(size) - size, size


def _decoded(ids: pa.Array, flat: np.ndarray, first: np.ndarray, size: np.ndarray):
    """The texts of lists of ids, some rows at a time; piece ``i`` is ``size[i]`` bytes of ``flat`` from ``first[i]``."""
    lists = ids.cast(pa.large_list(pa.int32()))
    values, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
    for start, end in chunks(ends, DECODED_IDS):
        some = values[ends[start]:ends[end]]
        body, n = _gather(flat, first, size, some)
        if not n.all():
            raise ValueError("an id that is no piece")
        at = np.concatenate([[0], np.cumsum(n)])[ends[start:end + 1] - ends[start]]
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - start, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(body)])
        try:
            texts = texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # byte pieces that make no characters
            texts = pa.array([t.decode(errors="replace") for t in texts.to_pylist()], pa.large_string())
        yield pc.replace_substring_regex(pc.replace_substring(texts, SPACE, " "), r"\A ", "")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds ``text`` to rows with ``ids``; no ids give an empty text, null ids a null.

    The pieces' bytes go with the function, so that rows stay where they are; a join would
    shuffle every id to its piece and back.
    """
    table = _piece_bytes(Model(model_path))

    @arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        texts = pa.concat_arrays([pa.array([], pa.large_string()), *_decoded(ids, *table)])
        return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.large_string())).cast(pa.string())

    return encoded.withColumn("text", run("ids"))
