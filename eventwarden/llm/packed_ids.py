"""Token ids in files of fixed-width bits, in the order of the documents.

Each id takes ``bits_for(vocabulary)`` bits and no more.  Ids stand in blocks of ``BLOCK`` ids, each of
which starts at a byte given in the file, so that any stretch of ids is read from its blocks alone
and unpacked as one numpy expression.  A file holds

    magic (8 bytes), bits (uint32), ids of a block (uint32), blocks,
    documents (Arrow file: doc_id, first, n), byte offset of every block and of their end (uint64),
    ids (uint64), documents' offset (uint64), number of blocks (uint64), magic (8 bytes)

all little-endian.  ``first`` is a document's place in its file; the manifest, a Parquet table with a
row per file, has the place of the file in the whole (``first_id``).

Texts are dealt out by range of (doc_id, digest of the text), and each sorted range is encoded and written in one
streaming pass.  A file is closed at ``FILE_IDS`` ids, so memory does not follow a range's size.  Files have names
of their own for each attempt of a task, and only those of the attempt that Spark commits are in the manifest: a
lost executor leaves at most a file that nothing names.

Defined cases: a null or empty text has the end id alone; a null doc_id comes first; rows of one doc_id stand
in the order of their text's digest, and rows alike in both are interchangeable; an empty table gives an empty
manifest and no file; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwarden.llm.common import discard, partitions, qualified, shared_folder, stage

MAGIC = b"PACKIDS1"
HEAD, TAIL = 16, 32
#: Ids of a block (a multiple of 8, so that every block ends at a byte) and ids after which a file is closed.
BLOCK = 1 << 15
FILE_IDS = 1 << 26
#: A worker's memory of encoded units in bytes, two halves of which the older goes when the newer is full.
MEMORY = 320 << 20
#: Units that are encoded as one text.
JOINED = 1 << 13
MANIFEST = "part int, file_no int, path string, n_docs bigint, n_ids bigint, bits int"


# -- bits ---------------------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    """The least number of bits for ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after the other in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of packed ``data``, as uint32."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}")[start:stop].astype(np.uint32)
    at = np.arange(start, stop, dtype=np.int64) * bits
    body = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    word = np.zeros(len(at), np.uint64)
    for i in range((bits + 14) // 8):
        word |= body[(at >> 3) + i].astype(np.uint64) << np.uint64(8 * i)
    return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


# -- files --------------------------------------------------------------------------

class FileWriter:
    """One file: ids go in as they come and leave as full blocks."""

    def __init__(self, path: str, bits: int, id_type: pa.DataType) -> None:
        self.path, self.bits, self.id_type = path, bits, id_type
        system, place = pafs.FileSystem.from_uri(path)
        if isinstance(system, pafs.LocalFileSystem):
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(place)
        self.out.write(MAGIC + np.array([bits, BLOCK], "<u4").tobytes())
        self.offsets, self.rest, self.n_ids = [HEAD], np.zeros(0, np.uint32), 0
        self.docs, self.sizes = [], []

    def add(self, doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``sizes`` ids each, which stand in ``ids`` one after the other."""
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id does not fit in {self.bits} bits")
        self.docs.append(doc_ids)
        self.sizes.append(sizes)
        self.n_ids += len(ids)
        self.rest = np.concatenate([self.rest, ids.astype(np.uint32)])
        full = len(self.rest) // BLOCK * BLOCK
        if full:
            self._write(self.rest[:full])
            self.rest = self.rest[full:]

    def _write(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        blocks, size = -(-len(ids) // BLOCK), BLOCK * self.bits // 8
        self.offsets += [self.offsets[-1] + min(size * (k + 1), len(data)) for k in range(blocks)]
        self.out.write(data)

    def close(self) -> dict:
        if len(self.rest):
            self._write(self.rest)
        n = np.concatenate(self.sizes)
        table = pa.table({"doc_id": pa.chunked_array(self.docs, self.id_type), "first": np.cumsum(n) - n, "n": n})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.schema) as file:
            file.write_table(table)
        body = sink.getvalue()
        self.out.write(body)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([self.n_ids, self.offsets[-1], len(self.offsets) - 1], "<u8").tobytes() + MAGIC)
        self.out.close()
        return {"path": self.path, "n_docs": len(n), "n_ids": self.n_ids, "bits": self.bits}


class FileReader:
    """Random access to one file; only what is asked for is read."""

    def __init__(self, path: str) -> None:
        system, place = pafs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(TAIL, size - TAIL)
        if tail[-8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        self.bits, self.block = (int(x) for x in np.frombuffer(self.file.read_at(8, 8), "<u4"))
        self.n_ids, table, blocks = (int(x) for x in np.frombuffer(tail[:24], "<u8"))
        end = size - TAIL - 8 * (blocks + 1)
        self.offsets = np.frombuffer(self.file.read_at(8 * (blocks + 1), end), "<u8").astype(np.int64)
        self.docs = pa.ipc.open_file(pa.BufferReader(self.file.read_at(end - table, table))).read_all()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) of the file."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        data = self.file.read_at(int(self.offsets[b] - self.offsets[a]), int(self.offsets[a]))
        return unpack(data, self.bits, start - a * self.block, stop - a * self.block)

    def document(self, row: int) -> np.ndarray:
        first, n = (self.docs[c][row].as_py() for c in ("first", "n"))
        return self.ids(first, first + n)


# -- encoding -----------------------------------------------------------------------

#: A space before a character that is surely not white space.  A token of byte-level pre-tokenizers (words
#: with one space before them, runs of white space up to the last one) never goes on across its left side.
BREAK = re.compile(rb" (?=[!-~\xc3-\xe0\xe4-\xf4])")
UNSURE = re.compile(rb" (?![!-~\xc3-\xe0\xe4-\xf4])")


class Encoder:
    """Ids of whole texts by the library; what was encoded before is looked up.

    A text is cut where no token can cross, and each distinct unit encoded once.  Texts with a special
    string go to the library as they are, and so do all texts where the pre-tokenizer is another one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.cuts = (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True) \
            and not spec["normalizer"] and not spec["post_processor"] and not spec["truncation"] and not spec["padding"]
        self.heads: dict[bytes, bytes] = {}  # ids of texts' first units
        self.known: dict[bytes, bytes] = {}  # ids of units without the space before them
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.marks = {m: np.array(self.library.encode(m.decode(), add_special_tokens=False).ids, "<u4").tobytes() for m in (b".", b",")}
        words = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(words.values()) + 1, np.int64)  # bytes of each token, which has a letter per byte
        self.sizes[list(words.values())] = list(map(len, words))

    @property
    def vocabulary(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _spaced(self, units: list[bytes]) -> list[bytes]:
        """The ids of each unit with its space before it: encoded as one text and told apart by their bytes."""
        out = []
        for k in range(0, len(units), JOINED):
            some = units[k:k + JOINED]
            body = self._whole([b" " + b" ".join(some)])[0]
            ends = np.cumsum([1 + len(u) for u in some])
            last = (4 * np.searchsorted(np.cumsum(self.sizes[np.frombuffer(body, "<u4")]), ends) + 4).tolist()
            out += [body[a:b] for a, b in zip([0, *last], last)]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian 32-bit integers."""
        if not self.cuts:
            return self._whole(texts)
        if 2 * self.held > MEMORY:  # what is used again comes back from the older half, the rest goes
            self.older, self.known, self.held = self.known, {}, 0
            self.heads = {}
        out, plain = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = self._whole([text])[0]
            elif UNSURE.search(text):
                head, *units = BREAK.split(text)
                out[i] = b"".join([*self._heads([head]), *self._units(units)])
            else:
                plain.append(i)
        for i, ids in zip(plain, self._plain([texts[i] for i in plain]) if plain else ()):
            out[i] = ids
        return out

    def _heads(self, heads: list[bytes]) -> list[bytes]:
        new = list({u for u in heads if u not in self.heads})
        self._learn(self.heads, new, self._whole(new))
        return [self.heads[u] for u in heads]

    def _units(self, units: list[bytes]) -> list[bytes]:
        found = list(map(self.known.get, units))
        if None in found:
            new = {u for u, ids in zip(units, found) if ids is None}
            again = [u for u in new if u in self.older]
            self._learn(self.known, again, [self.older[u] for u in again])
            self._learn_spaced(new.difference(again))
            found = list(map(self.known.__getitem__, units))
        return found

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Texts whose every space begins a unit: split, numbered and put together as whole columns."""
        parts = pc.split_pattern(pa.array(texts, pa.large_binary()).cast(pa.large_string()), " ")
        bounds = parts.offsets.to_numpy()
        numbered = parts.values.dictionary_encode()
        unit = numbered.indices.to_numpy().copy()
        heads = self._heads([u.encode() for u in parts.values.take(pa.array(bounds[:-1])).to_pylist()])
        units = self._units(numbered.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, [*units, *heads]), np.int32, len(units) + len(heads)) // 4
        unit[bounds[:-1]] = np.arange(len(units), len(units) + len(heads))  # a text's first unit has no space before it
        n = sizes[unit]
        ends = np.cumsum(n, dtype=np.int32)  # a chunk's ids are fewer than its bytes
        place = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[unit] - (ends - n), n)
        place += np.arange(len(place), dtype=np.int32)
        body = np.frombuffer(b"".join([*units, *heads]), "<u4").take(place).tobytes()
        at = (4 * np.append(0, ends.astype(np.int64))[bounds]).tolist()
        return [body[a:b] for a, b in zip(at, at[1:])]

    def _learn_spaced(self, new: set[bytes]) -> None:
        """Units that end in a letter and a mark share their word's ids: no token holds both."""
        marked = {u: u[:-1] for u in new if u[-1:] in self.marks and u[-2:-1].isalpha()}
        plain = [u for u in new.difference(marked).union(marked.values()) if u not in self.known]
        self._learn(self.known, plain, self._spaced(plain))
        self._learn(self.known, list(marked), [self.known[word] + self.marks[u[-1:]] for u, word in marked.items()])

    def _learn(self, known: dict[bytes, bytes], units: list[bytes], found: list[bytes]) -> None:
        known.update(zip(units, found))
        self.held += sum(map(len, units)) + sum(map(len, found)) + 160 * len(units)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer, kept from task to task."""
    return Encoder(path)


#: Bytes of text that are encoded at once.
AT_ONCE = 8 << 20


def _runs(sizes: list[int], most: int):
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


# -- the whole ------------------------------------------------------------------------

def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
              file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents' ids under ``path`` in ascending order of ``doc_id``; returns the manifest."""
    spark = docs.sparkSession
    folder, bits = qualified(spark, path), bits_for(max(encoder(tokenizer).vocabulary, end_id + 1))
    manifest_type = pa.schema([("part", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                               ("n_ids", pa.int64()), ("bits", pa.int32())])

    def write(batches):
        from pyspark import TaskContext

        part, number, out, model = TaskContext.get().partitionId(), 0, None, encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        done = lambda: pa.RecordBatch.from_pylist([{"part": part, "file_no": number, **out.close()}], manifest_type)
        for batch in batches:
            doc_ids, column = batch.column("doc_id"), batch.column("text")
            for a, b in _runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), AT_ONCE):
                if out is None:
                    out = FileWriter(f"{folder}/ids/{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids", bits, doc_ids.type)
                bodies = model.encode([t or b"" for t in column.slice(a, b - a).to_pylist()])
                sizes = np.array([len(x) // 4 + 1 for x in bodies], np.int64)
                out.add(doc_ids.slice(a, b - a), sizes, np.frombuffer(end.join([*bodies, b""]), "<u4"))
                if out.n_ids >= file_ids:
                    yield done()
                    out, number = None, number + 1
        if out is not None:
            yield done()

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    files = stage(dealt.select("doc_id", "text").mapInArrow(write, MANIFEST), "id-files")
    # a number per task that wrote: no more than the scheduler itself keeps of a stage
    sums = sorted((r.part, r.n) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before = np.cumsum([0, *[n for _, n in sums]]).tolist()
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(sums, before)], "part int, base bigint")
    earlier = F.expr("sum(n_ids) OVER (PARTITION BY part ORDER BY file_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    manifest = files.withColumn("first_id", F.coalesce(earlier, F.lit(0))).join(bases, "part").select(
        "part", "file_no", "path", "n_docs", "n_ids", "bits", (F.col("first_id") + F.col("base")).alias("first_id"))
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    discard(files)
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{qualified(spark, path)}/manifest")


def _files(manifest: DataFrame) -> DataFrame:
    """A task for each file, up to a bound."""
    return manifest.select("path", "first_id").repartition(max(1, min(manifest.count(), 100_000)))


def _spans(docs: pa.Table, most: int):
    """(row range, first id, end id) of neighbouring documents with ``most`` ids or fewer, or of one document."""
    first, n = docs["first"].to_numpy(), docs["n"].to_numpy()
    for a, b in _runs(n.tolist(), most):
        yield a, b, int(first[a]), int(first[b - 1] + n[b - 1])


#: Ids that are unpacked at once.
UNPACKED = 4 << 20


def read_ids(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of every document, from the files."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = FileReader(row["path"])
                for a, b, lo, hi in _spans(file.docs, UNPACKED):
                    part = file.docs.slice(a, b - a).combine_chunks()
                    ends = np.append(part["first"].to_numpy() - lo, hi - lo).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(file.ids(lo, hi).view(np.int32)))
                    starts = pa.array(part["first"].to_numpy() + row["first_id"])
                    yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), starts, ids], ["doc_id", "start", "ids"])

    return _files(manifest).mapInArrow(run, f"doc_id {id_type}, start bigint, ids array<int>")


def digests(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` (of the ids as little-endian 32-bit integers), from the files."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = FileReader(row["path"])
                for a, b, lo, hi in _spans(file.docs, UNPACKED):
                    part = file.docs.slice(a, b - a)
                    first, n = part["first"].to_numpy(), part["n"].to_numpy()
                    body = memoryview(file.ids(lo, hi).astype("<u4").tobytes())
                    sums = [zlib.crc32(body[4 * s:4 * e]) for s, e in zip((first - lo).tolist(), (first - lo + n).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [part["doc_id"].combine_chunks(), pa.array(first + row["first_id"]), pa.array(n), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _files(manifest).mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def window(manifest: DataFrame, start: int, length: int) -> np.ndarray:
    """``length`` ids from place ``start`` of the whole on: reads only the blocks that hold them."""
    stop, out = start + length, []
    held = manifest.filter((F.col("first_id") < stop) & (F.col("first_id") + F.col("n_ids") > start))
    for row in held.orderBy("first_id").toLocalIterator():
        out.append(FileReader(row.path).ids(start - row.first_id, stop - row.first_id))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def packed_digests(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all ids to a fresh folder and read every document back."""
    path = shared_folder(docs.sparkSession, "packed-ids")
    return digests(write_ids(docs, tokenizer, path, end_id, doc_id, text), docs.schema[doc_id].dataType.simpleString())
