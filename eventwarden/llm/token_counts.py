"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a linked list, and a heap holds its mergeable adjacent pairs by rank,
then place.  The lowest is popped and merged until none is left.  A word's tokens are its
symbols less its merges; no identifiers are made.

Defined cases: a null or empty text has no tokens; a null doc_id stays null; repeated rows are
counted each by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

LIMIT = 2048
#: Counts that a worker remembers before it starts anew.
REMEMBERED = 400_000
_WHITE = regex.compile(r"\s+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others get letters from U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Counter:
    """Counts tokens as the tokenizer of a vocabulary file does (BPE with word ends)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a vocabulary of the kind that is read here")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.end = model["end_of_word_suffix"]
        self.vocabulary = frozenset(model["vocab"])
        self.ranks = {tuple(p.split(" ") if isinstance(p, str) else p): i for i, p in enumerate(model["merges"])}
        self.letters = byte_letters()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words: dict[str, int] = {}
        self.runs: dict[str, int] = {}

    def merges(self, symbols: list[str]) -> int:
        """How many merges the symbols of one word take."""
        ranks, n = self.ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = left + right, ""
            after[i] = k = after[j]
            done += 1
            if k < n:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return done

    def word(self, word: str) -> int:
        """Tokens of one word of the pattern."""
        if (n := self.words.get(word)) is None:
            symbols = [self.letters[b] for b in word.encode()]
            symbols[-1] += self.end
            symbols = [s for s in symbols if s in self.vocabulary]
            n = len(symbols) - self.merges(symbols)
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = n
        return n

    def run(self, run: str) -> int:
        """Tokens of one run without white space: no word of the pattern crosses any."""
        n = sum(map(self.word, self.pattern.findall(run)))
        if len(self.runs) >= REMEMBERED:
            self.runs.clear()
        if len(run) <= 64:
            self.runs[run] = n
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma, letter by letter
        known = self.runs.get
        total = 0
        for run in _WHITE.sub(" ", text).lower().split(" "):
            if run:
                n = known(run)
                total += self.run(run) if n is None else n
        return total

    def text(self, text: str | None) -> int:
        """Tokens of a text; a special string in it is one token, as the library's default has it."""
        if not text:
            return 0
        if self.special is None or "<|" not in text:
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    """One counter per worker, so that what it remembers serves all its tasks."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: n_bytes, n_tokens and whether these are more than ``limit``."""

    @arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        counter = _counter(path)
        return pa.array([counter.text(t.as_py()) for t in texts], pa.int64())

    body = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
                       count(body).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
