"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are runs of three and four bytes of the lower-cased text with everything but letters
as one space, hashed into buckets.  A text is the mean of its subwords' embeddings; a linear
layer and a softmax give its language.  Embeddings and layer are trained together by stochastic
gradient descent in numpy, on a bounded sample: SAMPLE labelled documents per language.  A
fifth of the sample is held back to fit the temperature of the scores and the score from which
an answer is accepted; below it an answer is marked as rejected.

Since mean and layer are linear, a trained model is one row of logits per bucket, and scoring a
text is the mean of its buckets' rows.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without labelled
rows every text is; a null doc_id stays null and teaches nothing; repeated rows are scored each
by itself; a label that is null teaches nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import chunks, strings, text_bytes

BUCKETS = 1 << 14
DIMENSIONS = 16
#: Labelled documents per language that the model is fitted on, with their whole texts.
SAMPLE = 300
EPOCHS = 12
RATE = 0.5
#: Share of right answers among the accepted ones that the held-back fifth must show.
ACCEPTED_RIGHT = 0.99
UNKNOWN = "und"
_STEP = 2_000_000
_HELD_OUT = 2
# A byte of a letter: a-z, or part of a character beyond ASCII.
_FOLD = np.array([c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_HAS_LETTER = r"\p{L}"


def buckets_of(body: np.ndarray, size: int) -> np.ndarray:
    """The bucket of the ``size`` bytes from each place on; there are size - 1 fewer than bytes."""
    n = len(body) - size + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    code = np.zeros(n, np.uint32)
    for i in range(size):
        code = (code << np.uint32(8)) | body[i:i + n]
    return ((code * np.uint32(2654435761 + 2 * size)) >> np.uint32(18)).astype(np.int32)


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all rows, with a space between two, and each row's range in them."""
    lower = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pc.utf8_lower(strings(texts)),
                                        pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    body, offsets = text_bytes(lower)
    return _FOLD[body], offsets


def bucket_sums(body: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sum of ``table`` (columns by bucket) over its subwords, and their number."""
    rows, columns = len(offsets) - 1, len(table)
    sums, counts = np.zeros((rows, columns)), np.zeros(rows)
    for start, end in chunks(offsets, _STEP):
        part, at = body[offsets[start]:offsets[end]], offsets[start:end] - offsets[start]
        for size in (3, 4):
            h = buckets_of(part, size)
            if not len(h):
                continue
            # a few subwords cross into the next row's first letters; they are taken off again
            crossing = np.zeros(len(part), bool)
            for back in range(1, size):
                crossing[np.maximum(np.append(at[1:], len(part)) - back, 0)] = True
            use = ~crossing[:len(h)]
            cuts = np.minimum(at, len(h) - 1)
            empty = np.append(at[1:], len(part)) - at < size
            for c in range(columns):
                value = np.add.reduceat(np.where(use, table[c][h], 0), cuts)
                value[empty] = 0
                sums[start:end, c] += value
            number = np.add.reduceat(use.astype(np.int64), cuts)
            number[empty] = 0
            counts[start:end] += number
    return sums, counts


@dataclass
class Model:
    """What a trained model keeps: languages, logits by language and bucket, temperature, bar."""

    languages: list[str]
    table: np.ndarray
    temperature: float
    accept_from: float

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The best language's place and probability for each row."""
        sums, counts = bucket_sums(*folded(texts), self.table)
        logits = sums / np.maximum(counts, 1)[:, None] / self.temperature
        p = _softmax(logits)
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def crc_part(doc_id: Column, parts: int = 4) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def _sample(docs: DataFrame) -> DataFrame:
    """Sampled rows as sparse subword shares: (doc_id, lang, buckets, shares).

    The first SAMPLE of each language by a hash of the id; the limit is applied in each task
    before the shuffle, so a language with a third of all rows sends no more than others do.
    """
    thin = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(crc_part(F.col("doc_id")) != _HELD_OUT)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = thin.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE)

    @arrow_udf("struct<buckets:array<int>,shares:array<float>>")
    def shares(texts: pa.Array) -> pa.Array:
        out = []
        body, offsets = folded(texts)
        for a, b in zip(offsets, offsets[1:]):
            h = np.concatenate([buckets_of(body[a:b], 3), buckets_of(body[a:b], 4)])
            number, n = np.unique(h, return_counts=True)
            out.append({"buckets": number.tolist(), "shares": (n / max(len(h), 1)).tolist()})
        return pa.array(out, pa.struct([("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))]))

    picked = thin.join(chosen.select("doc_id", "lang").distinct(), ["doc_id", "lang"], "left_semi").dropDuplicates(["doc_id", "lang"])
    return picked.select("doc_id", "lang", shares("text").alias("x")).select("doc_id", "lang", "x.*")


def train(docs: DataFrame) -> Model | None:
    """Fit a model on the sample of ``docs`` (doc_id, text, lang); None without labelled rows."""
    rows = sorted(_sample(docs).collect(), key=lambda r: (r.doc_id, r.lang))
    rows = [r for r in rows if len(r.buckets)]
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    x = [(np.array(r.buckets), np.array(r.shares, np.float64)) for r in rows]
    y = np.array([languages.index(r.lang) for r in rows])
    rng = np.random.default_rng(7)
    held = rng.random(len(rows)) < 0.2
    if held.all() or len(set(y[~held])) < len(languages):
        held[:] = False
    embed = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, len(languages)))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(np.flatnonzero(~held)):
            at, share = x[i]
            mean = share @ embed[at]
            error = _softmax(mean @ layer)
            error[y[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            # by the square root: else a text's many buckets would each learn next to nothing
            embed[at] -= rate * np.sqrt(share)[:, None] * back
    table = (embed @ layer).T.copy()
    check = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    logits = np.array([table[:, x[i][0]] @ x[i][1] for i in check])
    temperature = _temperature(logits, y[check])
    p = _softmax(logits / temperature)
    return Model(languages, table, temperature, _bar(p.max(1), p.argmax(1) == y[check]))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the lowest log-loss, out of a geometric grid."""
    grid = np.geomspace(0.02, 5, 60)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-9)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _bar(score: np.ndarray, right: np.ndarray) -> float:
    """The lowest score from which on ACCEPTED_RIGHT of the answers are right."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= ACCEPTED_RIGHT)
    return float(score[order[good[-1]]]) if len(good) else 1.0


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: held_out, lang_pred, score, rejected."""
    model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages, whatever the corpus

    @arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        lettered = pc.match_substring_regex(strings(texts), _HAS_LETTER).to_numpy(zero_copy_only=False)
        if model is None or not len(lettered):
            best, score, names = np.zeros(len(lettered), int), np.zeros(len(lettered)), [UNKNOWN]
        else:
            best, score = model.scores(texts)
            names = model.languages
        score = np.where(lettered, score, 0.0)
        pred = [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        bar = model.accept_from if model else 1.0
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(score < bar)],
                                          ["lang_pred", "score", "rejected"])

    return docs.select("doc_id", F.coalesce(crc_part(F.col("doc_id")) == _HELD_OUT, F.lit(False)).alias("held_out"),
                       predict("text").alias("x")).select("doc_id", "held_out", "x.*")
