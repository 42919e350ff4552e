"""A quality classifier from weak labels.

Overlapping heuristic labellers vote good or bad on each document or abstain.  Expectation-
maximisation over the counts of their vote patterns estimates each labeller's accuracy on good
and on bad documents; a pattern's posterior is the soft label of its documents.  A bounded
sample of documents with these labels trains a hashed linear scorer (logistic regression over
hashed byte three-grams and binned measures, by stochastic gradient descent in numpy), which
then scores every document by its whole text.

Defined cases: a null or empty text has no words; its score is that of the scorer's bias and the
measures of an empty text; a null doc_id stays null; repeated rows are scored each by itself; in
an empty table nothing is trained and nothing returned; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import chunks, stage, text_bytes

BUCKETS = 1 << 14
#: Documents that the scorer is trained on, the first by a hash of text and id.
SAMPLE = 4_000
ROUNDS = 40
EPOCHS = 8
RATE = 0.5
KEEP_FROM = 0.7
#: Start values: the share of good documents, and how often a labeller that votes is right on
#: bad and on good ones.  Most labellers look for one fault, and a bad document may have another.
START_GOOD, START_BAD, START_RIGHT = 0.85, 0.5, 0.97
#: Pseudo-votes by which each labeller is held to its start, as a share of the corpus.
ANCHOR = 0.02
_STEP = 2_000_000

# Frequent function words of English, German, French and Spanish.
_STOP = frozenset(b"the of and to in is that for it was with on be der die und den von zu das mit sich auf nicht ein le la les et "
                  b"des en du un que est pour dans de el los se las por con una para del".split())
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER = bytes(range(65, 91))
_SIGNS = b"#*$%&|<>"
MEASURES = ["words", "signs", "upper", "exclaimed", "repeated", "variety", "stop", "length", "marked"]


def measures(text: bytes) -> list[float]:
    """The measures that the labellers vote on."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    signs = size - len(text.translate(None, _SIGNS)) if text else 0
    upper = len(text) - len(text.translate(None, _UPPER))
    letters = len(text) - len(text.translate(None, _LETTERS))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    different = set(words)
    marked = sum(len(w) != len(w.translate(None, _SIGNS)) for w in words) if signs else 0
    variety = np.log(max(len(different), 1)) / np.log(n) if n > 1 else 1.0
    return [n, signs / max(n, 1), upper / max(letters, 1), text.count(b"!") / max(n, 1), repeats / max(n, 1), variety,
            len(different & _STOP), letters / max(n, 1), marked / max(n, 1)]


#: labeller -> vote of a row of measures: 0 bad, 1 abstains, 2 good.
LABELLERS = {
    "signs": lambda m: 0 if m[1] > 0.1 else 2 if m[1] == 0 and m[0] >= 20 else 1,
    "marked words": lambda m: 1 if m[0] < 20 else 0 if m[8] > 0.2 else 2 if m[8] < 0.02 else 1,
    "shouting": lambda m: 0 if m[2] > 0.3 else 2 if m[2] < 0.1 and m[0] >= 20 else 1,
    "exclaiming": lambda m: 0 if m[3] > 0.2 else 2 if m[3] < 0.02 and m[0] >= 20 else 1,
    "stutter": lambda m: 0 if m[4] > 0.1 else 2 if m[4] < 0.02 and m[0] >= 20 else 1,
    "variety": lambda m: 1 if m[0] < 20 else 0 if m[5] < 0.75 else 2 if m[5] > 0.85 else 1,
    "function words": lambda m: 0 if m[0] >= 50 and m[6] < 2 else 2 if m[6] >= 4 else 1,
    "word length": lambda m: 1 if m[0] < 20 else 2 if 3.5 <= m[7] <= 6.5 else 0 if not 2 <= m[7] <= 9 else 1,
}


def pattern(row: list[float]) -> int:
    """The votes as one number, base 3."""
    out = 0
    for vote in LABELLERS.values():
        out = out * 3 + vote(row)
    return out


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The posterior of good for each pattern, by expectation-maximisation over the counts.

    ``bad_vote`` is how often a labeller that votes says bad, on bad and on good documents; its
    accuracies are that and one less it.  An abstention says nothing of either class.
    """
    k = len(LABELLERS)
    votes = patterns[:, None] // 3 ** np.arange(k - 1, -1, -1) % 3
    bad, voted = votes == 0, votes != 1
    start = np.array([[START_BAD] * k, [1 - START_RIGHT] * k])
    bad_vote, good, held = start, START_GOOD, ANCHOR * counts.sum()
    for _ in range(rounds):
        each = np.where(bad, np.log(bad_vote)[:, None], np.log(1 - bad_vote)[:, None]) * voted
        log = each.sum(2) + np.log([[1 - good], [good]])
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        weight = np.stack([(1 - post) * counts, post * counts])
        good = float(np.clip(weight[1].sum() / counts.sum(), 0.5, 0.98))
        bad_vote = (weight @ bad + held * start) / (weight @ voted + held)
    return post


def _features(body: np.ndarray, offsets: np.ndarray, rows: list[list[float]], weights: np.ndarray) -> np.ndarray:
    """Scores: the mean weight of a text's byte three-grams plus the weights of its binned measures."""
    grams = np.zeros(len(offsets) - 1)
    for start, end in chunks(offsets, _STEP):
        for i in range(start, end):
            h = _grams(body[offsets[i]:offsets[i + 1]])
            grams[i] = weights[h].mean() if len(h) else 0.0
    return grams * GRAM_SCALE + np.array([weights[_bins(r)].sum() for r in rows])


#: What a mean of three-gram weights counts against one measure.
GRAM_SCALE = 10.0


def _grams(body: np.ndarray) -> np.ndarray:
    if len(body) < 3:
        return np.zeros(0, np.int64)
    code = body[:-2].astype(np.uint32) << np.uint32(16) | body[1:-1].astype(np.uint32) << np.uint32(8) | body[2:]
    return (code * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)


def _bins(row: list[float]) -> np.ndarray:
    """One bucket per measure, after those of the three-grams; the last one is the bias."""
    edges = [(10, 20, 60), (0.02, 0.1, 0.5), (0.1, 0.3, 0.6), (0.05, 0.2, 0.5), (0.02, 0.1, 0.3), (0.75, 0.8, 0.85), (1, 2, 4), (2, 3.5, 6.5), (0.02, 0.1, 0.2)]
    return np.array([BUCKETS + 4 * i + sum(x >= e for e in es) for i, (x, es) in enumerate(zip(row, edges))] + [BUCKETS + 4 * len(edges)])


def train(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """Weights by stochastic gradient descent on soft labels."""
    weights = np.zeros(BUCKETS + 4 * len(MEASURES) + 1)
    rng = np.random.default_rng(5)
    data = []
    for t in texts:
        at, n = np.unique(_grams(np.frombuffer(t, np.uint8)), return_counts=True)
        data.append((at, GRAM_SCALE * n / max(n.sum(), 1), _bins(measures(t))))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(data)):
            at, share, bins = data[i]
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ share + weights[bins].sum(), -50, 50))) - labels[i]
            weights[at] -= rate * error * share
            weights[bins] -= rate * error
    return weights


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: weak_label (posterior), score (of the scorer) and kept."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    @arrow_udf("int")
    def vote(texts: pa.Array) -> pa.Array:
        return pa.array([pattern(measures(t.as_py().encode())) for t in texts], pa.int32())

    table = stage(rows.select("doc_id", vote("text").alias("pattern"), F.xxhash64("text", "doc_id").alias("place")), "weak-labels")
    found = table.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()  # 3 ** labellers at most
    numbers = np.array([r.pattern for r in found], np.int64)
    posterior = dict(zip(numbers.tolist(), fit(numbers, np.array([r.n for r in found], float)).tolist())) if found else {}
    bar = table.select("place").orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]
    chosen = rows.withColumn("place", F.xxhash64("text", "doc_id")).filter(F.col("place") <= F.lit(bar)).dropDuplicates(["place"]) \
        .orderBy("place").limit(SAMPLE).collect() if bar is not None else []
    texts = [r.text.encode() for r in chosen]
    weights = train(texts, np.array([posterior[pattern(measures(t))] for t in texts]))
    shared = spark.sparkContext.broadcast((weights, posterior))  # hashed weights, whatever the corpus

    @arrow_udf("struct<weak_label:double,score:double>")
    def score(texts: pa.Array) -> pa.Array:
        weights, posterior = shared.value
        body, offsets = text_bytes(texts)
        own = [measures(body[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        x = _features(body, offsets, own, weights)
        return pa.StructArray.from_arrays([pa.array([posterior[pattern(m)] for m in own], pa.float64()),
                                           pa.array(1 / (1 + np.exp(-np.clip(x, -50, 50))), pa.float64())], ["weak_label", "score"])

    return rows.select("doc_id", score("text").alias("x")).select("doc_id", "x.*").withColumn("kept", F.col("score") >= KEEP_FROM)
