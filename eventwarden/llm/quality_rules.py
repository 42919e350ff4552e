"""Quality rules as weak supervision, with DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0).  The corpus is reduced to the counts of
its vote patterns (at most 3 ** rules rows, whatever the corpus), and expectation-maximisation
over those counts estimates how often each rule is right on good and on bad documents.
The posterior probability that a document is good is a function of its pattern.

Defined cases: a null or empty text has no words, fails the base rule and is never kept; a null
doc_id stays null; repeated rows are judged each by itself (they count each in the estimates);
an empty table gives an empty result; other columns are passed through or ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventwarden.llm.common import packed, stage, unpacked, words_of

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: A document is kept from this posterior probability of being good.
KEEP_FROM = 0.8
ROUNDS = 40
#: Start values: the share of good documents, and how often a rule that votes is right on bad and
#: on good ones.  Most rules look for one fault, and a bad document may have another.
START_GOOD, START_BAD, START_RIGHT = 0.85, 0.5, 0.97
#: Pseudo-votes by which each rule is held to its start, as a share of the corpus.
ANCHOR = 0.02

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "with", "on", "be",
              "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "nicht", "ein",
              "le", "la", "les", "et", "des", "en", "du", "un", "que", "est", "pour", "dans",
              "de", "el", "los", "se", "las", "por", "con", "una", "para", "del"]

#: rule -> (bad when, good when), over the measures below; neither: it abstains.
RULES: list[tuple[str, str, str]] = [
    ("symbols", "n_symbols > 0.1 * n_words", "n_symbols = 0 AND n_words >= 20"),
    ("capitals", "n_upper > 0.3 * word_chars", "n_upper < 0.1 * word_chars AND n_words >= 20"),
    ("repeats", "n_repeat_words > 0.2 * n_words", "n_repeat_words <= 0.05 * n_words AND n_words >= 20"),
    ("lines", "n_dup_lines > 0.4 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    ("variety", "n_words >= 20 AND ln(n_distinct) < 0.75 * ln(n_words)",
     "n_words >= 20 AND ln(n_distinct) > 0.85 * ln(n_words)"),
    ("stop words", "n_words >= 50 AND n_stop < 2", "n_stop >= 4"),
    ("word length", "word_chars < 2.5 * n_words OR word_chars > 7 * n_words",
     "word_chars BETWEEN 4 * n_words AND 6.5 * n_words"),
]


def repeated_words(words: str, hashes: str) -> str:
    """Words in windows that occur twice or more in the text, as SQL over two array columns.

    ``hashes`` has the windows' hashes.  Only where two are equal are the windows themselves
    sorted with their places: neighbours with equal words are repeats, and each place adds the
    words up to the next one or a whole window.
    """
    last = WINDOW - 1
    at = (f"transform({hashes}, (h, i) -> struct(concat_ws(' ', slice({words}, i + 1, {WINDOW})) AS w, i AS i))")
    # let-bindings: a one-element array bound by a lambda is computed once
    pairs = (f"transform(array(array_sort({at})), s -> array_sort(transform("
             f"filter(s, (x, k) -> (k > 0 AND s[greatest(k - 1, 0)].w = x.w) OR "
             f"(k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].w = x.w)), x -> x.i)))[0]")
    cover = (f"aggregate(transform(array({pairs}), p -> transform(p, (x, k) -> "
             f"IF(k = size(p) - 1, {WINDOW}, least({WINDOW}, p[least(k + 1, size(p) - 1)] - x))))[0], "
             f"0L, (a, x) -> a + x)")
    return (f"CASE WHEN size({words}) <= {last} OR size(array_distinct({hashes})) = size({hashes}) "
            f"THEN 0L ELSE {cover} END")


def measured(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The measures that the rules and the base rule use, beside the columns ``keep``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    body = F.coalesce(text, F.lit(""))
    split = df.select(
        *keep, words_of(text).alias("words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.translate(body, upper, ""))).cast("long").alias("n_upper"),
    )
    item = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    hashes = (f"CASE WHEN size(words) < {WINDOW} THEN CAST(array() AS array<bigint>) ELSE "
              f"transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({item})) END")
    hashed = split.withColumn("hashes", F.expr(hashes)).withColumn("vocabulary", F.array_distinct("words"))
    return hashed.select(
        *keep, F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"), "n_symbols", "n_upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated_words("words", "hashes")).cast("long").alias("n_repeat_words"),
        F.size("vocabulary").cast("long").alias("n_distinct"),
        F.size(F.array_intersect("vocabulary", F.array(*map(F.lit, STOP_WORDS)))).cast("long").alias("n_stop"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def voted(df: DataFrame) -> DataFrame:
    """Adds ``pattern``: the rules' votes as one number, base 3 with digits vote + 1."""
    votes = [F.expr(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END") for _, bad, good in RULES]
    return df.withColumn("pattern", reduce(lambda a, v: a * 3 + F.coalesce(v, F.lit(1)), votes, F.lit(0)).cast("int"))


def posteriors(patterns: DataFrame, rounds: int = ROUNDS, anchor: float = ANCHOR) -> DataFrame:
    """(pattern, quality) from (pattern, n): expectation-maximisation in one row.

    The parameters are how often each rule that votes says bad, on bad and on good documents; an
    abstention says nothing of either class, and the votes of a class are taken as independent.
    All rounds are one higher-order fold over the pattern counts; its state is the posterior of
    every pattern, and a round derives the parameters from it and then the posteriors from those.
    """
    k = len(RULES)
    digits = ", ".join(f"CAST(floor(pattern / {3 ** (k - 1 - i)}) AS INT) % 3" for i in range(k))
    one = patterns.withColumn("v", F.expr(f"array({digits})")).agg(
        F.array_sort(F.collect_list(F.struct("pattern", "v", F.col("n").cast("double").alias("n")))).alias("ps")).filter("size(ps) > 0")
    begin = "array(" + ", ".join(f"{START_BAD}D" if x < k else f"{1 - START_RIGHT}D" for x in range(2 * k)) + ")"

    def good(bad_vote: str, prior: str) -> str:
        """Posterior of good for pattern p."""
        like = lambda c: (f"aggregate(sequence(0, {k - 1}), 0D, (a, i) -> a + CASE p.v[i] WHEN 0 THEN ln({bad_vote}[{c * k} + i]) "  # noqa: E731
                          f"WHEN 2 THEN ln(1D - {bad_vote}[{c * k} + i]) ELSE 0D END)")
        return f"1D / (1D + exp(({like(0)} + ln(1D - {prior})) - ({like(1)} + ln({prior}))))"

    total = "aggregate(ps, 0D, (a, p) -> a + p.n)"
    mass = "aggregate(ps, struct(0D AS t, 0 AS j), (a, p) -> struct(a.t + p.n * r[a.j] AS t, a.j + 1 AS j)).t"
    weighted = (f"aggregate(ps, struct(0D AS t, 0 AS j), (a, p) -> struct(a.t + IF(p.v[x % {k}] {{}}, "
                f"p.n * IF(x < {k}, 1D - r[a.j], r[a.j]), 0D) AS t, a.j + 1 AS j)).t")
    held = f"{anchor}D * total"
    step = (f"transform(array({mass}), g -> transform(array(transform(sequence(0, {2 * k - 1}), x -> "
            f"({weighted.format('= 0')} + {held} * begin[x]) / ({weighted.format('<> 1')} + {held}))), bad_vote -> "
            f"transform(ps, p -> {good('bad_vote', 'least(greatest(g / total, 0.5D), 0.98D)')}))[0])[0]")
    fitted = one.withColumn("begin", F.expr(begin)).withColumn("total", F.expr(total)) \
        .withColumn("r0", F.expr(f"transform(ps, p -> {good('begin', f'{START_GOOD}D')})")) \
        .withColumn("r", F.expr(f"aggregate(sequence(1, {rounds}), r0, (r, t) -> {step})"))
    return fitted.select(F.explode(F.arrays_zip(F.col("ps.pattern").alias("pattern"), F.col("r").alias("quality"))).alias("x")) \
        .select("x.pattern", "x.quality")


def judged(df: DataFrame) -> DataFrame:
    """Adds ``quality`` and ``kept`` to staged measures with ``pattern``.

    The pattern table has at most 3 ** rules rows, so it is broadcast whatever the corpus, and
    the documents, of which most share one pattern, are not shuffled.
    """
    counts = df.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    model = F.broadcast(posteriors(counts))
    return df.join(model, "pattern", "left").withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its measures, ``base_failed``, ``quality`` and ``kept``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    table = stage(voted(measured(rows, F.col("body"), ["doc_id"])), "quality")
    return judged(table)


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with the columns they came with.

    The documents are written once beside their measures, so the second reading does not
    measure again and needs no key to find a document's verdict.
    """
    rows = packed(docs)
    table = stage(voted(measured(rows, F.col("doc").getField(text), ["doc"])), "quality-docs")
    return unpacked(judged(table).filter("kept"), docs)
