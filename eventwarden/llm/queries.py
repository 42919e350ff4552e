"""One registered query per text operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwarden.llm import (
    decontaminate, hard_negatives, language, lexical_search, licenses, packed_ids, pieces, pii, quality_classifier, quality_rules,
    simhash, substring, token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sentencepiece(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL, decoded=True)


@query
def op2_quality_rules(spark, sf_dir):
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "quality")


@query
def op3_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"))


@query
def op4_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op5_simhash(spark, sf_dir):
    return simhash.simhash(table(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


@query
def op7_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_substring_dedup(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op10_licenses(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op11_packed_ids(spark, sf_dir):
    return packed_ids.packed_digests(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, END_ID)


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


@query
def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Words of lower-cased texts, each ten-word window of an item (or a shorter item whole), and
# the document words inside any place where one of them occurs.
ORACLES["op8_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT r, spots.n, i, item_id FROM spots JOIN wins USING (n, s)),
marked AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, n, i FROM hits)) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

# Every window of 50 words, the smallest doc_id that holds it, and the words of each document
# that no window of a smaller doc_id covers.
ORACLES["op9_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
lows AS (SELECT s, min(doc_id) AS low FROM wins GROUP BY s),
gone AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(range(i, i + 50)) AS p FROM wins JOIN lows USING (s) WHERE low < doc_id)),
cut AS (SELECT r, list(p) AS ps, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w ELSE [w[k] FOR k IN range(1, len(w) + 1)
              IF NOT list_contains(ps, k)] END, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""


def _canonical_sql(text: str) -> str:
    """The canonical form of a licence text as a DuckDB expression."""
    body = rf"regexp_replace(lower({text}), '(?m)^\s*(copyright\b|\(c\)|©|all rights reserved)[^\n]*$', ' ', 'g')"
    body = f"' ' || regexp_replace({body}, '[^a-z0-9]+', ' ', 'g') || ' '"
    for word, same in licenses.SPELLINGS:
        body = f"replace({body}, ' {word} ', ' {same} ')"
    return f"trim({body}, ' ')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLES["op10_licenses"] = f"""
WITH listed(license, body) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in licenses.KNOWN)}),
known AS (SELECT sha256({_canonical_sql("body")}) AS digest, min(license) AS license FROM listed GROUP BY 1),
docs AS (SELECT doc_id, row_number() OVER () AS r, text, sha256({_canonical_sql("text")}) AS digest FROM documents),
lines AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs),
notes AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM lines JOIN known ON known.digest = sha256({_canonical_sql("line")}) GROUP BY r)
SELECT doc_id, docs.digest, license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM docs LEFT JOIN known USING (digest) LEFT JOIN notes USING (r)
"""

# Whole components, the five best of the same label, and the five best of other labels in each window.
ORACLES["op12_hard_negatives"] = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
best AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place
  FROM pairs WHERE same),
found AS (
  SELECT best.anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY best.anchor_id, positive_id ORDER BY score DESC, other) AS place
  FROM best JOIN pairs ON pairs.anchor_id = best.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
  WHERE best.place <= 5)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE place <= 5
"""

# Terms of all documents, their counts, and every document's score for each item.
ORACLES["op13_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
asked AS (
  SELECT i, item_id, t, count(*) AS times FROM (
    SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
sizes AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY r),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
held AS (SELECT r, t, count(*) AS tf FROM words SEMI JOIN asked USING (t) GROUP BY r, t),
rare AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY t, n_docs),
scores AS (
  SELECT i, item_id, r, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN rare USING (t) JOIN sizes USING (r), whole GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""
