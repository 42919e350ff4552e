"""Information-theoretic sanitisation of personal data.

Mail addresses, IP addresses, card and phone numbers are the protected entities.  A term in a
document with an entity reveals it as far as it makes the entity likely: with document counts
over the whole corpus, its disclosure is the pointwise mutual information of entity and term as
a share of the entity's own information, PMI(e, t) / -log p(e).  In it p(e | t) is the lower end
of its Wilson interval, so a pair of any support counts by what it is evidence for: a term that
never occurs without the entity comes near 1 as its documents become many, and one seen in a
single document counts as far as the corpus is large.  From GENERALISE_FROM a term is replaced by
a placeholder, from REMOVE_FROM it is taken out, wherever it stands in the documents that hold
the entity.

Entities held by the same documents have the same counts with every term, so they are counted
as one set.

Defined cases: a null text is an empty one (a sanitised null stays null); a null doc_id stays
null; repeated rows are documents of their own; ties in place go by kind; an empty table gives
an empty result; other columns are passed through or ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from eventwarden.llm.common import packed, stage, unpacked

KINDS = ["email", "ip", "card", "phone", "term"]
TERM = KINDS.index("term")
#: Width of the interval for p(e | t), in standard deviations.
WILSON_Z = 1.96
GENERALISE_FROM = 0.75
REMOVE_FROM = 0.95
#: Candidate terms that are sent to all tasks; more are counted by a shuffle of all terms.
SENT_TERMS = 200_000
PLACEHOLDERS = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]"]

# Possessive runs and the look-behind keep each search linear; what matches is the same.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]{3,}")
_SPAN = "struct<start:int,`end`:int,kind:int>"
_SCAN = f"struct<base:array<{_SPAN}>,terms:array<struct<t:string,places:array<struct<start:int,`end`:int>>>>,entities:array<bigint>>"


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the four kinds, by start, then kind."""
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2]))


def _entity(text: str, span: tuple[int, int, int]) -> int:
    """A number for an entity: its kind and value, without case or separators."""
    value = text[span[0]:span[1]]
    value = _NOT_DIGIT.sub("", value) if span[2] > 1 else value.lower()
    x = xxhash.xxh64_intdigest(f"{KINDS[span[2]]}:{value}".encode())
    return x - (1 << 64) if x >> 63 else x


def _terms(text: str, base: list[tuple[int, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Each term of the text, with its places outside of all entities."""
    out, at, reach = defaultdict(list), 0, 0
    for m in _WORD.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][1]), at + 1
        places = out[m[0].lower()]
        if reach <= m.start():
            places.append(m.span())
    return out


def _lists(ends: array, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _scan(text: Column) -> Column:
    @arrow_udf(_SCAN)
    def run(texts: pa.Array) -> pa.Array:
        base, entities, words = [], [], []
        term_ends, place_ends, starts, ends = array("i", [0]), array("i", [0]), array("i"), array("i")
        for t in texts:
            text = t.as_py() or ""
            found = base_spans(text)
            base.append([{"start": s, "end": e, "kind": k} for s, e, k in found])
            entities.append(sorted({_entity(text, s) for s in found}))
            for word, places in (_terms(text, found) if found else {}).items():
                words.append(word)
                for s, e in places:
                    starts.append(s)
                    ends.append(e)
                place_ends.append(len(starts))
            term_ends.append(len(words))
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
        places = _lists(place_ends, pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"]))
        terms = _lists(term_ends, pa.StructArray.from_arrays([pa.array(words, pa.string()), places], ["t", "places"]))
        return pa.StructArray.from_arrays([pa.array(base, pa.list_(span)), terms, pa.array(entities, pa.list_(pa.int64()))], ["base", "terms", "entities"])

    return run(text)


def _term_counts(rows: DataFrame, text: Column, wanted: DataFrame) -> DataFrame:
    """(t, n_t): the number of documents that hold each of the wanted terms.

    Up to SENT_TERMS terms go to all tasks; beyond that the terms of all documents are
    counted, with one row per term and batch at most before the shuffle.
    """
    few = wanted.limit(SENT_TERMS + 1).collect()
    if not few:
        return wanted.select("t", F.lit(0).cast("long").alias("n_t"))
    only = rows.sparkSession.sparkContext.broadcast(frozenset(r.t for r in few) if len(few) <= SENT_TERMS else None)

    def count(batches):
        for batch in batches:
            seen = Counter()
            for t in batch.column(0):
                found = {w.lower() for w in set(_WORD.findall(t.as_py() or ""))}
                seen.update(only.value & found if only.value is not None else found)
            yield pa.RecordBatch.from_pydict({"t": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    return rows.select(text).mapInArrow(count, "t string, n long").groupBy("t").agg(F.sum("n").alias("n_t"))


def _held(scanned: DataFrame) -> DataFrame:
    """(row, words, sets): rows with an entity, their terms, and the sets of entities they hold.

    A set is all entities of the same documents: ``a`` and ``b`` are 128 bits of these, ``n_e`` their number.
    """
    held = scanned.filter(F.size("scan.entities") > 0)
    each = held.select("row", F.explode("scan.entities").alias("e"))
    alike = each.groupBy("e").agg(F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"),
                                  F.count(F.lit(1)).alias("n_e"))
    sets = each.join(alike, "e").groupBy("row").agg(F.collect_set(F.struct("a", "b", "n_e")).alias("sets"))
    return held.select("row", F.col("scan.terms.t").alias("words")).join(sets, "row")


def _pairs(held: DataFrame) -> DataFrame:
    """(row, a, b, n_e, i, t): each term of a row, numbered, with each of the row's sets."""
    return held.select("row", "words", F.explode("sets").alias("x")).select("row", "x.*", F.posexplode("words").alias("i", "t"))


def _disclosure(n: int, n_e: Column, n_t: Column, n_et: Column) -> Column:
    """The lower bound of PMI(e, t) as a share of -log p(e); null if all documents hold the entity."""
    p, z = n_et / n_t, WILSON_Z ** 2 / n_t
    low = (p + z / 2 - F.sqrt(z * (p * (1 - p) + z / 4))) / (1 + z)
    return F.when(n_e < n, 1 + F.log(low) / F.log(n / n_e))


def disclosing(held: DataFrame, total: int, rows: DataFrame, text: Column) -> DataFrame:
    """(a, b, t, disclosure) of the pairs of set and term that reach GENERALISE_FROM.

    ``held``: the staged rows with an entity, of ``total``; ``rows`` and ``text``: all documents.
    Pairs that would not reach it if no other document held the term go without a count of these.
    """
    share = lambda n_t: _disclosure(total, F.col("n_e"), F.col(n_t), F.col("n_et"))
    pairs = _pairs(held).groupBy("a", "b", "n_e", "t").agg(F.count(F.lit(1)).alias("n_et")).filter(share("n_et") >= GENERALISE_FROM)
    pairs = stage(pairs, "pii-pairs")
    terms = _term_counts(rows, text, pairs.select("t").distinct())
    return pairs.join(terms, "t").select("a", "b", "t", share("n_t").alias("disclosure")).filter(F.col("disclosure") >= GENERALISE_FROM)


def found_terms(scanned: DataFrame, rows: DataFrame, text: Column) -> DataFrame:
    """(row, found): the numbers of a row's disclosing terms, with their disclosure, of the rows that have any."""
    held = stage(_held(scanned), "pii-held")
    hits = _pairs(held).join(disclosing(held, scanned.count(), rows, text), ["a", "b", "t"])
    return hits.groupBy("row", "i").agg(F.max("disclosure").alias("disclosure")) \
        .groupBy("row").agg(F.collect_list(F.struct("i", "disclosure")).alias("found"))


def _term_spans() -> Column:
    """A span for every place of a row's disclosing terms."""
    found = F.coalesce("found", F.array().cast("array<struct<i:int,disclosure:double>>"))
    return F.flatten(F.transform(found, lambda x: F.transform(F.col("scan.terms")[x["i"]]["places"], lambda p: F.struct(
        p["start"].alias("start"), F.lit(TERM).alias("kind"), p["end"].alias("end"), x["disclosure"].alias("disclosure")))))


def _all_spans() -> Column:
    """Base and term spans by start, then kind."""
    whole = F.transform("scan.base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(1.0).alias("disclosure")))
    return F.array_sort(F.concat(whole, _term_spans()))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the four kinds, digest of their spans, all spans."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    scanned = stage(rows.select("doc_id", _scan(F.col("body")).alias("scan"), F.monotonically_increasing_id().alias("row")), "pii")
    out = scanned.join(found_terms(scanned, rows, F.col("body")), "row", "left").withColumn("spans", _all_spans())
    count = lambda k: F.size(F.filter("scan.base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return out.select("doc_id", *map(count, range(TERM)), F.sha2(_written(F.col("scan.base")), 256).alias("base_sha256"),
                      _written(F.col("spans")).alias("spans"), F.size(_term_spans()).cast("long").alias("n_term"))


def _masked(text: Column) -> Column:
    @arrow_udf("string")
    def run(texts: pa.Array, base: pa.Array, places: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, whole, places, terms in zip(texts, base, places, found):
            t = t.as_py()
            if t is None or not len(whole):
                out.append(t)
                continue
            spans = [(x["start"], x["kind"], x["end"], 1.0) for x in whole.as_py()]
            for x in terms.as_py() or []:
                spans += [(p["start"], TERM, p["end"], x["disclosure"]) for p in places[x["i"]].as_py()]
            parts, at = [], 0
            for start, kind, end, disclosure in sorted(spans):
                if start >= at:  # of spans that overlap, the first names the whole
                    parts += [t[at:start], "" if kind == TERM and disclosure >= REMOVE_FROM else PLACEHOLDERS[kind]]
                at = max(at, end)
            out.append("".join(parts) + t[at:])
        return pa.array(out, pa.string())

    return run(text, F.col("scan.base"), F.col("scan.terms.places"), F.col("found"))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with entities masked and disclosing terms generalised or taken out.

    Only rows with an entity are joined with what was found; the others pass as they are.
    """
    rows = packed(docs)
    body = F.col("doc").getField(text)
    scanned = stage(rows.select("doc", _scan(body).alias("scan"), F.monotonically_increasing_id().alias("row")), "pii-docs")
    held = scanned.filter(F.size("scan.base") > 0)
    thin = scanned.select("row", "scan", body.alias("body"))
    joined = held.join(found_terms(thin, thin.select("body"), F.col("body")), "row", "left")
    clean = joined.select(F.col("doc").withField(text, _masked(body)).alias("doc"))
    return unpacked(scanned.filter(F.size("scan.base") == 0).select("doc").unionAll(clean), docs)
