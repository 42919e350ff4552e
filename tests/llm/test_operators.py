"""The text operators against brute-force versions, the libraries, and held-out labels."""

import hashlib
import json
import math
import random
import re
import textwrap
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
import corpus_pipeline
from eventwarden.llm import (
    components, decontaminate, fm_index, language, licenses, pieces, pii, quality_classifier, quality_rules, queries, simhash,
    substring, token_counts,
)

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, found string, row int"


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def odd_rows():
    """Nulls, empty and very long texts, repeats, ties, marks and names that operators use themselves."""
    rng = random.Random(3)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(300)) for _ in range(6000))
    passage = " ".join(f"w{i}" for i in range(70))
    texts = [None, "", " \n\t ", "a", "Of " * 400, "x" * 3000, long, long + " tail", passage, "head " + passage + " tail", passage,
             "Ünïcode ▁ mark ①²… ｆｕｌｌ\r\nline\n\nline\n line", "MAIL a.b+c%d@e-f.g.h. 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111 +1 (234) 567-8901",
             "Don't <|endoftext|> stop 'S'll 12½ İΣ é\u0085x", "MIT License\n" + licenses.KNOWN[2][1], "Released under the MIT Licence."]
    rows = [(900 + i, t) for i, t in enumerate(texts)] + [(None, "no id " + passage), (None, None), (901, ""), (908, passage), (908, passage)]
    return [(i, t, "en" if k % 3 else None, None, 5, "clash", "clash", k) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], None, None, 1) for r in table("documents")] + odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# -- 1: pieces --------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return pieces.Model(MODEL)


def best_path(model, unit):
    best = [(0.0, 0, [])]
    for stop in range(1, len(unit) + 1):
        paths = []
        for start in range(max(0, stop - model.longest), stop):
            p = unit[start:stop]
            if p in model.pieces:
                step = model.scores[model.pieces[p]], [model.pieces[p]]
            elif len(p) == 1:
                step = model.unknown(), [model.bytes[b] for b in p.encode()]
            else:
                continue
            paths.append((best[start][0] + step[0], -start, best[start][2] + step[1]))
        best.append(max(paths, key=lambda x: x[:2]))
    return best[-1][2]


def test_encoding_is_the_best_path_and_decodes(spark, docs, rows, model):
    split, solved = re.compile(model.pattern), {}

    def ids(text):
        out = []
        for u in pieces.split_units(split, text):
            if u not in solved:
                solved[u] = best_path(model, u.replace(" ", pieces.SPACE))
            out += solved[u]
        return out

    encoded = pieces.encode(docs, MODEL, block_bytes=100_000)
    want = Counter((r[0], len(x := ids(r[1])), tuple(x)) for r in rows)
    assert Counter((r.doc_id, r.n_pieces, tuple(r.ids)) for r in encoded.collect()) == want
    back = pieces.decode(encoded, MODEL)
    plain = Counter((r[0], (r[1] or "").replace(pieces.SPACE, " ")) for r in rows)
    assert got(back, "doc_id", "text") == plain


def test_query_decodes_every_document(spark, docs, rows):
    plain = Counter((r[0], hashlib.sha256((r[1] or "").replace(pieces.SPACE, " ").encode()).hexdigest()) for r in rows)
    assert got(pieces.encode(docs, MODEL, block_bytes=100_000, decoded=True), "doc_id", "decoded_sha256") == plain
    out = {r.doc_id: r.decoded_sha256 for r in queries.QUERIES["op1_sentencepiece"](spark, SF).collect()}
    assert out == {r["doc_id"]: hashlib.sha256(r["text"].replace(pieces.SPACE, " ").encode()).hexdigest() for r in table("documents")}


@pytest.mark.parametrize("at_a_time", [1, 500_000])
def test_decoding_of_any_ids(spark, model, at_a_time, monkeypatch):
    rng, known = random.Random(8), sorted(model.encoded)
    lists = [None, [], [model.bytes[0xE2]], [model.bytes[b] for b in "é▁".encode()], [model.pieces["▁"]] * 3, [model.bytes[10], model.pieces["▁"]]]
    lists += [rng.choices(known, k=rng.randrange(40)) for _ in range(300)]
    want = [None if x is None else model.decode(x) for x in lists]
    monkeypatch.setattr(pieces, "DECODED_IDS", at_a_time)
    found = pieces._decoded(pa.array(lists, pa.list_(pa.int32())), *pieces._piece_bytes(model))
    assert [t for texts in found for t in texts.to_pylist()] == [x or "" for x in want]
    some = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, ids array<int>")
    assert {r.k: r.text for r in pieces.decode(some, MODEL).collect()} == dict(enumerate(want))


def test_paths_are_those_of_the_library_with_the_same_scores(model):
    """The model file with its scores as log-probabilities, read by the library as a unigram model."""
    sentencepiece = pytest.importorskip("sentencepiece")
    try:
        from sentencepiece import sentencepiece_model_pb2 as proto
    except ImportError:
        pytest.skip("no protocol buffers for model files here")
    m = proto.ModelProto.FromString(open(MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    for i, p in enumerate(m.pieces):
        if i in model.scores:
            p.score = model.scores[i]
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    words = {w for r in table("documents") for w in r["text"].split()}
    same = sum(lib.encode(w) == best_path(model, pieces.SPACE + w) for w in sorted(words)[:3000])
    assert same >= 0.99 * min(len(words), 3000)  # single precision there


def test_no_piece_crosses_units(model):
    split = re.compile(model.pattern)
    assert all(split.fullmatch(p.replace(pieces.SPACE, " ")) for p in model.pieces)


def test_tokens_of_a_block_are_numbered_once(model):
    """Letters between spaces are units as the pattern cuts them, in every mixture of texts; equal hashes are put in the order of the bytes."""
    rng, split = random.Random(5), re.compile(model.pattern)
    words = ["plain", "Word", "naïve", "don't", "a1", "2024", "x,", "...", "é", "²", "_", "日本", "\n", "two\nlines", "x" * 1024, "y" * 1025, "plumless", "buckeroo"]
    texts = [None, "", " ", "a", " a", "a  b", "plain ▁ x"] + [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(200)]
    block = pieces._Block(model.pattern, texts)
    units, ends = block.units.to_pylist(), np.cumsum([0, *block.counts])
    assert len(set(units)) == len(units)
    for text, part in zip(texts, block.parts):
        assert [units[u] for t in part for u in block.flat[ends[t]:ends[t + 1]]] == pieces.split_units(split, text)
    one, other = (pa.array(x, pa.large_string()) for x in (["buckeroo", "plain", "plumless", "a"], ["a", "plumless", "buckeroo", "plain"]))
    for buckets in (1, 3):  # the first two have one CRC-32
        (used, order, at), (used_2, order_2, at_2) = pieces.in_buckets(one, buckets), pieces.in_buckets(other, buckets)
        assert used.tolist() == used_2.tolist() and at.tolist() == at_2.tolist() and one.take(pa.array(order)) == other.take(pa.array(order_2))
    assert [len(x) for x in pieces.in_buckets(one[:0], 3)] == [0, 0, 1]


def test_units_go_through_the_lattice_without_their_blocks(spark, model):
    """Every edge used to carry its unit and all the unit's blocks through the join and the grouping."""
    units = spark.createDataFrame([(0, " running", list(range(500))), (0, "\n", [3]), (1, " a日" + "x" * 40, [1, 2])], "bucket int, unit string, places array<long>")
    found = pieces.solve(units, model)
    got_ids = {r.unit: (r.bucket, r.places, r.ids) for r in found.collect()}
    assert got_ids == {r.unit: (r.bucket, r.places, best_path(model, r.unit.replace(" ", pieces.SPACE))) for r in units.collect()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouping = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert grouping.split("Aggregate")[1].startswith(" [number") and "places" not in grouping.split("]")[0]


# -- 2 and 3: quality -------------------------------------------------------------

def base(text):
    w = WORDS.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORDS.search(x):
            dup += x in seen
            seen.add(x)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_rules(docs, rows):
    out = quality_rules.quality_rules(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert got(out, *names) == Counter((r[0], *base(r[1])) for r in rows)
    assert not out.filter("base_failed AND kept").count()


def test_rule_posteriors_are_those_of_plain_loops(spark):
    rng = random.Random(1)
    k = len(quality_rules.RULES)
    counts = {tuple(rng.randrange(3) for _ in range(k)): rng.randrange(1, 50) for _ in range(40)}
    number = lambda v: sum(x * 3 ** (k - 1 - i) for i, x in enumerate(v))
    df = spark.createDataFrame([(number(v), n) for v, n in counts.items()], "pattern int, n long")
    found = {r.pattern: r.quality for r in quality_rules.posteriors(df, rounds=7).collect()}
    begin = [[quality_rules.START_BAD] * k, [1 - quality_rules.START_RIGHT] * k]
    bad_vote, prior, total = begin, quality_rules.START_GOOD, sum(counts.values())
    held = quality_rules.ANCHOR * total
    for step in range(8):
        post = {}
        for v in counts:
            b, g = (np.prod([bad_vote[c][i] if x == 0 else 1 - bad_vote[c][i] for i, x in enumerate(v) if x != 1]) for c in (0, 1))
            post[v] = prior * g / (prior * g + (1 - prior) * b)
        weight = [lambda v: counts[v] * (1 - post[v]), lambda v: counts[v] * post[v]]
        bad_vote = [[(sum(weight[c](v) for v in counts if v[i] == 0) + held * begin[c][i]) / (sum(weight[c](v) for v in counts if v[i] != 1) + held)
                     for i in range(k)] for c in (0, 1)]
        prior = min(max(sum(map(weight[1], counts)) / total, 0.5), 0.98)
    assert found == pytest.approx({number(v): p for v, p in post.items()})


@pytest.mark.parametrize("run", [quality_rules.quality_rules, quality_classifier.classify])
def test_quality_on_labels(spark, run):
    labels = {r["doc_id"]: r["quality"] for r in table("labels", "/root/testdata/sf0.01")}
    out = run(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    verdict = {r.doc_id: r for r in out.collect() if r.doc_id in labels}
    long_enough = lambda r: "base_failed" not in r or not r.base_failed
    good = [r.kept for i, r in verdict.items() if labels[i] == 1 and long_enough(r)]
    bad = [r.kept for i, r in verdict.items() if labels[i] == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.2 * len(bad)


# -- 4: personal data -------------------------------------------------------------

def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def plain_spans(text):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for kind, pattern, ok in [
        (0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (2, r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]:
        out += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if ok(m[0])]
    return sorted(out, key=lambda x: (x[0], x[2]))


def random_personal_text(rng):
    parts = ["a@b.c", "@", "x.y@z", "1.2.3.4", "999.1.1.1", ".", "4111111111111111", "4111 1111-1111 1111", "+1 234 567 890", "+", "(", ")", " ", "-",
             "12", "foo", "%", "a@b.c%d@e.f", "0001.02.3.255", "\n", "é"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(2)
    for text in [random_personal_text(rng) for _ in range(4000)] + [r["text"] for r in table("documents")]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data(docs, rows):
    want = Counter()
    for r in rows:
        s = plain_spans(r[1] or "")
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in s)
        want[(r[0], *[sum(x[2] == k for x in s) for k in range(4)], hashlib.sha256(written.encode()).hexdigest())] += 1
    assert got(pii.personal_data(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def disclosure_corpus():
    rng = random.Random(4)
    fill = lambda: " ".join(f"filler{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(12))
    rows = [(i, f"{fill()} write to Zorblax Quibble at zq@example.org about {fill()}") for i in range(5)]
    rows += [(100 + i, f"{fill()} plain about write text {fill()}") for i in range(60)]
    return rows + [(200, "two only rareterm once@example.org"), (201, "two only rareterm once@example.org")]


def test_terms_that_disclose_are_found_and_taken_out(spark):
    docs = spark.createDataFrame(disclosure_corpus(), "doc_id long, text string")
    for sent in (pii.SENT_TERMS, 0):
        pii.SENT_TERMS, before = sent, pii.SENT_TERMS
        try:
            out = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
        finally:
            pii.SENT_TERMS = before
        texts = dict(disclosure_corpus())
        for i in range(5):
            terms = {texts[i][int(a):int(b)] for k, a, b in (x.split(":") for x in out[i].split(",")) if k == "term"}
            assert {"Zorblax", "Quibble"} <= terms and "about" not in terms and "write" not in terms
        assert all(out[100 + i] == "" for i in range(60))
        assert "term" not in out[200]  # two documents are no evidence
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zorblax" not in clean[0] and "[EMAIL]" in clean[0] and "zq@" not in clean[0]
    assert all(clean[100 + i] == texts[100 + i] for i in range(60))


def test_a_disclosing_term_goes_wherever_it_stands(spark):
    far = " ".join(f"between{chr(97 + i)}" for i in range(26))
    texts = {i: f"Zorblax zq@example.org {far}\nnothing here\nsigned Zorblax and again zorblax, Faraway" for i in range(6)}
    texts |= {100 + i: f"{far} plain text nothing here signed and again" for i in range(80)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    for i in range(6):
        spans = [texts[i][int(a):int(b)] for k, a, b in (x.split(":") for x in out[i].spans.split(",")) if k == "term"]
        assert spans == ["Zorblax", "Zorblax", "zorblax", "Faraway"] and out[i].n_term == 4
        assert "zorblax" not in clean[i].lower() and "Faraway" not in clean[i] and far in clean[i]
    assert all(out[100 + i].spans == "" and clean[100 + i] == texts[100 + i] for i in range(80))


def test_pairs_of_any_support_count(spark):
    """One document of many is enough for a term of its own; a term that others hold too is none."""
    texts = {0: "Zorblax writes from zq@example.org", 1: "Quibble writes from one@example.org", 2: "Quibble writes from two@example.org"}
    texts |= {100 + i: "everybody writes from somewhere" for i in range(1500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert "term:0:7" in out[0] and all("term" not in out[i] for i in texts if i)
    n, n_e, n_t, n_et = 1503, 1, 1, 1
    low = n_et / (n_t + pii.WILSON_Z ** 2)  # of the interval when all of a term's documents hold the entity
    row = spark.range(1).select(pii._disclosure(n, *map(F.lit, (n_e, n_t, n_et))).alias("x"), pii._disclosure(n, F.lit(3), F.lit(6), F.lit(2)).alias("y")).first()
    assert row.x == pytest.approx(math.log(low * n / n_e) / math.log(n / n_e))
    z, p = pii.WILSON_Z, 2 / 6
    low = (p + z * z / 12 - z * math.sqrt(p * (1 - p) / 6 + z * z / 144)) / (1 + z * z / 6)
    assert row.y == pytest.approx(math.log(low * n / 3) / math.log(n / 3))


def test_terms_and_their_places():
    text = "Zorblax, zorblax@mail.example.com ZORBLAX 1.2.3.4 İstanbul mail"
    found = pii._terms(text, pii.base_spans(text))
    assert {t: [text[a:b] for a, b in p] for t, p in found.items()} == {
        "zorblax": ["Zorblax", "ZORBLAX"], "mail": ["mail"], "example": [], "com": [], "İstanbul".lower(): ["İstanbul"]}


# -- 5: SimHash -------------------------------------------------------------------

def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(low)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def plain_components(ids, fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    low = {}
    for i, f in zip(ids, fps):
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [low.get(find(f)) for f in fps]


def test_simhash(docs, rows):
    fps = [plain_fingerprint(r[1]) for r in rows]
    ids = [r[0] for r in rows]
    want = Counter(zip(ids, (f"{f:016x}" for f in fps), plain_components(ids, fps)))
    assert got(simhash.simhash(docs), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("bucket", [0, 5, 48])
def test_links_of_dense_groups(spark, bucket):
    rng = random.Random(bucket)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randrange(0, 6)):
            f ^= 1 << b
        fps.append(f)
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in set(fps)], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(nodes, bucket=bucket)).collect()}
    roots = [found.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    want = plain_components(range(len(fps)), fps)
    assert len(set(zip(roots, want))) == len(set(roots)) == len(set(want))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(80)}}


def test_one_document_of_each_component_stays(docs, rows):
    parts = plain_components([k for k in range(len(rows))], [plain_fingerprint(r[1]) for r in rows])
    first = {}
    for r, c in zip(rows, parts):
        key = (r[0] is None, r[0] or 0)
        first[c] = min(first.get(c, key), key)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == Counter(first.values())


# -- 6: token counts --------------------------------------------------------------

def test_token_counts_are_the_librarys(docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    want = Counter()
    for r in rows:
        n = len(lib.encode(r[1] or "", add_special_tokens=False).ids)
        want[(r[0], len((r[1] or "").encode()), n, n > 2048)] += 1
    assert got(token_counts.token_counts(docs, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_merging_of_odd_strings_is_the_librarys():
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    lib, own, rng = tokenizers.Tokenizer.from_file(path), token_counts.Counter(path), random.Random(6)
    letters = ["a", "aa", "the", "ing", "é", "é", "Σ", "İ", "½", "中", "!", "'s", "'ll", " ", "\n", " ", " ", "\x1c", "\u0085", "9", "_", "👍🏽",
               "<|endoftext|>", "<|startoftext|>", "<|", "ａ", "ß"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))
        assert own.text(text) == len(lib.encode(text, add_special_tokens=False).ids), repr(text)


# -- 7: language ------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in source.select("doc_id", "lang").collect()}
    out = language.identify(source).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(docs, none):
    out = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(900, "und"), (901, "und"), (902, "und"), (None, "und")} <= out
    unlabelled = language.identify(docs.withColumn("lang", docs.lang.cast("string")).filter("lang IS NULL"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_subword_sums_stay_in_their_rows():
    import pyarrow as pa
    table = np.random.default_rng(1).random((2, language.BUCKETS))
    texts = ["Hello World", "", "a", "ab", "xyz", None, "one two three", "É"]
    body, offsets = language.folded(pa.array(texts))
    sums, counts = language.bucket_sums(body, offsets, table)
    for i in range(len(texts)):
        own = body[offsets[i]:offsets[i + 1]]
        h = np.concatenate([language.buckets_of(own, 3), language.buckets_of(own, 4)])
        assert counts[i] == len(h)
        assert np.allclose(sums[i], table[:, h].sum(1))


# -- 8: decontamination -----------------------------------------------------------

def plain_contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[k:k + 10])].add(i)
    out = Counter()
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[x] - {None}
        out[(d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_contamination(spark, docs, rows, block_words, monkeypatch):
    items = [(str(r["item_id"]), r["text"]) for r in table("benchmark")]
    items += [("z", "Epsilon Zeta"), ("y", "w5 w6 w7!"), ("x", None), ("w", " ,. "), (None, "w30 w31"), ("y", "w5 w6 w7!"), ("v", rows[3][1])]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    monkeypatch.setattr(decontaminate.search_benchmark, "__defaults__", (block_words,))
    out = decontaminate.contamination(docs, benchmark)
    assert got(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == plain_contamination([(r[0], r[1]) for r in rows], items)
    kept = decontaminate.filter_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == out.filter("NOT contaminated").count()
    nothing = decontaminate.contamination(docs, benchmark.limit(0))
    assert nothing.filter("contaminated OR n_items > 0").count() == 0 and nothing.count() == len(rows)


def test_items_with_one_text_are_dealt_to_all_blocks(spark, monkeypatch):
    body = " ".join(f"same{i}" for i in range(15))
    items = [(f"copy{k}", body) for k in range(300)] + [(None, body)] * 200 + [(f"own{k}", " ".join(f"own{k}x{i}" for i in range(15))) for k in range(100)]
    sizes, block = [], decontaminate.Block
    monkeypatch.setattr(decontaminate, "Block", lambda rows: (sizes.append(sum(len(r[1]) for r in rows)), block(rows))[1])
    monkeypatch.setattr(decontaminate.search_benchmark, "__defaults__", (1200,))
    own = [(1, "head " + body + " tail"), (2, items[-1][1]), (3, "nothing of it")]
    out = decontaminate.contamination(spark.createDataFrame(own, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert got(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == plain_contamination(own, items)
    assert len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


# -- 9: repeated passages ---------------------------------------------------------

def plain_repeats(docs):
    low, out = {}, Counter()
    last = float("inf")
    words = [(d, WORDS.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - 49):
            k = tuple(w[i:i + 50])
            low[k] = min(low.get(k, last), last if d is None else d)
    for d, w in words:
        gone = {j for i in range(len(w) - 49) if low[tuple(w[i:i + 50])] < (last if d is None else d) for j in range(i, i + 50)}
        out[(d, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())] += 1
    return out


def repeated_rows(rows):
    rng = random.Random(9)
    own = [(r[0], r[1]) for r in rows]
    for i in range(60):  # pieces of other texts, spaces changed, in new surroundings
        w = (rng.choice(own)[1] or "").split()
        a = rng.randrange(max(1, len(w)))
        own.append((2000 + i, f"s{i} " * rng.randrange(60) + rng.choice([" ", "  ", "\n"]).join(w[a:a + rng.randrange(40, 200)]) + f" e{i}" * 55))
    return own


@pytest.mark.parametrize("many, shard", [(20_000, 300_000), (20_000, 500), (2, 2_000), (0, 300_000)])
def test_repeats(spark, rows, many, shard):
    own = repeated_rows(rows)
    docs = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    out = substring.remove_repeats(docs, many=many, shard_words=shard)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_repeats(own)


def test_long_runs_of_a_shared_anchor_are_compared_by_digest(spark):
    phrase = " ".join(f"p{i}" for i in range(20))
    texts = [(k, " ".join([f"own{k}", *[phrase] * 60, f"end{k}"])) for k in range(4)] + [(9, "short " * 60), (10, "short " * 55)]
    runs = spark.createDataFrame([(1, 1, 0, 999), (1, 2, 0, 999), (2, 1, 0, 9), (2, 2, 0, 9), (3, 1, 0, 5000)], "anchor long, doc long, first int, last int")
    assert {r.anchor: r.many for r in substring.shared_anchors(runs, 20).collect()} == {1: True, 2: False}
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    whole = got(substring.remove_repeats(docs), *columns)
    assert got(substring.remove_repeats(docs, many=60), *columns) == whole
    assert {r[0]: r[2] for r in whole} == {0: 0, 1: 1200, 2: 1200, 3: 1200, 9: 0, 10: 55}


def test_runs_follow_their_words():
    """Word hashes differ by word and not by place; each window is in one run, with one anchor per content."""
    import pyarrow as pa
    texts = [r["text"] for r in table("documents")] + [None, "", "a b"]
    body, offsets = substring.text_bytes(pa.array(texts))
    hashes, firsts = substring.word_hashes(body, offsets)
    words = [w for t in texts for w in (t or "").split()]
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist())))
    anchors, windows = defaultdict(set), 0
    for row, anchor, first, last in zip(*(x.tolist() for x in substring.window_runs(body, offsets))):
        w = texts[row].split()
        windows += last - first + 1
        for i in range(first, last + 1):
            anchors[tuple(w[i:i + 50])].add(anchor)
    assert windows == sum(max(0, len((t or "").split()) - 49) for t in texts)
    assert all(len(a) == 1 for a in anchors.values()) and len({x for a in anchors.values() for x in a}) > 500


def test_index_finds_all_windows():
    rng = np.random.default_rng(2)
    text = np.concatenate([rng.integers(1, 4, 700), [0], np.tile([1, 2], 100), [0]])
    index = fm_index.FmIndex(text, 50)
    first, last = np.array([0, 701]), np.array([650, 851])
    found = index.match(text, first, last)
    group = defaultdict(set)
    for i in [*range(0, 651), *range(701, 852)]:
        group[found[i]].add(tuple(text[i:i + 50]))
    assert all(len(x) == 1 for x in group.values())
    assert len(group) == len({x for v in group.values() for x in v})


# -- 10: licences -----------------------------------------------------------------

def test_licenses(spark):
    mit = licenses.KNOWN[2][1]
    rows = [(1, "Copyright (c) 2020 Someone\n" + mit.upper()), (2, mit + " and more"), (3, "text\nReleased under the MIT Licence\nmore"),
            (4, None), (5, ""), (6, mit.replace("noninfringement".upper(), "NON-INFRINGEMENT").replace(". ", ".\n\n")), (7, "(c) nobody\nall rights reserved"),
            (None, "Licensed under CC BY-NC 4.0."), (8, "SPDX-License-Identifier: MIT\nLicensed under the Apache License, Version 2.0.\n")]
    out = {r.doc_id: (r.license, r.n_notices, r.notices) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: ("MIT", 1, "MIT"), 2: (None, 0, ""), 3: (None, 1, "MIT"), 4: (None, 0, ""), 5: (None, 0, ""), 6: ("MIT", 0, ""), 7: (None, 0, ""),
                   None: ("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), 8: (None, 2, "Apache-2.0,MIT")}


def test_licenses_are_found_however_they_are_wrapped(spark):
    texts = {(k, width): "\n".join(textwrap.wrap(text, width, break_long_words=False)) for k, (_, text) in enumerate(licenses.KNOWN) for width in range(24, 100, 3)}
    # broken before each place where the text speaks of copyright
    texts |= {(k, 0): re.sub(r"(?i) (?=copyright|\(c\)|all rights)", "\n  ", text) for k, (_, text) in enumerate(licenses.KNOWN)}
    heads = ["Copyright (c) 2020 Someone\nAll rights reserved.\n\n", "Copyright 2019-2021 A. B.\n", "  © Someone\n", "(C) 2020 Someone\r\n", "Copyright by Someone, 2020.\n"]
    rows = [(k, head + text) for (k, width), text in texts.items() for head in ["", *heads[:1 + 4 * (width == 0)]]]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "license").distinct().collect()
    assert {(r.doc_id, r.license) for r in out} == {(k, name) for k, (name, _) in enumerate(licenses.KNOWN)}


def test_full_texts_and_a_callers_licenses(spark, docs):
    full = licenses.full_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= {n for n, _ in full}
    own = spark.createDataFrame([("House-1", "Use it at home."), ("House-2", "Do\nnot\nuse it."), ("Empty", "Copyright 2020 Nobody"), (None, "no name")], "license string, text string")
    rows = [(k, "\n".join(x.strip() for x in text.upper().split("\n")) + "\n\n") for k, (_, text) in enumerate(full)]
    rows += [(100, "head\nuse it at HOME\nReleased under the MIT License.\nUse it at home!"), (100, "do not use it"), (101, "Use it at home."), (102, None), (103, "")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(k, name) for k, (name, _) in enumerate(full)}
    assert {(r.doc_id, r.license) for r in licenses.scan_licenses(some).collect() if r.doc_id < 100} == want
    out = licenses.scan_licenses(some, more=own).collect()
    assert {(r.doc_id, r.license) for r in out if r.doc_id < 100} == want
    assert Counter((r.doc_id, r.license, r.n_notices, r.notices) for r in out if r.doc_id >= 100) == Counter(
        [(100, None, 3, "House-1,MIT"), (100, "House-2", 1, "House-2"), (101, "House-1", 1, "House-1"), (102, None, 0, ""), (103, None, 0, "")])
    columns = ["doc_id", "digest", "license", "n_notices", "notices"]
    assert got(licenses.scan_licenses(docs, more=own.limit(0)), *columns) == got(licenses.scan_licenses(docs), *columns)


# -- all --------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    ok, note = compare.compare(spark, compare.connect(SF), SF, name)
    assert ok, note


def test_odd_rows_and_empty_tables(spark, docs, rows, none):
    benchmark = spark.createDataFrame([("a", "w1 w2 w3")], "item_id string, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    for run in (lambda d: pieces.encode(d, MODEL), quality_rules.quality_rules, quality_classifier.classify, pii.personal_data, simhash.simhash,
                lambda d: token_counts.token_counts(d, path), language.identify, lambda d: decontaminate.contamination(d, benchmark),
                substring.remove_repeats, licenses.scan_licenses):
        assert run(docs).count() == len(rows)
        assert run(none).count() == 0
    for stage in (quality_rules.filter_quality, simhash.keep_one, lambda d: decontaminate.filter_contaminated(d, benchmark), pii.sanitise):
        out = stage(docs)
        assert out.columns == docs.columns and 0 < out.count() <= len(rows)
        assert stage(none).count() == 0 and [f.dataType for f in stage(none).schema] == [f.dataType for f in none.schema]


def test_queries_are_registered():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES][1] == "simhash near-dedup"


def test_pipeline_against_brute_force(spark, model):
    """Each stage of the chain against its plain version, on what the plain versions of the others kept."""
    docs = table("documents")
    out = quality_rules.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"))
    kept = {r.doc_id for r in out.filter("kept").collect()}
    docs = [(d["doc_id"], d["text"]) for d in docs if d["doc_id"] in kept]
    parts = plain_components([d for d, _ in docs], [plain_fingerprint(t) for _, t in docs])
    docs = [d for d, c in zip(docs, parts) if d[0] == c]
    clean = plain_contamination(docs, [(str(r["item_id"]), r["text"]) for r in table("benchmark")])
    docs = [d for d in docs if any(k[0] == d[0] and not k[5] for k in clean)]
    masked = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    split = re.compile(model.pattern)
    want = {d: [i for u in pieces.split_units(split, t) for i in best_path(model, u.replace(" ", pieces.SPACE))] for d, t in masked.items()}
    got_ids = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got_ids == want
    for d, t in docs:
        spans = plain_spans(t)
        assert not spans or all(t[a:b] not in masked[d] or k == 2 for a, b, k in spans if b - a > 8)


def test_a_session_without_a_shared_folder_is_refused(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    from eventwarden.llm import common
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session, "x")


def test_vocabulary_files_are_read_in_place():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert json.load(f)["model"]["type"] == "BPE"
