"""Packed ids, hard negatives and ranked search against the library and brute-force versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

import corpus_pipeline
from eventwarden.llm import hard_negatives, lexical_search, packed_ids, quality_classifier, queries
from .test_operators import SCHEMA, SF, odd_rows, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], None, None, 1) for r in table("documents")] + odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 11: packed ids -------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 15, 16, 17, 20, 27, 32])
def test_bits_go_in_and_come_out(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1003, dtype=np.uint32)
    data = packed_ids.pack(ids, bits)
    assert len(data) == -(-1003 * bits // 8)
    for a, b in ((0, 1003), (0, 0), (17, 18), (999, 1003), (500, 900)):
        assert packed_ids.unpack(data, bits, a, b).tolist() == ids[a:b].tolist()


def test_least_bits():
    assert [packed_ids.bits_for(n) for n in (1, 2, 3, 4, 5, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 2, 3, 8, 9, 16, 16, 17]


def test_cut_texts_are_encoded_as_the_library_does(library):
    rng = random.Random(11)
    marks = [" ", "  ", "   ", "\n", " \n", "\n ", "\t", " ", "  ", " ", "　", "\x85", "\x1c", "\x00", "'s", "'ll", "'", ".",
             "...", "a", "Word", "12", "é", " é", "ñandú", "漢字", "ひら", "👍", "👍🏽", "é", " ́", "<|endoftext|>", "<|", "İ", "ß", "½", "²"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(12))) for _ in range(4000)]
    model = packed_ids.Encoder(TOKENIZER)
    assert model.cuts
    found = model.encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_full_memory_is_emptied(library, monkeypatch):
    monkeypatch.setattr(packed_ids, "MEMORY", 50)
    model = packed_ids.Encoder(TOKENIZER)
    for text in ("one two three", "two three four", "", "one two"):
        assert np.frombuffer(model.encode([text.encode()])[0], "<u4").tolist() == library.encode(text).ids


def plain_ids(rows, library):
    return Counter((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows)


@pytest.mark.parametrize("file_ids", [3_000, 1 << 26])
def test_files_hold_every_document_in_order(spark, docs, rows, library, file_ids, tmp_path, monkeypatch):
    monkeypatch.setattr(packed_ids, "UNPACKED", 5_000)
    manifest = packed_ids.write_ids(docs, TOKENIZER, str(tmp_path / "ids"), 2, file_ids=file_ids)
    found = sorted(packed_ids.read_ids(manifest).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == plain_ids(rows, library)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    whole = [i for r in found for i in r.ids]
    assert [r.start for r in found] == np.cumsum([0, *[len(r.ids) for r in found]])[:-1].tolist()
    assert manifest.agg(F.sum("n_ids"), F.sum("n_docs"), F.max("bits")).first() == (len(whole), len(rows), 16)
    for start, n in ((0, 10), (len(whole) // 2, 4000), (len(whole) - 3, 100), (len(whole), 5)):
        assert packed_ids.window(manifest, start, n).tolist() == whole[start:start + n]
    sums = {(r.start, r.n_tokens, r.ids_crc32) for r in packed_ids.digests(packed_ids.read_manifest(spark, str(tmp_path / "ids"))).collect()}
    assert sums == {(r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found}


@pytest.mark.parametrize("bits", [5, 17])
def test_a_file_of_odd_bits_is_read_at_random(bits, tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packed_ids, "BLOCK", 64)
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 1 << bits, n, dtype=np.uint32) for n in (0, 3, 500, 1, 64, 128, 7)]
    out = packed_ids.FileWriter(f"file://{tmp_path}/x.ids", bits, pa.string())
    for k, x in enumerate(lists):
        out.add(pa.array([f"d{k}"]), np.array([len(x)]), x)
    with pytest.raises(ValueError, match="fit"):
        out.add(pa.array(["d"]), np.array([1]), np.array([1 << bits]))
    assert out.close()["n_ids"] == sum(map(len, lists))
    file, whole = packed_ids.FileReader(f"file://{tmp_path}/x.ids"), np.concatenate(lists)
    assert file.offsets[-1] == packed_ids.HEAD + -(-len(whole) * bits // 8)
    assert [file.document(k).tolist() for k in range(len(lists))] == [x.tolist() for x in lists]
    for a in range(0, len(whole), 37):
        assert file.ids(a, a + 90).tolist() == whole[a:a + 90].tolist()


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"no packed ids" * 9)
    with pytest.raises(ValueError, match="no file"):
        packed_ids.FileReader(f"file://{tmp_path}/x")


def test_packed_query_on_whole_table(spark, library):
    out = sorted(tuple(r) for r in queries.QUERIES["op11_packed_ids"](spark, SF).collect())
    start, want = 0, []
    for r in sorted(table("documents"), key=lambda r: r["doc_id"]):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert out == want


def test_no_documents_no_files(spark, none):
    assert packed_ids.packed_digests(none, TOKENIZER, 2).count() == 0


# -- 12: hard negatives -----------------------------------------------------------------

def plain_negatives(rows, every, k_pos=5, k_neg=5, low=80):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * x) for x in v]
        held[i] = min(held.get(i, (label, v)), (label, v))
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    out = []
    for a, (label, v) in held.items():
        if a % every:
            continue
        scored = [(-clip(sum(x * y for x, y in zip(v, w))), i, m == label) for i, (m, w) in held.items() if i != a]
        for p, positive, _ in sorted(s for s in scored if s[2])[:k_pos]:
            fit = sorted(s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= 100 * -p)[:k_neg]
            out += [(a, positive, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fit)]
    return Counter(out)


VECTORS = "vec_id long, embedding array<double>, label int, id string, v string, anchor int"


def mined(spark, rows, every, **more):
    df = spark.createDataFrame([(i, v, m, "clash", "clash", 1) for i, m, v in rows], VECTORS).repartition(3)
    out = hard_negatives.hard_negatives(df, F.col("id") % every == 0, F.col("label"), **more)
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("grid", [{}, {"most_rows": 300, "most_anchors": 60, "fewest": 20}])
@pytest.mark.parametrize("tile, gathered", [(1 << 22, 1 << 20), (64, 10)])
def test_hard_negatives(spark, grid, tile, gathered, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "GATHERED", gathered)
    rng = random.Random(12)
    vector = lambda: [rng.choice([-0.25, 0.0, 0.125, 0.5, 0.503, 1.0]) for _ in range(4)]
    rows = [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 4), vector()) for i in range(260)]
    rows += [(400 + i, 1 + i % 2, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # copies: many ties
    rows += [(None, 1, vector()), (501, None, vector()), (502, 1, None), (503, 1, [None, 1.0, 0.0, 0.0]), (504, 1, [math.nan] * 4),
             (505, 2, [math.inf, 0.0, 0.0, 0.0]), (510, 2, []), (520, 1, [0.5]), (530, 3, [0.5, 0.5, 0.5, 0.5, 9.0]), rows[0], rows[10],
             (20, 3, vector()), (20, 2, vector())]
    assert mined(spark, rows, 10, **grid) == plain_negatives(rows, 10)


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 25)
    rows = [(0, 0, [big, 1.0]), (1, 0, [big, 2.0]), (2, 1, [big, 1.99609375]), (3, 1, [big, 2.00390625]), (4, 1, [0.8 * big, 0.0]),
            (10, 2, [1e300, -1e300]), (11, 2, [1e300, 0.0]), (12, 3, [1e300, 0.0]), (13, 3, [-1e300, 0.0])]
    got, want = mined(spark, rows, 10), plain_negatives([(i, m, [min(max(x, -2.0 ** 54), 2.0 ** 54) for x in v]) for i, m, v in rows], 10)
    assert got == want and any(r[0] == 0 for r in got)


@pytest.mark.parametrize("slots", [[3], [0, 4], [1, 1, 2], [5, 0, 2]])
def test_suffixes_are_the_heads_of_all_lower_slots(spark, slots):
    rows, score = [], 1000
    for slot, n in enumerate(slots):
        for place in range(n):
            score -= 1
            rows.append((7, slot, score, 100 + len(rows), place + 1))
    df = spark.createDataFrame(rows, "anchor long, slot int, score long, id long, place int")
    got = {r.slot: [x.id for x in r.best] for r in hard_negatives.suffixes(df, 3).collect()}
    last = max(s for s, n in enumerate(slots) if n)
    assert got == {s: [r[3] for r in rows if r[1] >= s][:3] for s in range(last + 1)}


def test_no_vectors_no_negatives(spark):
    assert not mined(spark, [(0, 1, [1.0])], 10)
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("id") % 10 == 0, F.col("label")).count() == 0


# -- 13: ranked search --------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_scores(rows, items):
    docs = [(d, c) for d, t in rows if (c := Counter(TERM.findall((t or "").translate(LOWER))))]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(TERM.findall((text or "").translate(LOWER))), []
        for d, c in docs:
            n = sum(c.values())
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(f * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, f in asked.items() if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0))
        out += [(item, k + 1, d if some else None, -s) for k, (s, some, d) in enumerate(sorted(scored)[:20])]
    return Counter(out)


def test_terms():
    text = "Ab-c_D9 É'é ﬀ\x00x\x7fy 漢字 Ünï,  z"
    assert [t.decode() for t in lexical_search.terms(text.encode())] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("most, block, step", [(1 << 22, 1 << 20, 32), (500, 100, 1), (3, 1 << 20, 2)])
def test_ranked_search(spark, docs, rows, most, block, step, monkeypatch):
    monkeypatch.setattr(lexical_search.Index.search, "__defaults__", (step,))
    asked = [(r["item_id"], r["text"]) for r in table("benchmark")][:12]
    asked += [(500, None), (501, ""), (502, "!?"), (503, "neverseenterm"), (504, "w1 W2 w2 w69"), (504, "w5"), (None, "alpha1 beta2 ünïcode")]
    items = spark.createDataFrame([(i, t, "clash") for i, t in asked], "item_id long, text string, doc_id string")
    out = lexical_search.search(docs, items, most=most, block_terms=block)
    assert Counter(tuple(r) for r in out.collect()) == plain_scores([(r[0], r[1]) for r in rows], asked)


def test_search_stops_early_and_keeps_ties():
    rng = np.random.default_rng(13)
    n, k = 4000, 5
    doc, term, impact = [], [], []
    for t in range(3):
        held = np.sort(rng.choice(n, 2500, replace=False))
        doc.append(held)
        term.append(np.full(len(held), t))
        impact.append(rng.geometric(0.002, len(held)) // 7)
    index = lexical_search.Index(np.concatenate(doc), np.concatenate(term), np.concatenate(impact), 3)
    whole = np.zeros(n, np.int64)
    for t, f in ((0, 1), (1, 2), (2, 1)):
        whole[doc[t]] += f * impact[t]
    for step in (1, 8, 32):
        docs, scores = index.search(np.array([0, 1, 2]), np.array([1, 2, 1]), k, 0, step)
        assert list(zip(docs, scores)) == [(d, whole[d]) for d in np.lexsort((np.arange(n), -whole))[:k]]
    # all scores alike: nothing may be left unmet that ties with the k-th
    index = lexical_search.Index(np.arange(n), np.zeros(n, np.int64), np.full(n, 9), 1)
    assert index.search(np.array([0]), np.array([1]), k, 0)[0].tolist() == [0, 1, 2, 3, 4]


def test_search_reads_less_than_the_lists():
    n, seen = 20_000, []
    impact = np.arange(n, 0, -1) ** 2

    class Counted(lexical_search.Index):
        pass

    index = Counted(np.concatenate([np.arange(n)] * 2), np.repeat([0, 1], n), np.concatenate([impact, impact]), 2)
    index.fall = type("Fall", (), {"__getitem__": lambda self, x, fall=index.fall: seen.append(x) or fall[x]})()
    docs, _ = index.search(np.array([0, 1]), np.array([1, 1]), 10, 0)
    assert docs.tolist() == list(range(10))
    assert max(x.stop for x in seen if isinstance(x, slice)) < n + 200


def test_searches_without_documents_or_items(spark, docs, none):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


# -- the pipeline's tables ------------------------------------------------------------------

def staged(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    return {p.name for p in __import__("pathlib").Path(root.removeprefix("file:")).glob("llm/*")}


def test_a_stage_deletes_what_the_one_before_it_staged(spark, docs, tmp_path):
    before, held = staged(spark), docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, held, SF)
        new = {n.rsplit("-", 1)[0] for n in staged(spark) - before}
        assert k == 0 or not any(n.startswith(earlier) for n in new)
        earlier = ("quality-docs", "simhash", "benchmark", "pii")[k]
        out.write.parquet(str(tmp_path / str(k)))
        held = spark.read.parquet(str(tmp_path / str(k)))
    lazy = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, docs, SF), SF)  # not written in between
    assert lazy.count() > 0


def test_the_pipeline_leaves_its_output_alone(spark):
    before = staged(spark)
    out = corpus_pipeline.run(spark, SF)
    assert len(staged(spark) - before) <= 2 and out.count() > 0  # the output, and what another query may have staged


def test_the_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# -- 3: the quality classifier against plain loops ------------------------------------------

def plain_measures(text):
    words, signs = text.split(), b"#*$%&|<>"
    n, size = max(len(words), 1), max(len(text), 1)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in text)
    stop = len(set(words) & quality_classifier._STOP)
    return [len(words), sum(c in signs for c in text) / n, sum(65 <= c <= 90 for c in text) / max(letters, 1), text.count(b"!") / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            math.log(max(len(set(words)), 1)) / math.log(len(words)) if len(words) > 1 else 1.0, stop, letters / n,
            sum(any(c in signs for c in w) for w in words) / n]


def plain_posteriors(counts):
    """Expectation-maximisation over votes per pattern, one number at a time."""
    k, c = len(quality_classifier.LABELLERS), quality_classifier
    split = lambda p: [p // 3 ** i % 3 for i in range(k - 1, -1, -1)]
    total, start = sum(counts.values()), (c.START_BAD, 1 - c.START_RIGHT)
    rate, good = [[start[0]] * k, [start[1]] * k], c.START_GOOD
    for _ in range(c.ROUNDS):
        post = {}
        for p in counts:
            odds = [math.log(1 - good), math.log(good)]
            for i, v in enumerate(split(p)):
                for side in (0, 1):
                    odds[side] += 0 if v == 1 else math.log(rate[side][i] if v == 0 else 1 - rate[side][i])
            post[p] = 1 / (1 + math.exp(odds[0] - odds[1]))
        share = lambda side, p: (post[p] if side else 1 - post[p]) * counts[p]
        good = min(max(sum(share(1, p) for p in counts) / total, 0.5), 0.98)
        rate = [[(sum(share(s, p) for p in counts if split(p)[i] == 0) + c.ANCHOR * total * start[s])
                 / (sum(share(s, p) for p in counts if split(p)[i] != 1) + c.ANCHOR * total) for i in range(k)] for s in (0, 1)]
    return post


def plain_training(texts, labels):
    c, weights = quality_classifier, Counter()
    rng, data = np.random.default_rng(5), []
    for t in texts:
        grams = Counter(((t[i] << 16 | t[i + 1] << 8 | t[i + 2]) * 2654435761 % 2 ** 32) >> 18 for i in range(len(t) - 2))
        n = max(sum(grams.values()), 1)
        data.append({**{g: c.GRAM_SCALE * m / n for g, m in grams.items()}, **{int(b): 1.0 for b in c._bins(plain_measures(t))}})
    score = lambda x: 1 / (1 + math.exp(-sum(weights[j] * v for j, v in x.items())))
    for epoch in range(c.EPOCHS):
        for i in rng.permutation(len(data)):
            step = c.RATE * (1 - epoch / c.EPOCHS) * (score(data[i]) - labels[i])
            for j, v in data[i].items():
                weights[j] -= step * v
    return [score(x) for x in data]


def test_classifier_is_that_of_plain_loops(spark):
    docs = [r for r in table("documents")][:80] + [{"doc_id": 1000 + i, "text": t} for i, t in enumerate([None, "", "a b", "#$% " * 40])]
    texts = sorted(((r["doc_id"], (r["text"] or "").encode()) for r in docs))
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in docs], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_classifier.classify(frame).collect()}
    patterns = {d: quality_classifier.pattern(plain_measures(t)) for d, t in texts}
    post = plain_posteriors(Counter(patterns.values()))
    assert all(abs(got[d].weak_label - post[p]) < 1e-9 for d, p in patterns.items())
    placed = frame.select("doc_id", F.xxhash64(F.coalesce("text", F.lit("")), "doc_id").alias("place")).orderBy("place").collect()
    order = [r.doc_id for r in placed]
    by_id = dict(texts)
    scores = plain_training([by_id[d] for d in order], [post[patterns[d]] for d in order])
    for d, s in zip(order, scores):
        assert abs(got[d].score - s) < 1e-6 and got[d].kept == (got[d].score >= quality_classifier.KEEP_FROM)


# -- what goes through the driver or to all tasks --------------------------------------------

# file: (broadcasts, collects), each with its bound beside it in the code or in the README
SENT = {
    "components.py": (0, 0), "decontaminate.py": (2, 3), "language.py": (1, 1), "lexical_search.py": (2, 0), "licenses.py": (1, 1),
    "packed_ids.py": (0, 1), "pieces.py": (1, 0), "pii.py": (1, 1), "quality_classifier.py": (1, 2), "quality_rules.py": (1, 0),
}


def test_broadcasts_and_collects_are_the_bounded_ones():
    import pathlib
    for path in pathlib.Path(queries.__file__).parent.glob("*.py"):
        text = path.read_text(encoding="utf-8")
        assert (text.count("broadcast("), text.count(".collect()")) == SENT.get(path.name, (0, 0)), path.name
        assert not any(word in text for word in ("localCheckpoint", "crossJoin", ".rdd", "toPandas"))
