"""Token alignment, spelling variants and forest search against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from tidemark.llm import rp_forest, spelling, token_alignment
from tidemark.llm.common import read_table, written
from tidemark.llm.queries import QUERIES
from tidemark.llm.word_ids import byte_letters

TEXTS = "doc_id long, text string"


def plain(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---- token alignment -------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_tokens(libraries, text):
    a, b = libraries
    letters = {c: n for n, c in byte_letters().items()}
    e = a.encode(" " + text, add_special_tokens=False)
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    return ([(i, bytes(letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)],
            [(i, bytes([int(t[3:5], 16)]) if re.fullmatch("<0x..>", t) else t.replace("▁", " ").encode()) for i, t in pieces])


def brute_alignment(libraries, rows):
    told, count = [], Counter()
    for doc_id, text in rows:
        a, b = byte_tokens(libraries, text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            a = b = []
        groups, side, upto_a, upto_b, rest = [], [], 0, 0, list(b)
        for i, t in a:
            side.append(i)
            upto_a += len(t)
            ends = np.cumsum([len(x) for _, x in rest]) + upto_b
            if upto_a in ends:
                n = int(np.flatnonzero(ends == upto_a)[0]) + 1
                groups.append((side, [i for i, _ in rest[:n]]))
                side, rest, upto_b = [], rest[n:], upto_a
        links = [(x[-1], y[-1]) for x, y in groups]
        count.update(links)
        told.append((doc_id, len(a), len(b), groups, links))
    best = {y: max(n for (_, z), n in count.items() if z == y) for _, y in count}
    text = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return plain((i, n, m, len(g), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                  hashlib.sha256(text(g).encode()).hexdigest() if g else "") for i, n, m, g, links in told)


ODD = ["a", "  b  ", "\n\n x\t y \r\n", "▁ab", "<|endoftext|> <s></s> <unk>", "é é ｆ İ ǅ", "𝒳😀 \x00\x7f\x85　z", "don't I'LL we've 12345 ___",
       "x" * 700, " " * 2500 + "y" + " " * 90, "ab" * 200 + " ", "", None, "﻿q", "कखग 漢字かな", "\x1c\x1d"]


def test_alignment_matches_brute_force(spark, libraries):
    rng = random.Random(3)
    bits = ["ab", "é", " ", "\n", "  ", "the ", "'s", "1", "漢", "\xad", "𝒳", "<s>", "\t"]
    rows = list(enumerate(ODD)) + [(None, "hello"), (0, "a"), (0, "a")] + [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 50)))) for i in range(120)]
    docs = spark.createDataFrame(rows, TEXTS).withColumn("n_a", F.lit("clash")).withColumn("block", F.lit(1))
    assert plain(tuple(r) for r in token_alignment.link_report(docs).collect()) == brute_alignment(libraries, rows)
    empty = token_alignment.link_report(docs.limit(0))
    assert empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and empty.count() == 0


def test_alignment_counts_over_blocks(spark, libraries):
    """Counts are corpus-wide however the documents are cut into blocks and tasks."""
    docs = read_table(spark, SF_SMALL, "documents").repartition(7)
    rows = [(r["doc_id"], r["text"]) for r in docs.filter("length(text) < 1500").collect()]
    small = spark.createDataFrame(rows, TEXTS).repartition(5)
    assert plain(tuple(r) for r in token_alignment.link_report(small).collect()) == brute_alignment(libraries, rows)


def test_texts_are_searched_together(libraries, monkeypatch):
    """One search serves many short texts and finds what each has alone."""
    v, calls, search = token_alignment.loaded(None), [], token_alignment.common
    monkeypatch.setattr(token_alignment, "common", lambda a, b: calls.append(len(a)) or search(a, b))
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    texts = [t for t in ODD * 20]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    docs = [d for b in token_alignment._blocks(iter([batch]), None) for d in b.column("docs")[0].as_py()]
    assert len(calls) <= 3
    alone = [token_alignment.aligned(v, [v.encode(t)])[:2] if v.encode(t) else ([0], [""]) for t in texts]
    assert [(d["id"], [d["n_groups"]], [d["groups_sha256"]]) for d in docs] == [(i, *x) for i, x in enumerate(alone)]


def test_groups_and_overlaps(spark, libraries):
    v = token_alignment.loaded(None)
    texts = ["hello wörld  tokenization", "漢字 don't", "antidisestablishment 12345"]
    for r in token_alignment.align(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect():
        a, b = byte_tokens(libraries, texts[r["doc_id"]])
        assert [i for g in r["groups"] for i in g["a"]] == [i for i, _ in a] and [i for g in r["groups"] for i in g["b"]] == [i for i, _ in b]
        for mine, other, told in ((a, b, r["a_overlaps"]), (b, a, r["b_overlaps"])):
            ends, others = np.cumsum([len(t) for _, t in mine]), np.cumsum([len(t) for _, t in other])
            for (_, t), end, got in zip(mine, ends, told):
                share = [j for j, (_, o) in enumerate(other) if others[j] > end - len(t) and others[j] - len(o) < end]
                assert (share[0], share[-1]) == (got["first"], got["last"])
    assert v.encode("▁") is None and v.encode("") is None


def test_gallop_finds_lower_bounds():
    rng = np.random.default_rng(0)
    for _ in range(300):
        into = np.unique(rng.integers(0, 4000, rng.integers(0, 500)))
        values = np.unique(rng.integers(0, 4200, rng.integers(0, 300)))
        assert token_alignment.gallop(values, into).tolist() == np.searchsorted(into, values).tolist()
    into = np.arange(0, 10 ** 6, 2)
    assert token_alignment.gallop(np.array([5, 999_998]), into).tolist() == [3, 499_999]


# ---- spelling variants -----------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if every and h % every == 0 else w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in words.items():
        found = [(-words[x], x) for x in words if near(w, x)]
        form = min(found)[1] if found and -min(found)[0] >= 10 * n else None
        out[w] = (form, n, len(found), words[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return plain((w, f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items())


def test_variants_match_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(250)]
    rows = [(i, " ".join(rng.choice(words[:int(250 * rng.random() ** 3) + 1]) for _ in range(120))) for i in range(30)]
    rows += [(None, None), (None, "ÀÉÈabcdefg ababababab abababababa Ababababab,abababababa"), (7, ""), (7, ""), (8, "ababababab Ababababab.AbababababA"), (9, "zyxwvut " * 30_000),
             (10, "zyxwvuts zyxwvuts×zyxwvu zyxwvu " * 3)]
    docs = spark.createDataFrame(rows, TEXTS).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = spelling.spelling_variants(docs, thin_every=31)
    want = brute_variants(rows, 31)
    assert plain(tuple(r) for r in got.collect()) == want
    assert sum(r[1] is not None for r in want) >= 3
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_chain_of_forms_has_one_root(spark):
    counts = [("abcdefgh", 5000), ("abcdefgx", 300), ("abcdefyx", 20), ("abcdezyx", 2), ("qrstuvw", 4), ("qrstuvx", 39)]
    got = {r["word"]: r for r in spelling.variants(written(spark.createDataFrame(counts, "word string, n long"), "w")).collect()}
    assert [got[w]["form"] for w, _ in counts] == [None, "abcdefgh", "abcdefgx", "abcdefyx", None, None]
    assert {got[w]["root"] for w, _ in counts[:4]} == {"abcdefgh"} and got["qrstuvw"]["n_near"] == 1


def test_near_pairs_of_one_letter_runs(spark):
    """Words whose bigrams tie everywhere, and a hot prefix."""
    words = ["a" * n for n in range(7, 20)] + ["b" + "a" * n for n in range(6, 18)] + ["a" * n + "b" for n in range(6, 18)] + ["ab" * n for n in range(4, 9)] + ["ba" * n for n in range(4, 9)]
    pairs = {(r["a"], r["b"]) for r in spelling.near_pairs(written(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), "w")).collect()}
    assert pairs == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(2)
    for _ in range(200):
        grams = sorted({(rng.randrange(9), i) for i in rng.sample(range(12), rng.randint(3, 6))}, key=lambda g: g[1])
        weight = sorted(rng.randrange(1, 50) for _ in range(9))
        pairs = [(weight[x[0]] + weight[y[0]]) for x in grams for y in grams if x[1] + 2 <= y[1]]
        if pairs:
            (r, i), (s, j) = spelling.pivots(grams, weight)
            assert i + 2 <= j and weight[r] + weight[s] == min(pairs)


# ---- forest search ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>"


def brute_neighbours(rows, mod, k):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    dim = Counter(map(len, good.values())).most_common(1)[0][0]
    good = {i: v for i, v in good.items() if len(v) == dim}
    cos = lambda a, b: float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()))
    return {q: sorted(((-cos(good[q], v), i) for i, v in good.items() if i != q))[:k] for q in good if q % mod == 0}


def test_forest_on_odd_rows_is_exact_when_small(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(80)]
    same = rows[10][1]
    rows += [(200 + i, same) for i in range(40)]                       # copies, queries among them
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (304, [float("nan")] * 6), (305, [float("inf")] + [1.0] * 5),
             (306, [1.0, 2.0]), (None, same), (5, rows[5][1]), (5, rows[5][1])]
    table = spark.createDataFrame(rows, VECTORS).withColumn("key", F.lit("clash")).withColumn("ids", F.lit(0)).withColumn("tree", F.lit(None).cast("int"))
    got = rp_forest.search(table, F.col("vec_id") % 10 == 0, leaf_rows=1000, recall=1.0).collect()
    want = brute_neighbours(rows, 10, 5)
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert mine.keys() == want.keys()
    for q, found in want.items():
        assert np.allclose([s for _, s in mine[q]], [-s for s, _ in found], atol=1e-12)
        if len({round(s, 9) for s, _ in found}) == 1:                  # all ties: the smallest ids
            assert [i for i, _ in mine[q]] == sorted(i for i, _ in mine[q])
    assert [i for i, _ in mine[200]] == [10, 201, 202, 203, 204] and [i for i, _ in mine[10]] == [200, 201, 202, 203, 204]
    assert rp_forest.search(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert rp_forest.search(table.filter("vec_id in (300, 302)"), F.col("vec_id") % 10 == 0).count() == 0
    alone = rp_forest.search(table.filter("vec_id in (0, 1, 2)"), F.col("vec_id") % 10 == 0).collect()
    assert sorted((r["rank"], r["query_id"]) for r in alone) == [(1, 0), (2, 0)]


def test_forest_recall_and_blocks(spark):
    """Deep trees, crowded leaves dealt into blocks: the share found is at least the one asked for (less noise), scores exact."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in centres[i % 30] + 0.4 * rng.standard_normal(16)]) for i in range(3000)]
    table = spark.createDataFrame(rows, VECTORS)
    want = brute_neighbours(rows, 50, 5)
    results = []
    for block in (4096, 37):
        got = rp_forest.search(table, F.col("vec_id") % 50 == 0, leaf_rows=64, block_rows=block, sample_rows=500, recall=0.95).collect()
        hits = sum((-r["score"], r["vec_id"]) <= (want[r["query_id"]][4][0] + 1e-12, 10 ** 9) for r in got)
        assert len(got) == 5 * len(want) and hits >= 0.93 * len(got)
        results.append(plain(tuple(r) for r in got))
    assert results[0] == results[1]


def test_queue_gives_leaves_in_order_of_distance():
    rng = np.random.default_rng(1)
    x = rp_forest.unit(rng.standard_normal((400, 8)))
    forest = rp_forest.fit(x, 400, trees=3, leaf_rows=50, seed=1)
    codes = forest.codes(x)
    for i in range(20):
        walk = list(forest.leaves(forest.project(x[i:i + 1])[0]))
        assert len(walk) == len(set(walk)) == 3 * 2 ** forest.depth
        assert set(walk[:3]) == set(enumerate(codes[i].tolist()))      # its own leaves first
    assert max(np.bincount(codes[:, 0])) <= 120


def test_contract_query_recall(spark):
    got = QUERIES["op13_rp_forest"](spark, SF_SMALL).collect()
    rows = [(r["vec_id"], list(r["embedding"])) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    want = brute_neighbours(rows, 50, 5)
    hit = sum(r["vec_id"] in {i for _, i in want[r["query_id"]]} for r in got)
    assert hit >= 0.9 * sum(map(len, want.values()))
    truth = {q: dict((i, -s) for s, i in found) for q, found in want.items()}
    assert all(abs(r["score"] - truth[r["query_id"]][r["vec_id"]]) < 1e-12 for r in got if r["vec_id"] in truth[r["query_id"]])


def test_extreme_magnitudes_keep_their_cosine():
    a = rp_forest.doubles(pa.array([[1e300, 2e300], [3e-300, 1e-300], [1.0, 2.0]]), 2)
    assert np.allclose(rp_forest.cosines(a[:1], a[2:]), 1.0) and np.isfinite(rp_forest.cosines(a[1:2], a[2:])).all()


# ---- earlier operators: mended cases ------------------------------------------------

def test_salvage_time_grows_with_the_archive():
    """Twice the records take about twice the time, not four times."""
    import gzip
    import time

    from tidemark.llm import warc

    def archive(n):
        body = bytes(range(256)) * 24
        head = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:%d>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n\r\n"
        return b"".join(gzip.compress((head % (i, len(body))).encode() + body + str(i).encode()[:0] + b"\r\n\r\n", 0) for i in range(n))
    took = []
    for n in (2000, 4000):
        data = archive(n)
        t = time.process_time()
        assert sum(kind == "record" for kind, *_ in warc.salvage(data)) == n
        took.append(time.process_time() - t)
    assert took[1] < 3 * took[0] + 0.2


def test_blank_texts_have_the_prior_quality(spark):
    from tidemark.llm import quality_knn

    rows = [(i, ("good words about rivers and hills " if i % 3 else "## $$ || ") * (3 + i % 5)) for i in range(60)] + [(100, "   "), (101, "\n\n"), (102, ""), (103, None)]
    docs = spark.createDataFrame(rows, TEXTS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    out = {r["doc_id"]: r["score"] for r in quality_knn.score(docs, quality_knn.train(docs, labels), ["doc_id"]).collect()}
    assert {out[i] for i in (100, 101, 102, 103)} == {40 / 60}


def test_clashing_names_pass_the_pipeline_stages(spark):
    import corpus_pipeline

    docs = read_table(spark, SF_SMALL, "documents")
    for c in ("_text", "_letter", "_stage_lang", "_stage_score", "_stage_lines", "_stage_removed"):
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    plain = read_table(spark, SF_SMALL, "documents")
    for stage in (corpus_pipeline.language, corpus_pipeline.lines):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert out.filter("_text != concat('_text', doc_id) or _stage_lang != concat('_stage_lang', doc_id) or _stage_removed != concat('_stage_removed', doc_id)").count() == 0
        want = stage(spark, plain, SF_SMALL)
        assert out.select(*plain.columns).exceptAll(want).count() == 0 and out.count() == want.count()


def _toxic_corpus(n, pad, seed=5):
    """Texts of about ``pad`` characters; every fourth one ends with marks, one of them within a very long word."""
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "on", "el", "su", "ka"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(pad // 7)]
        if i % 4 == 0:
            words += [rng.choice(["zvork", "quxify", "blarghs"]) for _ in range(5)] + ["ta" * 60 + "zvork" + "ka" * 60]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxic_marks_behind_twenty_thousand_characters(spark):
    from tidemark.llm import toxicity

    rows, labels = _toxic_corpus(160, 24_000)
    docs = spark.createDataFrame(rows, TEXTS)
    model = toxicity.train(docs, spark.createDataFrame([x for x in labels if x[0] < 110], "doc_id long, toxic int"))
    assert all(s in model.toxic for s in (b"zvork", b"quxify", b"blarghs"))
    out = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    held = range(110, 160)
    assert sum(out[i] >= 0.5 for i in held if i % 4 == 0) >= 0.9 * sum(i % 4 == 0 for i in held)
    assert sum(out[i] >= 0.5 for i in held if i % 4) <= 1
    # a score is the logistic of the evidence of its windows
    model.open()
    text = dict(rows)[112]
    saved = [len(model._ordinary.compress(w)) - len(model._toxic.compress(w)) for w in toxicity.windows(text)]
    x = [1.0, np.log1p(len(saved)), *[np.log1p(sum(s >= t for s in saved)) for t in toxicity.THRESHOLDS], max(0, max(saved))]
    assert abs(out[112] - 1 / (1 + np.exp(-float(np.dot(x, model.weights))))) < 1e-9


def test_toxic_recall_on_the_table(spark):
    """A model that never predicts toxic fails here."""
    out = QUERIES["op3_toxic_compression"](spark, "/root/testdata/sf0.1").join(read_table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("held_out")
    share = {r["toxic"]: r["p"] for r in out.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert share[1] > 0.8 and share[0] < 0.02


def test_long_words_count_by_their_pieces():
    from tidemark.llm import toxicity

    word = "".join(chr(97 + i % 26) for i in range(1000))
    pieces = set().union(*map(toxicity._segments, toxicity.spaced_words(word)))
    assert pieces == toxicity._segments(f" {word} ")
    assert toxicity.spaced_words("a b a") == {" a ", " b "}


# ---- near pairs ------------------------------------------------------------------

def test_wide_sketches_are_compared_in_bounded_memory():
    """Two blocks whose pairs all pass the size test, with sketches of the
    greatest width: what is gathered for them at once is bounded."""
    import tracemalloc

    from tidemark.llm import shingle_join

    rng = np.random.default_rng(1)

    def block(first, k):
        words = rng.integers(0, 2 ** 63, (k, shingle_join.SKETCH_MOST), dtype=np.uint64)
        words[1] = words[0]
        sketches = np.empty(k, object)
        sketches[:] = list(words)
        return {"doc": np.arange(k) + first, "component": np.arange(k) + first, "n": np.full(k, 10_000), "sketch": sketches}

    left, right = block(0, 900), block(900, 800)
    right["sketch"][5] = left["sketch"][7]
    tracemalloc.start()
    own, across = (shingle_join.near_pairs(left, x, 80, 100).tolist() for x in (None, right))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [*map(sorted, own)] == [[0, 1]] and across == [[7, 5]]
    assert peak < 64 << 20
