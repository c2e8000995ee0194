"""Learned operators: held-out accuracy, exact parts against brute force, edge tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL

from tidemark.llm import langid, ngrams, quality_knn, toxicity
from tidemark.llm.common import fold, read_table
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string"
WORDS = {"aa": ["kato", "miko", "tako", "lamo"], "bb": ["schlum", "grund", "brett", "stumpf"], "cc": ["élan", "façon", "règle", "où"]}
EDGE = [(1001, None, "aa"), (1002, "", "bb"), (1003, "123 !!", None), (1004, "kato " * 30000, "aa"), (1004, "kato " * 30000, "aa"),
        (None, "grund brett", None), (1005, "a\x00b \ud800".encode("utf-8", "replace").decode(), None), (1006, "中文", None)]


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[la]) for _ in range(rng.randint(3, 40))), la) for i in range(n) for la in [rng.choice(list(WORDS))]]


# ---- n-grams ---------------------------------------------------------------------

def test_ngram_counts_cover_the_whole_text():
    for text in ("", "a", "ab", "hello wörld 𝒳" * 50):
        slots, n = ngrams.counts(text, (1, 2, 3), 16)
        assert n.sum() == sum(max(0, len(text) - k + 1) for k in (1, 2, 3))
        assert list(slots) == sorted(set(slots.tolist()))
    a, b = ngrams.counts("xyz" * 9000, (2,), 12), ngrams.counts("xyz" * 3, (2,), 12)
    assert set(a[0].tolist()) == set(b[0].tolist())  # dense and sparse counting agree


# ---- language --------------------------------------------------------------------

def test_langid_learns_and_defines_edges(spark):
    df = spark.createDataFrame(corpus() + EDGE, DOCS).withColumn("score", F.lit(3)).withColumn("_text", F.lit("x"))
    model = langid.train(df.filter("doc_id < 200"))
    out = langid.predict(df, model, ["doc_id", "lang", "score"]).collect()
    assert len(out) == 248 and all(0.0 <= r["score"] <= 1.0 for r in out)
    test = [r for r in out if r["doc_id"] is not None and 200 <= r["doc_id"] < 240]
    assert np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.95
    by = {r["doc_id"]: r["lang_pred"] for r in out}
    assert by[1001] == by[1002] == by[1003] == "und" and by[1004] == "aa" and by[None] == "bb" and by[1006] in WORDS


def test_langid_without_labels_or_rows(spark):
    df = spark.createDataFrame(corpus(20), DOCS)
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert langid.train(bare) is None
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(bare, None, ["doc_id"]).collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), langid.train(df), ["doc_id"]).count() == 0
    one = langid.train(df.filter("lang = 'aa'"))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df, one, ["doc_id"]).collect()} == {("aa", 1.0)}


def test_ftrl_is_sparse_and_matches_a_plain_loop():
    rng = np.random.default_rng(0)
    samples = [(np.sort(rng.choice(30, 5, replace=False)), rng.random(5), int(rng.integers(3))) for _ in range(40)]
    got = langid.ftrl(samples, 30, 3, 0.7, 1.0, 0.05, 0.1, 1, seed=2)
    z, n = np.zeros((31, 3)), np.zeros((31, 3))

    def weight(i, c):
        if abs(z[i, c]) <= 0.05:
            return 0.0
        return -(z[i, c] - np.sign(z[i, c]) * 0.05) / ((1.0 + n[i, c] ** 0.5) / 0.7 + 0.1)
    for k in np.random.default_rng(2).permutation(40):
        slots, x, y = samples[k]
        pairs = [*zip(slots.tolist(), x.tolist(), strict=True), (30, 1.0)]
        s = [sum(v * weight(i, c) for i, v in pairs) for c in range(3)]
        p = np.exp(s) / np.exp(s).sum()
        for c in range(3):
            for i, v in pairs:
                g, w = v * (p[c] - (c == y)), weight(i, c)
                z[i, c] += g - ((n[i, c] + g * g) ** 0.5 - n[i, c] ** 0.5) / 0.7 * w
                n[i, c] += g * g
    want = np.array([[weight(i, c) for c in range(3)] for i in range(31)])
    assert np.allclose(got, want) and (got == 0).any()


def test_temperature_minimises_log_loss():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 400)
    logits = 5 * (np.eye(3)[np.where(rng.random(400) < 0.8, y, rng.integers(0, 3, 400))])
    t = langid.temperature(logits, y)
    loss = lambda v: -np.log(langid.softmax(logits / v)[np.arange(400), y]).mean()
    assert all(loss(t) <= loss(v) + 1e-9 for v in (0.3, 0.7, 1.0, 2.0, 3.0, 6.0))


def held_out_accuracy(spark, query, truth, value):
    out = QUERIES[query](spark, SF_MID)
    docs = read_table(spark, SF_MID, "documents")
    assert out.count() == docs.count()
    return out.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col(value[0]) == F.col(value[1])).cast("int"))).first()[0]


def test_langid_held_out_accuracy(spark):
    assert held_out_accuracy(spark, "op6_langid_ftrl", read_table(spark, SF_MID, "documents").select("doc_id", "lang"), ("lang", "lang_pred")) > 0.98


# ---- quality ---------------------------------------------------------------------

def test_quality_vote_is_exact():
    rng = np.random.default_rng(2)
    labelled, y = quality_knn.unit(rng.standard_normal((90, 8))), rng.integers(0, 2, 90).astype(float)
    model = quality_knn.Model(np.ones(1), np.zeros((1, 8)), labelled, y, np.where(y == 1, 2.0, 0.5), 0.6)
    rows = quality_knn.unit(rng.standard_normal((700, 8)))
    rows[3] = 0
    got = model.vote(rows)
    for i in (0, 1, 3, 511, 512, 699):
        cos = labelled @ rows[i]
        near = np.argsort(-cos)[: quality_knn.K]
        w = np.maximum(cos[near], 0) ** quality_knn.POWER * model.weight[near]
        assert got[i] == pytest.approx((w * y[near]).sum() / w.sum() if w.sum() else 0.6, abs=1e-5)


def test_quality_edges(spark):
    df = spark.createDataFrame(corpus(60) + EDGE, DOCS).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(None, 1, 1), (77777, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    out = quality_knn.score(df, quality_knn.train(df, labels), ["doc_id", "score"]).collect()
    assert len(out) == 68 and all(0.0 <= r["score"] <= 1.0 for r in out)
    none = quality_knn.score(df, quality_knn.train(df, labels.limit(0)), ["doc_id"])
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality_knn.score(df.limit(0), quality_knn.train(df, labels), ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    assert held_out_accuracy(spark, "op5_quality_neighbours", read_table(spark, SF_MID, "labels"), ("quality", "predicted")) > 0.95


# ---- toxicity --------------------------------------------------------------------

def test_windows_cover_the_text():
    for text in ("", "a", "one two three " * 40, "x" * 500, "é " * 100):
        w = toxicity.windows(text)
        data = toxicity.normal(text)
        assert b"".join(x[:-1] for x in w) + b" " == data if w else data.strip() == b""
        assert all(len(x) <= toxicity.WINDOW + 2 for x in w)


def test_toxicity_learns_planted_segments(spark):
    rng = random.Random(3)
    clean = [" ".join("".join(rng.choice(["ta", "re", "mi", "on", "el"]) for _ in range(3)) for _ in range(60)) for _ in range(400)]
    rows, labels = [], []
    for i, t in enumerate(clean):
        words, bad = t.split(), i % 4 == 0
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zvork", "quxify", "blarghs"]))
        rows.append((i, " ".join(words), None))
        labels.append((i, 1, int(bad)))
    df = spark.createDataFrame(rows + EDGE, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, lab.filter("doc_id < 300"))
    assert all(s in model.toxic for s in (b"zvork", b"quxify", b"blarghs"))
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, model, ["doc_id"]).collect()}
    assert np.mean([(out[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400)]) > 0.97
    assert all(0 <= s <= 1 for s in out.values()) and out[1001] == out[1002] < 0.5


def test_toxicity_edges(spark):
    df = spark.createDataFrame(corpus(20) + EDGE, DOCS)
    lab = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(df, toxicity.train(df, lab), ["doc_id"]).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(df, toxicity.train(df, lab.limit(0)), ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(df.limit(0), toxicity.train(df, lab), ["doc_id"]).count() == 0


def test_toxicity_held_out(spark):
    out = QUERIES["op3_toxic_compression"](spark, SF_MID)
    labels = read_table(spark, SF_MID, "labels")
    assert out.filter(F.col("held_out") != (fold("doc_id", 5) == 0)).count() == 0
    r = out.join(labels, "doc_id").filter("held_out and toxic = 0").agg(F.avg("predicted")).first()[0]
    assert r < 0.1
    assert QUERIES["op3_toxic_compression"](spark, SF_SMALL).count() == read_table(spark, SF_SMALL, "documents").count()
