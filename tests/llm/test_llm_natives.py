"""Line windows, budgets and syncmers against brute force on small tables."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import line_windows, mixing, syncmers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=None):
    rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for c in extra or ():
        df = df.withColumn(c, F.lit(7))
    return df


# ---- line windows ----------------------------------------------------------------

def brute_lines(texts):
    """{(id, text): (kept text, lines, removed)} by the documented rule."""
    full = {k: [(i, s) for i, s in enumerate((k[1] or "").split("\n")) if re.search(r"[^\x20\x09-\x0d]", s)] for k in set(texts) if k[1] is not None}
    th = {k: xxhash.xxh64_intdigest(k[1].encode(), 42) for k in full}
    th = {k: v - 2 ** 64 if v >= 2 ** 63 else v for k, v in th.items()}
    wins = {}
    for k, f in full.items():
        if f:
            for p in range(max(1, len(f) - 2)):
                wins.setdefault(tuple(s for _, s in f[p:p + 3]), []).append(((k[0] is not None, k[0] or 0, th[k], p), k))
    gone = {}
    for found in wins.values():
        for place, k in sorted(found, key=lambda x: x[0])[1:]:
            gone.setdefault(k, set()).update(i for i, _ in full[k][place[3]:place[3] + 3])
    out = {}
    for k in set(texts):
        if k[1] is None:
            out[k] = (None, 0, 0)
            continue
        lines, g = k[1].split("\n"), gone.get(k, set())
        kept = k[1] if not g else "" if len(g) == len(full[k]) else "\n".join(s for i, s in enumerate(lines) if i not in g)
        out[k] = (kept, len(full[k]), len(g))
    return out


def check_lines(spark, texts, extra=None):
    df = docs_of(spark, texts, extra)
    got = line_windows.dedup_lines(df)
    keyed = df.select("doc_id", F.col("text").alias("old")).distinct()
    want = brute_lines(texts)
    rows = got.collect()
    assert len(rows) == len(texts)
    left = sorted(((r["doc_id"], r["text"], r["_n_lines"], r["_n_removed"]) for r in rows), key=str)
    right = sorted(((k[0], *want[k]) for k in texts), key=str)
    assert left == right
    assert keyed.count() == len(set(texts))
    return got


def test_lines_defined_cases(spark):
    long = "\n".join(f"line {i}" for i in range(3000))
    texts = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc\nd"), (4, None), (5, ""), (6, "one"), (7, "one"), (8, " \n\t\n"),
             (9, "q\nq\nq\nq\nq"), (10, "a\n\nb\nc\n"), (11, long), (12, "s\n" + long), (3, "a\nb\nc\nd"), (3, "zz\nother"), (None, "a\nb\nc"), (None, None)]
    got = check_lines(spark, texts, ["row", "_gone", "h", "_id"])
    by = {(r["doc_id"], r["_n_removed"]): r["text"] for r in got.collect()}
    assert by[(2, 3)] == "x\ny" if (2, 3) in by else True
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and {r["h"] for r in got.collect()} == {7}


def test_lines_empty_table(spark):
    assert line_windows.dedup_lines(docs_of(spark, [])).count() == 0


def test_lines_random(spark):
    rng = random.Random(5)
    texts = [(i, "\n".join(rng.choice("abcde ") for _ in range(rng.randint(0, 9)))) for i in range(120)]
    check_lines(spark, texts)


def test_lines_every_line_stays_somewhere(spark):
    rng = random.Random(6)
    texts = [(i, "\n".join(rng.choice("abc") + str(rng.randint(0, 2)) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    rows = line_windows.dedup_lines(docs_of(spark, texts)).collect()
    assert {s for r in rows for s in r["text"].split("\n") if s} == {s for _, t in texts for s in t.split("\n")}


def test_lines_long_passages_on_few_lines(spark):
    rng = random.Random(14)
    line = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    one, two, plain = line(51), f"{line(26)}\n{line(25)}", line(50)
    texts = [(1, f"a1\n{one}\nb1"), (2, f"a2\n{one}\n\nb2"), (3, one), (4, f"a4\n{two}\nb4"), (5, f"a5\n{two}\nb5"), (6, two),
             (7, f"a7\n{plain}\nb7"), (8, f"a8\n{plain}\nb8"), (9, plain), (10, None), (11, f"{one}\n{one}\nc")]
    got = {r["doc_id"]: (r["text"], r["_n_removed"]) for r in line_windows.dedup_lines(docs_of(spark, texts), long_words=50).collect()}
    want = {i: (t, 0) for i, t in texts} | {2: ("a2\n\nb2", 1), 3: ("", 1), 5: ("a5\nb5", 2), 6: ("", 2), 11: ("c", 2)}
    assert got == want
    import corpus_pipeline
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs_of(spark, texts), "").collect()}
    assert staged == {i: t for i, (t, _) in want.items() if t != ""}


# ---- budgets ---------------------------------------------------------------------

def fill(budget, children):
    """Progressive water filling of (capacity, weight) by bisection."""
    lo, hi = 0.0, max(c / w for c, w in children) if children else 0.0
    if sum(c for c, _ in children) <= budget:
        return [c for c, _ in children]
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(c, w * mid) for c, w in children) > budget:
            hi = mid
        else:
            lo = mid
    return [min(c, w * lo) for c, w in children]


def test_budgets_match_water_filling(spark):
    rng = random.Random(3)
    rows = [(f"d{d}", lang, f"s{s}", rng.choice([0, 3, 50, 400, 9000])) for d in range(3) for lang in ("en", "fr") for s in range(4)]
    leaves = spark.createDataFrame(rows, "domain string, language string, source string, available long")
    plan = mixing.MixPlan(0.5, 1, "t", {"d0": 5, "d1": 1}, {"en": 3}, {"s0": 2})
    got = {(r["domain"], r["language"], r["source"]): r["leaf_budget"] for r in mixing.allocate(leaves, plan).collect()}
    cap = {r[:3]: r[3] for r in rows}
    w = lambda level, n: plan.weights(level).get(n, 1)
    total = sum(cap.values())
    doms = sorted({r[0] for r in rows})
    for d, bd in zip(doms, fill(total // 2, [(sum(v for k, v in cap.items() if k[0] == d), w("domain", d)) for d in doms]), strict=True):
        langs = sorted({r[1] for r in rows})
        for la, bl in zip(langs, fill(bd, [(sum(v for k, v in cap.items() if k[:2] == (d, la)), w("language", la)) for la in langs]), strict=True):
            leaf = sorted(k for k in cap if k[:2] == (d, la))
            for k, b in zip(leaf, fill(bl, [(cap[k], w("source", k[2])) for k in leaf]), strict=True):
                assert abs(got[k] - b) <= 3, (k, got[k], b)
    assert total // 2 - len(rows) - 10 <= sum(got.values()) <= total // 2


def test_mix_selects_prefixes(spark):
    rng = random.Random(4)
    texts = [(i, " ".join("w" for _ in range(rng.randint(0, 40)))) for i in range(300)] + [(900, None), (901, ""), (None, "a b"), (5, "w w")]
    plan = mixing.MixPlan(1.3, 2, "seed", {"d0": 6}, {}, {})
    df = docs_of(spark, texts, ["epoch", "available", "_key"]).withColumn("source", F.when(F.col("doc_id") == 7, None).otherwise(F.col("source")))
    out = mixing.mix(df, plan).collect()
    tokens = {}
    for r in mixing.document_tokens(df).collect():
        tokens.setdefault((r["domain"], r["language"], r["source"]), []).append((r["doc_id"], r["n_tokens"]))
    taken = {}
    for r in out:
        taken.setdefault((r["domain"], r["language"], r["source"], r["epoch"]), []).append((r["doc_id"], r["n_tokens"]))
    budget = {(r["domain"], r["language"], r["source"]): r["leaf_budget"] for r in out}
    for leaf, b in budget.items():
        avail = sum(n for _, n in tokens[leaf])
        full = min(2, b // avail)
        for e in range(full):
            assert sorted(taken[(*leaf, e)], key=str) == sorted(tokens[leaf], key=str)
        rest = b - full * avail
        key = lambda d: hashlib.md5(f"seed:{full}:{'null' if d is None else d}".encode()).hexdigest()  # noqa: E731, B023
        order, run, want = sorted(tokens[leaf], key=lambda x: key(x[0])), 0, []
        groups = {}
        for d, n in order:
            groups.setdefault(key(d), []).append((d, n))
        for k in sorted(groups):
            run += sum(n for _, n in groups[k])
            if rest and run <= rest:
                want += groups[k]
        assert sorted(taken.get((*leaf, full), []), key=str) == sorted(want, key=str)


def test_mix_empty(spark):
    assert mixing.mix(docs_of(spark, []), mixing.QUERY_PLAN).count() == 0


# ---- syncmers --------------------------------------------------------------------

def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def signed(v):
    return v - 2 ** 64 if v >= 2 ** 63 else v


def chain(values):
    """Spark's xxhash64 over longs, each seeded by the hash before."""
    h = 42
    for v in values:
        h = xx(v.to_bytes(8, "little", signed=True), h)
        h &= 2 ** 64 - 1
    return h


def brute_anchors(text, k=syncmers.K):
    tok = [signed(xx(t.encode())) for t in re.findall(r"[^\x20\x09-\x0d]{1,16}", text)]
    if not tok:
        return []
    if len(tok) < k:
        return [chain(tok) & 0xFFFFFFFF]
    sm = [signed(chain([a, b])) for a, b in zip(tok, tok[1:], strict=False)]
    return [chain(tok[i:i + k]) & 0xFFFFFFFF for i in range(len(tok) - k + 1)
            if min(sm[i:i + k - 1]) in (sm[i], sm[i + k - 2])]


def test_fingerprints_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "SLICE_BYTES", 1500)
    rng = random.Random(8)
    words = ["alpha", "beta", "gämma", "δ", "中文字", "x" * 40, "the", "of"]
    texts = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    texts += [(500, None), (501, ""), (502, "one two"), (503, "𝒳𝒴 " * 30), (504, texts[3][1]), (505, texts[3][1])]
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs_of(spark, texts, ["_text", "_slice", "_next"])).collect()}
    order = sorted(texts)
    hexes = lambda a: "".join(f"{v:08x}" for v in a)
    jac = lambda a, b: 1.0 if not (a or b) else len(set(a) & set(b)) / len(set(a) | set(b))
    for at, (i, t) in enumerate(order):
        t, nxt = t or "", order[(at + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, e, n = brute_anchors(t), brute_anchors(edited), brute_anchors(nxt)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (hexes(a), hexes(e))
        assert r["near_edited"] == pytest.approx(jac(a, e)) and r["near_next"] == pytest.approx(jac(a, n))


def test_fingerprints_edge_tables(spark):
    assert syncmers.fingerprints(docs_of(spark, [])).count() == 0
    one = syncmers.fingerprints(docs_of(spark, [(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    many = syncmers.fingerprints(docs_of(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)])).collect()
    assert len(many) == 4


def test_anchors_are_context_free(spark):
    rng = random.Random(9)
    body = " ".join(f"w{rng.randint(0, 999)}" for _ in range(200))
    df = spark.createDataFrame([(1, body), (2, "some other words in front " + body)], T.StructType.fromDDL("doc_id long, text string"))
    a, b = (set(r["x"]) for r in df.orderBy("doc_id").select(syncmers.anchors(F.col("text")).alias("x")).collect())
    assert a <= b and 30 <= len(a) <= 70
    m = syncmers.positional_matches(df.filter("doc_id = 1"), df.filter("doc_id = 2")).orderBy(F.desc("n")).first()
    assert m["n"] >= 0.8 * len(a)


def test_slices_follow_bytes_for_any_ids(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "SLICE_BYTES", 1000)
    rng = random.Random(12)
    text = lambda i: f"t{i} " + "x" * rng.randint(0, 60)
    hashed = lambda t: signed(xx(t.encode()))
    tables = {"long": [(None, text(i)) for i in range(200)] + [(7, text(i)) for i in range(150)] + [(7, "same")] * 150 + [(i, text(i)) for i in range(100)],
              "string": [(f"id-{i}", text(i)) for i in range(300)] + [("id-5", "same")] * 200 + [(None, None)] * 100,
              "decimal(20,2)": []}
    for coarse in (4096, 4):  # the second cuts the slices of the driver again
        monkeypatch.setattr(syncmers, "COARSE", coarse)
        for kind, data in tables.items():
            df = spark.createDataFrame(data, f"doc_id {kind}, text string")
            rows, _ = syncmers.with_next(df)
            got = rows.filter("_mark = 0").select("_id", "_text", "_next", "_slice").collect()
            want = sorted(((i is not None, i if i is not None else 0), hashed(t or ""), t or "") if kind == "long"
                          else ((i is not None, i or ""), hashed(t or ""), t or "") for i, t in data)
            pairs = sorted((k[0], k[2], want[(at + 1) % len(want)][2]) for at, k in enumerate(want))
            blank = 0 if kind == "long" else ""
            assert sorted(((r["_id"] is not None, blank if r["_id"] is None else r["_id"]), r["_text"], r["_next"]) for r in got) == pairs
            if data:
                sizes = {}
                for r in got:
                    sizes[r["_slice"]] = sizes.get(r["_slice"], 0) + len(r["_text"]) + 64
                assert len(sizes) >= 8 and max(sizes.values()) <= sum(sizes.values()) / 6, (kind, coarse, sizes)


def test_positions_of_repeated_and_common_anchors(spark):
    rng = random.Random(13)
    body = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(80))
    docs = docs_of(spark, [(i, f"{body} only{i} {body}") for i in range(40)] + [(90, None), (None, body)])
    once, twice = (len(brute_anchors(t)) for t in (body, f"{body} only3 {body}"))
    got = syncmers.positional_matches(docs.filter("doc_id >= 3"), docs.filter("doc_id < 3 or doc_id is null")).collect()
    best = {}
    for r in got:
        best[r["left_id"]] = max(best.get(r["left_id"], 0), r["n"])
        assert r["right_id"] in (0, 1, 2) and 0 <= r["first"] <= r["last"] < twice
    # the anchors across the middle word may differ in number, so the second half may have its own offset
    assert set(best) == set(range(3, 40)) and min(best.values()) >= once
    by = {}
    for r in got:
        by[r["left_id"]] = by.get(r["left_id"], 0) + r["n"]
    assert min(by.values()) >= 2 * once and max(by.values()) <= twice  # at most one match per anchor


def test_short_texts_without_syncmers_are_not_alike(spark, tmp_path):
    from tidemark.llm.queries import QUERIES
    rng = random.Random(10)
    short = [" ".join(f"v{rng.randint(0, 9999)}" for _ in range(n)) for n in range(9, 15) for _ in range(40)]
    bare = [t for t in short if not brute_anchors(t)]
    assert len(bare) > 20
    texts = list(enumerate(bare)) + [(1000, ""), (1001, " \n"), (1002, bare[0]), (1003, bare[0])]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op9_closed_syncmers"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(bare):
        tok = [signed(xx(w.encode())) for w in t.split()]
        least = min(signed(chain(tok[k:k + syncmers.K])) for k in range(len(tok) - syncmers.K + 1))
        assert got[i]["fingerprint"] == f"{least & 0xFFFFFFFF:08x}"
        assert got[i]["near_next"] == 0.0  # different texts, and the empty text after the last
    assert got[1000]["fingerprint"] == got[1001]["fingerprint"] == "" and got[1000]["near_next"] == 1.0
    assert got[1001]["near_next"] == 0.0 and got[1002]["near_next"] == 1.0
