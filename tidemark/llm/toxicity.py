"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text.  The ordinary one
holds the words that most ordinary texts use.  The toxic one holds the same
words and the segments that set toxic texts apart: of all segments of 4 to 12
characters, those whose document frequency in toxic text exceeds what
ordinary text predicts by ``Z_LEAST`` standard deviations, picked greedily by
the bytes they save (a word that a picked segment explains no longer counts),
over texts that are not near copies of one another.  (zstandard's own
dictionary trainer covers what is frequent, not what differs; the README has
the recall it gives.)  Training samples rows, never parts of a text: tasks
count the words of whole texts and compress whole texts for the calibration;
the driver receives run hashes, word counts and evidence.  A text is cut at word
ends into windows of about ``WINDOW`` bytes; each window is compressed with
both dictionaries, and the bytes that the toxic one saves are compared with
thresholds.  A logistic regression over the counts of windows beyond each
threshold, fitted on labelled rows that neither dictionary saw, calibrates
the score, so 0.5 is the natural cut.

Defined cases: a null or empty text has no window and gets the score of a
text that shows nothing; if either label is missing from the training rows,
every score is the share of toxic labels (0 without labels); an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, stratified_sample, written

#: Labelled rows per class the model is fitted on (the documented bound); of
#: each, training and scoring read the whole text.
LIMIT = {0: 3000, 1: 1600}
#: Hashes of three-word runs that show near copies among the sampled texts: all
#: of a text with up to so many runs, about so many of a longer one.
RUN_HASHES = 256
#: A longer word counts as overlapping pieces of this length.
LONG_WORD = 64
WINDOW = 48
SEGMENTS = tuple(range(4, 13))
Z_LEAST = 8.0
COMMON_WORDS = 1200
MAX_SEGMENTS = 300
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8)
#: Stands between segments of a dictionary; never part of a window.
GAP = "\x00"


def normal(text: str) -> bytes:
    return (" " + " ".join(text.lower().replace(GAP, " ").split()) + " ").encode("utf-8", "surrogatepass")


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    data, out, at = normal(text), [], 0
    last = len(data) - 1
    while at < last:
        end = at + size
        if end < last:
            k = data.rfind(b" ", at + 1, end)
            end = k if k > 0 else end
        else:
            end = last
        out.append(data[at:end + 1])
        at = end
    return out


# ---- training ------------------------------------------------------------------

def run_hashes(text: str) -> list[int]:
    """Hashes of the text's three-word runs: all, or those below a bound that
    leaves about ``RUN_HASHES`` (texts of like length have like bounds)."""
    w = text.lower().split()
    runs = {xxhash.xxh64_intdigest(" ".join(w[i:i + 3])) >> 1 for i in range(len(w) - 2)}
    return sorted(runs) if len(runs) <= RUN_HASHES else sorted(h for h in runs if h < (RUN_HASHES << 63) // len(runs))


def distinct_rows(rows: list[list[int]], share: float = 0.3) -> list[bool]:
    """Whether each text, in order, is new: not mostly made of runs seen."""
    seen: set[int] = set()
    out = []
    for hashes in rows:
        old = bool(hashes) and sum(h in seen for h in hashes) > share * len(hashes)
        out.append(not old)
        if not old:
            seen.update(hashes)
    return out


def spaced_words(text: str) -> set[str]:
    """The distinct words, each between spaces; a long one as overlapping
    pieces, so that every segment of it is in one of them."""
    out = set()
    for word in text.lower().replace(GAP, " ").split():
        w = f" {word} "
        if len(w) <= LONG_WORD:
            out.add(w)
        else:
            step = LONG_WORD - SEGMENTS[-1] + 1
            out.update(w[i:i + LONG_WORD] for i in range(0, len(w) - SEGMENTS[-1] + 1, step))
    return out


def _segments(w: str) -> set[str]:
    return {w[i:i + k] for k in SEGMENTS for i in range(len(w) - k + 1)}


def toxic_segments(toxic: Counter, n_toxic: int, ordinary: Counter, n_ordinary: int) -> list[str]:
    """Segments that mark toxic text, the most valuable first."""
    share = n_toxic / max(n_ordinary, 1)
    least = max(4.0, 0.012 * n_toxic)
    found: Counter = Counter()
    for w, n in toxic.items():
        for s in _segments(w):
            found[s] += n
    found = Counter({s: n for s, n in found.items() if n >= least})
    wanted = set(found)
    normal_n: Counter = Counter()
    for w, n in ordinary.items():
        for s in _segments(w) & wanted:
            normal_n[s] += n
    expect = {s: (normal_n[s] + 1) * share for s in wanted}

    def telling(s, n):
        return n >= least and n >= 6 * expect[s] and (n - expect[s]) / math.sqrt(expect[s] + 1) >= Z_LEAST

    wanted = {s for s in wanted if telling(s, found[s])}
    held: dict[str, set[str]] = {w: telling_of for w in toxic if (telling_of := _segments(w) & wanted)}
    by_segment = defaultdict(list)
    for w, segs in held.items():
        for s in segs:
            by_segment[s].append(w)
    left = {s: found[s] for s in wanted}
    picked: list[str] = []
    while len(picked) < MAX_SEGMENTS:
        best = max(((n - 3 * expect[s]) * (len(s.encode()) - 2.5), s) for s, n in left.items() if telling(s, n)) if any(
            telling(s, n) for s, n in left.items()) else None
        if best is None:
            break
        picked.append(best[1])
        for w in by_segment[best[1]]:
            for s in held.pop(w, ()):
                left[s] -= toxic[w]
    return picked


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    p = zstd.ZstdCompressionParameters.from_level(
        3, source_size=WINDOW, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False,
        format=zstd.FORMAT_ZSTD1_MAGICLESS, min_match=4, strategy=zstd.STRATEGY_LAZY2)
    d.precompute_compress(compression_params=p)
    return zstd.ZstdCompressor(dict_data=d, compression_params=p)


@dataclass
class Model:
    ordinary: bytes            # dictionary contents
    toxic: bytes
    weights: np.ndarray | None
    prior: float

    def open(self) -> Model:
        if self.weights is not None or self.toxic:
            self._ordinary, self._toxic = _compressor(self.ordinary), _compressor(self.toxic)
        return self

    def saved(self, text: str) -> np.ndarray:
        """Bytes that the toxic dictionary saves, per window."""
        a, b = self._ordinary.compress, self._toxic.compress
        return np.array([len(a(w)) - len(b(w)) for w in windows(text)], np.int64)

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        return float(1 / (1 + math.exp(-max(-60.0, min(60.0, float(evidence(self.saved(text)) @ self.weights))))))


def evidence(saved: np.ndarray) -> np.ndarray:
    return np.array([1.0, math.log1p(len(saved)), *(math.log1p(int((saved >= t).sum())) for t in THRESHOLDS), max(0, int(saved.max(initial=0)))])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionaries(toxic: Counter, n_toxic: int, ordinary: Counter, n_ordinary: int, prior: float) -> Model:
    """The two dictionaries from document frequencies of spaced words."""
    common = [w.strip() for w, _ in sorted(ordinary.items(), key=lambda x: (x[1], x[0])) if w[0] == w[-1] == " "][-COMMON_WORDS:]
    base = GAP.encode() * 8 + (" ".join(common) + " ").encode("utf-8", "surrogatepass")
    marks = toxic_segments(toxic, n_toxic, ordinary, n_ordinary)
    # the shared words stand last in both, so ordinary matches cost the same
    return Model(base, (GAP + GAP.join(reversed(marks)) + GAP).encode("utf-8", "surrogatepass") + base, None, prior)


def calibrate(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    if len(set(y.tolist())) == 2:
        model.weights = logistic(x, y)
        # the sample holds more toxic rows than the labels do: shift to their share, at most to even odds
        odds = (y.sum() / len(y)) / max(1 - y.sum() / len(y), 1e-9)
        true = max(model.prior, 1e-6) / max(1 - model.prior, 1e-6)
        model.weights[0] += min(0.0, math.log(true / odds))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([run_hashes(t.as_py()) for t in b.column(1)], pa.list_(pa.int64()))], names=["n", "runs"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = {y: Counter() for y in (0, 1)}
        for y, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            counts[y].update(spaced_words(t.as_py()))
        rows = [(y, w, n) for y, c in counts.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 3, (
            pa.int32(), pa.string(), pa.int64()), strict=True)], names=["y", "word", "n"])


def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    model.open()
    for b in batches:
        found = [evidence(model.saved(t.as_py())).tolist() for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.float64()))], names=["n", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample of labelled rows.  Half of the toxic and two
    thirds of the ordinary ones train the dictionaries, the rest the
    calibration."""
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_y")).filter("_y in (0, 1) and _lid is not null")
    totals = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    chosen, taken = [], Counter()
    for r in sorted(stratified_sample(known, "_lid", "_y", max(LIMIT.values()), "toxic-1").collect(), key=lambda r: (r["_h"], r["_lid"])):
        if taken[r["_y"]] < LIMIT[r["_y"]]:
            taken[r["_y"]] += 1
            chosen.append((r["_lid"], r["_y"], r["_h"]))
    nothing = Model(b"", b"", None, prior)
    if not chosen:
        return nothing
    listed = F.broadcast(spark.createDataFrame(chosen, "_lid long, _y int, _h long"))  # bounded by LIMIT
    rows = docs.select(F.col(id_col).cast("long").alias("_lid"), F.col(text_col).cast("string").alias("_t")).join(listed, "_lid")
    # the sampled rows, written once; equal rows of one id are one
    sample = written(rows.select("_h", "_y", F.coalesce("_t", F.lit("")).alias("_t")).withColumn("_n", F.xxhash64("_h", "_y", "_t"))
                     .dropDuplicates(["_h", "_y", "_n"]).hint("rebalance"), "toxic-sample")
    runs = {r["n"]: r["runs"] for r in map_arrow(sample.select("_n", "_t"), _runs, "n long, runs array<long>").collect()}
    order = {y: [r["_n"] for r in sorted(sample.select("_h", "_y", "_n").filter(F.col("_y") == y).collect(), key=lambda r: (r["_h"], r["_n"]))] for y in (0, 1)}
    if min(len(x) for x in order.values()) < 2:
        return nothing
    cut = {1: (len(order[1]) + 1) // 2, 0: -(-len(order[0]) * 2 // 3)}
    fresh = {y: [n for n, new in zip(order[y][:cut[y]], distinct_rows([runs[n] for n in order[y][:cut[y]]]), strict=True) if new] for y in (0, 1)}
    mine = F.broadcast(spark.createDataFrame([(n,) for y in (0, 1) for n in fresh[y]], "_n long"))
    counted = map_arrow(sample.join(mine, "_n").select("_y", "_t"), _words, "y int, word string, n long").groupBy("y", "word").agg(F.sum("n").alias("n"))
    words = {0: Counter(), 1: Counter()}
    for r in counted.collect():
        words[r["y"]][r["word"]] = r["n"]
    model = dictionaries(words[1], len(fresh[1]), words[0], len(fresh[0]), prior)
    content = (model.ordinary, model.toxic, None, prior)
    held = F.broadcast(spark.createDataFrame([(n,) for y in (0, 1) for n in order[y][cut[y]:]], "_n long"))
    got = sorted(map_arrow(sample.join(held, "_n").select("_n", "_y", "_t"), lambda it: _evidence(it, Model(*content)), "n long, y int, x array<double>").collect(),
                 key=lambda r: r["n"])
    calibrate(model, np.array([r["x"] for r in got]), np.array([float(r["y"]) for r in got]))
    return model


# ---- scoring -------------------------------------------------------------------

def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    model.open()
    for b in batches:
        scores = [model.score(t.as_py() or "") for t in b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], [*b.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score`` of the whole text (it replaces a column of that name)."""
    content = (model.ordinary, model.toxic, model.weights, model.prior)  # a few kilobytes
    keep = [c for c in keep if c != "score"]
    rows = docs.select(*keep, F.col(text_col).cast("string").alias(free_name(keep, "_text")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, lambda it: _score(it, Model(*content)), f"{types}, score double")
