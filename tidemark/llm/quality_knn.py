"""Quality by nearest-neighbour voting over labelled latent-semantic vectors.

Terms are hashed character 1- and 2-grams, 1- to 4-grams of the text's shape
(case, letter, digit and the marks themselves), and steps of the share of
words that repeat the word before.  TF-IDF vectors of a bounded sample of
labelled rows give a truncated singular value decomposition; its first
direction (the mean text) is left out, and rows are scaled to length 1.  The
labelled vectors and the projection are broadcast (``2 * LIMIT`` rows at
most); every document is projected, its cosine with every labelled vector is
computed exactly in blocks, and its ``K`` nearest neighbours vote with the
weight ``cosine ** POWER``, times a factor that undoes the balanced sampling.

Defined cases: a null, empty or blank text has no direction and gets the
share of label 1 in the labelled rows; without labelled rows every score is
0.5; labels without a document are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import operator
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, stratified_sample
from .ngrams import code_points, hashed_points

BITS = 12
STEPS = 16
TERMS = 2 * (1 << BITS) + STEPS
#: Labelled rows per class that are fitted and broadcast (the documented bound).
LIMIT = 1200
RANK = 32
K = 15
POWER = 8
BLOCK = 512

_SHAPE: np.ndarray | None = None


def _shape_table() -> np.ndarray:
    global _SHAPE
    if _SHAPE is None:
        t = np.arange(0x10000, dtype=np.uint64)
        for i in range(0x10000):
            c = unicodedata.category(chr(i))
            if c[0] in "LN":
                t[i] = 1 if c == "Lu" else 2 if c[0] == "L" else 3
        _SHAPE = t
    return _SHAPE


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of a text's terms."""
    a = code_points(text)
    shape = _shape_table()[np.minimum(a, 0xFFFF).astype(np.int64)]
    size = 1 << BITS
    n = np.bincount(np.concatenate([hashed_points(a, (1, 2), BITS), hashed_points(shape, (1, 2, 3, 4), BITS) + size]), minlength=TERMS)
    words = text.split()
    again = sum(map(operator.eq, words, words[1:]))
    if again:
        n[2 * size: 2 * size + 1 + min(STEPS - 1, STEPS * again // len(words))] = again
    at = np.flatnonzero(n)
    return at, n[at]


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray      # terms x rank
    vectors: np.ndarray    # labelled rows x rank, of length 1
    labels: np.ndarray
    weight: np.ndarray     # per labelled row
    prior: float

    def project(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[slots]
        return unit(x.astype(np.float32) @ self.basis[slots])

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        out = np.full(len(vectors), self.prior)
        k = min(K, len(self.labels))
        if k == 0:
            return out
        for at in range(0, len(vectors), BLOCK):
            cos = vectors[at:at + BLOCK] @ self.vectors.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(cos, near, 1), 0.0).astype(np.float64) ** POWER * self.weight[near]
            total = w.sum(1)
            some = total > 0
            out[at:at + BLOCK][some] = (w * self.labels[near]).sum(1)[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.where(size > 1e-9, v / np.maximum(size, 1e-9), 0.0).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], totals: dict[int, int], rank: int = RANK, seed: int = 7) -> Model:
    """``rows``: (slots, counts, label); ``totals``: labelled rows per class."""
    y = np.array([r[2] for r in rows], np.float64)
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, (slots, n, _) in enumerate(rows):
        x[i, slots] = 1 + np.log(n)
    idf = (np.log((1 + len(rows)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    rank = min(rank, len(rows))
    if rank < 2:
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y[:0], y[:0], prior)
    # randomised subspace iteration
    q = np.random.default_rng(seed).standard_normal((TERMS, min(rank + 8, len(rows)))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    basis = np.ascontiguousarray((q @ v.T[:, :rank])[:, 1:])
    sampled = {c: float((y == c).sum()) for c in (0, 1)}
    weight = np.array([totals.get(int(c), 0) / max(sampled[int(c)], 1.0) for c in y])
    return Model(idf, basis, unit(x @ basis), y, weight, prior)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h", "label", "slots", "counts"]
    for b in batches:
        found = [terms(t.as_py() or "") for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.astype("<i4").tobytes() for s, _ in found], pa.binary()),
                                          pa.array([n.astype("<i4").tobytes() for _, n in found], pa.binary())], names)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> Model:
    """Fit on at most ``limit`` labelled rows per class.  Only ids and labels
    are sampled; their texts come by a join with that bounded list."""
    known = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_y")).filter("_y in (0, 1) and _lid is not null")
    totals = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = []
    for r in sorted(stratified_sample(known, "_lid", "_y", limit, "quality-1").collect(), key=lambda r: (r["_h"], r["_lid"])):
        if sum(c[1] == r["_y"] for c in chosen) < limit:
            chosen.append((r["_lid"], r["_y"], r["_h"]))
    if not chosen:
        return fit([], {})
    spark = docs.sparkSession
    listed = F.broadcast(spark.createDataFrame(chosen, "_lid long, _y int, _h long"))  # at most 2 * limit rows
    rows = docs.select(F.col(id_col).cast("long").alias("_lid"), F.col(text_col).cast("string").alias("_t")).join(listed, "_lid")
    got = map_arrow(rows.select("_h", "_y", "_t"), _term_batches, "h long, label int, slots binary, counts binary").collect()
    got.sort(key=lambda r: (r["h"], r["label"], r["slots"]))
    return fit([(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["counts"], "<i4"), r["label"]) for r in got], totals)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vectors = np.zeros((b.num_rows, model.basis.shape[1]), np.float32)
        for i, text in enumerate(b.column(b.num_columns - 1)):
            text = text.as_py()
            if text and text.strip():
                vectors[i] = model.project(*terms(text))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.vote(vectors), pa.float64())], [*b.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score`` of the whole text (it replaces a column of that name)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by LIMIT, RANK and BITS
    keep = [c for c in keep if c != "score"]
    rows = docs.select(*keep, F.col(text_col).cast("string").alias(free_name(keep, "_text")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, lambda it: _score(it, shared.value), f"{types}, score double")
