"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic net,
calibrated by a temperature.

Features are hashed character 1- to 3-grams of the whole lower-cased text.
The model is fitted on the driver from a bounded sample of labelled rows
(``limit`` per language, whose feature counts the executors compute);
everything else covers all documents.

Defined cases: a null text or one without a letter is ``und`` with score 0,
as is every text if no row is labelled; with one language that language has
score 1; ids may be null or repeat (such rows are scored like any other); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, stratified_sample
from .ngrams import count_batches, counts

ORDERS = (1, 2, 3)
BITS = 16
#: Labelled rows per language that the model is fitted on, and of all languages
#: together (the documented bounds): with more than ``TOTAL / LIMIT`` languages
#: each has an equal part of ``TOTAL``.
LIMIT = 1500
TOTAL = 24_000
UND = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray            # per slot
    weights: np.ndarray        # (slots + 1, languages); the last row is the bias
    temperature: float = 1.0

    def features(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[slots]
        return x / max(float(np.sqrt((x * x).sum())), 1e-12)

    def logits(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.features(slots, n) @ self.weights[slots] + self.weights[-1]

    def probabilities(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        return softmax(self.logits(slots, n) / self.temperature)


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], n_slots: int, n_classes: int, alpha: float, beta: float,
         l1: float, l2: float, epochs: int, seed: int) -> np.ndarray:
    """Weights (slots + bias, classes) by per-coordinate FTRL-proximal.

    ``samples`` are (slots, values, class).  L1 keeps a coordinate at zero
    until its summed gradient exceeds ``l1``; L2 shrinks the rest.
    """
    z, n = np.zeros((n_slots + 1, n_classes)), np.zeros((n_slots + 1, n_classes))

    def solved(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            slots, x, y = samples[k]
            at, x = np.append(slots, n_slots), np.append(x, 1.0)
            zi, ni = z[at], n[at]
            w = solved(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p
            g2 = g * g
            z[at] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[at] = ni + g2
    return solved(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss (golden-section search on its log)."""
    def loss(t):
        v = logits / np.exp(t)
        top = v.max(axis=1)
        return float((np.log(np.exp(v - top[:, None]).sum(axis=1)) + top - v[np.arange(len(y)), y]).mean())
    lo, hi, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(50):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02,
        l2: float = 0.02, epochs: int = 2, calibrate: float = 0.2, seed: int = 1) -> Model:
    """``rows``: (language, slots, counts).  The last ``calibrate`` share, in
    the given order, sets the temperature only."""
    languages = sorted({r[0] for r in rows})
    df = np.zeros(1 << BITS)
    for _, slots, _ in rows:
        df[slots] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    model = Model(languages, idf.astype(np.float32), np.zeros(((1 << BITS) + 1, len(languages)), np.float32))
    if len(languages) < 2:
        return model
    place = {v: i for i, v in enumerate(languages)}
    samples = [(s, model.features(s, n), place[lang]) for lang, s, n in rows]
    held = int(len(samples) * calibrate)
    learn = samples[: len(samples) - held] or samples
    model.weights = ftrl(learn, 1 << BITS, len(languages), alpha, beta, l1, l2, epochs, seed).astype(np.float32)
    check = samples[len(samples) - held:] or samples
    model.temperature = temperature(np.array([x @ model.weights[s] + model.weights[-1] for s, x, _ in check]), np.array([y for *_, y in check]))
    return model


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limit: int = LIMIT,
          total: int = TOTAL) -> Model | None:
    """A model from at most ``limit`` rows per language and about ``total`` in
    all, at least one per language (None: no labelled row)."""
    sample = stratified_sample(labelled.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"), F.col(lang_col).cast("string").alias("_lang"))
                               .filter(F.col("_t").rlike(r"\p{L}")), "_id", "_lang", limit, "langid-1", total=total)
    got = map_arrow(sample.select("_h", "_lang", "_t"), lambda it: count_batches(it, ORDERS, BITS, True),
                    "h long, label string, slots binary, counts binary").collect()
    limit = max(1, min(limit, total // max(1, len({r["label"] for r in got}))))
    rows, taken = [], {}
    for r in sorted(got, key=lambda r: (r["h"], r["label"], r["slots"])):
        taken[r["label"]] = taken.get(r["label"], 0) + 1
        if taken[r["label"]] <= limit:
            rows.append((r["label"], np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["counts"], "<i4")))
    return fit(rows) if rows else None


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None, text: str, letter: str, keep: list[str], out: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, scores = [], []
        for t, lettered in zip(b.column(text), b.column(letter).to_pylist(), strict=True):
            if not lettered or model is None:
                langs.append(UND)
                scores.append(0.0)
                continue
            p = model.probabilities(*counts(t.as_py().lower(), ORDERS, BITS))
            k = int(p.argmax())
            langs.append(model.languages[k])
            scores.append(min(1.0, float(p[k])))
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*keep, *out])


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text",
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` with the predicted language and its probability
    (``out``, which replace columns of those names) of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one row of weights per hash slot
    keep = [c for c in keep if c not in out]
    own, letter = free_name(keep, "_text"), free_name(keep, "_letter")
    reuse = text_col in keep and docs.schema[text_col].dataType.simpleString() == "string"
    extra = [] if reuse else [F.col(text_col).cast("string").alias(own)]
    rows = docs.select(*keep, *extra, F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)).alias(letter))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep)
    source = text_col if reuse else own
    return map_arrow(rows, lambda it: _predict(it, shared.value, source, letter, keep, out), f"{types}{', ' if types else ''}`{out[0]}` string, `{out[1]}` double")
