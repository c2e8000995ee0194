"""Spelling variants: words one edit apart, found through pivotal bigrams.

``word_counts`` counts the letter runs of whole texts, ``near_pairs`` finds
all pairs of words at edit distance one, ``variants`` names each word's form
and root.

Method.  The bigrams of the vocabulary have one order, rarest first.  A word's
*prefix* is its three first bigrams in that order (with all that tie with the
third); two disjoint ones among them, chosen by dynamic programming for the
least total frequency, are its *pivots*.  One edit touches at most one of two
disjoint bigrams, so of two near words the one whose prefix ends earlier in
the order has a pivot that stands, intact, in the other's prefix.  Position
limits: left of the second pivot nothing has changed if the edit lies in it or
behind it, so the first pivot stands at the same place behind the same
letters; otherwise the second pivot stands at the same distance from the end
before the same letters.  Both are equi-joins on the letters up to, or from,
the pivot; every candidate is verified by its exact edit distance.

Defined cases: null or empty texts have no words; a null id counts as the
empty string in the seeded deletion; equal rows count as often as they occur;
an empty table gives an empty result with the same columns; other columns of
the input, whatever their names, are ignored.  Texts are read whole; a very
long text is counted in one pass that holds its distinct runs only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.patterns import resolve_key_chains
from ..operators.sizing import checked_broadcast
from .common import map_arrow, written

#: Letters of a run: the two basic alphabets and the letters of Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
#: Code points of the alphabet after lower-casing A-Z: bounds the bigrams.
ALPHABET = 26 + 64
#: Distinct runs that a task holds before it hands its counts on.
HELD_RUNS = 300_000
#: A text above this many characters is scanned run by run, without a list.
LISTED_CHARS = 1 << 22

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_GRAMS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("chars", pa.int32()), ("last", pa.int32()),
                    ("pivot", pa.bool_()), ("key", pa.string()), ("head", pa.string())])


# ---- words ---------------------------------------------------------------------

def thin(word: str, seed: bytes, every: int) -> str:
    """``word`` without one code point where ``every`` divides the crc32 of
    ``seed`` and the word."""
    h = zlib.crc32(word.encode(), zlib.crc32(seed))
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _count(batches: Iterator[pa.RecordBatch], least: int, every: int) -> Iterator[pa.RecordBatch]:
    run = re.compile(f"[{LETTERS}]{{{least},}}")  # a maximal run is found whole or, if shorter, not at all
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=_COUNTS)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            low = text.as_buffer().to_pybytes().lower().decode()  # bytes.lower() changes A-Z only
            runs = Counter(run.findall(low) if len(low) <= LISTED_CHARS else (m[0] for m in run.finditer(low)))
            seed = f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode()
            for word, n in runs.items():
                word = thin(word, seed, every) if every else word
                if len(word) >= least:
                    counts[word] += n
            if len(counts) >= HELD_RUNS:
                yield out()
                counts.clear()
    yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_n: int = 2,
                thin_every: int = 0) -> DataFrame:
    """``(word, n)``: runs of letters of at least ``min_chars`` code points,
    A-Z lower-cased, with at least ``min_n`` occurrences.  ``thin_every``
    deletes one letter where it divides the seeded hash of id and run."""
    counted = map_arrow(docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")),
                        partial(_count, least=min_chars, every=thin_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


# ---- pivotal bigrams -------------------------------------------------------------

def prefix(word: str, rank: dict[str, int]) -> list[tuple[int, int]]:
    """``(rank, position)`` of the three rarest bigrams, with ties of the
    third, in the order of their positions."""
    grams = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][0]
    return sorted((g for g in grams if g[0] <= last), key=lambda g: g[1])


def pivots(grams: list[tuple[int, int]], weight: list[int], parts: int = 2, q: int = 2) -> list[tuple[int, int]]:
    """The ``parts`` pairwise disjoint grams of least total weight, by dynamic
    programming over the grams in the order of their positions."""
    best = [(weight[r], [(r, i)]) for r, i in grams]
    for _ in range(parts - 1):
        step = []
        for j, (r, i) in enumerate(grams):
            before = [best[k] for k in range(j) if best[k] and grams[k][1] + q <= i]
            step.append(min(((c + weight[r], p + [(r, i)]) for c, p in before), default=None))
        best = step
    return min(b for b in best if b)[1]


def _signatures(batches: Iterator[pa.RecordBatch], weights: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    rank = {g: k for k, (g, _) in enumerate(weights)}
    weight = [n for _, n in weights]
    for batch in batches:
        rows = []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            grams = prefix(word, rank)
            last = max(r for r, _ in grams)
            fixed = (word, n, len(word), last)
            for _, i in grams:
                rows.append((*fixed, False, "<" + word[:i + 2], ""))
                rows.append((*fixed, False, ">" + word[i:], ""))
            (_, first), (_, second) = pivots(grams, weight)
            rows.append((*fixed, True, "<" + word[:first + 2], word[:second]))
            rows.append((*fixed, True, ">" + word[second:], ""))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, _GRAMS.types, strict=True)],
                                         schema=_GRAMS)


def bigram_weights(words: DataFrame) -> list[tuple[str, int]]:
    """Bigrams of the vocabulary and how often they occur, rarest first: at
    most ``ALPHABET`` squared rows, the one list that reaches the driver."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("gram"))
    return [(r["gram"], r["n"]) for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram").limit(ALPHABET ** 2).collect()]


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: every pair of words of ``words(word, n)`` that
    differ by one inserted, deleted or replaced code point, once, ``a < b``.

    ``words`` holds each word once, of at least four letters of the alphabet;
    it is read twice, so pass a written table."""
    signed = written(map_arrow(words, partial(_signatures, weights=bigram_weights(words)),
                               "word string, n long, chars int, last int, pivot boolean, key string, head string"), "pivots")
    p = signed.filter("pivot").select("key", "head", *[F.col(c).alias(f"p_{c}") for c in ("word", "n", "chars", "last")])
    x = signed.filter("not pivot").select("key", *[F.col(c).alias(f"x_{c}") for c in ("word", "n", "chars", "last")])
    near = p.join(x, (p["key"] == x["key"]) & (F.abs(p["p_chars"] - x["x_chars"]) <= 1) & (p["p_last"] <= x["x_last"])
                  & F.startswith(x["x_word"], p["head"]) & (F.levenshtein("p_word", "x_word", 1) == 1))
    first = F.col("p_word") < F.col("x_word")
    return near.select(F.when(first, F.col("p_word")).otherwise(F.col("x_word")).alias("a"), F.when(first, F.col("p_n")).otherwise(F.col("x_n")).alias("n_a"),
                       F.when(first, F.col("x_word")).otherwise(F.col("p_word")).alias("b"),
                       F.when(first, F.col("x_n")).otherwise(F.col("p_n")).alias("n_b")).distinct()


# ---- forms -----------------------------------------------------------------------

def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a written ``words(word,
    n)``: the form is the near word of largest ``n`` (ties: the smallest) if
    it occurs at least ``ratio`` times as often; the root ends the chain of
    forms.  A chain cannot be longer than the digits of the largest ``n``."""
    pairs = written(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("_near"), F.col("n_b").alias("_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("_near"), F.col("n_a").alias("_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_n")).alias("_m"), F.col("_near"))).alias("_best"))
    told = words.join(best, "word", "left")
    is_form = -F.col("_best._m") >= ratio * F.col("n")
    told = written(told.select("word", F.when(is_form, F.col("_best._near")).alias("form"), "n",
                               F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, -F.col("_best._m")).alias("form_n")), "forms")
    chains = resolve_key_chains(told.filter("form is not null"), "word", "form").withColumnsRenamed({"old_key": "word", "new_key": "_root"})
    return told.join(checked_broadcast(chains), "word", "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_chars: int = 7, min_n: int = 2, ratio: int = 10, thin_every: int = 0) -> DataFrame:
    """The words of ``docs(doc_id, text)`` with their forms and roots."""
    return variants(written(word_counts(docs, min_chars=min_chars, min_n=min_n, thin_every=thin_every), "words"), ratio)
