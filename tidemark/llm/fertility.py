"""Tokeniser fertility as a quality rule.

Two public vocabularies measure every whole text: the byte-level one for many
languages gives characters per token and the entropy of the token
distribution, the piece vocabulary gives the share of byte-fallback tokens
among all tokens of the words (each word encoded on its own; white space is
not counted).  Rejection bands are set per language (the
script where the language is null) and length class, from all documents: the
median, plus or minus a multiple of the distance from the median to the
quartile on the side that junk does not reach.  Length classes are half
octaves of the token count.  In a class with fewer than ``LEAST_ROWS``
documents the limits of characters per token and byte share are those of the
language over all lengths, and that of the entropy those of the length class
over all languages; with fewer there, those of all documents (the entropy then
at most a share of what the length class can reach).  Texts under ``SHORT`` tokens have noisy measures: their
band of characters per token is twice as wide, and their entropy is held
against a share of the most it can be.

The base rule rejects texts under ten words or with over 20 % of their words
in repeated five-word windows.  Words are runs of other characters than the
six ASCII white-space characters.

Defined cases: a null or empty text has no words and fails the base rule; ids
may be null or repeat (each row is judged on its own text); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_arrow, written
from .ngrams import code_points
from .shingle_join import _SPACE, mix, word_hashes

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
LEAST_ROWS = 50
#: Half-widths of the bands in quartile distances, and the least half-width.
CHARS_WIDTH, CHARS_LEAST = 6.0, 0.12
ENTROPY_WIDTH, ENTROPY_LEAST = 6.0, 0.35
BYTES_WIDTH, BYTES_LEAST = 10.0, 0.03
SHORT, SHORT_ENTROPY = 64, 0.6
MEASURES = ("chars_per_token", "token_entropy", "byte_share")

_WORDS = re.compile(WORD)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
          "chars_per_token double, token_entropy double, byte_share double")


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    words = word_hashes(data, lower=False)
    lines = [s for s in text.split("\n") if s.strip(" \t\r\x0b\x0c")]
    again = 0
    if len(words) > WINDOW:
        h = np.zeros(len(words) - WINDOW + 1, np.uint64)
        for i in range(WINDOW):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i: len(h) + i])
        _, of, n = np.unique(h, return_inverse=True, return_counts=True)
        again = int((np.convolve(n[of] > 1, np.ones(WINDOW, np.int64)) > 0).sum())
    return len(words), int((inside & ((b & 0xC0) != 0x80)).sum()), int(_SYMBOL[b].sum()), len(lines) - len(set(lines)), again


class Vocabularies:
    """The two vocabularies of one Python worker; the word cache is bounded
    and only saves time, as does the table of the characters that have a
    piece (one byte per code point)."""

    def __init__(self, bytes_path: str, pieces_path: str, max_words: int = 200_000):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(bytes_path, "rb") as f:
            ranks = {base64.b64decode(a): int(r) for a, r in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("byte_bpe_multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.fallback = frozenset(i for i in range(self.pieces.get_piece_size()) if self.pieces.is_byte(i))
        self.spelt = np.full(0x110000, -1, np.int8)  # -1 unknown, 0 has a piece, 1 alone it is spelt in bytes
        self.spelt[[*range(0x09, 0x0E), 0x20]] = 0   # white space is in no word
        self.words: dict[str, tuple[int, int]] = {}
        self.max_words = max_words

    def entropy(self, text: str) -> tuple[int, float]:
        """Tokens, and bits per token of their distribution."""
        ids = np.array(self.bytes.encode_ordinary(text), np.int64)
        if not len(ids):
            return 0, 0.0
        n = np.unique(ids, return_counts=True)[1] / len(ids)
        return len(ids), float(-(n * np.log2(n)).sum()) + 0.0

    def fallback_share(self, text: str) -> float:
        """Byte-fallback tokens over tokens of the words of the whole text.

        The vocabulary does not rewrite characters, and one that has a piece
        of its own is never spelt in bytes: a text of such characters only
        has the share 0, whatever its tokens are.
        """
        points = code_points(text).astype(np.int64)
        unknown = np.unique(points[self.spelt[points] < 0])
        for p in unknown.tolist():
            self.spelt[p] = 0xD800 <= p < 0xE000 or any(i in self.fallback for i in self.pieces.encode(chr(p)))
        if not self.spelt[points].any():
            return 0.0
        words = _WORDS.findall(text.encode("utf-8", "replace").decode())
        new = list(set(words).difference(self.words))
        fresh = {w: (len(ids), sum(i in self.fallback for i in ids)) for w, ids in zip(new, self.pieces.encode(new, num_threads=1), strict=True)}
        of = [self.words.get(w) or fresh[w] for w in words]
        if len(self.words) < self.max_words:
            self.words.update((w, n) for w, n in fresh.items() if len(w) <= 40)
        return sum(b for _, b in of) / sum(n for n, _ in of)


_LOADED: dict[tuple, Vocabularies] = {}


def _measure(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    v = _LOADED.get(paths) or _LOADED.setdefault(paths, Vocabularies(*paths))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64()] * 6 + [pa.float64()] * 3
    for b in batches:
        rows = []
        for t in b.column(b.num_columns - 1):
            t = t.as_py() or ""
            n, h = v.entropy(t)
            rows.append((*base_measures(t), n, len(t) / n if n else 0.0, h, v.fallback_share(t)))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 9, types, strict=True))],
                                         [*b.schema.names[:-1], *names])


def script(text: Column) -> Column:
    """The first script, in a fixed order, that a letter of the text has."""
    names = ("Latin", "Cyrillic", "Han", "Arabic", "Devanagari", "Greek", "Hebrew", "Hangul", "Thai")
    out = F.lit("other")
    for n in reversed(names):
        out = F.when(text.rlike(rf"\p{{Is{n}}}"), F.lit(n)).otherwise(out)
    return out


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """Base and fertility measures of every row; ``band`` is its language or script."""
    if vocabularies is None:
        import public_tokenizers

        vocabularies = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    text = F.col(text_col).cast("string")
    band = F.coalesce(F.col(lang_col).cast("string"), script(text))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(band, F.lit("other")).alias("band"), text.alias("_text"))
    return map_arrow(rows, lambda it: _measure(it, vocabularies), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, band string, {SCHEMA}")


def _quartiles(rows: DataFrame, *by: str) -> DataFrame:
    q = lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(c)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[q(c) for c in MEASURES])


def bands(measured: DataFrame) -> DataFrame:
    """One row per band and length class: the least and most that each
    measure may be (null: no limit of its own)."""
    rows = measured.filter("n_tokens > 0")
    own = _quartiles(rows, "band", "length_class").select("band", "length_class", F.struct("n", *MEASURES).alias("_own"))
    by_band = _quartiles(rows, "band").select("band", F.struct("n", *MEASURES).alias("_band"))
    by_length = _quartiles(rows, "length_class").select("length_class", F.struct("n", *MEASURES).alias("_length"))
    every = _quartiles(rows).select(F.struct("n", *MEASURES).alias("_all"))  # one row
    j = own.join(by_band, "band").join(by_length, "length_class").crossJoin(F.broadcast(every))
    wide = {"chars_per_token": "_band", "byte_share": "_band", "token_entropy": "_length"}

    def at(c, i):
        use = F.when(F.col("_own.n") >= LEAST_ROWS, F.col(f"_own.{c}")).when(F.col(f"{wide[c]}.n") >= LEAST_ROWS, F.col(f"{wide[c]}.{c}"))
        return F.get(use.otherwise(F.col(f"_all.{c}")), F.lit(i))
    short = F.col("length_class") < int(2 * np.log2(SHORT))

    def half(c, width, least):  # junk lies below the median: the upper quartile gives the spread
        return F.greatest(width * (at(c, 2) - at(c, 1)), F.lit(least))
    chars = half("chars_per_token", CHARS_WIDTH, CHARS_LEAST) * F.when(short, 2.0).otherwise(1.0)
    entropy = at("token_entropy", 1) - half("token_entropy", ENTROPY_WIDTH, ENTROPY_LEAST)
    # entropy grows with the length: the limit of all documents may be out of reach of a short class
    entropy = F.when(F.greatest("_own.n", "_length.n") >= LEAST_ROWS, entropy).otherwise(F.least(entropy, SHORT_ENTROPY * F.col("length_class") / 2))
    return j.select("band", "length_class", (at("chars_per_token", 1) - chars).alias("chars_per_token_least"),
                    (at("chars_per_token", 1) + F.greatest(2 * chars, F.lit(4 * CHARS_LEAST))).alias("chars_per_token_most"),
                    F.when(~short, entropy).alias("token_entropy_least"),
                    (at("byte_share", 1) + half("byte_share", BYTES_WIDTH, BYTES_LEAST)).alias("byte_share_most"))


def judge(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: base measures, ``base_failed``, ``kept`` and the
    fertility measures.  The measures are written once; the bands and the
    verdicts read them, never the texts again."""
    m = measure(docs, **columns).withColumn("length_class", F.when(F.col("n_tokens") > 0, F.floor(2 * F.log2("n_tokens")).cast("int")).otherwise(F.lit(-1)))
    m = written(m, "fertility")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    j = m.join(bands(m), ["band", "length_class"], "left")
    entropy_least = F.coalesce("token_entropy_least", F.when(F.col("n_tokens") < SHORT, SHORT_ENTROPY * F.log2("n_tokens")))
    checks = (F.col("chars_per_token") < F.col("chars_per_token_least"), F.col("chars_per_token") > F.col("chars_per_token_most"),
              F.col("token_entropy") < entropy_least, F.col("byte_share") > F.col("byte_share_most"))
    out = F.lit(False)
    for c in checks:  # no limit: no rejection
        out = out | F.coalesce(c, F.lit(False))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                    (~failed & ~out).alias("kept"), "n_tokens", *MEASURES, "band", "length_class")
