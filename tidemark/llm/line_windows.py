"""Line dedup by overlapping three-line windows.

Every run of three consecutive non-blank lines is hashed (MD5 of the lines
joined by newlines).  A window hash found more than once in the corpus keeps
its first occurrence, in the order (doc_id, text hash, position); the
positions covered by later occurrences are merged and their lines removed.
Each removed line has an earlier equal line that itself is kept or removed in
favour of a still earlier one, so one copy of every line stays.

With ``long_words`` a run of one or two non-blank lines of more words than
that is a window as well, so a long passage on few lines is found between
differing lines, and a long text of one or two lines inside a longer one.

DataFrame functions only.  Defined cases: a text with one or two non-blank
lines is one window of those lines (so copies of short documents go, but a
short document matches inside a longer one only by ``long_words``); blank lines are never part
of a window and go only when no other line of the text stays; a null text
stays null; rows that repeat both id and text are one document and get the
same result; an empty table gives no rows.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, written

WINDOW = 3
_WORD_CHAR = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _full_lines(text: Column) -> Column:
    """Structs (i, s) of the non-blank lines, ``i`` the position in the text."""
    return F.filter(F.transform(_lines(text), lambda s, i: F.struct(i.alias("i"), s.alias("s"))),
                    lambda x: x["s"].rlike(_WORD_CHAR))


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
                 long_words: int | None = None) -> DataFrame:
    """``_id, _th, p, lines, h``: one row per window; ``lines`` are the
    positions in the text that it covers."""
    base = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                       _full_lines(F.col(text_col)).alias("_f")).filter(F.size("_f") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_f") - (size - 1), F.lit(1)))

    def runs(starts, size):
        one = lambda p: F.slice("_f", p, size)
        return F.transform(starts, lambda p: F.struct(
            p.alias("p"), F.transform(one(p), lambda x: x["i"]).alias("lines"),
            F.unhex(F.md5(F.concat_ws("\n", F.transform(one(p), lambda x: x["s"])).cast("binary"))).alias("h")))

    def over(k):
        return lambda p: sum((F.element_at("_nw", p + i) for i in range(k)), F.lit(0)) > long_words
    wins = runs(starts, size)
    if long_words is not None:
        base = base.withColumn("_nw", F.transform("_f", lambda x: F.regexp_count(x["s"], F.lit(WORD))))
        for k in range(1, size):  # a text of k lines is its own window already
            at = F.when(F.size("_f") > k, F.sequence(F.lit(1), F.greatest(F.size("_f") - (k - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
            wins = F.concat(wins, runs(F.filter(at, over(k)), k))
    return base.select("_id", "_th", F.explode(wins).alias("w")).select("_id", "_th", "w.*")


def later_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
                long_words: int | None = None) -> DataFrame:
    """``_id, _th, _gone``: the merged line positions that later occurrences
    of repeated windows cover, one row per document that has any.

    The first occurrence of a window comes from a partial aggregate; only
    windows that occur again join back, and adaptive execution splits the
    rows of a window that a large part of the corpus shares.
    """
    wins = written(line_windows(docs, id_col, text_col, size, long_words), "line-windows")
    place = F.struct("_id", "_th", "p")
    first = wins.groupBy("h").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).filter("_first != _last")
    later = wins.join(first.select("h", "_first"), "h").filter(~place.eqNullSafe(F.col("_first")))
    return later.groupBy("_id", "_th").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
                counts: tuple[str, str] = ("_n_lines", "_n_removed"), long_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` with the text shortened, plus the number of
    non-blank lines before and of lines removed (``counts``, which replace
    columns of those names)."""
    gone = later_lines(docs, id_col, text_col, size, long_words)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"))
    j = row.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    text = F.col("row").getField(text_col)
    lines = _lines(text)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: F.get(lines, i))
    n_full = F.when(text.isNull(), 0).otherwise(F.size(F.filter(lines, lambda s: s.rlike(_WORD_CHAR)))).cast("long")
    n_gone = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")
    short = F.when(n_gone == 0, text).when(n_full == n_gone, F.lit("")).otherwise(F.array_join(kept, "\n"))
    columns = [short.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in counts]
    return j.select(*columns, n_full.alias(counts[0]), n_gone.alias(counts[1]))
