"""Document fingerprints from closed syncmers of words.

A text is a sequence of tokens (words; runs over 16 code points are cut into
pieces of 16).  Each token has a 64-bit hash, each pair of neighbours an
s-mer hash.  A k-mer of nine tokens holds eight s-mers; it is a closed
syncmer if its smallest s-mer stands first or last.  Whether a k-mer is
chosen depends on its own tokens alone, so an edit changes only the anchors
that overlap it, and about one k-mer in four is chosen.  The fingerprint is
the 32-bit hashes of the chosen k-mers, in text order, as hexadecimal text.

DataFrame functions only.  Defined cases: a null text counts as empty; a text
without tokens has the empty fingerprint; one with fewer tokens than a k-mer
has one anchor, the hash of all its tokens; the likeness of two fingerprints
is the Jaccard coefficient of their anchor sets, 1 if both are empty.  A text
of 9 to 14 tokens may have no closed syncmer.  With ``stand_in`` (the query)
its smallest k-mer is then its anchor, so that only texts without tokens have
the empty fingerprint; without, such a text has it too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 9          # tokens of an anchor
MAX_RUN = 16   # code points of a token
TOKEN = rf"[^\x20\x09-\x0D]{{1,{MAX_RUN}}}"
#: Text bytes of a slice of the document order (a task holds a few slices), up to
#: ``MAX_FINE`` slices; beyond that slices grow with the table instead.
SLICE_BYTES = 8 << 20
MAX_FINE = 1 << 20
#: Slices that the driver cuts itself; more are cut inside these, by Spark.
COARSE = 4096
#: Most cuts of one list (the search takes as many steps as this has bits).
MOST_CUTS = 8191
#: Sampled points per slice that its cut is chosen from.
POINTS = 16


def anchors(text: Column, k: int = K, stand_in: bool = False) -> Column:
    """Array of the 32-bit hashes of the closed syncmers of ``text``; with
    ``stand_in`` that of the smallest k-mer if there are tokens but no
    syncmer (it is no syncmer anywhere, so it only ever equals another)."""
    n_inner = k - 1  # s-mers of two tokens in a k-mer
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), 0), lambda t: F.xxhash64(t))
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF)).cast("long")

    starts_of = lambda tok: F.sequence(F.lit(1), F.size(tok) - (k - 1))

    def chosen(tok: Column, sm: Column) -> Column:
        starts = starts_of(tok)
        smallest = lambda i: F.array_min(F.slice(sm, i, n_inner))
        at_edge = F.filter(starts, lambda i: smallest(i) == F.least(F.element_at(sm, i), F.element_at(sm, i + (n_inner - 1))))
        return F.transform(at_edge, lambda i: low(F.xxhash64(F.slice(tok, i, k))))

    # arrays that are used more than once are bound through a one-element transform, so they are computed once
    bind = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    none = F.array().cast("array<bigint>")
    smallest_of = lambda tok: F.array(low(F.array_min(F.transform(starts_of(tok), lambda i: F.xxhash64(F.slice(tok, i, k))))))
    whole = lambda tok, found: bind(found, lambda c: F.when(F.size(c) == 0, smallest_of(tok)).otherwise(c)) if stand_in else found
    pairs = lambda tok: F.zip_with(F.slice(tok, 1, F.size(tok) - 1), F.slice(tok, 2, F.size(tok) - 1), lambda a, b: F.xxhash64(a, b))
    return F.when(text.isNull() | (text == ""), none).otherwise(bind(tokens, lambda tok: (
        F.when(F.size(tok) == 0, none)
        .when(F.size(tok) < k, F.array(low(F.xxhash64(tok))))
        .otherwise(whole(tok, bind(pairs(tok), lambda sm: chosen(tok, sm)))))))


def fingerprint(anchor_list: Column) -> Column:
    return F.array_join(F.transform(anchor_list, lambda a: F.lower(F.lpad(F.hex(a), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two anchor arrays (distinct anchors)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _place(ids: Column, hashes: Column, at: Column, h: Column) -> tuple[Column, Column]:
    """How many of the ascending cuts (ids, hashes) lie below the key (at, h),
    and how many do not lie above it; null ids come first.  Binary search, as
    an expression, in arrays of at most ``MOST_CUTS`` cuts."""
    halves = F.lit([2 ** i for i in reversed(range(MOST_CUTS.bit_length()))])

    def found(tie) -> Column:
        def step(seen: Column, half: Column) -> Column:
            k = seen + half
            cut, cut_h = F.get(ids, k - 1), F.get(hashes, k - 1)
            under = F.coalesce(cut < at, cut.isNull() & at.isNotNull()) | (cut.eqNullSafe(at) & tie(cut_h, h))
            return F.when((k <= F.size(ids)) & under, k).otherwise(seen)
        return F.aggregate(halves, F.lit(0), step)
    return found(lambda a, b: a < b), found(lambda a, b: a <= b)


def _dealt(rows: DataFrame, ids: Column, hashes: Column, name: str) -> DataFrame:
    """``rows`` with the slice of each row in column ``name``.  Rows that equal
    a run of repeated cuts are equal in id and text, so any of the run's slices
    will do."""
    low, high = _place(ids, hashes, F.col("_id"), F.col("_h"))
    return rows.withColumn("_low", low).withColumn(name, F.col("_low") + F.floor(F.rand(7) * (high - F.col("_low") + 1)).cast("int")).drop("_low")


def _cuts(points: DataFrame, n: int) -> tuple[Column, Column]:
    """``n - 1`` cuts from about ``POINTS * n`` sorted keys."""
    kept = points.orderBy("_id", "_h").collect()
    kept = [kept[len(kept) * i // n] for i in range(1, n)] if kept else []
    kind = points.schema["_id"].dataType.simpleString()
    return F.array(*[F.lit(r["_id"]) for r in kept]).cast(f"array<{kind}>"), F.array(*[F.lit(r["_h"]) for r in kept]).cast("array<bigint>")


def _sliced(rows: DataFrame) -> DataFrame:
    """``rows`` (_id, _h, _text) with ``_slice``: ranges of the order (_id, _h)
    of about equal bytes, numbered in that order.

    Every row gives one point per ``SLICE_BYTES / POINTS`` bytes of its text,
    a smaller rest one by chance, so the points follow the bytes, whatever the
    ids are: null, repeated or of any type that has an order.  The cuts are
    chosen from the points; they decide the balance and never the result.
    """
    keys = rows.select("_id", "_h", (F.coalesce(F.octet_length("_text"), F.lit(0)) + 64).alias("_bytes"))
    total = keys.agg(F.sum("_bytes").alias("n")).first()["n"] or 0
    n = min(MAX_FINE, total // SLICE_BYTES + 1)
    if n == 1:
        return rows.withColumn("_slice", F.lit(0).cast("long"))

    def points(every: float) -> DataFrame:
        return keys.select("_id", "_h", F.floor(F.col("_bytes") / every + F.rand(11)).cast("int").alias("_k")).filter("_k > 0")
    each = F.explode(F.array_repeat(F.lit(0), F.col("_k")))
    first = min(n, COARSE)
    ids, hashes = _cuts(points(total / (first * POINTS)).select("_id", "_h", each).drop("col"), first)
    coarse = _dealt(rows, ids, hashes, "_part")
    if n == first:
        return coarse.withColumn("_slice", F.col("_part").cast("long")).drop("_part")
    fine = _dealt(points(total / (n * POINTS)).select("_id", "_h", each).drop("col"), ids, hashes, "_part")
    run = F.array_sort(F.collect_list(F.struct(F.col("_id").isNotNull().alias("k"), F.col("_id").alias("i"), F.col("_h").alias("h"))))
    cuts = fine.groupBy("_part").agg(F.filter(run, lambda x, i: i % POINTS == POINTS - 1).alias("_cut"))
    cuts = cuts.select("_part", F.slice("_cut", 1, MOST_CUTS).alias("_cut"))
    both = coarse.join(F.broadcast(cuts), "_part", "left").withColumn("_cut", F.coalesce("_cut", F.array().cast(cuts.schema["_cut"].dataType)))  # at most MAX_FINE keys
    both = _dealt(both, F.col("_cut.i"), F.col("_cut.h"), "_fine")
    return both.withColumn("_slice", F.col("_part").cast("long") * (MOST_CUTS + 1) + F.col("_fine")).drop("_part", "_fine", "_cut")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """``_id, _text, _next`` in ascending id order (null ids first, ties by
    the text's hash), the last row followed by the first; and the window that
    orders the rows of a slice, so that later columns need no new shuffle.

    Rows are dealt by slices of that order; each slice also gets a copy of
    the first row of the next slice that has rows, marked ``_mark``.
    """
    base = _sliced(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
                   .withColumn("_h", F.xxhash64("_text")).select("_id", "_h", "_text"))
    firsts = base.groupBy("_slice").agg(F.min(F.struct("_id", "_h", "_text")).alias("_row"))
    ring = Window.partitionBy(F.lit(1)).orderBy("_slice")  # slice numbers only
    before = firsts.select("_slice", F.coalesce(F.lag("_slice").over(ring), F.max("_slice").over(Window.partitionBy(F.lit(1)))).alias("_before"))
    marks = firsts.join(before, "_slice").select("_row._id", "_row._h", "_row._text", F.col("_before").alias("_slice"), F.lit(1).alias("_mark"))
    rows = base.withColumn("_mark", F.lit(0)).unionByName(marks)
    w = Window.partitionBy("_slice").orderBy("_mark", "_id", "_h", "_text")
    return rows.withColumn("_next", F.lead("_text").over(w)), w


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stand_in: bool = False) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text
    (the last half replaced by the start of the next document), and the
    likeness to the edited text and to the next document."""
    rows, w = with_next(docs, id_col, text_col)
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), (n - half).cast("int")), F.substring(F.col("_next"), F.lit(1), half))
    r = (rows.select("_id", "_h", "_text", "_mark", "_slice", n.cast("long").alias("n_chars"), edited.alias("_edited"), anchors(F.col("_text"), stand_in=stand_in).alias("_a"))
         .withColumn("_na", F.lead("_a").over(w)).filter("_mark = 0")
         .select("_id", "n_chars", "_edited", "_a", "_na", anchors(F.col("_edited"), stand_in=stand_in).alias("_ea")))
    return r.select(F.col("_id").alias(id_col), "n_chars", F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
                    fingerprint(F.col("_a")).alias("fingerprint"), fingerprint(F.col("_ea")).alias("edited_fingerprint"),
                    likeness(F.col("_a"), F.col("_ea")).alias("near_edited"), likeness(F.col("_a"), F.col("_na")).alias("near_next"))


def positional_matches(left: DataFrame, right: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of ``left`` that ``right`` holds too: ``left_id, right_id,
    offset, n, first, last``, the number and the span (anchor ranks in the
    left document) of the anchors that lie ``offset`` ranks further left in
    the right one.  A long run of one offset is a shared passage.

    An anchor that repeats within a document counts by its occurrence: the
    second one meets the second one.  Of the right documents that hold an
    occurrence the smallest id stands for all (then the least rank), so the
    result has at most one row per left anchor, however common an anchor is;
    which documents share a passage with each other follows from the common
    ``right_id``.  Rows with null ids match nothing; rows that repeat an id
    are one document, the one of the least text."""
    def occurrences(df: DataFrame) -> DataFrame:
        one = df.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(text_col).alias("_t"))
        at = one.select("_id", F.posexplode(anchors(F.col("_t"))).alias("_at", "_h"))
        return at.groupBy("_id", "_h").agg(F.array_sort(F.collect_list("_at")).alias("_all")).select("_id", "_h", F.posexplode("_all").alias("_nth", "_at"))
    held = occurrences(right).groupBy("_h", "_nth").agg(F.min(F.struct("_id", "_at")).alias("_r"))
    j = occurrences(left).join(held, ["_h", "_nth"])
    return j.groupBy(F.col("_id").alias("left_id"), F.col("_r._id").alias("right_id"), (F.col("_at") - F.col("_r._at")).alias("offset")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"), F.max("_at").alias("last"))
