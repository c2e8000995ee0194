"""Exact Jaccard self-join of documents on word shingles, by partitioning the
shingle universe.

Documents are sets of distinct shingles of ``words`` consecutive words.  If
two sets of sizes a and b have a Jaccard coefficient of num/den or more, they
differ in at most ``H = (a + b)(den - num) / (den + num)`` shingles.  For each
size band the hashed universe is dealt into segments, each with an allowance
k of 0 or 1, so that the sum of (k + 1) is over H: by the pigeonhole principle
a linked pair has a segment whose two parts differ in at most k shingles.  A
part with k = 0 is indexed by its signature, one with k = 1 by its own and
those of its one-deletion neighbours.  The number of segments and their
allowances are chosen per band by a cost model over the band's documents
(signatures written against chance matches expected).

``e`` further segments pay for empty parts: a linked pair then has matching
segments of weight e + 1, so a document may leave out its empty parts with
k = 0 unless it has more than e of them.

Sets with equal content are one class from the start.  Buckets (equal
signatures) of up to ``small`` classes give their pairs.  In those over
``middle`` every class is first paired with the bucket's most central class.
After those links have merged components, the remaining pairs across
components of every bucket over ``small`` are compared block by block inside
tasks, and only pairs that a parity sketch cannot exclude leave the task.  A
sketch (512 bits or more, by the size of the set; each bit the parity of the
shingles that hash to it) bounds the difference of two sets from below, so
nothing linked is lost.  All pairs that remain are verified on the texts
themselves, shingle by shingle.

Defined cases: a text without words, or null, is an empty set, linked with
nothing; with fewer words than a shingle the whole sequence is one shingle;
equal non-empty sets link; rows that repeat an id are joined under it (if
their texts differ, pairs are verified on the smallest); rows with a null id take the component of their equal set, else null; an empty
table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import checked_broadcast
from .common import map_arrow, written
from .components import components

@dataclass(frozen=True)
class Limits:
    """Sizes of the work units; they change plans, never results."""
    small: int = 6            # largest bucket whose pairs are all written
    middle: int = 64          # largest bucket that is compared without a hub
    local_large: int = 96     # rows of a batch from which a bucket is known to be large
    block: int = 16_384       # classes of a bucket that one task holds (twice)
    sketch_size: int = 700    # largest set with a sketch of the least width (a doubling each beyond)


SKETCH_WORDS, SKETCH_MOST = 8, 128  # 64-bit words of a parity sketch, least and most
SKETCHES_HELD = 1 << 18  # words of sketches that one comparison gathers from each side
#: Cost model only: shingles that a document of any size shares by boilerplate,
#: and the cost of a chance candidate in signatures.
BOILERPLATE, CANDIDATE_COST = 10.0, 5.0

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _STEP)]))


def word_hashes(data: bytes, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, A to Z lower-cased by default."""
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    chars = _LOWER[b[inside]] if lower else b[inside]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    at = np.arange(len(chars)) - np.repeat(first, size)
    h = np.add.reduceat(_BYTE[chars] * _powers(int(size.max()))[at], first)
    return mix(h + size.astype(np.uint64) * _STEP)


def shingle_hashes(data: bytes, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending."""
    w = word_hashes(data)
    if not len(w):
        return w
    width = min(words, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        h = mix(h * _STEP + w[i: len(w) - width + 1 + i])
    return np.unique(h)


def shingle_set(text: str, words: int) -> frozenset[str]:
    """The shingles themselves (verification)."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return frozenset()
    if len(w) < words:
        return frozenset([b" ".join(w)])
    return frozenset([b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)])


# ---- schemes: bands, segments, allowances ---------------------------------------

@dataclass(frozen=True)
class Scheme:
    """Pairs whose larger set has ``lo`` to ``hi`` shingles."""
    lo: int
    hi: int
    most: int       # H for the band's largest pair
    segments: int
    ones: int       # segments with allowance 1 (the first ones)
    spare: int      # e


def most_difference(total: int, num: int, den: int) -> int:
    return total * (den - num) // (den + num)


def allocate(lo: int, hi: int, docs: float, num: int, den: int) -> Scheme:
    """The cheapest numbers of segments and allowances for a band."""
    most = most_difference(2 * hi, num, den)
    if most == 0:
        return Scheme(lo, hi, 0, 1, 0, 0)
    size, least = (lo + hi) / 2, lo * num / den
    best = None
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        spare = 0
        for _ in range(6):  # e and the number of segments fix one another
            weight = most + 1 + spare
            ones = int(round(share * weight / (1 + share)))
            segments = max(1, weight - ones)
            ones = min(weight - segments, segments)
            empty = (segments - ones) * math.exp(-least / segments)
            need = math.ceil(empty + 5 * math.sqrt(empty) + 1) if segments > ones else 0
            if need <= spare:
                break
            spare = need
        weight = segments + ones
        if weight < most + 1 + spare:
            spare = weight - most - 1
        if spare < 0:
            continue
        part = size / segments
        same = min(0.95, BOILERPLATE / size)
        signatures = docs * (segments + ones * part)
        chance = docs * docs / 2 * ((segments - ones) * same ** part + ones * (1 + part) * same ** part)
        cost = signatures + CANDIDATE_COST * chance
        if best is None or cost < best[0]:
            best = (cost, Scheme(lo, hi, most, segments, ones, spare))
    return best[1]


def schemes(largest: int, counts: dict[int, int], num: int, den: int) -> list[Scheme]:
    """Bands from one shingle to ``largest``; ``counts``: documents by the
    integer part of 4 log2(size)."""
    out, lo, before = [], 1, 0
    while lo <= largest:
        hi = max(lo, lo * den * den // (num * num), before * den // num)
        docs = 1.0 + sum(n for k, n in counts.items() if lo <= 2 ** (k / 4 + 0.125) <= hi * 1.2)
        out.append(allocate(lo, hi, docs, num, den))
        lo, before = hi + 1, hi
    return out


def signatures(tokens: np.ndarray, plan: list[Scheme], num: int, den: int) -> np.ndarray:
    """All signatures of a set, under its own band's scheme and, if it can be
    the smaller set there, the next band's."""
    n = len(tokens)
    band = bisect.bisect_right([s.lo for s in plan], n) - 1
    out = []
    for j in (band, band + 1):
        if j >= len(plan) or plan[j].most == 0 or (j > band and n * den // num < plan[j].lo):
            continue
        s = plan[j]
        seg = ((mix(tokens, 2 * j + 1) >> _U(32)) * _U(s.segments) >> _U(32)).astype(np.int64)
        value = mix(tokens, 0x5EED)
        # sums modulo 2^64, from exact sums of the halves
        low = np.bincount(seg, (value & _U(0xFFFFFFFF)).astype(np.float64), s.segments).astype(np.uint64)
        high = np.bincount(seg, (value >> _U(32)).astype(np.float64), s.segments).astype(np.uint64)
        total = low + (high << _U(32))
        name = mix(np.arange(s.segments, dtype=np.uint64) + (_U(j + 1) << _U(40)), 0xA11)
        empty = np.bincount(seg, minlength=s.segments) == 0
        keep = np.ones(s.segments, bool)
        keep[s.ones:] = ~empty[s.ones:] | (int(empty[s.ones:].sum()) > s.spare)
        out.append(mix(total + name)[keep])
        if s.ones:
            of = seg < s.ones
            out.append(mix(total[seg[of]] - value[of] + name[seg[of]]))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


# ---- tasks -----------------------------------------------------------------------

def sketch(tokens: np.ndarray, size: int = Limits.sketch_size) -> np.ndarray:
    """Parity of the shingles that hash to each bit; 64-bit words.  Halving a
    sketch (first half XOR second half) gives that of half as many bits."""
    words = SKETCH_WORDS
    while len(tokens) > size * words // SKETCH_WORDS and words < SKETCH_MOST:
        words *= 2
    bits = np.bincount((mix(tokens, 77) & _U(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _bytes(scalar) -> bytes:
    v = scalar.as_py()
    return v.encode("utf-8", "surrogatepass") if v else b""


def _describe(batches: Iterator[pa.RecordBatch], words: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sketch", pa.list_(pa.int64()))])
    for b in batches:
        n, h1, h2, sk = [], [], [], []
        for text in b.column(1):
            t = shingle_hashes(_bytes(text), words)
            n.append(len(t))
            h1.append(int(mix(t, 1).sum(dtype=np.uint64).astype(np.int64)))
            h2.append(int(mix(t, 2).sum(dtype=np.uint64).astype(np.int64)))
            sk.append(sketch(t, limits.sketch_size).tolist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                          pa.array(sk, pa.list_(pa.int64()))], schema=schema)


def _index(batches: Iterator[pa.RecordBatch], words: int, plan: list[Scheme], num: int, den: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Rows (part, doc, sig): the shuffle key, a document, and null, or for
    documents of a bucket that is large in this batch already the signature
    (those rows are dealt by document, and one more row with sig 0 tells the
    bucket's task that it is large)."""
    schema = pa.schema([("part", pa.int64()), ("doc", pa.int64()), ("sig", pa.int64())])
    for b in batches:
        sigs, docs, seen = [], [], set()
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            t = shingle_hashes(_bytes(text), words)
            if doc is None or not len(t):
                continue
            key = t.tobytes() if len(t) <= 4 else (len(t), int(mix(t, 1).sum(dtype=np.uint64)), int(mix(t, 2).sum(dtype=np.uint64)))
            if key in seen:  # an equal set of this batch stands for it
                continue
            seen.add(key)
            s = signatures(t, plan, num, den)
            sigs.append(s.view(np.int64))
            docs.append(np.full(len(s), doc, np.int64))
        if not sigs:
            continue
        sig, doc = np.concatenate(sigs), np.concatenate(docs)
        if not len(sig):
            continue
        order = np.argsort(sig, kind="stable")
        sig, doc = sig[order], doc[order]
        run = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([run, [len(sig)]]))
        large = np.repeat(size > limits.local_large, size)
        first = run[size > limits.local_large]
        spread = mix(doc[large].view(np.uint64) ^ sig[large].view(np.uint64), 9).view(np.int64)
        part = np.concatenate([sig[~large], sig[first], spread])
        who = np.concatenate([doc[~large], doc[first], doc[large]])
        mark = np.concatenate([np.zeros(int((~large).sum()), np.int64), np.zeros(len(first), np.int64), sig[large]])
        null = np.zeros(len(part), bool)
        null[: int((~large).sum())] = True
        for at in range(0, len(part), 100_000):
            c = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(part[c]), pa.array(who[c]), pa.array(mark[c], mask=null[c])], schema=schema)


PAIR, MEMBER, CROWD = 0, 1, 2


def _buckets(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``part`` to (kind, sig, a, b): pairs (a, b) of buckets up
    to ``small``, members a of buckets up to ``middle``, and members a of
    larger ones.  A bucket that spans batches is carried while it is small
    enough; after that its rows pass through."""
    schema = pa.schema([("kind", pa.int32()), ("sig", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def rows(kind, sig, a, b=None):
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int64()) if sig is None else pa.array(sig), pa.array(a),
                                           pa.nulls(n, pa.int64()) if b is None else pa.array(b)], schema=schema)

    def close(sig, doc, is_large):
        """Whole buckets, sorted."""
        if not len(sig):
            return
        run = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([run, [len(sig)]]))
        crowd = (size > limits.middle) | np.logical_or.reduceat(is_large, run)
        for kind, chosen in ((CROWD, crowd), (MEMBER, ~crowd & (size > limits.small))):
            at = np.repeat(chosen, size)
            if at.any():
                yield rows(kind, sig[at], doc[at])
        pairs = []
        small = ~crowd & (size <= limits.small)
        for k in np.unique(size[small]):
            if k > 1:
                first = run[(size == k) & small]
                i, j = np.triu_indices(int(k), 1)
                a, b = doc[first[:, None] + i].ravel(), doc[first[:, None] + j].ravel()
                pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        if pairs:
            p = np.concatenate(pairs)
            p = np.unique(p[p[:, 0] != p[:, 1]], axis=0)
            yield rows(PAIR, None, p[:, 0], p[:, 1])

    held_sig, held_doc, held_large = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    open_large = None  # signature of a large bucket whose earlier rows were passed through
    for b in batches:
        part, doc = b.column(0).to_numpy(), b.column(1).to_numpy()
        known = ~np.asarray(b.column(2).is_null())
        mark = b.column(2).fill_null(0).to_numpy()
        direct = known & (mark != 0)
        if direct.any():
            yield rows(CROWD, mark[direct], doc[direct])
        rest = ~direct
        sig = np.concatenate([held_sig, part[rest]])
        doc = np.concatenate([held_doc, doc[rest]])
        big = np.concatenate([held_large, known[rest]])
        if open_large is not None and len(sig):
            of = sig == open_large
            if of.any():
                yield rows(CROWD, sig[of], doc[of])
            if not of.all():
                open_large = None
            sig, doc, big = sig[~of], doc[~of], big[~of]
        if len(sig):
            last = np.searchsorted(sig, sig[-1])
            yield from close(sig[:last], doc[:last], big[:last])
            sig, doc, big = sig[last:], doc[last:], big[last:]
            if len(sig) > limits.middle or big.any():
                yield rows(CROWD, sig, doc)
                open_large = int(sig[0])
                sig, doc, big = sig[:0], doc[:0], big[:0]
        held_sig, held_doc, held_large = sig, doc, big
    yield from close(held_sig, held_doc, held_large)


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near_pairs(left: dict, right: dict | None, num: int, den: int) -> np.ndarray:
    """Index pairs (i of left, j of right; of left with itself if right is
    None) of different components that sizes and sketches cannot exclude.
    Every pair has a member outside the most frequent component, so only
    those are compared with the others."""
    parts, counts = np.unique(np.concatenate([left["component"], *([] if right is None else [right["component"]])]), return_counts=True)
    if len(parts) < 2:
        return np.zeros((0, 2), np.int64)
    main, out = parts[counts.argmax()], []
    width = lambda rows: np.array([len(x) for x in rows["sketch"]])

    def search(from_rows, pick, to_rows, flip, own, out):
        from_width, to_width = width(from_rows)[pick], width(to_rows)
        for w in np.unique(from_width):
            mine = pick[from_width == w]
            for v in np.unique(to_width):
                theirs = np.flatnonzero(to_width == v)
                n, comp = to_rows["n"][theirs], to_rows["component"][theirs]
                if v * 2 < w or w * 2 < v:
                    sk_m = sk_t = None  # of too different sizes for any link over one half
                else:
                    sk_m = _folded(np.stack(from_rows["sketch"][mine]), min(v, w))
                    sk_t = _folded(np.stack(to_rows["sketch"][theirs]), min(v, w))
                step = max(1, 200_000 // max(len(theirs), 1))
                for c in range(0, len(mine), step):
                    m = mine[c:c + step]
                    a = from_rows["n"][m][:, None]
                    ok = (comp != from_rows["component"][m][:, None]) & (den * np.minimum(a, n) >= num * np.maximum(a, n))
                    if own:  # each pair of two outside the main component once
                        ok &= (theirs > m[:, None]) | (comp == main)
                    i, j = np.nonzero(ok)
                    if len(i) and sk_m is not None:
                        some = max(1, SKETCHES_HELD // sk_m.shape[1])
                        far = np.concatenate([np.bitwise_count(sk_t[j[k:k + some]] ^ sk_m[c + i[k:k + some]]).sum(1) for k in range(0, len(i), some)])
                        near = far <= (from_rows["n"][m][i] + n[j]) * (den - num) // (den + num)
                        i, j = i[near], j[near]
                    if len(i):
                        found = np.stack([m[i], theirs[j]], 1)
                        out.append(found[:, ::-1] if flip else found)

    outside = np.flatnonzero(left["component"] != main)
    if right is None:
        search(left, outside, left, False, True, out)
    else:
        search(left, outside, right, False, False, out)
        # the rest: right rows outside the main component with left rows inside it
        inside = np.flatnonzero(left["component"] == main)
        more: list[np.ndarray] = []
        search(right, np.flatnonzero(right["component"] != main), {c: v[inside] for c, v in left.items()}, True, False, more)
        out += [np.stack([inside[p[:, 0]], p[:, 1]], 1) for p in more]
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (sig, x, y, side, doc, component, n, sketch) sorted by bucket and
    block pair (x, y): pairs across components that sizes and sketches cannot
    exclude.  At most two blocks are held, and the last pairs given, so that
    pairs of several buckets of a task are given once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    given: set[tuple[int, int]] = set()

    def block(rows: dict) -> Iterator[pa.RecordBatch]:
        first = {c: v[rows["side"] == 0] for c, v in rows.items()}
        second = {c: v[rows["side"] == 1] for c, v in rows.items()}
        own = not len(second["doc"])  # a block with itself
        if not len(first["doc"]):
            return
        p = near_pairs(first, None if own else second, num, den)
        if len(p):
            a, b = first["doc"][p[:, 0]], (first if own else second)["doc"][p[:, 1]]
            if len(given) > 500_000:
                given.clear()
            new = {*zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)} - given
            given.update(new)
            p = np.array(sorted(new), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], schema=schema)

    held = None
    for b in batches:
        rows = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "x", "y", "side", "doc", "component", "n")}
        values = b.column("sketch").flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(b.column("sketch").value_lengths().to_numpy())
        rows["sketch"] = np.empty(len(ends), object)
        for i, (at, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)):
            rows["sketch"][i] = values[at:end]
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
        new = np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c in ("sig", "x", "y")])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield from block({c: v[at:end] for c, v in rows.items()})
        held = {c: v[cuts[-1]:] for c, v in rows.items()}
    if held is not None:
        yield from block(held)


def _verify(batches: Iterator[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for b in batches:
        keep, known = [], {}
        for ta, tb in zip(b.column("ta").to_pylist(), b.column("tb").to_pylist(), strict=True):
            if len(known) > 64:
                known.clear()
            sa, sb = (known.get(t) or known.setdefault(t, shingle_set(t, words)) for t in (ta, tb))
            same = len(sa & sb)
            keep.append(same > 0 and den * same >= num * (len(sa) + len(sb) - same))
        at = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(at), b.column("b").filter(at)], schema=schema)


# ---- the join --------------------------------------------------------------------

def _as_classes(rows: DataFrame, copies: DataFrame, *cols: str) -> DataFrame:
    """Replace ids by their class's smallest id (``copies``: id, rep)."""
    for c in cols:
        rows = (rows.join(copies.select(F.col("id").alias(c), F.col("rep").alias("_rep")), c, "left")
                .withColumn(c, F.coalesce("_rep", c)).drop("_rep"))
    return rows


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, num: int, den: int, name: str) -> DataFrame:
    """Verified pairs of ``pairs`` (a < b, class ids): sizes and sketches
    first, then the texts of the documents still needed."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
    half = lambda c: F.zip_with(F.slice(c, 1, (F.size(c) / 2).cast("int")), F.slice(c, (F.size(c) / 2).cast("int") + 1, (F.size(c) / 2).cast("int")), lambda x, y: x.bitwiseXOR(y))
    fold = lambda c, other: F.when(F.size(c) == 2 * F.size(other), half(F.col(c))).otherwise(F.col(c))
    bits = F.aggregate(F.zip_with(fold("sa", "sb"), fold("sb", "sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    same_width = (F.size("sa") <= 2 * F.size("sb")) & (F.size("sb") <= 2 * F.size("sa"))
    far = F.when(same_width, bits).otherwise(0)
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
            .filter(far <= F.floor((F.col("na") + F.col("nb")) * (den - num) / (den + num))).select("a", "b"))
    near = written(near, f"{name}-near")
    need = written(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct(), f"{name}-ids")
    found = written(texts.join(checked_broadcast(need), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), f"{name}-texts")
    with_texts = (near.join(found.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
                  .join(found.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))
    return written(map_arrow(with_texts.select("a", "b", "ta", "tb"), lambda it: _verify(it, words, num, den), "a long, b long"), f"{name}-links")


def join_components(docs: DataFrame, words: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text",
                    limits: Limits = Limits()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    base = written(map_arrow(texts, lambda it: _describe(it, words, limits), "id long, n long, h1 long, h2 long, sketch array<long>"), "join-base")
    key = ["n", "h1", "h2"]
    classes = written(base.filter("n > 0 and id is not null").groupBy(*key).agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")), "join-classes")
    # one class per id: rows that repeat an id under different texts meet here
    copies = written(base.filter("n > 0").join(classes.select(*key, "rep"), key).filter("id != rep").groupBy("id").agg(F.min("rep").alias("rep")), "join-copies")

    stats = classes.groupBy(F.floor(4 * F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("top")).collect()
    plan = schemes(max([r["top"] for r in stats], default=0), {r["k"]: r["c"] for r in stats}, num, den)
    rows = map_arrow(texts, lambda it: _index(it, words, plan, num, den, limits), "part long, doc long, sig long")
    found = map_arrow(rows.repartition("part").sortWithinPartitions("part"), lambda it: _buckets(it, limits), "kind int, sig long, a long, b long")
    found = written(found, "join-buckets")

    ordered = lambda p: p.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    member = _as_classes(found.filter(F.col("kind") == MEMBER).select("sig", F.col("a").alias("doc")), copies, "doc")
    crowd = written(_as_classes(found.filter(F.col("kind") == CROWD).select("sig", F.col("a").alias("doc")), copies, "doc").distinct(), "join-crowds")
    size = written(crowd.groupBy("sig").agg(F.count(F.lit(1)).alias("c")), "join-sizes")
    central = crowd.join(size, "sig").groupBy("doc").agg(F.sum("c").alias("c"))
    hub = written(crowd.join(central, "doc").groupBy("sig").agg(F.max(F.struct("c", F.negative("doc").alias("d"))).alias("m"))
                  .select("sig", F.negative("m.d").alias("hub")), "join-hubs")
    star = crowd.join(hub, "sig").select(F.col("hub").alias("a"), F.col("doc").alias("b"))
    small = _as_classes(found.filter(F.col("kind") == PAIR).select("a", "b").distinct(), copies, "a", "b")
    tried = written(ordered(small.unionByName(star)), "join-pairs")
    links = _links(tried, classes, texts, words, num, den, "join-1")

    first = written(components(links), "join-components")
    state = written(classes.select(F.col("rep").alias("doc"), "n", "sketch").join(first.select(F.col("node").alias("doc"), "component"), "doc", "left")
                    .withColumn("component", F.coalesce("component", "doc")), "join-state")
    part = crowd.join(state.select("doc", "component"), "doc").groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y")
    blocks = part.select("sig").join(size.select("sig", F.ceil(F.col("c") / limits.block).cast("int").alias("_blocks")), "sig")
    # a bucket's pairs with its hub have been tried
    spread = (crowd.join(blocks.join(hub, "sig"), "sig").filter("doc != hub").withColumn("_own", F.pmod(F.xxhash64("doc"), F.col("_blocks")).cast("int"))
              .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .select("sig", "doc", F.least("_own", "_with").alias("x"), F.greatest("_own", "_with").alias("y"),
                      F.when(F.col("_own") <= F.col("_with"), 0).otherwise(1).alias("side")))
    every = spread.unionByName(member.withColumns({"x": F.lit(0), "y": F.lit(0), "side": F.lit(0)})).join(state, "doc")
    every = every.select("sig", "x", "y", "side", "doc", "component", "n", "sketch")
    more = map_arrow(every.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y"), lambda it: _compare(it, num, den), "a long, b long")
    more = written(ordered(more).join(tried, ["a", "b"], "left_anti"), "join-more")
    if more.limit(1).count():
        links = written(links.unionByName(_links(more, classes, texts, words, num, den, "join-2")), "join-links")
        first = written(components(links), "join-components")

    named = classes.select(*key, "rep").join(first.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return base.join(named, key, "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "id").alias("component_id"))
