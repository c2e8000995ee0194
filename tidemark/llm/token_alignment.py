"""Cross-tokenizer alignment: where the tokens of two public vocabularies end
together, found by galloping intersection of their byte offsets.

A text, with a space before it, is encoded by a byte-level vocabulary (A) and
by a piece vocabulary with byte fallback (B).  The ends of both token lists
are ascending byte offsets.  Each end of the shorter list is searched in the
longer one by galloping: from a known lower index the step doubles until it
passes the value, then a binary search closes in.  (A whole list gallops in
lockstep: every sixteenth end first, by the same rule, and the others from
the index found for theirs; ``link_report`` searches the lists of several
texts at once.)  Common ends slice both lists into groups; the
differences of the ranks of a token's two ends in the other list are the range
of tokens that it overlaps.

``align`` gives each document's groups and overlap ranges.  ``link_report``
counts the links (pairs of occurrences that end together) of the corpus: a
task reads blocks of whole documents, at most ``BLOCK_BYTES`` or one document,
and hands on each block's *distinct* id pairs with their counts.  The
corpus-wide counts are summed from these, and go back to each block by its own
pairs, so a pair that stands in every text is one row per block, not one per
occurrence; nothing grows with a pair's frequency but a sum.

Defined cases: a null or empty text, and one whose A or B tokens do not spell
the space and the text byte for byte (a U+2581 in it, for example), has no
tokens: zeros, an empty hash and no groups.  Special-token strings are plain
text.  Rows with a null id, equal rows and texts of any length are documents
like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written
from .word_ids import byte_letters

#: Bytes of text whose links are counted together.
BLOCK_BYTES = 4 << 20
#: Characters of text that are searched together.
SEARCH_CHARS = 128 << 10
#: Runs of white space above this go to the reference implementation, as the
#: fast one backtracks over them.
LONG_SPACE = re.compile(r"\s{2000}")
STRIDE = 16


# ---- tokens ----------------------------------------------------------------------

class Vocabularies:
    """Ids and byte lengths of both vocabularies' tokens."""

    def __init__(self, a: str, b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.a_path = a
        with open(a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte_of = {c: n for n, c in byte_letters().items()}
        spelt = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items() if all(c in byte_of for c in t)}
        self.a_bytes = [spelt.get(i, b"") for i in range(max(vocab.values()) + 1)]
        special = {i for t, i in vocab.items() if t.startswith("<|") and t.endswith("|>")}
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                      mergeable_ranks={s: i for i, s in spelt.items() if i not in special})
        self.slow = None
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        self.b_bytes = []
        for i in range(self.pieces.vocab_size()):
            piece = self.pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # decimal ids with what follows them in the digest: "," within a
        # group's side, else "|" after A's and ";" after B's last token
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.marks = [b"%d%s" % (i, s) for s, top in ((b",", n), (b"|", n), (b",", m), (b";", m)) for i in range(top)]
        self.mark_at = (0, n, 2 * n, 2 * n + m)

    def _a(self, text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.a_path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, or None where they do not spell the text."""
        if not text:
            return None
        spaced = " " + text
        a, b, raw = self._a(spaced), self.pieces.encode(text), spaced.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


_LOADED: dict[tuple, Vocabularies] = {}


def loaded(paths: tuple[str, str] | None) -> Vocabularies:
    """One pair of tokenizers per Python worker; by default the two that the
    public package names, looked up where the worker runs."""
    if paths not in _LOADED:
        import public_tokenizers

        _LOADED[paths] = Vocabularies(*(paths or (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))))
    return _LOADED[paths]


# ---- galloping -------------------------------------------------------------------

def gallop(values: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Index of the first element of ``into`` not below each of ``values``
    (``len(into)`` where all are); both ascend."""
    n, m = len(into), len(values)
    if not n:
        return np.zeros(m, np.int64)
    if m <= STRIDE:
        out, at = [], 0
        for value in values.tolist():
            step = 1
            while at + step <= n and into[at + step - 1] < value:
                step *= 2
            lo, hi = at + step // 2, min(at + step, n)  # all before lo are below; hi is not, or the end
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if into[mid] < value else (lo, mid)
            at = lo
            out.append(at)
        return np.array(out, np.int64)
    start = np.repeat(gallop(values[::STRIDE], into), STRIDE)[:m]
    step = np.ones(m, np.int64)
    live = np.arange(m)
    while len(live):  # double the step of those that have not passed their value
        reach = start[live] + step[live]
        short = (reach <= n) & (into[np.minimum(reach, n) - 1] < values[live])
        live = live[short]
        step[live] *= 2
    lo, hi = start + step // 2, np.minimum(start + step, n)
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) // 2
        below = into[mid] < values[live]
        lo[live[below]], hi[live[~below]] = mid[below] + 1, mid[~below]
        live = live[lo[live] < hi[live]]
    return lo


def common(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both lists of the ends that they share."""
    swap = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    at = gallop(short, long)
    hit = at < len(long)
    hit[hit] = long[at[hit]] == short[hit]
    here = np.flatnonzero(hit)
    return (at[here], here) if swap else (here, at[here])


def overlaps(starts: np.ndarray, ends: np.ndarray, other_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of the other list that each token shares a byte
    with, by the ranks of its two ends."""
    return gallop(starts + 1, other_ends), gallop(ends, other_ends)


def digests(v: Vocabularies, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, sizes: np.ndarray) -> list[str]:
    """SHA-256 of every text's groups, ``a1,a2|b1;a3|b2,b3``; ``sizes`` are
    the texts' numbers of tokens, of A and B together."""
    size_a, size_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    codes = np.empty(len(a) + len(b), np.int64)
    to_a = np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)  # B tokens of earlier groups
    to_b = np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)           # A tokens up to this group
    codes[to_a], codes[to_b] = a + v.mark_at[0], b + v.mark_at[2]
    codes[to_a[at_a]] = a[at_a] + v.mark_at[1]
    codes[to_b[at_b]] = b[at_b] + v.mark_at[3]
    marks, ends = list(map(v.marks.__getitem__, codes.tolist())), np.cumsum(sizes).tolist()
    return [hashlib.sha256(b"".join(marks[s:e])[:-1]).hexdigest() for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def aligned(v: Vocabularies, ids: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[str], np.ndarray]:
    """Numbers of groups, digests and links (A's id in the upper 32 bits) of
    several texts.  Their ends stand in one ascending list, a byte apart, so
    that one search serves all and no two texts share an end; each text's last
    tokens end together, so no group spans two."""
    a, b = (np.concatenate(x) for x in zip(*ids, strict=True))
    n_a, n_b = (np.array([len(x) for x in side]) for side in zip(*ids, strict=True))
    text = np.arange(len(ids))
    of_a, of_b = np.repeat(text, n_a), np.repeat(text, n_b)
    at_a, at_b = common(np.cumsum(v.a_len[a]) + of_a, np.cumsum(v.b_len[b]) + of_b)
    groups = np.bincount(of_a[at_a], minlength=len(ids)).tolist()
    return groups, digests(v, a, b, at_a, at_b, n_a + n_b), (a[at_a] << 32) + b[at_b]


# ---- groups per document ---------------------------------------------------------

_RANGE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_GROUP = pa.list_(pa.struct([("byte_from", pa.int64()), ("byte_to", pa.int64()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]))


def _groups(batches: Iterator[pa.RecordBatch], paths) -> Iterator[pa.RecordBatch]:
    v = loaded(paths)
    for batch in batches:
        groups, a_over, b_over = [], [], []
        for text in batch.column(1):
            ids = v.encode(text.as_py())
            if ids is None:
                groups.append([])
                a_over.append([])
                b_over.append([])
                continue
            a, b = ids
            ends_a, ends_b = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
            at_a, at_b = common(ends_a, ends_b)
            upto = ends_a[at_a].tolist()
            groups.append([{"byte_from": s, "byte_to": e, "a": x.tolist(), "b": y.tolist()} for s, e, x, y in zip(
                [0, *upto[:-1]], upto, np.split(a, at_a[:-1] + 1), np.split(b, at_b[:-1] + 1), strict=True)])
            for out, lengths, ends, other in ((a_over, v.a_len[a], ends_a, ends_b), (b_over, v.b_len[b], ends_b, ends_a)):
                out.append([{"first": f, "last": e} for f, e in zip(*(x.tolist() for x in overlaps(ends - lengths, ends, other)), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(groups, _GROUP), pa.array(a_over, _RANGE), pa.array(b_over, _RANGE)],
                                         names=[batch.schema.names[0], "groups", "a_overlaps", "b_overlaps"])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document: its groups ``(byte_from, byte_to, a, b)`` in order, the
    range of B tokens that each A token overlaps, and the reverse.  Offsets
    count the space before the text."""
    kind, ranges = docs.schema[id_col].dataType.simpleString(), "array<struct<first:bigint,last:bigint>>"
    return map_arrow(docs.select(id_col, F.col(text_col).cast("string").alias("_text")), partial(_groups, paths=paths),
                     f"`{id_col}` {kind}, groups array<struct<byte_from:bigint,byte_to:bigint,a:array<bigint>,b:array<bigint>>>, "
                     f"a_overlaps {ranges}, b_overlaps {ranges}")


# ---- links of the corpus ---------------------------------------------------------

#: Per block: its documents, its distinct pairs, and for each document's
#: distinct pairs the place among those of the block and the occurrences.
_DOCS = "array<struct<id:{id},n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string,n_pairs:bigint>>"
_BLOCK = "block long, docs " + _DOCS + ", pairs array<struct<pair:bigint,times:bigint>>, slots binary, times binary"
_PAIRS = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))


def _blocks(batches: Iterator[pa.RecordBatch], paths) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    v, first = loaded(paths), TaskContext.get().partitionId() << 32
    docs: list = []
    links: list[np.ndarray] = []
    sizes: list[int] = []  # links per document
    waiting: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []  # place in docs, ids
    held, unsearched, block = 0, 0, 0
    kind = None

    def search():
        if not waiting:
            return
        groups, hashes, found = aligned(v, [ids for _, ids in waiting])
        for (at, _), n, sha in zip(waiting, groups, hashes, strict=True):
            docs[at]["n_groups"], docs[at]["groups_sha256"], sizes[at] = n, sha, n
        links.append(found)
        waiting.clear()

    def out():
        search()
        pairs, slot = np.unique(np.concatenate(links), return_inverse=True) if links else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        mine, times = np.unique(owner * max(len(pairs), 1) + slot, return_counts=True)
        per_doc = np.bincount(mine // max(len(pairs), 1), minlength=len(sizes)).tolist()
        rows = [{**d, "n_pairs": n} for d, n in zip(docs, per_doc, strict=True)]
        counted = pa.StructArray.from_arrays([pa.array(pairs), pa.array(np.bincount(slot, minlength=len(pairs)))], names=["pair", "times"])
        return pa.RecordBatch.from_arrays(
            [pa.array([first + block]), pa.array([rows], kind), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), counted).cast(_PAIRS),
             pa.array([(mine % max(len(pairs), 1)).astype("<u4").tobytes()]), pa.array([times.astype("<u4").tobytes()])],
            names=["block", "docs", "pairs", "slots", "times"])

    for batch in batches:
        id_type = batch.schema.types[0]
        kind = kind or pa.list_(pa.struct([("id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                                           ("groups_sha256", pa.string()), ("n_pairs", pa.int64())]))
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            ids = v.encode(text)
            sizes.append(0)
            docs.append({"id": doc_id.as_py(), "n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": ""})
            if ids is not None:
                docs[-1]["n_a"], docs[-1]["n_b"] = map(len, ids)
                waiting.append((len(docs) - 1, ids))
                held, unsearched = held + len(text), unsearched + len(text)
            if unsearched >= SEARCH_CHARS:
                search()
                unsearched = 0
            held += 64
            if held >= BLOCK_BYTES:
                yield out()
                docs, links, sizes, held, unsearched, block = [], [], [], 0, 0, block + 1
    if docs:
        yield out()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            docs = batch.column("docs")[r].values
            totals = batch.column("totals")[r].values
            size = len(batch.column("pairs")[r])
            count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if totals is not None and len(totals):
                slot = totals.field("slot").to_numpy()
                count[slot] = totals.field("count").to_numpy()
                best[slot] = totals.field("best").to_numpy(zero_copy_only=False)
            slots = np.frombuffer(batch.column("slots")[r].as_py(), "<u4")
            times = np.frombuffer(batch.column("times")[r].as_py(), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(len(docs)), docs.field("n_pairs").to_numpy())
            add = lambda x: [np.add.reduce(p) for p in np.split(x, np.flatnonzero(np.diff(owner)) + 1)]
            n_best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            if len(owner):
                some = owner[np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])]
                n_best[some], total[some] = add(times * best[slots]), add(times * count[slots])
            yield pa.RecordBatch.from_arrays(
                [docs.field("id"), docs.field("n_a"), docs.field("n_b"), docs.field("n_groups"), docs.field("n_groups"),
                 pa.array(n_best), pa.array(total), docs.field("groups_sha256")],
                names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def pair_counts(each: DataFrame) -> DataFrame:
    """``(pair, count, best)``: occurrences of every id pair (A's id in the
    upper 32 bits) in the corpus, and whether no other A id is linked with
    the B id more often.  A B id has at most as many rows as A has ids."""
    counts = each.groupBy("pair").agg(F.sum("times").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def link_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document: token, group and link numbers, links whose pair is the
    most frequent of its B id, the sum of the links' corpus-wide counts, and
    the digest of its groups."""
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = written(map_arrow(docs.select(id_col, F.col(text_col).cast("string").alias("_text")), partial(_blocks, paths=paths),
                               _BLOCK.format(id=kind)), "token-links")
    each = blocks.select("block", F.posexplode("pairs").alias("slot", "x")).select("block", "slot", "x.pair", "x.times")
    totals = each.join(pair_counts(each), "pair").groupBy("block").agg(F.collect_list(F.struct("slot", "count", "best")).alias("totals"))
    return map_arrow(blocks.join(totals, "block", "left").select("docs", "pairs", "slots", "times", "totals"), _sums,
                     f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
