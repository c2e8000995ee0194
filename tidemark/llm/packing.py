"""Best-fit packing of tokenized documents with certified bin counts.

Documents become pieces of at most ``capacity`` tokens.  Pieces are dealt to
partitions of bounded size, and each partition is packed by best-fit
decreasing.  Dual-feasible functions (Martello-Toth thresholds, the
Fekete-Schepers u^(k) and phi^(eps) families) give a lower bound on the
partition's bins; a partition that meets it is certified optimal.  Partitions
with a gap release every bin that is not full, and certified ones their
emptiest bin; released pieces of all partitions are dealt anew and repacked,
and a round's result is taken only if it uses fewer bins than it replaced.

Defined cases: a null or empty text is the terminator alone; an empty table
gives no rows; rows with the same id are separate documents with equal
pieces; lengths tie by arrival order.  No piece is ever dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, ship, written

CAPACITY = 2048
GROUP_ROWS = 20_000
ROUNDS = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- pieces ------------------------------------------------------------------

def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids (4 bytes each)."""
    step = 4 * capacity
    return [(i, at // 4, len(part) // 4, zlib.crc32(part))
            for i, at in enumerate(range(0, len(ids), step)) for part in (ids[at:at + step],)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int) -> Iterator[pa.RecordBatch]:
    from .word_ids import loaded

    words = loaded(path or vocabulary_path())
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids = words.ids(text.as_py() or "") + b"\0\0\0\0"
            rows += [(doc_id, *p) for p in cut(ids, capacity)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema.types, strict=True)], schema=schema)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: ids by ``tokenizers`` without special tokens,
    then id 0, cut every ``capacity`` tokens."""
    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), lambda it: _pieces(it, path, capacity), PIECES)


# ---- one partition -----------------------------------------------------------

def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece.  The open bins are kept by free space;
    a bit per free space finds the tightest bin at once."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = open_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_bits ^= 1 << free
        else:
            b, free, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - free
        left = free - size
        if left:
            by_free[left].append(b)
            open_bits |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, max_k: int = 24) -> int:
    """The best bound of the dual-feasible functions: no packing of
    ``lengths`` into bins of ``capacity`` uses fewer bins."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    up = lambda total, unit: int(-(-int(total) // int(unit)))
    best = up((count * size).sum(), capacity)
    for k in range(1, max_k + 1):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, up((count * value).sum(), k * capacity))
    at_least = np.concatenate([[0], np.cumsum((count * size)[::-1])])[::-1]  # total size from a length on
    n_at_least = np.concatenate([[0], np.cumsum(count[::-1])])[::-1]
    for eps in np.flatnonzero(count[: capacity // 2 + 1]).tolist() or [1]:
        eps = max(eps, 1)
        big = int(n_at_least[capacity - eps + 1])
        middle = int(at_least[eps] - at_least[capacity - eps + 1])
        best = max(best, up(big * capacity + middle, capacity))
        unit = capacity // eps
        half = capacity // 2
        value = np.where(size > capacity - size, unit - (capacity - size) // eps, np.where(size >= eps, 1, 0))
        if half * 2 == capacity:
            value[half] = 1 if half >= eps else 0
        best = max(best, up((count * value).sum(), unit))
    return best


def _pack_group(key: tuple, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    lengths = rows["length"].to_numpy(np.int64)
    bins, offsets = best_fit_decreasing(lengths, capacity)
    n = int(bins.max()) + 1 if len(bins) else 0
    bound = lower_bound(lengths, capacity)
    fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
    released = fill < capacity if n > bound else np.arange(n) == int(np.argmin(fill))
    released &= fill < capacity
    return rows.assign(_bin=bins, offset=offsets, _bins=n, _bound=bound, _out=released[bins])


def _packed(pool: DataFrame, n: int, round_no: int, capacity: int, group_rows: int) -> DataFrame:
    groups = max(1, -(-n // group_rows))
    ship(pool.sparkSession)
    cols = "doc_id long, piece int, start long, length long, ids_crc32 long"
    dealt = pool.select("doc_id", "piece", "start", "length", "ids_crc32", F.pmod(
        F.xxhash64(F.lit(round_no), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)).alias("_group"))
    out = dealt.groupBy("_group").applyInPandas(
        lambda key, rows: _pack_group(key, rows, capacity),
        f"{cols}, _group long, _bin long, offset long, _bins long, _bound long, _out boolean")
    return written(out, f"pack-{round_no}")


def pack(piece_rows: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """``piece_rows`` with ``sequence_id`` and ``offset``."""
    pool = written(piece_rows, "pieces")
    n, done, old_bins, last = pool.count(), [], None, None
    for r in range(rounds):
        out = _packed(pool, n, r, capacity, group_rows).withColumn("_round", F.lit(r))
        per = out.groupBy("_group", "_bin").agg(F.count(F.lit(1)).alias("n"), F.first("_out").alias("out")).groupBy().agg(
            F.count(F.lit(1)).alias("bins"), F.count_if("out").alias("out_bins"), F.coalesce(F.sum(F.when(F.col("out"), F.col("n"))), F.lit(0)).alias("out_rows")).first()
        if old_bins is not None and per["bins"] >= old_bins:
            break  # the exchange gained nothing: keep the packing before it
        if last is not None:
            done.append(last.filter(~F.col("_out")))
        last, old_bins, n = out, per["out_bins"], per["out_rows"]
        pool = out.filter("_out")
        if old_bins < 2:
            break
    done.append(last)
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    seq = F.shiftleft(F.col("_round").cast("long"), 56) + F.shiftleft(F.col("_group"), 20) + F.col("_bin")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", seq.alias("sequence_id"), "offset")


def certificates(piece_rows: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per partition of the first deal: bins used, the lower bound,
    and whether they meet."""
    pool = written(piece_rows, "pieces")
    out = _packed(pool, pool.count(), 0, capacity, group_rows)
    return out.groupBy("_group").agg(F.first("_bins").alias("bins"), F.first("_bound").alias("bound"), F.sum("length").alias("tokens")).select(
        F.col("_group").alias("partition"), "bins", "bound", "tokens", (F.col("bins") == F.col("bound")).alias("certified"))
