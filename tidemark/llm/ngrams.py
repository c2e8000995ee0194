"""Hashed character n-gram counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multipliers of the n-gram hash (splitmix64 and xxhash64 constants).
_MULT = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F], np.uint64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def hashed(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """The hash slot of every n-gram of the given orders (1 to 4)."""
    return hashed_points(code_points(text), orders, bits)


def hashed_points(a: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    out, h = [], np.zeros(len(a), np.uint64)
    shift = np.uint64(64 - bits)
    for n in range(1, max(orders) + 1):
        if len(a) < n:
            break
        h = (h[: len(a) - n + 1] + a[n - 1:] + np.uint64(n)) * _MULT[n - 1]
        h ^= h >> np.uint64(29)
        if n in orders:
            out.append((h * _MULT[3]) >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def counts(text: str, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots (ascending) and their counts."""
    slots = hashed(text, orders, bits)
    if len(slots) * 8 < 1 << bits:
        return np.unique(slots, return_counts=True)
    full = np.bincount(slots, minlength=1 << bits)
    at = np.flatnonzero(full)
    return at, full[at]


def count_batches(batches: Iterator[pa.RecordBatch], orders: tuple[int, ...], bits: int, lower: bool) -> Iterator[pa.RecordBatch]:
    """(order, label, text) rows to (order, label, slots, counts)."""
    schema = pa.schema([("h", pa.int64()), ("label", pa.string()), ("slots", pa.binary()), ("counts", pa.binary())])
    for b in batches:
        rows: list[list] = [[], [], [], []]
        for h, label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            text = text.as_py() or ""
            s, n = counts(text.lower() if lower else text, orders, bits)
            for col, v in zip(rows, (h, label, s.astype("<i4").tobytes(), n.astype("<i4").tobytes()), strict=True):
                col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)
