"""Size-checked broadcast.

A side is broadcast only when its size is known (counted, or proven by the
number of rows and fixed-width types) and under the limit; otherwise the
ordinary shuffle join is left to Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limit for what we broadcast ourselves (bytes).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _fixed_width(dt: T.DataType) -> int | None:
    """Bytes of a value whose type fixes them; None for variable-width types."""
    if isinstance(dt, T.StructType):
        parts = [_fixed_width(f.dataType) for f in dt.fields]
        return None if None in parts else sum(parts) + 8
    if isinstance(dt, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)):
        return None
    return 16 if isinstance(dt, T.DecimalType) else 8


def _value_bytes(f: T.StructField):
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    return 2 * F.octet_length(F.to_json(F.struct(c)))  # nested: its text, with room for headers


def size_of(df: DataFrame, n_rows: int | None = None) -> int:
    """Bytes that ``df`` takes in memory, at most: counted (one aggregate)
    unless ``n_rows`` bounds the rows and every type has a fixed width."""
    loose = [f for f in df.schema.fields if _fixed_width(f.dataType) is None]
    fixed = 16 + sum((_fixed_width(f.dataType) or 16) for f in df.schema.fields)
    if n_rows is not None and not loose:
        return n_rows * fixed
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(_value_bytes(f)).alias(f"b{i}") for i, f in enumerate(loose)]).first()
    return row["n"] * fixed + sum(row[f"b{i}"] or 0 for i in range(len(loose)))


def checked_broadcast(df: DataFrame, n_rows: int | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its size is at most ``max_bytes``, else ``df``.

    ``n_rows`` is an upper bound of the rows; it saves the count only where
    no column has a variable width.
    """
    return F.broadcast(df) if size_of(df, n_rows) <= max_bytes else df
