"""Column expressions that put landed change rows into the common CDC shape.

All of it is built-in Catalyst expressions: it stays inside whole-stage
codegen and runs on the executors, batch or stream alike.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import FRAMEWORK_COLS, TableSpec

# Accepted spellings of an insert in the op column.  Updates
# need no entry: every spelling without one is an upsert ('U').
INSERT_CODES = ("I", "INSERT")

# The least value of each type a sequence may have.
LEAST_SEQ = {
    "tinyint": -2 ** 7, "smallint": -2 ** 15, "int": -2 ** 31, "bigint": -2 ** 63,
    "float": float("-inf"), "double": float("-inf"), "string": "",
    "date": "0001-01-01", "timestamp": "0001-01-01 00:00:00", "timestamp_ntz": "0001-01-01 00:00:00",
}


def op_expr(df: DataFrame, op_col: str, delete_code: str) -> Column:
    """Normalised operation: 'D' | 'I' | 'U'.

    One lookup of the trimmed, upper-cased code in a map of the spellings
    that mean something else than an upsert.  The declared delete code wins
    over an insert spelling, so any string may mark a delete.
    """
    if op_col not in df.columns:
        return F.lit("U")
    meaning = dict.fromkeys(INSERT_CODES, "I") | {str(delete_code).strip().upper(): "D"}
    lookup = F.create_map(*[F.lit(x) for pair in meaning.items() for x in pair])
    code = F.coalesce(F.upper(F.trim(F.col(op_col).cast("string"))), F.lit(""))
    return F.coalesce(F.try_element_at(lookup, code), F.lit("U"))


def default_seed_seq(seq_type: str) -> Column:
    """The least value of the sequence's type: below every change event."""
    if seq_type.startswith("decimal"):
        digits, _, scale = seq_type[8:-1].partition(",")
        return F.lit("-" + "9" * (int(digits) - int(scale or 0)) + ("." + "9" * int(scale) if int(scale or 0) else "")).cast(seq_type)
    if seq_type not in LEAST_SEQ:
        raise ValueError(f"no least value is known for a sequence of type {seq_type}: set seed_seq")
    return F.lit(LEAST_SEQ[seq_type]).cast(seq_type)


def seq_expr(df: DataFrame, seq_col: str, seed_seq: Any = None, seq_type: str | None = None) -> Column:
    """Ordering value.  Rows without a sequence (snapshot rows, or a change
    whose sequence is NULL) get ``seed_seq``, by default the least value of
    the sequence's type, so they order below every change event and are never
    lost.  Without a sequence column at all the ingest time orders the rows.
    """
    if seq_type is None and isinstance(seed_seq, int) and not isinstance(seed_seq, bool):
        seq_type = "bigint"
    if seq_col in df.columns:
        kind = seq_type or df.schema[seq_col].dataType.simpleString()
        seed = default_seed_seq(kind) if seed_seq is None else F.lit(seed_seq).cast(kind)
        return F.coalesce(F.col(seq_col).cast(kind), seed)
    if "_ingest_ts" in df.columns and seed_seq is None:
        return F.col("_ingest_ts")
    if seed_seq is None:
        return default_seed_seq(seq_type or "bigint")
    return F.lit(seed_seq).cast(seq_type) if seq_type is not None else F.lit(seed_seq)


def standardize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``_op`` and ``_seq`` (and the soft-delete flag) to landed rows, in
    one projection.  In soft mode a delete is an upsert whose flag is true;
    every other column passes through untouched.
    """
    op = op_expr(df, spec.op_col, spec.delete_code)
    added = {"_op": op, "_seq": seq_expr(df, spec.seq_col, spec.seed_seq, spec.seq_type)}
    if spec.soft:
        gone = op.eqNullSafe(F.lit("D"))
        added |= {"_op": F.coalesce(F.nullif(op, F.lit("D")), F.lit("U")), spec.is_deleted_col: gone}
    return df.withColumns(added)


def business_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Payload columns in declared order (not keys, headers or framework)."""
    skip = set(spec.keys) | set(spec.except_columns()) | {spec.is_deleted_col}
    return [c for c in df.columns if c not in skip]


def target_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Stored columns: everything but framework and raw header columns."""
    drop = set(spec.except_columns())
    return [c for c in df.columns if c not in drop]


def drop_framework(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    cols = spec.except_columns() if spec else list(FRAMEWORK_COLS)
    return df.drop(*cols)


def total_order(df: DataFrame, spec: TableSpec, descending: bool = False) -> list[Column]:
    """The total order used to pick a winner among events of one key.

    ``(_seq, _op = 'D', business columns in declared order)``, NULLs lowest;
    the winner is the maximum.  ``descending=True`` gives the sort that puts
    the winner first.
    """
    parts = [F.col("_seq"), (F.col("_op") == F.lit("D"))]
    parts += [F.col(c) for c in business_columns(df, spec)]
    if spec.soft and spec.is_deleted_col in df.columns:
        parts.insert(2, F.col(spec.is_deleted_col))
    if descending:
        return [p.desc_nulls_last() for p in parts]
    return [p.asc_nulls_first() for p in parts]


def content_hash(cols: list[str]) -> Column:
    """Stable hex digest of a row's content, for keyless identities."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)
