"""The change merge: SCD1 (latest state), SCD2 (history) and append.

Input is a standardised change DataFrame (``functions.cdc.standardize``).
Results do not depend on arrival order, batching or replay: the winner of a
key is the maximum under the total order of ``functions.cdc.total_order``,
and equal (key, sequence) events collapse to that winner.

Physical shape:
* SCD1 and SCD2 share one fold: ``operators.windows.with_neighbors`` over
  the total order gives each event its successor; the SCD1 winner is the
  event without one, SCD2 versions are the last events of each sequence.
  One shuffle per key normally, range-chunked for hot keys.  (A
  ``row_number() = 1`` plan would add a full map-side sort for its partial
  ``WindowGroupLimit``, which buys little when keys change a few times.)
* ``latest_per_key`` keeps the ``row_number`` form for callers that want
  every column of the winner including deletes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cdc import business_columns, target_columns, total_order
from ..spec import END_COL, START_COL, TableSpec
from .windows import DEFAULT_MAX_GROUP_ROWS, with_neighbors


def _require_seq(df: DataFrame) -> None:
    if "_seq" not in df.columns or "_op" not in df.columns:
        raise ValueError("merge input must be standardised (needs _op and _seq)")


def latest_per_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Winning event per key (deletes included), all columns kept."""
    _require_seq(df)
    w = Window.partitionBy(*spec.keys).orderBy(*total_order(df, spec, descending=True))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _valid_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with a NULL key are never merged (they belong in quarantine)."""
    cond = None
    for k in spec.keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def fold(df: DataFrame, spec: TableSpec, max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS, carry: dict | None = None,
         helpers: tuple[str, ...] = (), known_live: str | None = None) -> DataFrame:
    """The one shuffle both targets share: every valid event with the
    sequence of its successor in the key's total order (``_next_seq``) and
    whether it has one (``_has_next``).  Persist or checkpoint it when both
    targets are built from it.

    For folds over a part of the history: ``carry`` adds forward fills,
    ``helpers`` names columns that are no payload, and ``known_live`` the
    column with an event's last live payload, and the sequence ``_at`` that it
    comes from, where that is known already."""
    df = _valid_keys(df, spec)
    _require_seq(df)
    order_vals = [F.col("_seq"), (F.col("_op") == F.lit("D"))]
    if spec.soft and spec.is_deleted_col in df.columns:
        order_vals.append(F.col(spec.is_deleted_col))
    payload = [c for c in business_columns(df, spec) if c not in helpers]
    order_vals += [F.col(c) for c in payload]
    carry = dict(carry or {})
    keep = spec.soft and spec.keep_last_values and spec.is_deleted_col in df.columns and payload
    if keep:
        # the last live (not deleted) payload up to each event, same window
        at = [F.col("_seq").alias("_at")] if known_live else []
        live = F.when(~F.coalesce(F.col(spec.is_deleted_col), F.lit(False)), F.struct(*[F.col(c) for c in payload], *at))
        if known_live:
            live = F.coalesce(live, F.col(known_live))
        carry["_live"] = live
    out = with_neighbors(df, list(spec.keys), order_vals, nxt={"_next_seq": "_seq"}, carry=carry,
                         max_group_rows=max_group_rows).drop("_has_prev")
    if keep:
        # a soft delete keeps the last known values (when there are any)
        flag = F.coalesce(F.col(spec.is_deleted_col), F.lit(False)) & F.col("_live").isNotNull()
        for c in payload:
            out = out.withColumn(c, F.when(flag, F.col("_live").getField(c)).otherwise(F.col(c)))
        out = out if known_live else out.drop("_live")
    return out


def scd1_from_fold(folded: DataFrame, spec: TableSpec) -> DataFrame:
    """Latest state: the last event of each key under the total order."""
    latest = folded.filter(~F.col("_has_next"))
    if not spec.soft:
        latest = latest.filter(F.col("_op") != F.lit("D"))
    return latest.select(*target_columns(folded.drop("_next_seq", "_has_next"), spec))


def last_of_sequence(folded: DataFrame) -> DataFrame:
    """The winner of each (key, sequence); a NULL sequence is a value like
    any other here, so no event is lost to a comparison with NULL."""
    return folded.filter(~(F.col("_has_next") & F.col("_next_seq").eqNullSafe(F.col("_seq"))))


def scd2_from_fold(folded: DataFrame, spec: TableSpec) -> DataFrame:
    """History: the last event of each equal (key, sequence) run is its
    winner, and its successor's sequence is the next distinct sequence, i.e.
    the version's end.  A delete ends the version before it and adds none
    (hard); in soft mode it is a version."""
    winners = last_of_sequence(folded)
    if not spec.soft:
        winners = winners.filter(F.col("_op") != F.lit("D"))
    cols = target_columns(folded.drop("_next_seq", "_has_next"), spec)
    return winners.select(*cols, F.col("_seq").alias(START_COL), F.col("_next_seq").alias(END_COL))


def scd1(df: DataFrame, spec: TableSpec, max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Latest state per key.  Hard mode drops keys whose winner is a delete;
    soft mode keeps them flagged."""
    return scd1_from_fold(fold(df, spec, max_group_rows), spec)


def scd2(df: DataFrame, spec: TableSpec, max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Version history per key: ``[__START_AT, __END_AT)``, open end = NULL."""
    return scd2_from_fold(fold(df, spec, max_group_rows), spec)


def scd_targets(df: DataFrame, spec: TableSpec, max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> dict[int, DataFrame]:
    """Both targets of one processed source (M-BOTH) as plans."""
    return targets_from_fold(fold(df, spec, max_group_rows), spec)


def targets_from_fold(folded: DataFrame, spec: TableSpec) -> dict[int, DataFrame]:
    """The spec's targets from a fold the caller may have persisted, so that
    writing both targets costs one shuffle."""
    out = {}
    if 1 in spec.scd_types:
        out[1] = scd1_from_fold(folded, spec)
    if 2 in spec.scd_types:
        out[2] = scd2_from_fold(folded, spec)
    return out


def current_versions(scd2_df: DataFrame) -> DataFrame:
    """Open SCD2 versions (``__END_AT IS NULL``)."""
    return scd2_df.filter(F.col(END_COL).isNull())


def active_rows(df: DataFrame, is_deleted_col: str = "is_deleted") -> DataFrame:
    """Rows that are not soft-deleted (all rows when there is no flag)."""
    if is_deleted_col in df.columns:
        return df.filter(~F.coalesce(F.col(is_deleted_col), F.lit(False)))
    return df
