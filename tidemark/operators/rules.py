"""Correctness rules for merge targets: counts and SCD2 invariants.

Every rule is a distributed query that yields one row
``(rule, violations, passed)``; the rules are unioned, so one call returns a
small DataFrame and nothing is collected while computing it.  Neighbour
lookups go through ``with_neighbors`` (hot keys are chunked).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cdc import total_order
from ..spec import END_COL, START_COL, TableSpec
from .merge import active_rows
from .windows import DEFAULT_MAX_GROUP_ROWS, with_neighbors


def _rule(name: str, df_count: DataFrame) -> DataFrame:
    """``df_count`` has one row with column ``n``."""
    return df_count.select(F.lit(name).alias("rule"), F.col("n").cast("bigint").alias("violations"),
                           (F.col("n") == 0).alias("passed"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def active_count(target: DataFrame, expected: int | None = None, is_deleted_col: str = "is_deleted") -> DataFrame:
    """V-COUNT: active (not soft-deleted) rows, optionally against an expectation."""
    n = active_rows(target, is_deleted_col).agg(F.count(F.lit(1)).alias("actual"))
    if expected is None:
        return n
    return n.select("actual", F.lit(expected).alias("expected"), (F.col("actual") == expected).alias("passed"))


def scd2_rules(scd2_df: DataFrame, keys: list[str], start: str = START_COL, end: str = END_COL,
               deletes: DataFrame | None = None,
               max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """The structural SCD2 invariants.

    * ``scd2_one_current_per_key``: keys with more than one open version;
    * ``scd2_only_last_open``: open versions followed by another version;
    * ``scd2_no_overlap``: a version starting before the previous one ends;
    * ``scd2_contiguous_history``: a closed version whose end is not the next
      start, unless a delete at that end explains the gap (``deletes`` has
      the keys and ``_seq`` of delete events; without it every gap counts);
    * ``scd2_start_before_end``: closed versions with start >= end.
    """
    keys = list(keys)
    versions = with_neighbors(scd2_df.select(*keys, F.col(start).alias("_from"), F.col(end).alias("_to")), keys,
                              [F.col("_from"), F.col("_to")], nxt={"_follows": "_from"}, prev={"_before": "_to"},
                              max_group_rows=max_group_rows)
    # one pass: violations per key (the fold's partitioning), then their sums
    is_open, jump = F.col("_to").isNull(), F.col("_has_next") & (F.col("_to") != F.col("_follows"))
    if deletes is not None:
        ends = deletes.select(*keys, F.col("_seq").alias("_to")).distinct().withColumn("_deleted", F.lit(True))
        versions = versions.join(ends, [*keys, "_to"], "left")
        jump = jump & F.col("_deleted").isNull()
    per_key = versions.groupBy(*keys).agg(
        F.count_if(is_open).alias("_open"), F.count_if(is_open & F.col("_has_next")).alias("scd2_only_last_open"),
        F.count_if(F.col("_before") > F.col("_from")).alias("scd2_no_overlap"),
        F.count_if(jump).alias("scd2_contiguous_history"), F.count_if(F.col("_to") <= F.col("_from")).alias("scd2_start_before_end"))
    summed = ("scd2_only_last_open", "scd2_no_overlap", "scd2_contiguous_history", "scd2_start_before_end")
    found = per_key.agg(F.count_if(F.col("_open") > 1).alias("scd2_one_current_per_key"),
                        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed])
    names = ("scd2_one_current_per_key", *summed)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("violations")) for n in names]))
    return found.select(rows.alias("r")).select("r.rule", "r.violations", (F.col("r.violations") == 0).alias("passed"))


def applied_events(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Winner of each (key, sequence): the events the merge applies."""
    from pyspark.sql import Window

    w = Window.partitionBy(*spec.keys, "_seq").orderBy(*total_order(changes, spec, descending=True))
    return changes.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def history_rules(scd2_df: DataFrame, changes: DataFrame, spec: TableSpec,
                  compare_cols: list[str] | None = None,
                  max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Rules that compare a SCD2 target with its standardised change feed.

    * ``scd2_current_is_latest``: keys whose open version differs from the
      latest applied non-delete event (or exists on one side only);
    * ``scd2_delete_closes``: delete events that follow a live version (the
      previous applied event is not a delete) but close none;
    * ``scd2_versions_equal_events``: keys whose number of versions differs
      from their number of applied non-delete events.
    """
    keys = list(spec.keys)
    applied = applied_events(changes, spec)
    compare_cols = compare_cols or [c for c in scd2_df.columns if c not in keys + [START_COL, END_COL]]
    # latest applied event per key, deletes included; a delete winner means no open version
    from .merge import latest_per_key
    latest = latest_per_key(changes, spec).filter(F.col("_op") != "D")
    cur = scd2_df.filter(F.col(END_COL).isNull())
    l_ = latest.select(*keys, F.struct(*[F.col(c) for c in compare_cols]).alias("_l"))
    c_ = cur.select(*keys, F.struct(*[F.col(c) for c in compare_cols]).alias("_c"))
    j = l_.join(c_, keys, "full_outer")
    bad_latest = j.filter(~F.col("_l").eqNullSafe(F.col("_c")))

    # a delete whose previous applied event is not a delete must end a version
    prev = with_neighbors(applied.select(*keys, "_seq", "_op"), keys, [F.col("_seq")],
                          prev={"_prev_op": "_op"}, max_group_rows=max_group_rows)
    must_close = prev.filter((F.col("_op") == "D") & F.col("_prev_op").isNotNull() & (F.col("_prev_op") != "D"))
    closes = scd2_df.select(*keys, F.col(END_COL).alias("_seq")).filter(F.col("_seq").isNotNull()).distinct()
    bad_delete = must_close.select(*keys, "_seq").join(closes, [*keys, "_seq"], "left_anti")

    n_ev = applied.filter(F.col("_op") != "D").groupBy(*keys).agg(F.count(F.lit(1)).alias("e"))
    n_ver = scd2_df.groupBy(*keys).agg(F.count(F.lit(1)).alias("v"))
    bad_count = n_ev.join(n_ver, keys, "full_outer").filter(~F.col("e").eqNullSafe(F.col("v")))

    out = _rule("scd2_current_is_latest", _count(bad_latest))
    out = out.unionByName(_rule("scd2_delete_closes", _count(bad_delete)))
    out = out.unionByName(_rule("scd2_versions_equal_events", _count(bad_count)))
    return out


def with_total(results: DataFrame) -> DataFrame:
    """The rules frame with one more row, ``all rules``: it passes if every
    rule does and counts all violations (V-SUMMARY)."""
    total = results.agg(F.sum("violations").cast("bigint").alias("violations"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))
    return results.select("rule", "violations", "passed").unionByName(total.withColumn("rule", F.lit("all rules")))
