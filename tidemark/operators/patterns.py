"""Change-feed patterns around the merge: net change per batch, no-op
filtering, identities for keyless rows, key renumbering, balanced
segments.  All aggregates are partial (map-side combined); all per-key
orderings go through ``with_neighbors`` (hot keys chunked)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cdc import business_columns, content_hash
from ..session import materialise
from ..spec import TableSpec
from .windows import DEFAULT_MAX_GROUP_ROWS, with_neighbors


def net_change(df: DataFrame, spec: TableSpec, batch_col: str | Column) -> DataFrame:
    """Net effect of each key's changes within a batch (M-NET).

    One row per (key, batch): number of changes, first and last op, the
    winning event's payload (deletes kept), and the net op: an insert later
    deleted in the same batch nets to nothing ('N'), a batch ending in a
    delete nets to 'D', one starting with an insert to 'I', else 'U'.
    """
    batch = F.col(batch_col) if isinstance(batch_col, str) else batch_col
    payload = business_columns(df, spec)
    order = F.struct(F.col("_seq").alias("s"), (F.col("_op") == "D").alias("d"),
                     *[F.col(c).alias(f"c{i}") for i, c in enumerate(payload)])
    last = F.struct(F.col("_op").alias("op"), F.col("_seq").alias("seq"), *[F.col(c) for c in payload])
    g = (df.withColumn("_batch", batch).groupBy(*spec.keys, "_batch")
         .agg(F.count(F.lit(1)).cast("bigint").alias("n_changes"),
              F.min_by(F.col("_op"), order).alias("first_op"),
              F.max_by(last, order).alias("_last")))
    net = (F.when((F.col("first_op") == "I") & (F.col("_last.op") == "D"), F.lit("N"))
           .when(F.col("_last.op") == "D", F.lit("D"))
           .when(F.col("first_op") == "I", F.lit("I")).otherwise(F.lit("U")))
    return g.select(*spec.keys, F.col("_batch").alias("batch"), "n_changes", "first_op",
                    F.col("_last.op").alias("last_op"), F.col("_last.seq").alias("last_seq"),
                    *[F.col(f"_last.{c}").alias(c) for c in payload], net.alias("net_op"))


def flag_noops(df: DataFrame, spec: TableSpec, compare_cols: list[str],
               max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Mark changes that alter nothing (F-NOOP, opt-in): a non-delete whose
    ``compare_cols`` equal (NULL-safe) those of the key's previous event,
    when that event was not a delete.  Adds boolean ``_noop``."""
    cmp = F.struct(*[F.col(c) for c in compare_cols])
    nb = with_neighbors(df.withColumn("_cmp", cmp), list(spec.keys), [F.col("_seq")],
                        prev={"_prev_cmp": "_cmp", "_prev_op": "_op"}, max_group_rows=max_group_rows)
    noop = (F.col("_op") != "D") & F.col("_has_prev") & (F.col("_prev_op") != "D") & F.col("_cmp").eqNullSafe(F.col("_prev_cmp"))
    return nb.withColumn("_noop", noop).drop("_cmp", "_prev_cmp", "_prev_op", "_has_next", "_has_prev")


def noop_report(flagged: DataFrame) -> DataFrame:
    """Volume by op: changes in, no-ops, kept."""
    return flagged.groupBy(F.col("_op").alias("op")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_changes"),
        F.count_if(F.col("_noop")).cast("bigint").alias("n_noop"),
        F.count_if(~F.col("_noop")).cast("bigint").alias("n_kept"))


def synthetic_identity(df: DataFrame, content_cols: list[str], order_cols: list[str],
                       max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS, with_hash: bool = True) -> DataFrame:
    """Identity for keyless rows (M-SYNTH): ``_dup_no``, the copy's number
    among rows with identical content ordered by ``order_cols`` (e.g. file,
    sequence), and optionally ``_row_hash`` (SHA-256 of the content).
    (content, ``_dup_no``) or (``_row_hash``, ``_dup_no``) is then a key.

    Copies are grouped on the content columns themselves (exact, no hash
    collisions, no per-row hashing for the grouping); a group of copies
    holding a third of the data is chunked by ``with_neighbors``.
    """
    out = with_neighbors(df, list(content_cols), [F.col(c) for c in order_cols], number="_dup_no",
                         max_group_rows=max_group_rows).drop("_has_next", "_has_prev")
    if with_hash:
        out = out.withColumn("_row_hash", content_hash(content_cols))
    return out


def resolve_key_chains(mapping: DataFrame, old: str = "old_key", new: str = "new_key") -> DataFrame:
    """Collapse renumbering chains a->b->c into a->c.

    Pointer doubling: each round joins the mapping with itself, so a chain of
    n hops is resolved in about log2(n) rounds, whatever its length.  Every
    round is written, which cuts the lineage.  A mapping that still moves
    after as many rounds as its number of rows allows has a cycle: an error.
    """
    cur = materialise(mapping.select(F.col(old).alias("old_key"), F.col(new).alias("new_key")).filter("old_key != new_key"), "rekey")
    rounds = math.ceil(math.log2(max(cur.count(), 1))) + 2
    for _ in range(rounds):
        ahead = cur.select(F.col("old_key").alias("new_key"), F.col("new_key").alias("_next"))
        step = materialise(cur.join(ahead, "new_key", "left").select("old_key", F.coalesce("_next", "new_key").alias("new_key"),
                                                                     F.col("_next").isNotNull().alias("_moved")), "rekey")
        cur = step.drop("_moved")
        if not step.filter("_moved").limit(1).count():
            return cur
    raise ValueError("the key mapping has a cycle")


def rekey(df: DataFrame, chains: DataFrame, key: str) -> DataFrame:
    """Rewrite ``key`` through the resolved mapping (keys without a mapping
    keep their value)."""
    m = chains.select(F.col("old_key").alias(key), F.col("new_key").alias("_new_key"))
    return df.join(m, key, "left").withColumn(key, F.coalesce("_new_key", key)).drop("_new_key")


def segment_bounds(df: DataFrame, key: str, n_segments: int,
                   max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Balanced key ranges for parallel extraction (W-SEGMENT), with
    ``ntile`` semantics: the first (rows mod N) segments hold one row more.

    The global row number comes from ``with_neighbors`` over one group, so
    above ``max_group_rows`` it is computed on range-partitioned chunks
    instead of in a single task.
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    numbered = with_neighbors(df.select(key), [], [F.col(key)], number="_rn", max_group_rows=max_group_rows)
    q = F.floor(n / F.lit(n_segments))
    r = n - q * F.lit(n_segments)
    i = F.col("_rn")
    big = r * (q + 1)
    seg = F.when(i <= big, F.floor((i - 1) / (q + 1)) + 1).otherwise(r + F.floor((i - big - 1) / q) + 1)
    return (numbered.withColumn("segment", seg.cast("int")).groupBy("segment")
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def sketched_segments(df: DataFrame, key: str, n_segments: int, accuracy: int = 10_000) -> DataFrame:
    """Balanced key ranges without a sort of the keys (W-SEGMENT).

    A mergeable quantile summary (rank error rows / ``accuracy``) picks the
    ``n_segments - 1`` split points, which reach the driver; one aggregate
    then counts every range exactly.  Equal keys are never split.
    """
    cuts = df.agg(F.percentile_approx(key, [i / n_segments for i in range(1, n_segments)], accuracy).alias("c")).first()["c"]
    inner = F.array(*[F.lit(c) for c in cuts or []])
    segment = F.when(F.col(key).isNotNull(), F.size(F.filter(inner, lambda c: c < F.col(key))) + 1) if cuts else F.lit(1)
    return (df.select(key, segment.cast("int").alias("segment")).groupBy("segment")
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).cast("bigint").alias("n_rows")))
