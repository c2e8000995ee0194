"""Neighbour lookups (lag / lead) per key that survive hot keys.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.
When one key holds a third of the data that task is a third of the job.  The
helpers here find keys above ``max_group_rows`` with one partial-aggregated
count; those keys' rows are range-partitioned on ``(key, order)`` into
chunks of bounded size, the window runs per ``(key, chunk)``, and the rows at
chunk edges are patched from a boundary table with one row per chunk.  Keys
below the threshold take the ordinary one-shuffle window path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, materialise
from .sizing import checked_broadcast

# Default per-group row budget before a key is treated as hot.
DEFAULT_MAX_GROUP_ROWS = 2_000_000
# Target rows per chunk when a hot key is split.
DEFAULT_CHUNK_ROWS = 1_000_000
# Expected sampled rows of a key at the threshold (hot-key detection).
HOT_SAMPLE_ROWS = 200


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hot_keys(df: DataFrame, keys: list[str], max_group_rows: int,
             sample_rows: int = HOT_SAMPLE_ROWS) -> tuple[DataFrame, int, int]:
    """Keys estimated to hold more than ``max_group_rows`` rows, how many,
    and an estimate of their rows.

    A Bernoulli sample sized so that a key at the threshold shows about
    ``sample_rows`` sampled rows is counted per key (partial aggregate, tiny
    shuffle, key columns only); keys at half the threshold or more count as
    hot.  Being wrong about a key only changes the plan, never the result.
    The (rare) hot-key list is checkpointed so every later use sees the same
    keys.
    """
    fraction = min(1.0, sample_rows / max(max_group_rows, 1))
    src = df.select(*keys)
    if fraction < 1.0:
        src = src.sample(withReplacement=False, fraction=fraction, seed=17)
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") >= F.lit(max(1.0, max_group_rows * fraction / 2)))
    row = hot.agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()
    n_hot, est_rows = int(row["k"]), int(int(row["n"]) / fraction)
    if n_hot and keys:
        hot = materialise(hot.select(*keys), "hot-keys")
    return hot.select(*keys), n_hot, est_rows


def with_neighbors(
    df: DataFrame,
    keys: list[str],
    order: list,
    nxt: dict | None = None,
    prev: dict | None = None,
    max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    carry: dict | None = None,
    number: str | None = None,
    hot: tuple | None = None,
    cumsum: dict | None = None,
) -> DataFrame:
    """Add ``lead``/``lag`` values within each key, ordered ascending
    (NULLs first) by the value columns ``order``.

    ``nxt = {"out": expr}`` adds column ``out`` = ``expr`` on the next row of
    the same key (NULL on the last row); ``prev`` likewise for the previous
    row.  ``carry = {"out": expr}`` adds the last non-NULL value of ``expr``
    up to and including the row (a forward fill).  ``number="out"`` adds the
    1-based row number within the key; ``cumsum = {"out": expr}`` the running
    sum of ``expr`` up to and including the row.  Boolean ``_has_next`` /
    ``_has_prev`` tell a NULL value from a missing neighbour.
    ``max_group_rows=None`` skips the hot-key check; ``hot`` passes a
    decision from :func:`hot_keys` made on the same rows and keys (multi-pass
    operators check once).
    """
    nxt, prev, carry, keys = dict(nxt or {}), dict(prev or {}), dict(carry or {}), list(keys)
    cumsum = dict(cumsum or {})
    order = [_c(o) for o in order]
    if max_group_rows is None:
        return _windowed(df, keys, order, nxt, prev, carry, number, cumsum)
    hot, n_hot, hot_rows = hot if hot is not None else hot_keys(df, keys, max_group_rows)
    if n_hot == 0:
        return _windowed(df, keys, order, nxt, prev, carry, number, cumsum)

    spark = df.sparkSession
    if keys:
        flag = checked_broadcast(hot.select(*[F.col(k).alias(f"_hk_{k}") for k in keys], F.lit(True).alias("_hot")), n_hot)
        same = [F.col(k).eqNullSafe(F.col(f"_hk_{k}")) for k in keys]
        marked = df.join(flag, same, "left").drop(*[f"_hk_{k}" for k in keys])
    else:  # the whole frame is one group
        marked = df.withColumn("_hot", F.lit(True))
    cold = _windowed(marked.filter(F.col("_hot").isNull()).drop("_hot"), keys, order, nxt, prev, carry, number, cumsum)

    n_chunks = max(default_parallelism(spark), math.ceil(hot_rows / max(chunk_rows, 1)))
    # Range partitioning keeps equal (key, order) values together and hands
    # out contiguous, ordered slices of each hot key; the slice's partition id
    # is its chunk number and grows with the order.  The rows are written with
    # their chunk once: the window and the boundary table below must agree on
    # it, and two range exchanges would sample different split points.
    warm = (marked.filter(F.col("_hot").isNotNull()).drop("_hot")
            .repartitionByRange(n_chunks, *[F.col(k) for k in keys], *[o.asc_nulls_first() for o in order])
            .withColumn("_chunk", F.spark_partition_id()))
    warm = materialise(warm, "hot-chunks")
    warm_w = _windowed(warm, keys + ["_chunk"], order, nxt, prev, carry, number, cumsum)

    # One row per (hot key, chunk): values of its first and last row.
    ord_key = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    first_vals = F.struct(F.lit(True).alias("_x"), *[_c(e).alias(n) for n, e in nxt.items()])
    last_vals = F.struct(F.lit(True).alias("_x"), *[_c(e).alias(n) for n, e in prev.items()])
    # last non-NULL value of each carried expression within the chunk
    carry_last = [F.max_by(_c(e), F.when(_c(e).isNotNull(), ord_key)).alias(f"_cl_{n}") for n, e in carry.items()]
    bounds = (warm.groupBy(*keys, "_chunk")
              .agg(F.min_by(first_vals, ord_key).alias("_first"), F.max_by(last_vals, ord_key).alias("_last"),
                   F.count(F.lit(1)).alias("_cnt"), *carry_last,
                   *[F.sum(_c(e)).alias(f"_cs_{n}") for n, e in cumsum.items()]))
    wc = (Window.partitionBy(*keys) if keys else Window).orderBy("_chunk")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    edges = (bounds.withColumn("_next_first", F.lead("_first").over(wc))
                   .withColumn("_prev_last", F.lag("_last").over(wc))
                   .withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0))))
    for n in carry:
        edges = edges.withColumn(f"_ci_{n}", F.last(f"_cl_{n}", ignorenulls=True).over(before))
    for n in cumsum:
        edges = edges.withColumn(f"_co_{n}", F.coalesce(F.sum(f"_cs_{n}").over(before), F.lit(0)))
    edges = edges.select(*[F.col(k).alias(f"_ek_{k}") for k in keys], F.col("_chunk").alias("_ek"), "_next_first", "_prev_last", "_offset",
                         *[f"_ci_{n}" for n in carry], *[f"_co_{n}" for n in cumsum])
    # At most one edge row per chunk and hot key; a key may hold NULLs.
    edge = F.col("_chunk") == F.col("_ek")
    for k in keys:
        edge = edge & F.col(k).eqNullSafe(F.col(f"_ek_{k}"))
    patched = warm_w.join(checked_broadcast(edges, n_chunks + n_hot), edge, "left").drop("_ek", *[f"_ek_{k}" for k in keys])
    for name in nxt:
        patched = patched.withColumn(
            name, F.when(F.col("_has_next"), F.col(name)).otherwise(F.col("_next_first").getField(name)))
    for name in prev:
        patched = patched.withColumn(
            name, F.when(F.col("_has_prev"), F.col(name)).otherwise(F.col("_prev_last").getField(name)))
    for name in carry:
        patched = patched.withColumn(name, F.coalesce(F.col(name), F.col(f"_ci_{name}")))
    if number:
        patched = patched.withColumn(number, F.col(number) + F.col("_offset"))
    for name in cumsum:
        patched = patched.withColumn(name, F.col(name) + F.col(f"_co_{name}"))
    patched = (patched.withColumn("_has_next", F.col("_has_next") | F.col("_next_first").isNotNull())
                      .withColumn("_has_prev", F.col("_has_prev") | F.col("_prev_last").isNotNull())
                      .drop("_chunk", "_next_first", "_prev_last", "_offset", *[f"_ci_{n}" for n in carry],
                            *[f"_co_{n}" for n in cumsum]))
    return cold.unionByName(patched)


def _windowed(df, keys, order, nxt, prev, carry=None, number=None, cumsum=None) -> DataFrame:
    spec = Window.partitionBy(*keys) if keys else Window
    w = spec.orderBy(*[o.asc_nulls_first() for o in order])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col(c) for c in df.columns]
    cols += [F.lead(_c(e)).over(w).alias(n) for n, e in nxt.items()]
    cols += [F.lag(_c(e)).over(w).alias(n) for n, e in prev.items()]
    cols += [F.last(_c(e), ignorenulls=True).over(upto).alias(n) for n, e in (carry or {}).items()]
    if number:
        cols.append(F.row_number().over(w).cast("bigint").alias(number))
    cols += [F.sum(_c(e)).over(upto).alias(n) for n, e in (cumsum or {}).items()]
    cols += [F.lead(F.lit(True)).over(w).isNotNull().alias("_has_next"),
             F.lag(F.lit(True)).over(w).isNotNull().alias("_has_prev")]
    return df.select(*cols)
