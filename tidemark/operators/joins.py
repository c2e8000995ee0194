"""Joins the CDC layer needs: point-in-time (as-of) against SCD2, lookups
with misses, referential checks, grain checks, and event-time intervals.

None of them compares every pair of rows inside a key: the as-of join is a
sorted merge (union + forward fill per key, hot keys chunked), and the
interval join equi-joins on (key, time bucket) so a key's rows only meet
rows of adjacent buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from ..spec import END_COL, START_COL
from .sizing import checked_broadcast
from .windows import DEFAULT_MAX_GROUP_ROWS, with_neighbors


def as_of(scd2: DataFrame, at, start: str = START_COL, end: str = END_COL) -> DataFrame:
    """Versions valid at ``at`` (a value or Column): start <= at < end."""
    at = at if hasattr(at, "_jc") else F.lit(at)
    return scd2.filter((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def as_of_join(facts: DataFrame, scd2: DataFrame, keys: list[str], fact_seq: str,
               version_cols: list[str], start: str = START_COL, end: str = END_COL,
               max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Each fact with the version of its key valid at the fact's sequence
    (left join semantics: no valid version -> NULL version columns).

    Facts and versions are unioned, ordered per key by (sequence, versions
    before facts), and each fact takes the latest version started at or
    before it (forward fill); it matches when its sequence is before that
    version's end.
    """
    keys = list(keys)
    vstruct = F.struct(*[F.col(c).alias(c) for c in version_cols], F.col(start).alias(start), F.col(end).alias(end))
    fcols = [c for c in facts.columns if c not in keys]
    fstruct = F.struct(*[F.col(c) for c in fcols])
    v = scd2.select(*keys, F.col(start).alias("_t"), F.lit(0).alias("_side"), vstruct.alias("_v"))
    f = facts.select(*keys, F.col(fact_seq).alias("_t"), F.lit(1).alias("_side"), fstruct.alias("_f"))
    v = v.withColumn("_f", F.lit(None).cast(f.schema["_f"].dataType))
    f = f.withColumn("_v", F.lit(None).cast(v.schema["_v"].dataType))
    both = v.unionByName(f)
    filled = with_neighbors(both, keys, [F.col("_t"), F.col("_side")], carry={"_cur": "_v"},
                            max_group_rows=max_group_rows)
    out = filled.filter(F.col("_side") == 1)
    valid = F.col("_cur").isNotNull() & (F.col(f"_cur.{end}").isNull() | (F.col("_t") < F.col(f"_cur.{end}")))
    cols = [F.col(k) for k in keys] + [F.col(f"_f.{c}").alias(c) for c in fcols]
    cols += [F.when(valid, F.col(f"_cur.{c}")).alias(c) for c in version_cols + [start, end]]
    return out.select(*cols)


def lookup_split(facts: DataFrame, reference: DataFrame, fact_keys: list[str], ref_keys: list[str],
                 ref_cols: list[str], ref_order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Enrich facts from reference data; a miss is "not yet", not invalid.

    Returns (resolved, missed).  The reference side is reduced to one row per
    key before the join, the largest by ``ref_order`` (default: by the
    looked-up columns), so the join cannot multiply facts and does not depend
    on the order of the rows.  The joined rows are written once: both results
    come from the same evaluation of facts and reference.
    """
    best = F.max_by(F.struct(*ref_cols), F.struct(*(ref_order or ref_cols)))
    ref = (reference.groupBy(*[F.col(r).alias(f) for r, f in zip(ref_keys, fact_keys)]).agg(best.alias("_ref"))
           .select(*fact_keys, "_ref.*", F.lit(True).alias("_hit")))
    j = materialise(facts.join(ref, fact_keys, "left"), "lookup")
    resolved = j.filter(F.col("_hit").isNotNull()).drop("_hit")
    missed = j.filter(F.col("_hit").isNull()).drop("_hit", *ref_cols)
    return resolved, missed


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str]) -> DataFrame:
    """Child rows whose parent does not exist (J-REF)."""
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)])
    return child.join(p, child_keys, "left_anti")


def grain_report(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """How much a join on these keys would multiply rows (J-GRAIN).

    Both sides are reduced to per-key counts (partial aggregates) and joined
    key to key: rows the join would emit = sum over keys of n_left * n_right.
    """
    lc = left.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(left_keys)]).agg(F.count(F.lit(1)).alias("n"))
    rc = right.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(right_keys)]).agg(F.count(F.lit(1)).alias("m"))
    ks = [f"_k{i}" for i in range(len(left_keys))]
    j = lc.join(rc, ks, "full_outer")
    return j.agg(
        F.sum("n").cast("bigint").alias("left_rows"), F.sum("m").cast("bigint").alias("right_rows"),
        F.count("n").cast("bigint").alias("left_keys"), F.count("m").cast("bigint").alias("right_keys"),
        F.count(F.when(F.col("n").isNotNull() & F.col("m").isNotNull(), 1)).cast("bigint").alias("matched_keys"),
        F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).cast("bigint").alias("join_rows"),
        F.max("m").cast("bigint").alias("max_right_per_key"),
    )


def dedup_then_join(left: DataFrame, right: DataFrame, keys: list[str], right_order: list,
                    how: str = "left") -> DataFrame:
    """Reduce ``right`` to its latest row per key (by ``right_order``, the
    maximum wins), then join: the left grain is kept.  Adaptive execution
    picks the join from the reduced side's actual size, so it is not computed
    once more to be counted."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in right_order])
    one = right.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return left.join(one, keys, how)


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                  lower_sec: int, upper_sec: int, bucket_sec: int | None = None,
                  how: str = "inner") -> DataFrame:
    """Pairs with equal keys and ``lower <= right_ts - left_ts <= upper``.

    Each left row gets the time bucket (``bucket_sec``, default the
    interval width) of its own time; each right row is copied into the left
    buckets whose rows it can match, so one equi-join on (key, bucket) with
    the exact interval as join condition forms every pair exactly once and
    only compares rows of nearby buckets.  ``how='left'`` keeps unmatched
    left rows (once, with NULLs) in the same join.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_join supports how='inner' or 'left'")
    b_us = (bucket_sec or max(upper_sec - lower_sec, 1)) * 1_000_000
    lt = F.unix_micros(F.col(left_ts).cast("timestamp"))
    rt = F.unix_micros(F.col(right_ts).cast("timestamp"))
    lb = left.withColumn("_bkt", F.floor(lt / F.lit(b_us)).cast("bigint"))
    # left time lies in [right - upper, right - lower]
    lo_b = F.floor((rt - F.lit(upper_sec * 1_000_000)) / F.lit(b_us)).cast("bigint")
    hi_b = F.floor((rt - F.lit(lower_sec * 1_000_000)) / F.lit(b_us)).cast("bigint")
    rk = {k: f"_r_{k}" for k in keys}
    rb = right.withColumn("_r_bkt", F.explode(F.sequence(lo_b, hi_b)))
    rb = rb.select(*[F.col(c).alias(rk.get(c, c)) for c in rb.columns])
    d = F.unix_micros(F.col(right_ts).cast("timestamp")) - F.unix_micros(F.col(left_ts).cast("timestamp"))
    cond = (F.col("_bkt") == F.col("_r_bkt")) & (d >= F.lit(lower_sec * 1_000_000)) & (d <= F.lit(upper_sec * 1_000_000))
    for k in keys:
        cond = cond & (F.col(k) == F.col(rk[k]))
    return lb.join(rb, cond, how).drop("_bkt", "_r_bkt", *rk.values())


def scd2_join(left: DataFrame, right: DataFrame, keys: list[str], start: str = "__START_AT", end: str = "__END_AT",
              max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Both histories side by side (J-ASOF on two histories): one row per key
    and span in which a version of each is valid, ``[start, end)``.

    A sweep over the union of all starts and ends: every boundary sets or
    clears its side, a forward fill carries both sides on, and a span is the
    step to the key's next boundary.  The work is the number of versions, not
    of overlapping pairs, and a hot key is chunked like any ordering.
    Payload columns must not share names."""
    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        payload = [c for c in df.columns if c not in (*keys, start, end)]
        value = F.struct(*[F.col(c) for c in payload])
        kind = T.StructType([T.StructField("on", T.BooleanType()), T.StructField("v", T.StructType([df.schema[c] for c in payload]))])
        opens = df.select(*keys, F.col(start).alias("_t"), F.lit(1).alias("_k"), F.struct(F.lit(True).alias("on"), value.alias("v")).cast(kind).alias(name))
        shuts = df.filter(F.col(end).isNotNull()).select(*keys, F.col(end).alias("_t"), F.lit(0).alias("_k"),
                                                         F.struct(F.lit(False).alias("on"), F.lit(None).alias("v")).cast(kind).alias(name))
        return opens.unionByName(shuts)
    both = side(left, "_l", "_r").unionByName(side(right, "_r", "_l"), allowMissingColumns=True)
    swept = with_neighbors(both, keys, [F.col("_t"), F.col("_k")], nxt={"_to": "_t"}, carry={"_lv": "_l", "_rv": "_r"}, max_group_rows=max_group_rows)
    spans = swept.filter(F.col("_lv.on") & F.col("_rv.on") & (F.col("_to").isNull() | (F.col("_to") > F.col("_t"))))
    cols = [F.col(f"{s}.v").getField(c).alias(c) for s, df in (("_lv", left), ("_rv", right)) for c in df.columns if c not in (*keys, start, end)]
    return spans.select(*keys, *cols, F.col("_t").alias(start), F.col("_to").alias(end))
