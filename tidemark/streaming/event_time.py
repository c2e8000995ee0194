"""Event-time streaming: watermarked windows, sessions, dedup, interval joins.

Streams need ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``) event-time columns for
watermarks; ``as_event_time`` casts with the session time zone (UTC), and
results are cast back.  Rows older than the watermark are dropped by Spark;
state is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_event_time(df: DataFrame, ts: str, out: str = "_event_time") -> DataFrame:
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def windowed_counts(stream: DataFrame, ts: str, size: str, watermark: str, group_cols: list[str], aggs: list,
                    slide: str | None = None) -> DataFrame:
    """Append-mode windowed aggregate: a window is emitted once the watermark
    passes its end; later rows for it are dropped."""
    s = as_event_time(stream, ts).withWatermark("_event_time", watermark)
    w = F.window("_event_time", size, slide) if slide else F.window("_event_time", size)
    out = s.groupBy(w.alias("_w"), *group_cols).agg(*aggs)
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
                      *group_cols, *[c for c in out.columns if c not in ("_w", *group_cols)])


def session_counts(stream: DataFrame, ts: str, gap: str, watermark: str, keys: list[str], aggs: list) -> DataFrame:
    s = as_event_time(stream, ts).withWatermark("_event_time", watermark)
    out = s.groupBy(F.session_window("_event_time", gap).alias("_w"), *keys).agg(*aggs)
    return out.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("_w.end").cast("timestamp_ntz").alias("session_end"),
                      *[c for c in out.columns if c not in ("_w", *keys)])


def dedup(stream: DataFrame, ts: str, watermark: str, cols: list[str]) -> DataFrame:
    """Drop rows repeating ``cols`` within the watermark delay."""
    s = as_event_time(stream, ts).withWatermark("_event_time", watermark)
    return s.dropDuplicatesWithinWatermark(cols).drop("_event_time")


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                  lower: str, upper: str, watermark: str, how: str = "inner") -> DataFrame:
    """Stream-stream join with an event-time range; both sides watermarked so
    the join state is bounded."""
    lt, rt = "_lt", "_rt"
    l2 = left.withColumn(lt, F.col(left_ts).cast("timestamp")).withWatermark(lt, watermark)
    r2 = right.withColumn(rt, F.col(right_ts).cast("timestamp")).withWatermark(rt, watermark)
    rk = {k: f"_r_{k}" for k in keys}
    r2 = r2.select(*[F.col(c).alias(rk.get(c, c)) for c in r2.columns])
    cond = [F.col(k) == F.col(rk[k]) for k in keys]
    cond.append(F.col(rt) >= F.col(lt) + F.expr(f"INTERVAL {lower}"))
    cond.append(F.col(rt) <= F.col(lt) + F.expr(f"INTERVAL {upper}"))
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return l2.join(r2, c, how).drop(lt, rt, *rk.values())


def deduplicated_windows(stream: DataFrame, ts: str, cols: list[str], size: str, watermark: str, group_cols: list[str], aggs: list) -> DataFrame:
    """Two stateful operators in one query: rows that repeat ``cols`` within
    the watermark are dropped, and windows count what is left (append mode).
    Rows behind the watermark are counted by Spark, see
    :func:`dropped_by_watermark`."""
    once = as_event_time(stream, ts).withWatermark("_event_time", watermark).dropDuplicatesWithinWatermark(cols)
    out = once.groupBy(F.window("_event_time", size).alias("_w"), *group_cols).agg(*aggs)
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
                      *group_cols, *[c for c in out.columns if c not in ("_w", *group_cols)])


def dropped_by_watermark(query) -> int:
    """Rows that the stateful operators of a query dropped as too late, over
    the batches that its progress still lists."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
