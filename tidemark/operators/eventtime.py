"""Event-time operators in batch form (the streaming forms live in
``streaming.event_time`` and compute the same results for closed windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import DEFAULT_MAX_GROUP_ROWS, hot_keys, with_neighbors


def tumbling(df: DataFrame, ts: str, size: str, group_cols: list[str], aggs: list) -> DataFrame:
    """Tumbling (or, with ``size`` like '1 hour, 15 minutes', sliding)
    windows: ``window_start``, ``window_end``, groups, aggregates.  Partial
    aggregation runs before the shuffle."""
    parts = [p.strip() for p in size.split(",")]
    w = F.window(F.col(ts), parts[0], parts[1]) if len(parts) > 1 else F.window(F.col(ts), parts[0])
    out = df.groupBy(w.alias("_w"), *group_cols).agg(*aggs)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *group_cols, *[c for c in out.columns if c not in ("_w", *group_cols)])


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_sec: int,
               max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Tag each row with ``session_start``: a new session begins when the gap
    to the key's previous event is at least ``gap_sec`` (the rule of
    ``session_window``).  Two neighbour passes (previous time, then forward
    fill of session starts) so a hot key is split into chunks."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # both passes see the same rows and keys: one hot-key decision
    hot = hot_keys(df, list(keys), max_group_rows) if max_group_rows is not None else None
    a = with_neighbors(df.withColumn("_us", micros), keys, [F.col("_us")], prev={"_prev_us": "_us"},
                       max_group_rows=max_group_rows, hot=hot)
    starts = (F.col("_prev_us").isNull()) | ((F.col("_us") - F.col("_prev_us")) >= F.lit(gap_sec * 1_000_000))
    a = a.withColumn("_start_us", F.when(starts, F.col("_us"))).drop("_has_next", "_has_prev", "_prev_us")
    b = with_neighbors(a, keys, [F.col("_us")], carry={"_session_us": "_start_us"}, max_group_rows=max_group_rows,
                       hot=hot)
    return b.drop("_has_next", "_has_prev", "_start_us")


def sessions(df: DataFrame, keys: list[str], ts: str, gap_sec: int, aggs: list,
             max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """One row per session: start, end (last event + gap), aggregates."""
    tagged = sessionize(df, keys, ts, gap_sec, max_group_rows)
    g = tagged.groupBy(*keys, "_session_us").agg(F.max("_us").alias("_last_us"), *aggs)
    start = F.timestamp_micros(F.col("_session_us")).cast("timestamp_ntz")
    end = F.timestamp_micros(F.col("_last_us") + F.lit(gap_sec * 1_000_000)).cast("timestamp_ntz")
    rest = [c for c in g.columns if c not in (*keys, "_session_us", "_last_us")]
    return g.select(*keys, start.alias("session_start"), end.alias("session_end"), *rest)
