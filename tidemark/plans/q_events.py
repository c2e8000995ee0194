"""Catalogue: event-time windows, sessions, dedup and interval joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eventtime, joins, quality
from ..operators.quality import Rule
from ..session import scratch_dir
from ..sources.files import CORRUPT, SchemaStore, read_checked, stream_landed
from ..sources.tables import table
from ..streaming import event_time as ST
from .catalog import ORACLE_SQL, register


@register("event_window_agg", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, CAST(count(*) AS BIGINT) AS n_events, round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2, 3
""")
def event_window_agg(spark, sf_dir):
    """Hourly tumbling windows per event type (the batch form of the
    watermarked stream; see ``streaming.event_time.windowed_counts``)."""
    ev = table(spark, sf_dir, "events")
    out = eventtime.tumbling(ev, "ts", "1 hour", ["event_type"],
                             [F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")])
    return out.withColumn("total_value", F.round("total_value", 2))


SESSION_GAP_SEC = 6 * 3600


@register("event_sessions", f"""
WITH t AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                        OR date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) >= {SESSION_GAP_SEC * 1000000}
                     THEN 1 ELSE 0 END AS new_s FROM events),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM t)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {SESSION_GAP_SEC} SECOND AS session_end,
       CAST(count(*) AS BIGINT) AS n_events, round(sum(value), 2) AS total_value
FROM s GROUP BY user_id, sid
""")
def event_sessions(spark, sf_dir):
    """Six-hour-gap sessions per user (session_window semantics)."""
    ev = table(spark, sf_dir, "events")
    out = eventtime.sessions(ev, ["user_id"], "ts", SESSION_GAP_SEC,
                             [F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")])
    return out.withColumn("total_value", F.round("total_value", 2))


DEDUP_PARTS = 4
STREAM_COLS = ("event_id", "ts", "user_id", "event_type", "value")


def _streamed(spark, sf_dir, name, transform):
    """Run ``transform`` (stream reader -> streaming result) over the events,
    landed in time order, one landing per trigger.  A last landing holds a
    click and a purchase of nobody 30 days after the last event: they move the
    watermark past every real window, session and interval, and stay open
    themselves.  Returns what the stream emitted."""
    root = scratch_dir(spark, name)
    landing, out_path = f"{root}/landing", f"{root}/out"
    ev = table(spark, sf_dir, "events").select(*STREAM_COLS)
    part = F.least(F.lit(DEDUP_PARTS - 1), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    store = SchemaStore(spark, f"{root}/_schema")
    last = ev.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    closing = last.select(F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(-1).cast("bigint").alias("user_id"),
                          F.explode(F.array(F.lit("click"), F.lit("purchase"))).alias("event_type"), F.lit(0.0).alias("value"))
    landings = [(f"part={i}", ev.filter(part == i)) for i in range(DEDUP_PARTS)] + [("part=closing", closing)]
    for folder, rows in landings:
        rows.write.parquet(f"{landing}/{folder}")
        schema, _ = store.resolve(landing)

        def read(schema=schema):
            return stream_landed(spark, landing, schema).select(*STREAM_COLS)
        q = (transform(read).writeStream.format("parquet").option("path", out_path)
             .option("checkpointLocation", f"{root}/_checkpoint").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.read.parquet(out_path)


@register("event_dedup", """
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def event_dedup(spark, sf_dir):
    """Events land in time order, one landing per trigger, and the first
    landing is replayed at the end: the watermarked stream keeps each event
    once (duplicates within the delay by state, the late replay by the
    watermark)."""
    root = scratch_dir(spark, "dedup")
    landing = f"{root}/landing"
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    part = F.least(F.lit(DEDUP_PARTS - 1), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    store = SchemaStore(spark, f"{root}/_schema")
    out_path = f"{root}/out"

    def run():
        schema, _ = store.resolve(landing)
        s = stream_landed(spark, landing, schema).select("event_id", "ts", "user_id", "event_type", "value")
        q = (ST.dedup(s, "ts", "15 minutes", ["event_id"]).writeStream.format("parquet")
             .option("path", out_path).option("checkpointLocation", f"{root}/_checkpoint")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()

    for i in range(DEDUP_PARTS):
        ev.filter(part == i).write.parquet(f"{landing}/part={i}")
        run()
    ev.filter(part == 0).write.parquet(f"{landing}/part=replay0")
    run()
    return spark.read.parquet(out_path)


CLICK_WINDOW_SEC = 3600


@register("click_purchase_interval", f"""
WITH c AS (SELECT event_id AS click_id, user_id, ts AS click_ts FROM events WHERE event_type = 'click'),
     p AS (SELECT event_id AS purchase_id, user_id AS p_user, ts AS purchase_ts FROM events WHERE event_type = 'purchase'),
     m AS (SELECT c.*, p.purchase_id, p.purchase_ts FROM c JOIN p ON p.p_user = c.user_id
           AND date_diff('microsecond', c.click_ts, p.purchase_ts) BETWEEN 0 AND {CLICK_WINDOW_SEC * 1000000})
SELECT click_id, user_id, click_ts, purchase_id, purchase_ts FROM m
UNION ALL
SELECT click_id, user_id, click_ts, NULL, NULL FROM c WHERE click_id NOT IN (SELECT click_id FROM m)
""")
def click_purchase_interval(spark, sf_dir):
    """Clicks with the purchases of the same user within the next hour (left
    outer interval join, batch form of the watermarked stream-stream join)."""
    ev = table(spark, sf_dir, "events")
    clicks = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts"))
    out = joins.interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", 0, CLICK_WINDOW_SEC,
                              how="left")
    return out.select("click_id", "user_id", "click_ts", "purchase_id", "purchase_ts")


WINDOW_SQL, SESSION_SQL, INTERVAL_SQL = (ORACLE_SQL[n] for n in ("event_window_agg", "event_sessions", "click_purchase_interval"))
STREAM_DELAY = "12 hours"


def _totals():
    return [F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")]


@register("stream_windows", WINDOW_SQL)
def stream_windows(spark, sf_dir):
    """Hourly windows per event type as a watermarked append-mode stream."""
    out = _streamed(spark, sf_dir, "stream_windows",
                    lambda read: ST.windowed_counts(read(), "ts", "1 hour", STREAM_DELAY, ["event_type"], _totals()))
    return out.withColumn("total_value", F.round("total_value", 2))


@register("stream_sessions", SESSION_SQL)
def stream_sessions(spark, sf_dir):
    """Six-hour-gap sessions per user as a watermarked append-mode stream."""
    out = _streamed(spark, sf_dir, "stream_sessions",
                    lambda read: ST.session_counts(read(), "ts", f"{SESSION_GAP_SEC} seconds", STREAM_DELAY, ["user_id"], _totals()))
    return out.withColumn("total_value", F.round("total_value", 2))


def _click_purchases(read, how):
    clicks = read().filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    bought = read().filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts"))
    return ST.interval_join(clicks, bought, ["user_id"], "click_ts", "purchase_ts", "0 SECONDS", f"{CLICK_WINDOW_SEC} SECONDS", STREAM_DELAY, how)


def _real(out):
    """Without the pair that the closing rows form with each other."""
    return out.filter("click_id >= 0").select("click_id", "user_id", "click_ts", "purchase_id", "purchase_ts")


@register("stream_interval_join", f"SELECT * FROM ({INTERVAL_SQL}) j WHERE purchase_id IS NOT NULL")
def stream_interval_join(spark, sf_dir):
    """Clicks with the same user's purchases of the next hour, as an inner
    stream-stream join with state bounded by the watermarks."""
    return _real(_streamed(spark, sf_dir, "stream_ij", lambda read: _click_purchases(read, "inner")))


@register("stream_interval_join_outer", INTERVAL_SQL)
def stream_interval_join_outer(spark, sf_dir):
    """The same as a left outer join: a click without a purchase comes out
    once the watermark shows that none can follow."""
    return _real(_streamed(spark, sf_dir, "stream_ijo", lambda read: _click_purchases(read, "leftOuter")))


@register("stream_dedup_windows", ORACLE_SQL["event_window_agg"])
def stream_dedup_windows(spark, sf_dir):
    """Every event arrives twice; one query drops the repeats and counts
    hourly windows of the rest (chained stateful operators)."""
    aggs = [F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total_value")]
    return _streamed(spark, sf_dir, "dedup_windows", lambda read: ST.deduplicated_windows(
        read().unionByName(read()), "ts", ["event_id"], "1 hour", "15 minutes", ["event_type"], aggs))


_BROKEN = 50


@register("landing_corrupt_rows", " UNION ALL ".join(f"""
SELECT '{f}' AS format, CASE WHEN event_id % {_BROKEN} = 0 THEN 'quarantine' ELSE 'loaded' END AS place, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN event_id % {_BROKEN} <> 0 THEN event_id END) AS BIGINT) AS ids
FROM events GROUP BY 2""" for f in ("json", "csv")))
def landing_corrupt_rows(spark, sf_dir):
    """Events land as JSON and as CSV with every fiftieth row broken: the
    rows that the reader cannot parse are in the quarantine table, as text."""
    root = scratch_dir(spark, "corrupt")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    bad = F.col("event_id") % _BROKEN == 0
    as_json, as_csv = F.to_json(F.struct(*ev.columns)), F.concat_ws(",", *ev.columns)
    ev.select(F.when(bad, F.substr(as_json, F.lit(1), F.length(as_json) - 4)).otherwise(as_json)).write.text(f"{root}/landing/json")
    ev.select(F.when(bad, F.concat(F.lit("x"), as_csv)).otherwise(as_csv)).write.text(f"{root}/landing/csv")
    rule, out = [Rule("readable", F.col(CORRUPT).isNull(), "drop")], []
    for f in ("json", "csv"):
        quality.load(read_checked(spark, f"{root}/landing/{f}", f, ev.schema), rule, root, f, "1")
        out.append(quality.read_loaded(spark, root, f).agg(F.lit(f).alias("format"), F.lit("loaded").alias("place"), F.count(F.lit(1)).alias("n_rows"),
                                                           F.sum("event_id").alias("ids")))
        out.append(quality.read_quarantine(spark, root, f).filter(F.length(CORRUPT) > 0).agg(
            F.lit(f).alias("format"), F.lit("quarantine").alias("place"), F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("long").alias("ids")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
