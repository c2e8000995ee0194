"""Streaming event-time forms agree with their batch forms."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark.operators import eventtime, joins
from tidemark.session import scratch_dir
from tidemark.sources.files import SchemaStore, stream_landed
from tidemark.sources.tables import table
from tidemark.streaming import event_time as ST


def _land_in_time_order(spark, root, n=4):
    ev = table(spark, SF_SMALL, "events").select("event_id", "ts", "user_id", "event_type", "value")
    part = F.least(F.lit(n - 1), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    return ev, [ev.filter(part == i) for i in range(n)]


def _run(spark, landing, root, build, name):
    store = SchemaStore(spark, f"{root}/_schema_{name}")
    schema, _ = store.resolve(landing)
    s = stream_landed(spark, landing, schema).drop("_ingest_source", "_ingest_file", "_ingest_ts")
    q = (build(s).writeStream.format("parquet").outputMode("append")
         .option("path", f"{root}/out_{name}").option("checkpointLocation", f"{root}/ck_{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None


def test_windowed_stream_matches_batch_for_closed_windows(spark):
    root = scratch_dir(spark, "wstream")
    ev, parts = _land_in_time_order(spark, root)
    aggs = [F.count(F.lit(1)).alias("n")]
    build = lambda s: ST.windowed_counts(s, "ts", "1 day", "15 minutes", ["event_type"], aggs)
    for i, p in enumerate(parts):
        p.write.parquet(f"{root}/landing/part={i}")
        _run(spark, f"{root}/landing", root, build, "w")
    got = rows(spark.read.parquet(f"{root}/out_w"), "window_start", "event_type", "n")
    batch = rows(eventtime.tumbling(ev, "ts", "1 day", ["event_type"], aggs), "window_start", "event_type", "n")
    assert got and set(got) <= set(batch)
    # every window closed before the last landing has been emitted
    cut = parts[2].agg(F.max("ts")).first()[0]
    closed = [r for r in batch if r[0].timestamp() + 86400 <= cut.timestamp() - 900]
    assert set(closed) <= set(got)


def test_stream_interval_join_matches_batch(spark):
    root = scratch_dir(spark, "jstream")
    ev, parts = _land_in_time_order(spark, root)

    def build(s):
        clicks = s.filter(F.col("event_type") == "click").select(
            F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
        buys = s.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts"))
        return ST.interval_join(clicks, buys, ["user_id"], "click_ts", "purchase_ts", "0 seconds", "1 hour",
                                "2 hours")

    for i, p in enumerate(parts):
        p.write.parquet(f"{root}/landing/part={i}")
        _run(spark, f"{root}/landing", root, build, "j")
    got = rows(spark.read.parquet(f"{root}/out_j"), "click_id", "purchase_id")
    clicks = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts"))
    batch = rows(joins.interval_join(clicks, buys, ["user_id"], "click_ts", "purchase_ts", 0, 3600),
                 "click_id", "purchase_id")
    assert got == batch


def test_sessions_hot_key_equal_plain(spark):
    ev = table(spark, SF_SMALL, "events")
    skew = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    aggs = [F.count(F.lit(1)).alias("n")]
    a = rows(eventtime.sessions(skew, ["user_id"], "ts", 3600, aggs, max_group_rows=None))
    b = rows(eventtime.sessions(skew, ["user_id"], "ts", 3600, aggs, max_group_rows=30))
    assert a == b
