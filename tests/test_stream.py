"""Incremental merge: arrival order, batching and replay do not matter."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark import standardize
from tidemark.operators import merge
from tidemark.session import scratch_dir
from tidemark.sources import feeds
from tidemark.sources.files import SchemaChangeError, SchemaStore
from tidemark.streaming.incremental import IncrementalTarget

SPEC = feeds.EVENTS_SPEC


def _batch_folds(spark):
    std = standardize(feeds.feed_events(spark, SF_SMALL), SPEC)
    return rows(merge.scd1(std, SPEC)), rows(merge.scd2(std, SPEC))


@pytest.mark.parametrize("seed", [1, 7])
def test_permuted_split_replayed_equals_batch(spark, seed):
    ct = feeds.feed_events(spark, SF_SMALL)
    rnd = random.Random(seed)
    n_parts = rnd.randint(3, 6)
    part = F.pmod(F.xxhash64(F.col("header__change_seq"), F.lit(seed)), F.lit(n_parts))
    parts = [ct.filter(part == i) for i in range(n_parts)]
    order = list(range(n_parts))
    rnd.shuffle(order)
    batches = [parts[i] for i in order] + [parts[order[0]]]  # the first batch replayed as new data
    t = IncrementalTarget(spark, scratch_dir(spark, "prop"), SPEC, buckets=8)
    for i, b in enumerate(batches):
        t.apply(b, i)
    s1, s2 = _batch_folds(spark)
    assert rows(t.read(1)) == s1
    assert rows(t.read(2)) == s2


def test_null_keys_go_to_quarantine(spark):
    ct = feeds.feed_events(spark, SF_SMALL)
    bad = ct.limit(3).withColumn("user_id", F.lit(None).cast("bigint"))
    root = scratch_dir(spark, "nullkey")
    t = IncrementalTarget(spark, root, SPEC, buckets=4)
    t.apply(ct.unionByName(bad), 0)
    q = t.read_quarantine()
    assert q.count() == 3
    assert {r["dq_reason"] for r in q.collect()} == {"null primary_key"}


def test_schema_store_additive_and_breaking(spark):
    root = scratch_dir(spark, "schema")
    ct = feeds.feed_events(spark, SF_SMALL)
    ct.limit(10).write.parquet(f"{root}/land/p0")
    store = SchemaStore(spark, f"{root}/schemas")
    s0, changed = store.resolve(f"{root}/land")
    assert not changed and "props" not in s0.fieldNames()
    ct.limit(10).withColumn("props", F.lit("{}")).write.parquet(f"{root}/land/p1")
    s1, changed = store.resolve(f"{root}/land")
    assert changed and s1.fieldNames()[-1] == "props"
    ct.limit(10).withColumn("value", F.col("value").cast("string")).write.parquet(f"{root}/land2/p0")
    store2 = SchemaStore(spark, f"{root}/schemas2")
    ct.limit(10).write.parquet(f"{root}/land2/p1")
    with pytest.raises(Exception):
        # value is double in one file and string in another: not additive
        store2.resolve(f"{root}/land2")


def test_schema_store_rejects_type_change(spark):
    root = scratch_dir(spark, "schema3")
    ct = feeds.feed_events(spark, SF_SMALL)
    ct.limit(5).write.parquet(f"{root}/a")
    store = SchemaStore(spark, f"{root}/s")
    store.resolve(f"{root}/a")
    ct.limit(5).withColumn("value", F.col("value").cast("string")).write.parquet(f"{root}/b")
    with pytest.raises(SchemaChangeError):
        store.resolve(f"{root}/b")


def test_json_landing_flow_equals_batch(spark):
    from tidemark.sources.files import read_landed
    from tidemark.streaming.flows import Flow, run_flow

    root = scratch_dir(spark, "json")
    ct = feeds.feed_events(spark, SF_SMALL)
    part = F.pmod(F.col("header__change_seq"), F.lit(3))
    for i in range(3):
        ct.filter(part == i).write.json(f"{root}/landing/events__ct/p={i}")
    spec = SPEC.with_(file_format="json")
    t = IncrementalTarget(spark, f"{root}/target", spec, buckets=4)
    run_flow(spark, t, Flow("ct", f"{root}/landing/events__ct", file_format="json", max_files_per_trigger=2),
             f"{root}/state")
    batch = standardize(read_landed(spark, f"{root}/landing/events__ct", "json"), spec)
    cols = ("user_id", "event_type", "value", "header__change_ts")
    assert rows(t.read(1), *cols) == rows(merge.scd1(batch, spec), *cols)
    assert t.read(1).count() == merge.scd1(standardize(ct, SPEC), SPEC).count()


def test_processing_time_trigger_runs_and_stops(spark):
    import time as _t

    from tidemark.streaming.flows import Flow, run_flow

    root = scratch_dir(spark, "ptime")
    feeds.feed_events(spark, SF_SMALL).write.parquet(f"{root}/landing/p0")
    t = IncrementalTarget(spark, f"{root}/target", SPEC, buckets=4)
    q = run_flow(spark, t, Flow("ct", f"{root}/landing"), f"{root}/state", trigger="processingTime",
                 processing_time="1 second")
    try:
        deadline = _t.time() + 120
        while not q.recentProgress and _t.time() < deadline:
            _t.sleep(1)
        assert q.recentProgress, "no micro-batch committed"
    finally:
        q.stop()
    std = standardize(feeds.feed_events(spark, SF_SMALL), SPEC)
    assert rows(t.read(1)) == rows(merge.scd1(std, SPEC))


def _same(target, spec, std):
    for scd, want in merge.scd_targets(std, spec).items():
        got = target.read(scd).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, scd


def _parts(ct, n, seed=0):
    part = F.pmod(F.xxhash64("header__change_seq", F.lit(seed)), F.lit(n))
    return [ct.filter(part == i) for i in range(n)]


@pytest.mark.parametrize("mode,keep", [("hard", False), ("soft", False), ("soft", True)])
def test_late_batches_equal_the_fold_of_everything(spark, mode, keep):
    """Events behind open, closed and deleted versions, equal sequences, NULL
    sequences, two flows with equal batch ids, a replay and a compaction."""
    spec = SPEC.with_(scd_types=(1, 2), delete_mode=mode, keep_last_values=keep)
    ev = feeds.feed_events(spark, SF_SMALL)
    op = F.when(F.col("header__change_seq") % 4 == 1, F.lit("D")).otherwise(F.lit("U"))
    ct = ev.withColumn("header__change_oper", op).withColumn("header__change_seq", F.when(F.col("header__change_seq") % 29 != 0, F.floor(F.col("header__change_seq") / 3)))
    ct = ct.withColumn("value", F.when(F.col("header__change_oper") == "D", F.lit(None)).otherwise(F.col("value")))
    t = IncrementalTarget(spark, scratch_dir(spark, "late"), spec, buckets=3)
    parts = _parts(ct, 4, 3)
    for i, (n, flow) in enumerate([(2, "a"), (0, "b"), (3, "a"), (0, "a")]):
        t.apply(parts[n], i // 2, flow)
    t.compact()
    t.apply(parts[1], 7, "b")
    _same(t, spec, standardize(ct, spec))


def test_a_replayed_batch_changes_nothing(spark):
    t = IncrementalTarget(spark, scratch_dir(spark, "replay"), SPEC, buckets=2)
    ct = feeds.feed_events(spark, SF_SMALL)
    for i in range(3):
        t.apply(_parts(ct, 3)[i], i)
    before, feed = rows(t.state().drop("_part")), t.change_feed(2).count()
    t.apply(_parts(ct, 3)[1], 1)
    assert rows(t.state().drop("_part")) == before and t.change_feed(2).count() == feed


def test_reads_do_not_grow_with_history(spark):
    """In order, a batch reads the open rows of its buckets and no closed row;
    a late event reads the versions of its own key that end after it."""
    ct = feeds.feed_events(spark, SF_SMALL)
    top = ct.agg(F.max("header__change_seq")).scalar()
    t = IncrementalTarget(spark, scratch_dir(spark, "growth"), SPEC, buckets=2)
    seen = []
    for i in range(6):
        t.apply(ct.filter((F.col("header__change_seq") > i * top / 6) & (F.col("header__change_seq") <= (i + 1) * top / 6)), i)
        seen.append(dict(t.rows_read))
    keys = ct.select("user_id").distinct().count()
    assert all(s["closed"] == 0 and s["open"] <= keys for s in seen)
    key, seq = ct.filter("header__change_oper != 'D'").orderBy("header__change_seq").select("user_id", "header__change_seq").first()
    ends = t.state().filter((F.col("user_id") == key) & (F.col("__END_AT") > seq)).count()
    t.apply(ct.filter((F.col("user_id") == key) & (F.col("header__change_seq") == seq)), 9)
    assert t.rows_read["closed"] == ends
    _same(t, SPEC, standardize(ct, SPEC))


def test_a_run_that_died_while_publishing_is_finished(spark, monkeypatch):
    """The staged result is complete before a partition is replaced, so the
    next run publishes it whatever had been replaced."""
    ct = feeds.feed_events(spark, SF_SMALL)
    root = scratch_dir(spark, "crash")
    t = IncrementalTarget(spark, root, SPEC, buckets=2)
    first, second, third = _parts(ct, 3)
    t.apply(first, 0)
    from tidemark.streaming import fs

    def die(staged):
        fs.delete(spark, f"{t.state_path}/_part=open/_bucket=0")  # the overwrite had removed it
        raise RuntimeError("lost")
    monkeypatch.setattr(t, "_publish", die)
    with pytest.raises(RuntimeError):
        t.apply(second, 1)
    again = IncrementalTarget(spark, root, SPEC, buckets=2)
    fs.mkdirs(spark, f"{root}/_staged/9_half/state")          # an incomplete one
    again.apply(second, 1)
    again.apply(third, 2)
    _same(again, SPEC, standardize(ct, SPEC))
    assert not fs.list_names(spark, f"{root}/_staged")


def test_change_rows_rebuild_the_target(spark):
    ct = feeds.feed_events(spark, SF_SMALL)
    t = IncrementalTarget(spark, scratch_dir(spark, "feed"), SPEC, buckets=2)
    for i, n in enumerate((1, 0, 2, 0)):
        t.apply(_parts(ct, 3)[n], i)
    feed = t.change_feed(1)
    last = feed.filter("_change_type != 'update_preimage'").groupBy("user_id").agg(
        F.max_by(F.struct("_change_type", "event_type", "value"), "_commit_version").alias("c")).filter("c._change_type != 'delete'")
    assert rows(last.select("user_id", "c.event_type", "c.value")) == rows(t.read(1).select("user_id", "event_type", "value"))
    assert {r["_commit_version"] for r in feed.select("_commit_version").distinct().collect()} == {1, 2, 3}
    assert t.change_feed(1, from_version=2).filter("_commit_version < 3").count() == 0
    history = t.change_feed(2)
    net = history.groupBy("user_id", "__START_AT").agg(F.sum(F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)).alias("n"))
    assert rows(net.filter("n = 1").select("user_id", "__START_AT")) == rows(t.read(2).select("user_id", "__START_AT")) and net.filter("n not in (0, 1)").count() == 0


@pytest.mark.parametrize("mode,keep", [("hard", False), ("soft", True)])
def test_change_rows_come_from_the_fold(spark, monkeypatch, mode, keep):
    """A late batch (a new column, equal sequences, deletes) joins old and new
    targets for no change row, and its change rows are those of that join."""
    from tidemark.plans import reports

    spec, joined = SPEC.with_(delete_mode=mode, keep_last_values=keep), reports.change_feed
    seq, op = F.floor(F.col("id") / 2), F.when(F.col("id") % 5 == 2, "D").otherwise("U")
    ct = spark.range(120).select((F.col("id") % 7).alias("user_id"), F.concat(F.lit("e"), F.col("id") % 3).alias("event_type"),
                                 (F.col("id") % 4 / 2).alias("value"), op.alias("header__change_oper"), seq.alias("header__change_seq"))
    t = IncrementalTarget(spark, scratch_dir(spark, "foldfeed"), spec, buckets=2)
    monkeypatch.setattr(reports, "change_feed", None)
    second, first = _parts(ct, 2, 3)
    t.apply(first, 0)
    keys = {1: ["user_id"], 2: ["user_id", "__START_AT"]}
    held = {scd: spark.createDataFrame(t.read(scd).collect(), t.read(scd).schema).withColumn("props", F.lit(None).cast("string")) for scd in keys}
    t.apply(second.withColumn("props", F.when(F.col("value") > 0, "{}")), 1)
    assert t.rows_read["closed"] > 0
    for scd, by in keys.items():
        new = t.read(scd)
        want = joined(held[scd].select(*new.columns), new, by, 2, F.lit(None).cast("timestamp_ntz")).drop("_commit_timestamp")
        got = t.change_feed(scd, from_version=1).select(*want.columns)
        assert got.count() and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_flows_that_keep_running_are_one_query(spark):
    from tidemark.streaming.flows import Flow, run_flows

    root = scratch_dir(spark, "both")
    spec = SPEC.with_(seed_seq=feeds.CUSTOMER_SEED_SEQ)
    feeds.seed_customer(spark, SF_SMALL).write.parquet(f"{root}/full")
    feeds.feed_events(spark, SF_SMALL).write.parquet(f"{root}/ct")
    t = IncrementalTarget(spark, f"{root}/target", spec, buckets=4)
    (q,) = run_flows(spark, t, [Flow("ct", f"{root}/ct"), Flow("full", f"{root}/full")], f"{root}/state", trigger="processingTime", processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    cols = ("user_id", "event_type", "value", "header__change_ts", "__START_AT", "__END_AT")
    assert rows(t.read(2), *cols) == rows(merge.scd2(standardize(feeds.events_with_seed(spark, SF_SMALL), spec), spec), *cols)


def test_restart_reads_the_footers_of_new_files_only(spark, tmp_path):
    import glob
    import os

    ct = feeds.feed_events(spark, SF_SMALL)
    ct.limit(40).repartition(4).write.parquet(f"{tmp_path}/land/p0")
    for i, f in enumerate(sorted(glob.glob(f"{tmp_path}/land/p0/*.parquet"))):
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    store = SchemaStore(spark, f"{tmp_path}/schemas")
    store.resolve(f"{tmp_path}/land")
    assert store.files_read == 4
    for f in glob.glob(f"{tmp_path}/land/p0/*.parquet"):
        os.utime(f, (1_600_000_000, 1_600_000_000))
    ct.limit(5).withColumn("props", F.lit("{}")).coalesce(1).write.parquet(f"{tmp_path}/land/p1")
    schema, changed = store.resolve(f"{tmp_path}/land")
    assert changed and store.files_read == 1 and schema.fieldNames()[-1] == "props"
    for f in glob.glob(f"{tmp_path}/land/p1/*.parquet"):
        os.utime(f, (1_600_000_000, 1_600_000_000))
    assert store.resolve(f"{tmp_path}/land") == (schema, False) and store.files_read == 0


def test_lag_from_progress_rows(spark):
    from tidemark.streaming import progress
    from tidemark.streaming.flows import Flow, run_flow

    root = scratch_dir(spark, "progress")
    log = progress.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    ct = feeds.feed_events(spark, SF_SMALL)
    try:
        ct.limit(60).write.parquet(f"{root}/land/p0")
        t = IncrementalTarget(spark, f"{root}/target", SPEC, buckets=2)
        q = run_flow(spark, t, Flow("ct", f"{root}/land"), f"{root}/state", trigger="processingTime", processing_time="1 second")
        q.processAllAvailable()
        q.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        import time as _t
        deadline = _t.time() + 60
        while _t.time() < deadline:
            try:
                done = progress.applied(progress.read_progress(spark, f"{root}/progress").filter("flow = 'ct'")).collect()
            except Exception:  # noqa: BLE001 - no record yet
                done = []
            if done and done[0]["applied_rows"] == 60:
                break
            _t.sleep(1)
        ct.limit(25).write.parquet(f"{root}/land/p1")
        landed = spark.read.parquet(f"{root}/land/p0", f"{root}/land/p1").agg(F.lit("ct").alias("flow"), F.count(F.lit(1)).alias("landed_rows"))
        (r,) = progress.lag(progress.read_progress(spark, f"{root}/progress"), landed).collect()
        assert (r["landed_rows"], r["applied_rows"], r["lag_rows"]) == (85, 60, 25) and r["applied_ts"] is not None
    finally:
        spark.streams.removeListener(log)


def test_rows_dropped_by_the_watermark_are_counted(spark):
    from tidemark.streaming import event_time as ST

    root = scratch_dir(spark, "dropped")
    rows_ = [(i, f"2024-01-01 {i % 20:02d}:00:00") for i in range(40)]
    schema = "event_id long, ts timestamp_ntz"
    dropped = 0
    for n, batch in enumerate((rows_, [(100, "2024-01-05 00:00:00")], [(200, "2024-01-01 01:00:00"), (201, "2024-01-01 02:00:00")])):
        spark.createDataFrame(batch, "event_id long, ts string").selectExpr("event_id", "cast(ts as timestamp_ntz) ts").write.parquet(f"{root}/land/p{n}")
        s = ST.deduplicated_windows(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/land"), "ts", ["event_id"],
                                    "1 hour", "15 minutes", [], [F.count(F.lit(1)).alias("n")])
        q = (s.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck").outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        dropped += ST.dropped_by_watermark(q)
    assert dropped == 2 and spark.read.parquet(f"{root}/out").agg(F.sum("n")).first()[0] == 40


def test_partitioned_landing_is_pruned(spark, tmp_path):
    from tidemark.sources.files import read_landed, stream_landed
    land, loose = f"{tmp_path}/land", f"{tmp_path}/loose"
    spark.range(30).withColumn("day", (F.col("id") % 3).cast("int")).write.partitionBy("day").parquet(land)
    spark.range(5).write.parquet(f"{loose}/a/b")
    df = read_landed(spark, land, partitioned=True).filter("day = 1")
    assert rows(df, "id") == [(i,) for i in range(1, 30, 3)]
    assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().toString().replace("IsNotNull", "isnotnull")
    assert len(df.inputFiles()) > 0 and df.select("_ingest_file").distinct().filter("_ingest_file like '%day=1%'").count() >= 1
    assert read_landed(spark, loose).count() == 5  # other nested folders are read whole
    assert "day" not in read_landed(spark, land).columns and read_landed(spark, land).count() == 30
    schema = read_landed(spark, land, partitioned=True).drop("_ingest_source", "_ingest_file", "_ingest_ts").schema
    q = stream_landed(spark, land, schema, partitioned=True).writeStream.format("memory").queryName("pruned_landing").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("pruned_landing"), "id", "day") == [(i, i % 3) for i in range(30)]


def test_batches_of_a_run_do_not_follow_the_files(spark):
    """A run to completion over many files takes a bounded number of
    micro-batches, from its landing's first files or later ones."""
    from tidemark.streaming import fs
    from tidemark.streaming.flows import Flow, run_flow

    root = scratch_dir(spark, "many_files")
    landing = f"{root}/landing/events__ct"
    ct = feeds.feed_events(spark, SF_SMALL)
    t = IncrementalTarget(spark, f"{root}/target", SPEC, buckets=4)
    commits = lambda: sum(not n.startswith(".") for n in fs.list_names(spark, f"{root}/state/_checkpoints/ct/commits"))
    ct.filter("header__change_seq % 2 = 0").repartition(9).write.parquet(f"{landing}/part=0")
    run_flow(spark, t, Flow("ct", landing, max_files_per_trigger=1), f"{root}/state")
    assert commits() == 2
    ct.filter("header__change_seq % 2 = 1").repartition(3).write.parquet(f"{landing}/part=1")
    run_flow(spark, t, Flow("ct", landing, max_files_per_trigger=1), f"{root}/state")
    assert commits() == 3
    s1, s2 = _batch_folds(spark)
    assert rows(t.read(1)) == s1
    assert rows(t.read(2)) == s2
