"""Streaming catalogue: incremental merge, schema evolution, append flows.

Each query lands a feed derived from the test tables as files in a fresh
folder of the shared checkpoint area, runs the flows to completion
(``availableNow``) and returns the committed target.  The oracles are the
batch folds: the stream must equal them whatever the file order, batching
or replay.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import feeds
from ..streaming.append import AppendTarget
from ..streaming.flows import Flow, run_flow, run_flows
from ..streaming.incremental import IncrementalTarget
from . import oracle_sql as O
from .catalog import register
from .q_core import EV_COLS, OVERLAP_STD

# Small bucket count: the test feeds are small; production sizes B so that a
# bucket's history fits a task comfortably.
TEST_BUCKETS = 16


def land_permuted_events(spark, sf_dir, landing: str, n_files: int = 4) -> str:
    """Land the events feed as ``n_files`` hash-split parts plus part 0 again
    (a replayed file)."""
    path = f"{landing}/events__ct"
    parts = feeds.permuted_event_files(spark, sf_dir, n_files)
    for i, p in enumerate(parts):
        p.write.parquet(f"{path}/part={i}")
    parts[0].write.parquet(f"{path}/part={n_files}")
    return path


def _stream_events(spark, sf_dir, scd: int):
    root = scratch_dir(spark, f"stream_scd{scd}")
    ct = land_permuted_events(spark, sf_dir, f"{root}/landing")
    spec = feeds.EVENTS_SPEC.with_(scd_types=(scd,))
    target = IncrementalTarget(spark, f"{root}/target", spec, buckets=TEST_BUCKETS)
    run_flow(spark, target, Flow("ct", ct, max_files_per_trigger=4), f"{root}/state")
    return target.read(scd)


@register("stream_scd1", O.scd1_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS))
def stream_scd1(spark, sf_dir):
    return _stream_events(spark, sf_dir, 1)


@register("stream_scd2", O.scd2_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def stream_scd2(spark, sf_dir):
    return _stream_events(spark, sf_dir, 2)


@register("stream_scd_seeded", O.scd2_sql(OVERLAP_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def stream_scd_seeded(spark, sf_dir):
    """Seed flow (customer snapshot) then change flow, into one SCD2 target."""
    root = scratch_dir(spark, "stream_seeded")
    full = f"{root}/landing/events__full"
    feeds.seed_customer(spark, sf_dir).write.parquet(full)
    ct = land_permuted_events(spark, sf_dir, f"{root}/landing")
    spec = feeds.EVENTS_SPEC.with_(scd_types=(2,), seed_seq=feeds.CUSTOMER_SEED_SEQ)
    target = IncrementalTarget(spark, f"{root}/target", spec, buckets=TEST_BUCKETS)
    run_flows(spark, target, [Flow("ct", ct, max_files_per_trigger=8), Flow("full", full)], f"{root}/state")
    return target.read(2)


EVOLVED_SQL = O.scd1_sql(
    f"""SELECT s.*, CASE WHEN s._seq >= (SELECT max(event_id) FROM events) // 2 + 1 THEN e.props END AS props
        FROM ({O.EVENTS_STD}) s JOIN events e ON e.event_id = s._seq""",
    "user_id", O.EVENTS_ORDER_DESC + ", props DESC NULLS LAST", EV_COLS + ", props")


@register("stream_schema_evolution", EVOLVED_SQL)
def stream_schema_evolution(spark, sf_dir):
    """The second half of the feed lands with a new column; the flow picks
    up the wider schema on restart and older rows read it as NULL."""
    root = scratch_dir(spark, "stream_evolve")
    ct = f"{root}/landing/events__ct"
    first, second = feeds.feed_events_evolved(spark, sf_dir)
    spec = feeds.EVENTS_SPEC.with_(scd_types=(1,))
    target = IncrementalTarget(spark, f"{root}/target", spec, buckets=TEST_BUCKETS)
    first.write.parquet(f"{ct}/part=0")
    run_flow(spark, target, Flow("ct", ct, max_files_per_trigger=4), f"{root}/state")
    second.write.parquet(f"{ct}/part=1")
    run_flow(spark, target, Flow("ct", ct, max_files_per_trigger=4), f"{root}/state")
    return target.read(1)


@register("stream_append_lineage", f"""
SELECT c_custkey AS user_id, 'seed' AS event_type, c_acctbal AS value,
       CAST(NULL AS VARCHAR) AS header__change_oper, CAST(NULL AS BIGINT) AS header__change_seq,
       CAST(NULL AS TIMESTAMP) AS header__change_ts, 'full' AS _ingest_source
FROM customer
UNION ALL
SELECT *, 'ct' AS _ingest_source FROM ({O.EVENTS_CT}) c
""")
def stream_append_lineage(spark, sf_dir):
    """Append target fed by a seed flow and a change flow, then the seed flow
    is dropped (load_type full -> incr) and more changes arrive: every row
    is kept exactly once with its source tag."""
    root = scratch_dir(spark, "stream_append")
    full = f"{root}/landing/events__full"
    ct = f"{root}/landing/events__ct"
    feeds.seed_customer(spark, sf_dir).write.parquet(full)
    parts = feeds.permuted_event_files(spark, sf_dir, 2)
    parts[0].write.parquet(f"{ct}/part=0")
    target = AppendTarget(spark, f"{root}/target")
    target.run(Flow("full", full))
    target.run(Flow("ct", ct, max_files_per_trigger=4))
    parts[1].write.parquet(f"{ct}/part=1")
    target.run(Flow("ct", ct, max_files_per_trigger=4))      # seed flow no longer started
    out = target.read()
    return out.select("user_id", "event_type", "value", "header__change_oper", "header__change_seq",
                      "header__change_ts", "_ingest_source")


@register("stream_log_compaction", O.scd1_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS))
def stream_log_compaction(spark, sf_dir):
    """Half of the files flow in, the closed rows of all batches are merged
    into one part, the rest (including a replayed file) flows in: the latest
    state is unchanged by compaction."""
    root = scratch_dir(spark, "stream_compact")
    ct = f"{root}/landing/events__ct"
    parts = feeds.permuted_event_files(spark, sf_dir, 4)
    spec = feeds.EVENTS_SPEC.with_(scd_types=(1,))
    target = IncrementalTarget(spark, f"{root}/target", spec, buckets=TEST_BUCKETS)
    for i in (0, 1):
        parts[i].write.parquet(f"{ct}/part={i}")
    run_flow(spark, target, Flow("ct", ct, max_files_per_trigger=4), f"{root}/state")
    target.compact()
    for i in (2, 3):
        parts[i].write.parquet(f"{ct}/part={i}")
    parts[0].write.parquet(f"{ct}/part=replay0")
    run_flow(spark, target, Flow("ct", ct, max_files_per_trigger=4), f"{root}/state")
    return target.read(1)


def _versions(upto: int) -> str:
    """Latest state after the first ``upto`` thirds of the feed."""
    third = "(SELECT max(event_id) FROM events) // 3 + 1"
    std = f"SELECT * FROM ({O.EVENTS_STD}) s0 WHERE _seq < {upto} * ({third})" if upto < 3 else O.EVENTS_STD
    return O.scd1_sql(std, "user_id", O.EVENTS_ORDER_DESC, EV_COLS)


def _diff_sql(before: str, after: str, version: int) -> str:
    cols = ["event_type", "value", "header__change_ts"]
    same = " AND ".join(f"b.{c} IS NOT DISTINCT FROM a.{c}" for c in cols)
    pick = lambda t: ", ".join(f"{t}.{c}" for c in cols)
    return f"""
    SELECT a.user_id, {pick('a')}, CASE WHEN b.user_id IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, CAST({version} AS BIGINT) AS _commit_version
    FROM ({after}) a LEFT JOIN ({before}) b ON a.user_id = b.user_id WHERE b.user_id IS NULL OR NOT ({same})
    UNION ALL
    SELECT b.user_id, {pick('b')}, CASE WHEN a.user_id IS NULL THEN 'delete' ELSE 'update_preimage' END, CAST({version} AS BIGINT)
    FROM ({before}) b LEFT JOIN ({after}) a ON a.user_id = b.user_id WHERE a.user_id IS NULL OR NOT ({same})"""


_NOTHING = f"SELECT * FROM ({_versions(1)}) z WHERE false"


@register("target_change_feed", " UNION ALL ".join(f"SELECT * FROM ({_diff_sql(_NOTHING if v == 1 else _versions(v - 1), _versions(v), v)}) d{v}" for v in (1, 2, 3)))
def target_change_feed(spark, sf_dir):
    """Three thirds of the feed flow in as three batches, the second one comes
    twice; the change rows that each micro-batch emitted are read on as a
    stream into a sink (R-CDF, T-PUSH)."""
    root = scratch_dir(spark, "target_cdf")
    ct = feeds.feed_events(spark, sf_dir)
    third = ct.agg(F.expr("max(header__change_seq) div 3 + 1")).scalar()
    target = IncrementalTarget(spark, f"{root}/target", feeds.EVENTS_SPEC.with_(scd_types=(1,)), buckets=TEST_BUCKETS)
    landing, sink = f"{root}/landing/events__ct", f"{root}/pushed"
    for i, n in enumerate((0, 1, 1, 2)):
        ct.filter(F.floor(F.col("header__change_seq") / third) == n).write.parquet(f"{landing}/part={i}")
        run_flow(spark, target, Flow("ct", landing, max_files_per_trigger=64), f"{root}/state")
        (target.stream_changes(1).writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{root}/push")
            .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(sink).select("user_id", "event_type", "value", "header__change_ts", "_change_type", "_commit_version")
