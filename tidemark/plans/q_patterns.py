"""Catalogue: net change, no-op filter, keyless identity, rekey, segments,
reload, and all target modes of the batch build."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge, patterns
from ..session import scratch_dir
from ..sources import feeds
from ..sources.tables import table
from . import oracle_sql as O
from . import build
from .catalog import register
from .q_core import EV_COLS, LI_COLS
from .q_stream import land_permuted_events

EV = feeds.EVENTS_SPEC
LI = feeds.LINEITEM_SPEC


@register("net_change", f"""
SELECT user_id, CAST(header__change_ts AS DATE) AS batch, CAST(count(*) AS BIGINT) AS n_changes,
       arg_min(_op, _seq) AS first_op, arg_max(_op, _seq) AS last_op, max(_seq) AS last_seq,
       arg_max(event_type, _seq) AS event_type, arg_max(value, _seq) AS value,
       arg_max(header__change_ts, _seq) AS header__change_ts,
       CASE WHEN arg_min(_op, _seq) = 'I' AND arg_max(_op, _seq) = 'D' THEN 'N'
            WHEN arg_max(_op, _seq) = 'D' THEN 'D' WHEN arg_min(_op, _seq) = 'I' THEN 'I' ELSE 'U' END AS net_op
FROM ({O.EVENTS_STD}) s GROUP BY user_id, CAST(header__change_ts AS DATE)
""")
def net_change(spark, sf_dir):
    """Net change per user per daily batch (deletes kept)."""
    std = standardize(feeds.feed_events(spark, sf_dir), EV)
    return patterns.net_change(std, EV, F.to_date("header__change_ts"))


@register("noop_filter", f"""
WITH s AS (SELECT _op, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY _seq) AS p_type,
                  lag(_op) OVER (PARTITION BY user_id ORDER BY _seq) AS p_op,
                  row_number() OVER (PARTITION BY user_id ORDER BY _seq) AS rn
           FROM ({O.EVENTS_STD}) x),
f AS (SELECT _op, (_op <> 'D' AND rn > 1 AND p_op <> 'D' AND event_type IS NOT DISTINCT FROM p_type) AS noop FROM s)
SELECT _op AS op, CAST(count(*) AS BIGINT) AS n_changes, CAST(count(*) FILTER (WHERE noop) AS BIGINT) AS n_noop,
       CAST(count(*) FILTER (WHERE NOT noop) AS BIGINT) AS n_kept
FROM f GROUP BY _op
""")
def noop_filter(spark, sf_dir):
    """Changes that repeat the tracked column (event_type) of the previous
    change of the same user, by op."""
    std = standardize(feeds.feed_events(spark, sf_dir), EV)
    return patterns.noop_report(patterns.flag_noops(std, EV, ["event_type"]))


_DUP_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]


@register("dup_identity", f"""
WITH a AS (
  SELECT {', '.join(_DUP_COLS)}, CAST(NULL AS TIMESTAMP) AS header__change_seq, 'full' AS _ingest_source FROM lineitem
  UNION ALL
  SELECT {', '.join(_DUP_COLS)}, header__change_seq, 'ct' FROM ({O.LINEITEM_CT}) c)
SELECT {', '.join(_DUP_COLS)}, _ingest_source,
       CAST(row_number() OVER (PARTITION BY {', '.join(_DUP_COLS)}
                               ORDER BY _ingest_source ASC NULLS FIRST, header__change_seq ASC NULLS FIRST) AS BIGINT) AS _dup_no
FROM a
""")
def dup_identity(spark, sf_dir):
    """Keyless rows (snapshot + change rows of lineitem, kept as appended)
    get (content hash, copy number) as identity."""
    li = table(spark, sf_dir, "lineitem").select(*_DUP_COLS)
    raw = feeds.full_and_ct(li, feeds.feed_lineitem(spark, sf_dir))
    out = patterns.synthetic_identity(raw, _DUP_COLS, ["_ingest_source", "header__change_seq"], with_hash=False)
    return out.select(*_DUP_COLS, "_ingest_source", "_dup_no")


REKEY_STEP = 1_000_000


def rekey_mapping(spark, sf_dir):
    """Renumbering derived from customer: BUILDING customers moved once,
    those of nations below 5 moved again (a two-hop chain)."""
    c = table(spark, sf_dir, "customer")
    hop1 = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("old_key"), (F.col("c_custkey") + REKEY_STEP).alias("new_key"))
    hop2 = c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") < 5)).select(
        (F.col("c_custkey") + REKEY_STEP).alias("old_key"), (F.col("c_custkey") + 2 * REKEY_STEP).alias("new_key"))
    return hop1.unionByName(hop2)


_REKEY_STD = f"""
SELECT s.* REPLACE (CASE WHEN c.c_mktsegment = 'BUILDING' AND c.c_nationkey < 5 THEN s.user_id + {2 * REKEY_STEP}
                         WHEN c.c_mktsegment = 'BUILDING' THEN s.user_id + {REKEY_STEP} ELSE s.user_id END AS user_id)
FROM ({O.EVENTS_STD}) s LEFT JOIN customer c ON c.c_custkey = s.user_id
"""


@register("rekey_history", O.scd2_sql(_REKEY_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def rekey_history(spark, sf_dir):
    """History follows a key renumbering: chains resolved by bounded joins,
    keys rewritten in the change log, then re-folded."""
    chains = patterns.resolve_key_chains(rekey_mapping(spark, sf_dir))
    ct = patterns.rekey(feeds.feed_events(spark, sf_dir), chains, "user_id")
    return merge.scd2(standardize(ct, EV), EV)


SEGMENTS = 14


@register("segment_bounds", f"""
SELECT CAST(seg AS INTEGER) AS segment, min(o_orderkey) AS lo, max(o_orderkey) AS hi, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT o_orderkey, ntile({SEGMENTS}) OVER (ORDER BY o_orderkey) AS seg FROM orders) x GROUP BY seg
""")
def segment_bounds(spark, sf_dir):
    """Balanced order-key ranges for a parallel full extract."""
    return patterns.segment_bounds(table(spark, sf_dir, "orders"), "o_orderkey", SEGMENTS)


@register("full_reload", O.scd2_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def full_reload(spark, sf_dir):
    """Reload the target from everything landed (files in any order, one
    replayed) into a new version and switch to it."""
    root = scratch_dir(spark, "reload")
    ct = land_permuted_events(spark, sf_dir, f"{root}/landing")
    spec = EV.with_(scd_types=(2,))
    build.full_reload(spark, spec, f"{root}/target", ct)
    paths = build.current_paths(spark, f"{root}/target")
    return spark.read.parquet(paths["scd2"])


_SNAP_SCD1 = "SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"


@register("scd_both_modes", f"""
SELECT 'events' AS dataset, 'hard' AS delete_mode, 'cdc' AS merge_mode, 'scd1' AS target,
       CAST((SELECT count(*) FROM ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) a) AS BIGINT) AS n_rows
UNION ALL SELECT 'events', 'hard', 'cdc', 'scd2', (SELECT count(*) FROM ({O.EVENTS_STD}) s WHERE _op <> 'D')
UNION ALL SELECT 'events', 'soft', 'cdc', 'scd1', (SELECT count(DISTINCT user_id) FROM events)
UNION ALL SELECT 'events', 'soft', 'cdc', 'scd2', (SELECT count(*) FROM events)
UNION ALL SELECT 'events', 'hard', 'append', 'append', (SELECT count(*) FROM events)
UNION ALL SELECT 'lineitem', 'hard', 'cdc', 'scd1',
  (SELECT count(*) FROM ({O.scd1_sql(O.LINEITEM_STD, 'l_orderkey, l_linenumber', O.LINEITEM_ORDER_DESC, LI_COLS)}) b)
UNION ALL SELECT 'lineitem', 'hard', 'cdc', 'scd2',
  (SELECT count(*) FROM ({O.scd2_sql(O.LINEITEM_STD, 'l_orderkey, l_linenumber', O.LINEITEM_ORDER_ASC, LI_COLS)}) c)
UNION ALL SELECT 'lineitem_snapshot', 'hard', 'cdc', 'scd1', ({_SNAP_SCD1})
UNION ALL SELECT 'lineitem_snapshot', 'hard', 'cdc', 'scd2', ({_SNAP_SCD1})
""")
def scd_both_modes(spark, sf_dir):
    """Every target mode written by the batch build and counted back from
    storage: both SCD types from one fold, soft deletes, append, clustering,
    and a snapshot without op / sequence columns (all upserts)."""
    root = scratch_dir(spark, "modes")
    li_snapshot = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                           "l_extendedprice", "l_returnflag", "l_linestatus")
    jobs = [
        ("events", feeds.feed_events(spark, sf_dir), EV),
        ("events", feeds.feed_events(spark, sf_dir), EV.with_(delete_mode="soft")),
        ("events", feeds.feed_events(spark, sf_dir), EV.with_(merge_mode="append")),
        ("lineitem", feeds.feed_lineitem(spark, sf_dir), LI.with_(cluster_by=("l_orderkey",))),
        ("lineitem_snapshot", li_snapshot, LI.with_(seed_seq=0, seq_type="bigint")),
    ]
    rows = None
    for i, (name, raw, spec) in enumerate(jobs):
        paths = build.build_targets(raw, spec, f"{root}/{i}")
        for target, path in paths.items():
            n = spark.read.parquet(path).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
                F.lit(name).alias("dataset"), F.lit(spec.delete_mode).alias("delete_mode"),
                F.lit(spec.merge_mode).alias("merge_mode"), F.lit(target).alias("target"), "n_rows")
            rows = n if rows is None else rows.unionByName(n)
    return rows


@register("segment_bounds_sketch", """
SELECT CAST(s AS INTEGER) AS segment, true AS within_1_percent, true AS above_the_previous,
       CAST((SELECT count(*) FROM orders) AS BIGINT) AS rows_in_all
FROM range(1, {n}) t(s)
""".format(n=SEGMENTS + 1))
def segment_bounds_sketch(spark, sf_dir):
    """Sketch-chosen order-key ranges: each holds its share of the rows to
    one percent, they do not overlap, and no row is lost."""
    seg = patterns.sketched_segments(table(spark, sf_dir, "orders"), "o_orderkey", SEGMENTS)
    w = Window.orderBy("segment")  # one row per segment
    total = F.sum("n_rows").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = total / F.lit(SEGMENTS)
    return seg.select("segment", (F.abs(F.col("n_rows") - share) <= F.greatest(share * 0.01, F.lit(1.0))).alias("within_1_percent"),
                      F.coalesce(F.col("lo") > F.lag("hi").over(w), F.lit(True)).alias("above_the_previous"), total.alias("rows_in_all"))


_NULLED = ["l_returnflag", "l_linestatus", "l_linenumber"]
_NULLED_SQL = """SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus, l_linenumber, l_extendedprice
FROM lineitem"""


@register("skewed_null_identity", f"""
SELECT {', '.join(_NULLED)}, l_orderkey, l_extendedprice, CAST(row_number() OVER (PARTITION BY {', '.join(_NULLED)} ORDER BY l_orderkey, l_extendedprice) AS BIGINT) AS _dup_no
FROM ({_NULLED_SQL}) x
""")
def skewed_null_identity(spark, sf_dir):
    """Keyless rows of few contents, a third of them with a NULL column, far
    above the hot-key threshold: every copy gets a number of its own."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_returnflag")).alias("l_returnflag"),
                                                 "l_linestatus", "l_linenumber", "l_extendedprice")
    out = patterns.synthetic_identity(li, _NULLED, ["l_orderkey", "l_extendedprice"], max_group_rows=200, with_hash=False)
    return out.select(*_NULLED, "l_orderkey", "l_extendedprice", "_dup_no")
