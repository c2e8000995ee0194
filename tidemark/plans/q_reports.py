"""Catalogue: reconciliation, change feed, latency, SLA and lag reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge
from ..session import materialise
from ..sources import feeds
from ..sources.tables import table
from . import oracle_sql as O
from . import reports as R
from .catalog import register
from .q_core import EV_COLS

EV = feeds.EVENTS_SPEC


def _events_scd1(spark, sf_dir, spec=EV, ct=None):
    ct = ct if ct is not None else feeds.feed_events(spark, sf_dir)
    return merge.scd1(standardize(ct, spec), spec)


MISSING_TARGET = "/nonexistent/tidemark/missing_target"


@register("recon_report", f"""
SELECT 'events.users' AS dataset_id, CAST(s.n AS BIGINT) AS source_count, CAST(t.n AS BIGINT) AS target_count,
       CAST(s.n - t.n AS BIGINT) AS diff, CASE WHEN s.n = t.n THEN 'OK' ELSE 'MISMATCH' END AS status,
       CAST(NULL AS VARCHAR) AS message
FROM (SELECT count(*) AS n FROM (SELECT user_id, arg_max(event_type, event_id) AS last FROM events GROUP BY user_id) x
      WHERE last <> 'error') s,
     (SELECT count(*) AS n FROM ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) y) t
UNION ALL
SELECT 'events.users_soft', s.n, t.n, s.n - t.n, CASE WHEN s.n = t.n THEN 'OK' ELSE 'MISMATCH' END, NULL
FROM (SELECT count(DISTINCT user_id) AS n FROM events) s,
     (SELECT count(*) AS n FROM ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) y) t
UNION ALL
SELECT 'orders.customers', s.n, t.n, s.n - t.n, CASE WHEN s.n = t.n THEN 'OK' ELSE 'MISMATCH' END, NULL
FROM (SELECT count(*) AS n FROM (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS last FROM orders GROUP BY o_custkey) x
      WHERE last <> 'P') s,
     (SELECT count(*) AS n FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY header__change_seq DESC) AS rn FROM ({O.ORDERS_CT}) c
      ) y WHERE rn = 1 AND header__change_oper <> 'D') t
UNION ALL
SELECT 'lineitem.lines', s.n, t.n, s.n - t.n, CASE WHEN s.n = t.n THEN 'OK' ELSE 'MISMATCH' END, NULL
FROM (SELECT count(*) AS n FROM lineitem) s,
     (SELECT count(*) AS n FROM ({O.scd1_sql(O.LINEITEM_STD, 'l_orderkey, l_linenumber', O.LINEITEM_ORDER_DESC, 'l_orderkey')}) y) t
UNION ALL
SELECT 'missing.table', NULL, NULL, NULL, 'ERROR', 'PATH_NOT_FOUND'
""")
def recon_report(spark, sf_dir):
    """Source counts (aggregated at the source tables) against active target
    rows, one plan for all datasets; an unreadable target is an ERROR row."""
    ev = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders")
    soft = EV.with_(delete_mode="soft")

    def users_source():
        last = ev.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last"))
        return last.filter(F.col("last") != "error")

    def orders_source():
        last = orders.groupBy("o_custkey").agg(F.max_by("o_orderstatus", "o_orderkey").alias("last"))
        return last.filter(F.col("last") != "P")

    pairs = [
        ("events.users", users_source, lambda: _events_scd1(spark, sf_dir)),
        ("events.users_soft", lambda: ev.select("user_id").distinct(), lambda: _events_scd1(spark, sf_dir, soft)),
        ("orders.customers", orders_source,
         lambda: merge.scd1(standardize(feeds.feed_orders(spark, sf_dir), feeds.ORDERS_SPEC), feeds.ORDERS_SPEC)),
        ("lineitem.lines", lambda: table(spark, sf_dir, "lineitem"),
         lambda: merge.scd1(standardize(feeds.feed_lineitem(spark, sf_dir), feeds.LINEITEM_SPEC), feeds.LINEITEM_SPEC)),
        ("missing.table", lambda: ev, lambda: spark.read.parquet(MISSING_TARGET)),
    ]
    return R.recon(spark, pairs)


def _split_expr(ev):
    """First event id of the second half, as a scalar subquery."""
    return ev.agg((F.floor(F.max("event_id") / 2) + 1).cast("bigint")).scalar()


_SPLIT_SQL = "(SELECT CAST(floor(max(event_id) / 2) + 1 AS BIGINT) FROM events)"


def _cdf_sql() -> str:
    before = O.scd1_sql(f"SELECT * FROM ({O.EVENTS_STD}) s0 WHERE _seq < {_SPLIT_SQL}", "user_id",
                        O.EVENTS_ORDER_DESC, EV_COLS)
    after = O.scd1_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS)
    diff = ("b.event_type IS DISTINCT FROM a.event_type OR b.value IS DISTINCT FROM a.value "
            "OR b.header__change_ts IS DISTINCT FROM a.header__change_ts")
    return f"""
WITH b AS ({before}), a AS ({after}),
j AS (SELECT coalesce(b.user_id, a.user_id) AS k, b.user_id AS bk, a.user_id AS ak,
             b.event_type AS b_t, b.value AS b_v, b.header__change_ts AS b_ts,
             a.event_type AS a_t, a.value AS a_v, a.header__change_ts AS a_ts
      FROM b FULL OUTER JOIN a ON b.user_id = a.user_id WHERE bk IS NULL OR ak IS NULL OR {diff})
SELECT k AS user_id, a_t AS event_type, a_v AS value, a_ts AS header__change_ts, 'insert' AS _change_type,
       CAST(2 AS BIGINT) AS _commit_version FROM j WHERE bk IS NULL
UNION ALL SELECT k, b_t, b_v, b_ts, 'delete', 2 FROM j WHERE ak IS NULL
UNION ALL SELECT k, b_t, b_v, b_ts, 'update_preimage', 2 FROM j WHERE bk IS NOT NULL AND ak IS NOT NULL
UNION ALL SELECT k, a_t, a_v, a_ts, 'update_postimage', 2 FROM j WHERE bk IS NOT NULL AND ak IS NOT NULL
"""


@register("change_feed", _cdf_sql())
def change_feed(spark, sf_dir):
    """Row changes of the SCD1 target between two sequence cuts (version 1 =
    first half of the feed applied, version 2 = all of it)."""
    ev = table(spark, sf_dir, "events")
    ct = feeds.feed_events(spark, sf_dir)
    before = _events_scd1(spark, sf_dir, ct=ct.filter(F.col("header__change_seq") < _split_expr(ev)))
    after = _events_scd1(spark, sf_dir, ct=ct)
    return R.change_feed(before, after, ["user_id"], version=2)


def _order_latency(spark, sf_dir, how="inner"):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    j = o.join(li, o.o_orderkey == li.l_orderkey, how)
    return j.withColumn("latency_sec", F.timestamp_diff("SECOND", F.col("o_orderdate"), F.col("l_shipdate")))


_LAT_SQL = """SELECT o_orderpriority, o_orderstatus, date_diff('second', o_orderdate, l_shipdate) AS latency_sec
FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


@register("latency_summary", f"""
SELECT o_orderpriority AS dataset_id, round(quantile_cont(latency_sec, 0.5), 3) AS p50_sec,
       round(quantile_cont(latency_sec, 0.95), 3) AS p95_sec, round(CAST(max(latency_sec) AS DOUBLE), 3) AS max_sec,
       CAST(count(*) AS BIGINT) AS record_count
FROM ({_LAT_SQL}) l GROUP BY o_orderpriority
""")
def latency_summary(spark, sf_dir):
    """Source commit (order date) to target commit (ship date), per dataset:
    exact p50 / p95 (linear interpolation), max, count."""
    lat = _order_latency(spark, sf_dir).withColumnRenamed("o_orderpriority", "dataset_id")
    return R.latency_summary(lat, ["dataset_id"])


@register("latency_clean", f"""
SELECT o_orderstatus AS dataset_id, round(quantile_cont(latency_sec, 0.5), 3) AS p50_sec,
       round(quantile_cont(latency_sec, 0.95), 3) AS p95_sec, round(CAST(max(latency_sec) AS DOUBLE), 3) AS max_sec,
       CAST(count(*) AS BIGINT) AS record_count
FROM (SELECT o_orderstatus, date_diff('second', o_orderdate, l_shipdate) AS latency_sec
      FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) l
WHERE latency_sec IS NOT NULL GROUP BY o_orderstatus
""")
def latency_clean(spark, sf_dir):
    """Orders without a shipment have no latency: they are dropped before the
    percentiles (F-NOTNULL), never counted as zero."""
    lat = _order_latency(spark, sf_dir, how="left").filter(F.col("latency_sec").isNotNull())
    return R.latency_summary(lat.withColumnRenamed("o_orderstatus", "dataset_id"), ["dataset_id"])


SLA_SEC = 60 * 86400


@register("latency_sla", f"""
SELECT o_orderpriority AS dataset_id, CAST(count(*) AS BIGINT) AS record_count,
       CAST(count(*) FILTER (WHERE latency_sec <= {SLA_SEC}) AS BIGINT) AS within_sla,
       round(count(*) FILTER (WHERE latency_sec <= {SLA_SEC}) / count(*), 6) AS sla_share
FROM ({_LAT_SQL}) l GROUP BY o_orderpriority
""")
def latency_sla(spark, sf_dir):
    lat = _order_latency(spark, sf_dir).withColumnRenamed("o_orderpriority", "dataset_id")
    return R.sla_share(lat, ["dataset_id"], SLA_SEC)


@register("latency_approx", f"""
SELECT o_orderpriority AS dataset_id, CAST(count(*) AS BIGINT) AS record_count, CAST(max(latency_sec) AS DOUBLE) AS max_sec,
       true AS p50_in_bound, true AS p95_in_bound
FROM ({_LAT_SQL}) l GROUP BY o_orderpriority
""")
def latency_approx(spark, sf_dir):
    """Sketches kept per commit (here: per order status, written) and merged
    into one report; the true ranks of both quantiles lie within the bound."""
    lat = _order_latency(spark, sf_dir).withColumnRenamed("o_orderpriority", "dataset_id")
    kept = materialise(R.latency_sketches(lat, ["dataset_id", "o_orderstatus"]), "latency-sketches")
    told = R.latency_from_sketches(kept, ["dataset_id"])
    v = F.col("latency_sec").cast("double")
    ranks = lat.join(F.broadcast(told.withColumnRenamed("dataset_id", "_d")), F.col("dataset_id") == F.col("_d")).groupBy("dataset_id").agg(
        *[f(v, F.col(q)).alias(f"{q}_{side}") for q in ("p50_sec", "p95_sec")
          for side, f in (("below", lambda a, b: F.avg((a < b).cast("double"))), ("upto", lambda a, b: F.avg((a <= b).cast("double"))))])
    slack = R.SKETCH_RANK_ERROR

    def ok(q, p):
        return (F.col(f"{q}_below") <= p + slack) & (F.col(f"{q}_upto") >= p - slack)
    return told.join(ranks, "dataset_id").select("dataset_id", F.col("record_count").cast("bigint").alias("record_count"), "max_sec",
                                                 ok("p50_sec", 0.5).alias("p50_in_bound"), ok("p95_sec", 0.95).alias("p95_in_bound"))


# Alert when the applied state is more than this far behind the landing.
LAG_ALERT_SEC = 3600


def _lag_for(dataset_id, ct, spec, ts_col="header__change_ts"):
    """Landed vs applied for one feed; the applier is one day behind the
    newest landed change."""
    cut = ct.agg(F.max(ts_col) - F.expr("INTERVAL 1 DAY")).scalar()
    applied = standardize(ct.filter(F.col(ts_col) <= cut), spec).filter(F.col(spec.keys[0]).isNotNull())
    landed = ct.agg(F.count(F.lit(1)).alias("landed_rows"), F.max(spec.seq_col).alias("landed_max_seq"),
                    F.max(ts_col).alias("landed_max_ts"))
    app = applied.agg(F.max("_seq").alias("applied_max_seq"), F.max(F.when(F.col("_op") != "D", F.col(ts_col))).alias("applied_max_ts"))
    lg = landed.select(F.lit(dataset_id).alias("dataset_id"), "*")
    ap = app.select(F.lit(dataset_id).alias("dataset_id"), "*")
    j = lg.join(ap, "dataset_id")
    lag_sec = F.round((F.unix_micros(F.col("landed_max_ts").cast("timestamp"))
                       - F.unix_micros(F.col("applied_max_ts").cast("timestamp"))) / 1e6, 3)
    return j.select("dataset_id", F.col("landed_rows").cast("bigint"), F.col("landed_max_seq").cast("bigint"),
                    F.col("applied_max_seq").cast("bigint"),
                    (F.col("landed_max_seq") - F.col("applied_max_seq")).cast("bigint").alias("seq_lag"),
                    lag_sec.alias("lag_sec"), (lag_sec > F.lit(LAG_ALERT_SEC)).alias("alert"))


def _lag_sql(name, ct, keys, order_asc, cols, ts="header__change_ts"):
    std = f"SELECT *, header__change_oper AS _op, header__change_seq AS _seq FROM ({ct}) c0"
    applied_std = f"SELECT * FROM ({std}) s1 WHERE {ts} <= (SELECT max({ts}) - INTERVAL 1 DAY FROM ({ct}) c1)"
    applied = O.scd2_sql(applied_std, keys, order_asc, cols)
    return f"""
SELECT '{name}' AS dataset_id, CAST(l.n AS BIGINT) AS landed_rows, CAST(l.s AS BIGINT) AS landed_max_seq,
       CAST(a.s AS BIGINT) AS applied_max_seq, CAST(l.s - a.s AS BIGINT) AS seq_lag,
       round((epoch_us(l.t) - epoch_us(a.t)) / 1e6, 3) AS lag_sec,
       round((epoch_us(l.t) - epoch_us(a.t)) / 1e6, 3) > {LAG_ALERT_SEC} AS alert
FROM (SELECT count(*) AS n, max(header__change_seq) AS s, max({ts}) AS t FROM ({ct}) c2) l,
     (SELECT max(greatest(__START_AT, coalesce(__END_AT, __START_AT))) AS s, max({ts}) AS t FROM ({applied}) v) a
"""


_ORD_ASC = ("_seq ASC NULLS FIRST, (_op = 'D') ASC NULLS FIRST, o_totalprice ASC NULLS FIRST, "
            "o_orderpriority ASC NULLS FIRST, header__change_ts ASC NULLS FIRST")


@register("feed_lag", _lag_sql("events", O.EVENTS_CT, "user_id", O.EVENTS_ORDER_ASC, EV_COLS) + " UNION ALL " +
          _lag_sql("orders", O.ORDERS_CT, "o_custkey", _ORD_ASC, "o_custkey, o_totalprice, o_orderpriority, header__change_ts"))
def feed_lag(spark, sf_dir):
    """Newest landed sequence vs newest applied one, per dataset (R-LAG)."""
    ev = _lag_for("events", feeds.feed_events(spark, sf_dir), EV)
    od = _lag_for("orders", feeds.feed_orders(spark, sf_dir), feeds.ORDERS_SPEC)
    return ev.unionByName(od)


_COMMIT_SQL = "((SELECT max(ts) FROM events) + INTERVAL 5 MINUTE)"


@register("latency_from_change_feed", f"""
WITH c AS ({_cdf_sql()}),
l AS (SELECT _change_type,
             round((epoch_us({_COMMIT_SQL}) - epoch_us(header__change_ts)) / 1e6, 3) AS latency_sec
      FROM c WHERE _change_type IN ('insert', 'update_postimage') AND header__change_ts IS NOT NULL)
SELECT _change_type AS dataset_id, round(quantile_cont(latency_sec, 0.5), 3) AS p50_sec,
       round(quantile_cont(latency_sec, 0.95), 3) AS p95_sec, round(max(latency_sec), 3) AS max_sec,
       CAST(count(*) AS BIGINT) AS record_count
FROM l GROUP BY _change_type
""")
def latency_from_change_feed(spark, sf_dir):
    """Record latency from the target's change feed: the second load commits
    five minutes after the newest change; arrivals (inserts, post-images)
    only, exact percentiles."""
    ev = table(spark, sf_dir, "events")
    ct = feeds.feed_events(spark, sf_dir)
    before = _events_scd1(spark, sf_dir, ct=ct.filter(F.col("header__change_seq") < _split_expr(ev)))
    after = _events_scd1(spark, sf_dir, ct=ct)
    commit = ev.agg(F.max("ts") + F.expr("INTERVAL 5 MINUTES")).scalar()
    cdf = R.change_feed(before, after, ["user_id"], version=2, commit_ts=commit)
    lat = R.latency_rows(cdf, "header__change_ts").withColumnRenamed("_change_type", "dataset_id")
    return R.latency_summary(lat, ["dataset_id"])
