"""Catalogue: gold marts, incremental refresh, change push, cost, compaction
and a whole group run with its log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import standardize
from ..operators import layout, merge, rules, sizing
from ..session import scratch_dir
from ..sources import feeds, scenario
from ..sources import metadata as M
from ..sources.files import read_landed
from ..sources.tables import table
from . import build, group_reports, marts, reports
from . import oracle_sql as O
from .catalog import register
from .group import latest_phase, run_group
from .q_core import EV_COLS, LI_COLS, OVERLAP_STD

LI = feeds.LINEITEM_SPEC


def _current_lines(spark, sf_dir):
    """Silver line items: latest state of the lineitem change feed."""
    return merge.scd1(standardize(feeds.feed_lineitem(spark, sf_dir), LI), LI)


_LINES_SQL = O.scd1_sql(O.LINEITEM_STD, "l_orderkey, l_linenumber", O.LINEITEM_ORDER_DESC, LI_COLS)


@register("gold_daily_sales", f"""
WITH p AS (SELECT l_orderkey, count(*) AS nl, sum(l_quantity) AS q, sum(l_extendedprice) AS r FROM ({_LINES_SQL}) l GROUP BY 1)
SELECT CAST(o_orderdate AS DATE) AS order_day, o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders,
       CAST(sum(nl) AS BIGINT) AS n_lines, round(sum(q), 2) AS total_quantity, round(sum(r), 2) AS revenue
FROM orders JOIN p ON o_orderkey = l_orderkey GROUP BY 1, 2
""")
def gold_daily_sales(spark, sf_dir):
    """Daily sales from the silver (current-state) line items."""
    return marts.daily_sales(table(spark, sf_dir, "orders"), _current_lines(spark, sf_dir))


@register("gold_customer_360", """
WITH o AS (SELECT o_custkey AS customer_key, CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 2) AS total_spend,
                  min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date FROM orders GROUP BY 1),
     e AS (SELECT user_id AS customer_key, CAST(count(*) AS BIGINT) AS n_events, arg_max(event_type, event_id) AS last_event_type,
                  round(sum(value), 2) AS total_event_value FROM events GROUP BY 1)
SELECT c.c_custkey AS customer_key, c.c_name AS customer_name, c.c_mktsegment AS market_segment,
       n.n_name AS nation_name, r.r_name AS region_name, o.n_orders, o.total_spend, o.first_order_date, o.last_order_date,
       e.n_events, e.last_event_type, e.total_event_value
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN o ON o.customer_key = c.c_custkey LEFT JOIN e ON e.customer_key = c.c_custkey
""")
def gold_customer_360(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return marts.customer_360(t("customer"), t("nation"), t("region"), t("orders"), t("events"))


# A flat fee added to re-priced orders (keeps every amount exact to the cent).
REPRICE_FEE = 100.0


def _month():
    return F.date_trunc("month", F.col("o_orderdate")).cast("date")


def _changed_orders(orders):
    """The change batch: pending orders re-priced with a flat fee."""
    return (orders.filter(F.col("o_orderstatus") == "P")
            .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(REPRICE_FEE)))


def _updated_orders(orders):
    upd = _changed_orders(orders).select("o_orderkey", F.col("o_totalprice").alias("_new"))
    return orders.join(upd, "o_orderkey", "left").withColumn(
        "o_totalprice", F.coalesce("_new", "o_totalprice")).drop("_new")


_UPDATED_SQL = f"""SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice + {REPRICE_FEE} ELSE o_totalprice END
                            AS o_totalprice) FROM orders"""
_DAILY_SQL = "SELECT CAST(o_orderdate AS DATE) AS order_day, CAST(count(*) AS BIGINT) AS n_orders, " \
             "round(sum(o_totalprice), 2) AS total_price FROM ({src}) x GROUP BY 1"


@register("mart_incremental", _DAILY_SQL.format(src=_UPDATED_SQL))
def mart_incremental(spark, sf_dir):
    """Daily order totals maintained incrementally: after a change batch only
    the touched days are rebuilt (dynamic partition overwrite); the result
    equals a full rebuild."""
    root = scratch_dir(spark, "mart_incr")
    orders = table(spark, sf_dir, "orders")
    path = f"{root}/daily"
    marts.write_partitioned(marts.daily_order_totals(orders), path, "order_month")
    changed = _changed_orders(orders).withColumn("order_month", _month())
    marts.refresh_partitions(spark, path, _updated_orders(orders), changed, "order_month", marts.daily_order_totals, _month())
    return spark.read.parquet(path).select("order_day", "n_orders", "total_price")


@register("mart_incremental_emptied", _DAILY_SQL.format(
    src="SELECT * FROM orders WHERE date_trunc('month', o_orderdate) > (SELECT date_trunc('month', min(o_orderdate)) FROM orders)"))
def mart_incremental_emptied(spark, sf_dir):
    """All orders of the first month are deleted at the source: its partition
    of the mart goes, the others are not touched."""
    root = scratch_dir(spark, "mart_empty")
    orders = table(spark, sf_dir, "orders")
    path = f"{root}/daily"
    marts.write_partitioned(marts.daily_order_totals(orders), path, "order_month")
    first = orders.agg(F.date_trunc("month", F.min("o_orderdate")).cast("date")).scalar()
    gone = orders.withColumn("order_month", _month()).filter(F.col("order_month") == first)
    kept = orders.filter(_month() != first)
    marts.refresh_partitions(spark, path, kept, gone, "order_month", marts.daily_order_totals, _month())
    return spark.read.parquet(path).select("order_day", "n_orders", "total_price")


@register("mart_change_push", f"""
WITH b AS ({_DAILY_SQL.format(src='SELECT * FROM orders')}), a AS ({_DAILY_SQL.format(src=_UPDATED_SQL)})
SELECT b.order_day, b.n_orders, b.total_price, 'update_preimage' AS _change_type, CAST(2 AS BIGINT) AS _commit_version
FROM b JOIN a USING (order_day) WHERE b.n_orders IS DISTINCT FROM a.n_orders OR b.total_price IS DISTINCT FROM a.total_price
UNION ALL
SELECT a.order_day, a.n_orders, a.total_price, 'update_postimage', 2
FROM b JOIN a USING (order_day) WHERE b.n_orders IS DISTINCT FROM a.n_orders OR b.total_price IS DISTINCT FROM a.total_price
""")
def mart_change_push(spark, sf_dir):
    """Changes of the daily mart between two versions, landed and pushed by a
    stream to a sink folder per micro-batch, the last one replayed; read back
    from the sink."""
    root = scratch_dir(spark, "push")
    orders = table(spark, sf_dir, "orders")
    v1 = marts.daily_order_totals(orders).drop("order_month")
    v2 = marts.daily_order_totals(_updated_orders(orders)).drop("order_month")
    cdf = reports.change_feed(v1, v2, ["order_day"], version=2)
    cdf.write.parquet(f"{root}/changes/version=2")
    marts.push_changes(spark, f"{root}/changes/version=2", f"{root}/sink", f"{root}/checkpoint")
    marts.push_batch(f"{root}/sink")(spark.read.parquet(f"{root}/changes/version=2"), 0)  # a replay of the batch
    return spark.read.parquet(f"{root}/sink").drop("push")


# Unit prices per usage type and validity period (a price list).
PRICE_LIST = [
    ("view", "2024-01-01 00:00:00", "2024-01-15 00:00:00", 0.010),
    ("view", "2024-01-15 00:00:00", "2100-01-01 00:00:00", 0.012),
    ("click", "2024-01-01 00:00:00", "2024-01-15 00:00:00", 0.020),
    ("click", "2024-01-15 00:00:00", "2100-01-01 00:00:00", 0.025),
    ("purchase", "2024-01-01 00:00:00", "2024-01-15 00:00:00", 0.100),
    ("purchase", "2024-01-15 00:00:00", "2100-01-01 00:00:00", 0.080),
    ("signup", "2024-01-01 00:00:00", "2100-01-01 00:00:00", 0.050),
    ("error", "2024-01-01 00:00:00", "2100-01-01 00:00:00", 0.000),
]
_PRICE_SQL = " UNION ALL ".join(
    f"SELECT '{i}' AS item, TIMESTAMP '{a}' AS valid_from, TIMESTAMP '{b}' AS valid_to, {p} AS unit_price"
    for i, a, b, p in PRICE_LIST)


def _prices(spark):
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("valid_from", T.StringType()),
                           T.StructField("valid_to", T.StringType()), T.StructField("unit_price", T.DoubleType())])
    return (spark.createDataFrame(PRICE_LIST, schema)
            .withColumn("valid_from", F.to_timestamp_ntz("valid_from")).withColumn("valid_to", F.to_timestamp_ntz("valid_to")))


def _usage(spark, sf_dir):
    """Events as usage, tagged with the pipeline group of the user's nation."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    u = ev.join(c, "user_id", "left").withColumn("group_tag", F.concat(F.lit("group_"), F.col("c_nationkey").cast("string")))
    return marts.usage_cost(u, _prices(spark), len(PRICE_LIST), "event_type", "ts", "value")


_USAGE_SQL = f"""
SELECT 'group_' || CAST(c.c_nationkey AS VARCHAR) AS group_tag, e.event_type, e.ts, e.value, e.value * p.unit_price AS cost
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN ({_PRICE_SQL}) p ON p.item = e.event_type AND e.ts >= p.valid_from AND e.ts < p.valid_to
"""


@register("cost_by_group", f"""
SELECT group_tag, event_type, CAST(count(*) AS BIGINT) AS units, round(sum(value), 2) AS quantity, round(sum(cost), 5) AS cost
FROM ({_USAGE_SQL}) u GROUP BY 1, 2
""")
def cost_by_group(spark, sf_dir):
    """Usage priced by the price valid when it happened, per pipeline group."""
    return _usage(spark, sf_dir).groupBy("group_tag", "event_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("units"), F.round(F.sum("value"), 2).alias("quantity"),
        F.round(F.sum("cost"), 5).alias("cost"))


@register("cost_outliers", f"""
WITH d AS (SELECT group_tag, CAST(ts AS DATE) AS day, round(sum(cost), 5) AS cost FROM ({_USAGE_SQL}) u GROUP BY 1, 2)
SELECT group_tag, day, cost,
       round(avg(cost) OVER w7, 6) AS avg_prev, round(stddev_samp(cost) OVER w7, 6) AS stddev_prev,
       round(cost - lag(cost) OVER w, 5) AS dod_change,
       coalesce(cost > avg(cost) OVER w7 + 2.0 * stddev_samp(cost) OVER w7, false) AS is_jump
FROM d WINDOW w AS (PARTITION BY group_tag ORDER BY day),
              w7 AS (PARTITION BY group_tag ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
""")
def cost_outliers(spark, sf_dir):
    """Daily spend per group against its previous week."""
    daily = _usage(spark, sf_dir).groupBy("group_tag", F.to_date("ts").alias("day")).agg(
        F.round(F.sum("cost"), 5).alias("cost"))
    return marts.cost_outliers(daily, "group_tag", "day", "cost")


@register("clustered_compacted_write", "SELECT * FROM orders")
def clustered_compacted_write(spark, sf_dir):
    """Orders landed as many small files, compacted into clustered files of
    bounded size; the contents are unchanged."""
    root = scratch_dir(spark, "compact")
    orders = table(spark, sf_dir, "orders")
    small = f"{root}/small"
    orders.repartition(64).write.parquet(small)
    n = orders.count()
    marts.compact(spark, small, f"{root}/compact", ["o_orderkey"], target_rows_per_file=max(1000, n // 8))
    return spark.read.parquet(f"{root}/compact")


def feed_metadata(spark, landing_root: str) -> dict:
    """Control tables for the feeds landed under ``landing_root``."""
    sm = spark.createDataFrame([("FEEDS", "test feeds", "tables", "derived", landing_root, True)], M.SOURCE_MASTER)
    sc = spark.createDataFrame([("FEEDS", "file_format", "parquet")], M.KV_SOURCE)
    dm = spark.createDataFrame([
        ("FEEDS.EVENTS", "FEEDS", "APP", "events", "events", 1, True),
        ("FEEDS.LINEITEM", "FEEDS", "SALES", "lineitem", "lineitem", 1, True),
        ("FEEDS.ORDERS", "FEEDS", "SALES", "orders", "orders", 1, True),
        ("FEEDS.BROKEN", "FEEDS", "SALES", "nothing_landed", "broken", 1, True),
        ("FEEDS.ARCHIVE", "FEEDS", "SALES", "archive", "archive", 1, False),
    ], M.DATASET_MASTER)
    dc = spark.createDataFrame([
        ("FEEDS.EVENTS", "primary_keys", "user_id"), ("FEEDS.EVENTS", "scd_type", "both"),
        ("FEEDS.EVENTS", "load_type", "full"), ("FEEDS.EVENTS", "seed_seq", "-1"), ("FEEDS.EVENTS", "seq_type", "bigint"),
        ("FEEDS.LINEITEM", "primary_keys", "l_orderkey, l_linenumber"), ("FEEDS.LINEITEM", "scd_type", "1"),
        ("FEEDS.LINEITEM", "cluster_by", "l_orderkey"),
        ("FEEDS.ORDERS", "primary_keys", "o_custkey"), ("FEEDS.ORDERS", "delete_mode", "soft"),
        ("FEEDS.BROKEN", "primary_keys", "id"),
    ], M.KV_DATASET)
    return {"source_master": sm, "source_config": sc, "dataset_master": dm, "dataset_config": dc,
            "platform_config": M.platform_config(spark)}


def _log_row(ds, target, phase, status, message):
    ds_sql = f"'{ds}'" if ds else "CAST(NULL AS VARCHAR)"
    tg_sql = f"'{target}'" if target else "CAST(NULL AS VARCHAR)"
    msg = message if message.startswith("(") else (f"'{message}'" if message else "CAST(NULL AS VARCHAR)")
    return (f"SELECT 'FEEDS' AS source_id, CAST(1 AS INTEGER) AS table_group_no, {ds_sql} AS dataset_id, "
            f"{tg_sql} AS target_table, '{phase}' AS phase, '{status}' AS status, {msg} AS message")


_RUN_SQL = " UNION ALL ".join([
    _log_row(None, None, "GROUP_START", "INFO", "run of group 1 of FEEDS; asked for: ALL"),
    _log_row("FEEDS.BROKEN", "broken", "REGISTERED", "OK", "targets: scd 1; loads: incr"),
    _log_row("FEEDS.BROKEN", "broken", "DERIVE", "OK", "cdc merge on (id)"),
    _log_row("FEEDS.BROKEN", "broken", "ERROR", "FAILED", "PATH_NOT_FOUND"),
    _log_row("FEEDS.EVENTS", "events", "REGISTERED", "OK", "targets: scd both; loads: full"),
    _log_row("FEEDS.EVENTS", "events", "DERIVE", "OK", "cdc merge on (user_id)"),
    _log_row("FEEDS.EVENTS", "events", "READER", "OK", "flows=full+ct"),
    _log_row("FEEDS.EVENTS", "events", "WRITER", "OK",
             f"('scd1=' || (SELECT count(*) FROM ({O.scd1_sql(OVERLAP_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) a)"
             f" || ' scd2=' || (SELECT count(*) FROM ({O.scd2_sql(OVERLAP_STD, 'user_id', O.EVENTS_ORDER_ASC, EV_COLS)}) b))"),
    _log_row("FEEDS.EVENTS", "events", "DONE", "OK", ""),
    _log_row("FEEDS.LINEITEM", "lineitem", "REGISTERED", "OK", "targets: scd 1; loads: incr"),
    _log_row("FEEDS.LINEITEM", "lineitem", "DERIVE", "OK", "cdc merge on (l_orderkey, l_linenumber)"),
    _log_row("FEEDS.LINEITEM", "lineitem", "READER", "OK", "flows=ct"),
    _log_row("FEEDS.LINEITEM", "lineitem", "WRITER", "OK", f"('scd1=' || (SELECT count(*) FROM ({_LINES_SQL}) c))"),
    _log_row("FEEDS.LINEITEM", "lineitem", "DONE", "OK", ""),
    _log_row("FEEDS.ORDERS", "orders", "REGISTERED", "OK", "targets: scd 1; loads: incr"),
    _log_row("FEEDS.ORDERS", "orders", "DERIVE", "OK", "cdc merge on (o_custkey)"),
    _log_row("FEEDS.ORDERS", "orders", "READER", "OK", "flows=ct"),
    _log_row("FEEDS.ORDERS", "orders", "WRITER", "OK", "('scd1=' || (SELECT count(DISTINCT o_custkey) FROM orders))"),
    _log_row("FEEDS.ORDERS", "orders", "DONE", "OK", ""),
])


@register("run_report_rows", _RUN_SQL)
def run_report_rows(spark, sf_dir):
    """One pipeline group run end to end from the control tables: feeds
    landed as <table>__full / <table>__ct, every dataset merged and written,
    targets counted back from storage, one log row per phase (a dataset
    with nothing landed fails and is logged, the others still run)."""
    root = scratch_dir(spark, "group")
    landing = f"{root}/landing"
    feeds.seed_customer(spark, sf_dir).write.parquet(f"{landing}/events__full")
    feeds.feed_events(spark, sf_dir).write.parquet(f"{landing}/events__ct")
    feeds.feed_lineitem(spark, sf_dir).write.parquet(f"{landing}/lineitem__ct")
    feeds.feed_orders(spark, sf_dir).write.parquet(f"{landing}/orders__ct")
    meta = feed_metadata(spark, landing)
    log = run_group(spark, meta, "FEEDS", 1, f"{root}/targets", log_path=f"{root}/run_log", parallelism=4)
    return log


# -- reports of a group, from the control tables ---------------------------------

def _report_metadata(spark, landing):
    """The feeds' group with one more dataset: history only, no latest state."""
    meta = feed_metadata(spark, landing)
    meta["dataset_master"] = meta["dataset_master"].unionByName(spark.createDataFrame(
        [("FEEDS.HISTORY", "FEEDS", "APP", "events", "history", 2, True)], meta["dataset_master"].schema))
    meta["dataset_config"] = meta["dataset_config"].unionByName(spark.createDataFrame(
        [("FEEDS.HISTORY", "primary_keys", "user_id"), ("FEEDS.HISTORY", "scd_type", "2"), ("FEEDS.HISTORY", "seq_type", "bigint")],
        meta["dataset_config"].schema))
    return meta


def _built_group(spark, sf_dir, name):
    """Land the feeds and build every dataset of both groups."""
    root = scratch_dir(spark, name)
    landing = f"{root}/landing"
    feeds.seed_customer(spark, sf_dir).write.parquet(f"{landing}/events__full")
    feeds.feed_events(spark, sf_dir).write.parquet(f"{landing}/events__ct")
    feeds.feed_lineitem(spark, sf_dir).write.parquet(f"{landing}/lineitem__ct")
    feeds.feed_orders(spark, sf_dir).write.parquet(f"{landing}/orders__ct")
    meta = _report_metadata(spark, landing)
    for group in (1, 2):
        run_group(spark, meta, "FEEDS", group, f"{root}/targets", parallelism=4)
    return root, meta


# The given table that stands for a dataset's source.
SOURCE_OF = {"events": "customer", "lineitem": "lineitem", "orders": "customer"}
_ACTIVE_ORDERS = "SELECT o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) o WHERE rn = 1 AND o_orderstatus <> 'P'"


def _recon_sql(ds, group, schema, src, table, source_sql, target_sql):
    return f"""SELECT '{ds}' AS dataset_id, 'FEEDS' AS source_id, CAST({group} AS INTEGER) AS table_group_no, '{schema}' AS source_schema,
  '{src}' AS source_table, '{table}' AS target_table, CAST(s AS BIGINT) AS source_count, CAST(t AS BIGINT) AS target_count,
  CAST(s - t AS BIGINT) AS diff, CASE WHEN s = t THEN 'OK' ELSE 'MISMATCH' END AS status, CAST(NULL AS VARCHAR) AS message
FROM (SELECT count(*) AS s FROM ({source_sql}) a) x, (SELECT count(*) AS t FROM ({target_sql}) b) y"""


_RECON_GROUP_SQL = " UNION ALL ".join([
    _recon_sql("FEEDS.EVENTS", 1, "APP", "events", "bronze.bronze_scd1.events", "SELECT * FROM customer",
               O.scd1_sql(OVERLAP_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS)),
    _recon_sql("FEEDS.LINEITEM", 1, "SALES", "lineitem", "bronze.bronze_scd1.lineitem", "SELECT * FROM lineitem", _LINES_SQL),
    _recon_sql("FEEDS.ORDERS", 1, "SALES", "orders", "bronze.bronze_scd1.orders", "SELECT * FROM customer", _ACTIVE_ORDERS),
    _recon_sql("FEEDS.HISTORY", 2, "APP", "events", "bronze.bronze_scd2.history", "SELECT * FROM customer",
               O.scd1_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS)),
    """SELECT 'FEEDS.BROKEN', 'FEEDS', CAST(1 AS INTEGER), 'SALES', 'nothing_landed', 'bronze.bronze_scd1.broken', CAST(NULL AS BIGINT),
  CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'ERROR', 'PATH_NOT_FOUND'"""])


@register("recon_group_report", _RECON_GROUP_SQL)
def recon_group_report(spark, sf_dir):
    """Every group reconciled from the control tables against the written
    targets (open versions of the history-only one), appended and read back."""
    root, meta = _built_group(spark, sf_dir, "recon_group")
    group_reports.recon_group(
        spark, meta, "FEEDS", source_rows=lambda r: table(spark, sf_dir, SOURCE_OF.get(r["source_table"], "customer")),
        target_rows=lambda r, kind: spark.read.parquet(f"{root}/targets/{r['target_table']}/{kind}"), report_path=f"{root}/recon_report")
    return spark.read.parquet(f"{root}/recon_report").drop("event_ts")


_COMMIT = "(TIMESTAMP '2031-01-01 00:00:00')"


def _latency_sql(ds, table, ts_sql):
    return f"""SELECT '{ds}' AS dataset_id, '{table}' AS target_table, round(quantile_cont(l, 0.5), 3) AS p50_sec,
  round(quantile_cont(l, 0.95), 3) AS p95_sec, round(max(l), 3) AS max_sec, CAST(count(l) AS BIGINT) AS record_count, 'OK' AS status, CAST(NULL AS VARCHAR) AS message
FROM (SELECT round((epoch_us({_COMMIT}) - epoch_us(ts)) / 1e6, 3) AS l FROM ({ts_sql}) t) x"""


_LATENCY_GROUP_SQL = " UNION ALL ".join([
    _latency_sql("FEEDS.EVENTS", "bronze.bronze_scd1.events",
                 f"SELECT header__change_ts AS ts FROM ({O.scd1_sql(OVERLAP_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) e WHERE header__change_ts IS NOT NULL"),
    _latency_sql("FEEDS.HISTORY", "bronze.bronze_scd2.history",
                 f"SELECT header__change_ts AS ts FROM ({O.scd2_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_ASC, EV_COLS)}) e"),
    _latency_sql("FEEDS.ORDERS", "bronze.bronze_scd1.orders", """SELECT o_orderdate AS ts FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) o WHERE rn = 1"""),
    """SELECT 'FEEDS.LINEITEM', 'bronze.bronze_scd1.lineitem', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), 'ERROR',
  'the change feed has no column header__change_ts'""",
    """SELECT 'FEEDS.BROKEN', 'bronze.bronze_scd1.broken', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), 'ERROR', 'PATH_NOT_FOUND'"""])


@register("latency_group_report", _LATENCY_GROUP_SQL)
def latency_group_report(spark, sf_dir):
    """Latency of every dataset's first load from its change feed (all rows
    arrive at one commit time), with ERROR rows for a feed without commit
    times and a target that is missing; appended and read back."""
    root, meta = _built_group(spark, sf_dir, "latency_group")
    commit = F.expr("TIMESTAMP_NTZ '2031-01-01 00:00:00'")

    def changes(r, kind):
        rows = spark.read.parquet(f"{root}/targets/{r['target_table']}/{kind}")
        keys = r["primary_keys"].split(",") + (["__START_AT"] if kind == "scd2" else [])
        return reports.change_feed(rows.limit(0), rows, keys, 1, commit)
    group_reports.latency_group(spark, meta, "FEEDS", changes=changes, from_version=1, report_path=f"{root}/latency_report")
    return spark.read.parquet(f"{root}/latency_report").drop("event_ts")


# -- a group on the incremental path ------------------------------------------------

def _half_sql(ct, order, half):
    """The changes of the first landing (even sequences), or of both."""
    return ct if half == 2 else f"SELECT * FROM ({ct}) h WHERE {order} % 2 = 0"


def _two_runs_sql():
    """Expected writer counts of two runs, the second with new files only."""
    parts = []
    for run in (1, 2):
        events = _half_sql(O.EVENTS_CT, "header__change_seq", run)
        orders = _half_sql(O.ORDERS_CT, "header__change_seq", run)
        std = f"SELECT *, header__change_oper AS _op, header__change_seq AS _seq FROM ({events}) c"
        seeded = OVERLAP_STD.replace(f"({O.EVENTS_CT})", f"({events})")
        parts.append(f"""SELECT {run} AS run_no, 'FEEDS.EVENTS' AS dataset_id,
  'scd1=' || (SELECT count(*) FROM ({O.scd1_sql(seeded, "user_id", O.EVENTS_ORDER_DESC, EV_COLS)}) a)
  || ' scd2=' || (SELECT count(*) FROM ({O.scd2_sql(seeded, "user_id", O.EVENTS_ORDER_ASC, EV_COLS)}) b) AS message""")
        parts.append(f"SELECT {run}, 'FEEDS.ORDERS', 'scd1=' || (SELECT count(DISTINCT o_custkey) FROM ({orders}) o)")
        parts.append(f"SELECT {run}, 'FEEDS.HISTORY', 'scd2=' || (SELECT count(*) FROM ({O.scd2_sql(std, 'user_id', O.EVENTS_ORDER_ASC, EV_COLS)}) d)")
    return " UNION ALL ".join(parts)


@register("group_incremental", _two_runs_sql())
def group_incremental(spark, sf_dir):
    """Two incremental runs of the groups: the even sequences land first, the
    odd ones before the second run, which reads the new files only."""
    root = scratch_dir(spark, "group_incr")
    landing = f"{root}/landing"
    feeds.seed_customer(spark, sf_dir).write.parquet(f"{landing}/events__full/part=0")
    meta = _report_metadata(spark, landing)
    logs = []
    for run in (1, 2):
        for name, feed in (("events", feeds.feed_events(spark, sf_dir)), ("orders", feeds.feed_orders(spark, sf_dir))):
            feed.filter(F.pmod("header__change_seq", F.lit(2)) == run - 1).write.parquet(f"{landing}/{name}__ct/part={run}")
        for group, wanted in ((1, "FEEDS.EVENTS,FEEDS.ORDERS"), (2, "ALL")):
            log = run_group(spark, meta, "FEEDS", group, f"{root}/targets", wanted, incremental=True, buckets=8, raise_at_end=True)
            logs.append(log.filter("phase = 'WRITER'").select(F.lit(run).alias("run_no"), "dataset_id", "message"))
    return reports._union(logs)


@register("small_file_compaction", """
SELECT CAST(2 * count(*) AS BIGINT) AS n_rows, true AS fewer_files, true AS sizes_in_range, true AS large_untouched FROM events
""")
def small_file_compaction(spark, sf_dir):
    """Events as one large and forty small files: only the small ones are
    merged, into files of at most about the target size."""
    path = f"{scratch_dir(spark, 'small_files')}/events"
    ev = table(spark, sf_dir, "events")
    ev.coalesce(1).write.parquet(path)
    large = layout.files_of(spark, path).first()
    ev.repartition(40).write.mode("append").parquet(path)
    target = large["bytes"] // 2
    before = layout.files_of(spark, path).count()
    layout.compact_small_files(spark, path, target, small_bytes=target, cluster_by=["event_id"])
    files = layout.files_of(spark, path)
    made = F.col("file_path") != large["file_path"]
    return files.agg(F.sum("rows").alias("n_rows"), (F.count(F.lit(1)) < before / 4).alias("fewer_files"),
                     F.bool_and(~made | F.col("bytes").between(target / 8, target * 1.5)).alias("sizes_in_range"),
                     F.bool_or((F.col("file_path") == large["file_path"]) & (F.col("bytes") == large["bytes"])).alias("large_untouched"))


@register("curve_clustered_write", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS fewer_files_for_second_column, true AS first_column_still_prunes FROM lineitem
""")
def curve_clustered_write(spark, sf_dir):
    """Line items clustered along a curve through part and ship date: a filter
    on the second column meets fewer files than with plain ranges of both,
    and one on the first does not meet all."""
    root = scratch_dir(spark, "curve")
    cols = ["l_partkey", "l_shipdate"]
    li = table(spark, sf_dir, "lineitem").select(*cols, "l_orderkey", "l_linenumber")
    n = li.count()
    layout.curve_clustered(li, cols, target_bytes=max(1, sizing.size_of(li, n) // 16), n_rows=n).write.parquet(f"{root}/curve")
    li.repartitionByRange(16, *cols).sortWithinPartitions(*cols).write.parquet(f"{root}/plain")
    cut = li.agg(*[F.percentile_approx(c, 0.1).alias(c) for c in cols]).first()

    def met(path, c):
        spans = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.min(c).alias("lo"))
        return spans.filter(F.col("lo") <= F.lit(cut[c])).count(), spans.count()
    curve2, _ = met(f"{root}/curve", "l_shipdate")
    plain2, _ = met(f"{root}/plain", "l_shipdate")
    curve1, files = met(f"{root}/curve", "l_partkey")
    return spark.read.parquet(f"{root}/curve").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(curve2 < plain2).alias("fewer_files_for_second_column"),
                                                   F.lit(curve1 < files).alias("first_column_still_prunes"))


@register("group_latest_phase", """
SELECT * FROM (VALUES ('FEEDS.BROKEN', 'ERROR', 'FAILED', 'PATH_NOT_FOUND'), ('FEEDS.EVENTS', 'DONE', 'OK', NULL), ('FEEDS.LINEITEM', 'DONE', 'OK', NULL),
  ('FEEDS.ORDERS', 'DONE', 'OK', NULL)) t(dataset_id, phase, status, message)
""")
def group_latest_phase(spark, sf_dir):
    """Where every dataset of a run got to, from the stored run log (R-LOG)."""
    root = scratch_dir(spark, "phases")
    landing = f"{root}/landing"
    feeds.seed_customer(spark, sf_dir).write.parquet(f"{landing}/events__full")
    feeds.feed_events(spark, sf_dir).write.parquet(f"{landing}/events__ct")
    feeds.feed_lineitem(spark, sf_dir).write.parquet(f"{landing}/lineitem__ct")
    feeds.feed_orders(spark, sf_dir).write.parquet(f"{landing}/orders__ct")
    run_group(spark, feed_metadata(spark, landing), "FEEDS", 1, f"{root}/targets", log_path=f"{root}/run_log", parallelism=4)
    return latest_phase(spark.read.parquet(f"{root}/run_log")).drop("run_id")


@register("scenario_rules", f"""
SELECT rule, CAST(0 AS BIGINT) AS violations, true AS passed, CAST(count(*) AS BIGINT) AS expected_active
FROM (VALUES ('active_count'), ('scd2_one_current_per_key'), ('scd2_only_last_open'), ('scd2_no_overlap'), ('scd2_contiguous_history'),
             ('scd2_start_before_end'), ('all rules')) r(rule),
     ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) s GROUP BY rule
""")
def scenario_rules(spark, sf_dir):
    """A landed scenario with changes out of order, repeated rows and equal
    sequences: the built targets pass the count check and the history rules."""
    root = scratch_dir(spark, "scenario")
    ct = feeds.feed_events(spark, sf_dir)
    again = ct.filter(F.col("header__change_seq") % 3 == 0)
    lower = ct.filter(F.col("header__change_seq") % 7 == 0).withColumn("value", F.lit(None).cast("double"))  # loses to its own sequence
    lower = lower.withColumn("event_type", F.lit("")).withColumn("header__change_oper", F.lit("U"))
    landed = ct.unionByName(again).unionByName(lower).repartition(7, F.xxhash64("header__change_seq"))
    cols = ["user_id", "event_type", "value", "header__change_ts"]
    info = scenario.write_scenario(spark, root, "events", ["user_id"], landed, cols)
    spec = feeds.EVENTS_SPEC.with_(scd_types=(1, 2), delete_mode="soft")  # a hard delete would leave a gap
    paths = build.build_targets(read_landed(spark, info["ct_path"]), spec, f"{root}/targets")
    found = scenario.check_scenario(spark.read.parquet(paths["scd1"]), spark.read.parquet(paths["scd2"]), ["user_id"], info["expected_active_count"])
    return rules.with_total(found).withColumn("expected_active", F.lit(info["expected_active_count"]).cast("long"))
