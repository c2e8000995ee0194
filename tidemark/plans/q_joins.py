"""Catalogue: point-in-time, lookup/retry, referential, grain and dimension joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import joins, merge
from ..session import scratch_dir
from ..sources import feeds
from ..sources.tables import table
from ..streaming.retry import RetryQueue
from ..sources.files import SchemaStore, stream_landed
from . import oracle_sql as O
from .catalog import register
from .q_core import EV_COLS

EV = feeds.EVENTS_SPEC
_SCD2 = O.scd2_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS)
_MID_SQL = "(SELECT CAST(floor(max(event_id) / 2) AS BIGINT) FROM events)"


@register("scd2_as_of", f"""
SELECT * FROM ({_SCD2}) v WHERE __START_AT <= {_MID_SQL} AND (__END_AT IS NULL OR {_MID_SQL} < __END_AT)
""")
def scd2_as_of(spark, sf_dir):
    """State of every key as of the middle of the feed (point-in-time query)."""
    ev = table(spark, sf_dir, "events")
    mid = ev.agg(F.floor(F.max("event_id") / 2).cast("bigint")).scalar()
    hist = merge.scd2(standardize(feeds.feed_events(spark, sf_dir), EV), EV)
    return joins.as_of(hist, mid)


_STATE_SCD2 = O.scd2_sql(f"SELECT * FROM ({O.EVENTS_STD}) s WHERE event_type <> 'purchase'", "user_id",
                         O.EVENTS_ORDER_ASC, EV_COLS)


@register("scd2_as_of_join", f"""
SELECT f.user_id, f.event_id, f.value AS purchase_value, v.event_type AS state_type, v.value AS state_value,
       v.__START_AT, v.__END_AT
FROM (SELECT user_id, event_id, value FROM events WHERE event_type = 'purchase') f
LEFT JOIN ({_STATE_SCD2}) v
  ON v.user_id = f.user_id AND v.__START_AT <= f.event_id AND (v.__END_AT IS NULL OR f.event_id < v.__END_AT)
""")
def scd2_as_of_join(spark, sf_dir):
    """Each purchase with the user's state (SCD2 of the other events) valid
    when it happened."""
    ct = feeds.feed_events(spark, sf_dir)
    state = merge.scd2(standardize(ct.filter(F.col("event_type") != "purchase"), EV), EV)
    facts = (table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
             .select("user_id", "event_id", F.col("value").alias("purchase_value")))
    j = joins.as_of_join(facts, state, ["user_id"], "event_id", ["event_type", "value"])
    return j.select("user_id", "event_id", "purchase_value", F.col("event_type").alias("state_type"),
                    F.col("value").alias("state_value"), "__START_AT", "__END_AT")


@register("orphan_check", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus IN ('F', 'O'))
""")
def orphan_check(spark, sf_dir):
    """Line items whose order is not live (pending orders count as removed)."""
    live = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.orphans(li, live, ["l_orderkey"], ["o_orderkey"])


@register("join_grain_report", """
WITH l AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
     r AS (SELECT user_id AS k, count(*) AS m FROM events GROUP BY 1),
     j AS (SELECT * FROM l FULL OUTER JOIN r USING (k))
SELECT CAST(sum(n) AS BIGINT) AS left_rows, CAST(sum(m) AS BIGINT) AS right_rows,
       CAST(count(n) AS BIGINT) AS left_keys, CAST(count(m) AS BIGINT) AS right_keys,
       CAST(count(*) FILTER (WHERE n IS NOT NULL AND m IS NOT NULL) AS BIGINT) AS matched_keys,
       CAST(coalesce(sum(n * m), 0) AS BIGINT) AS join_rows, CAST(max(m) AS BIGINT) AS max_right_per_key
FROM j
""")
def join_grain_report(spark, sf_dir):
    """How many rows orders x events on the customer would produce."""
    return joins.grain_report(table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"),
                              ["o_custkey"], ["user_id"])


@register("join_after_dedup", """
SELECT o_orderkey, o_custkey, e.event_type AS last_event_type, e.value AS last_value
FROM orders o LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) x
  WHERE rn = 1) e ON e.user_id = o.o_custkey
""")
def join_after_dedup(spark, sf_dir):
    """Orders with the customer's latest event: events are first reduced to
    one row per user, so the order grain is kept."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey"))
    ev = (table(spark, sf_dir, "events")
          .select(F.col("user_id").alias("o_custkey"), "event_id",
                  F.col("event_type").alias("last_event_type"), F.col("value").alias("last_value")))
    return joins.dedup_then_join(o, ev, ["o_custkey"], ["event_id"]).drop("event_id")


@register("silver_dim_fact", """
SELECT o.o_orderkey AS order_key, o.o_custkey AS customer_key, o.o_orderdate AS order_date,
       o.o_totalprice AS total_price, o.o_orderstatus AS order_status,
       c.c_name AS customer_name, c.c_mktsegment AS market_segment, n.n_name AS nation_name, r.r_name AS region_name
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def silver_dim_fact(spark, sf_dir):
    """Conformed customer dimension (customer + nation + region) joined to the
    order fact.  Nation and region are bounded reference tables: broadcast
    behind the size check; the customer join is a keyed shuffle join."""
    from ..operators.sizing import checked_broadcast
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey"), F.col("r_name").alias("region_name"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation_name"), "n_regionkey")
    geo = nation.join(checked_broadcast(region), nation.n_regionkey == region.r_regionkey, "left") \
                .select("n_nationkey", "nation_name", "region_name")
    dim = (table(spark, sf_dir, "customer")
           .select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
                   F.col("c_mktsegment").alias("market_segment"), "c_nationkey"))
    dim = dim.join(checked_broadcast(geo), dim.c_nationkey == geo.n_nationkey, "left") \
             .drop("c_nationkey", "n_nationkey")
    fact = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("order_status"))
    return fact.join(dim, "customer_key", "left")


# Retry parameters: reference rows (customers) become visible at batch
# pmod(custkey, 5); events arrive in four batches by day of month.
RETRY_BATCHES, RETRY_MAX_ATTEMPTS, RETRY_VISIBLE_MOD = 4, 2, 5


def _arrival_batch(ts_col):
    return F.least(F.lit(RETRY_BATCHES - 1), F.floor((F.dayofmonth(ts_col) - 1) / 8)).cast("int")


@register("lookup_miss_retry", f"""
WITH e AS (
  SELECT event_id, user_id, CAST(least({RETRY_BATCHES - 1}, floor((dayofmonth(ts) - 1) / 8)) AS INTEGER) AS a FROM events),
c AS (SELECT c_custkey, c_mktsegment, ((c_custkey % {RETRY_VISIBLE_MOD}) + {RETRY_VISIBLE_MOD}) % {RETRY_VISIBLE_MOD} AS v
      FROM customer),
x AS (SELECT e.*, c.v, c.c_mktsegment, greatest(e.a, coalesce(c.v, 1000000)) AS hit FROM e LEFT JOIN c ON c.c_custkey = e.user_id)
SELECT event_id, user_id,
  CASE WHEN hit <= a + {RETRY_MAX_ATTEMPTS - 1} AND hit <= {RETRY_BATCHES - 1} THEN 'resolved'
       WHEN a + {RETRY_MAX_ATTEMPTS - 1} <= {RETRY_BATCHES - 1} THEN 'expired' ELSE 'pending' END AS status,
  CAST(CASE WHEN hit <= a + {RETRY_MAX_ATTEMPTS - 1} AND hit <= {RETRY_BATCHES - 1} THEN hit - a + 1
       WHEN a + {RETRY_MAX_ATTEMPTS - 1} <= {RETRY_BATCHES - 1} THEN {RETRY_MAX_ATTEMPTS}
       ELSE {RETRY_BATCHES} - a END AS INTEGER) AS attempts,
  CAST(CASE WHEN hit <= a + {RETRY_MAX_ATTEMPTS - 1} AND hit <= {RETRY_BATCHES - 1} THEN hit
       WHEN a + {RETRY_MAX_ATTEMPTS - 1} <= {RETRY_BATCHES - 1} THEN a + {RETRY_MAX_ATTEMPTS - 1}
       ELSE {RETRY_BATCHES - 1} END AS INTEGER) AS batch,
  CASE WHEN hit <= a + {RETRY_MAX_ATTEMPTS - 1} AND hit <= {RETRY_BATCHES - 1} THEN c_mktsegment END AS c_mktsegment
FROM x
""")
def lookup_miss_retry(spark, sf_dir):
    """Events enriched with the customer's segment while customer rows arrive
    late: a file stream with one landing per batch, misses retried."""
    root = scratch_dir(spark, "retry")
    landing = f"{root}/landing/events"
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    cust = (table(spark, sf_dir, "customer")
            .select("c_custkey", "c_mktsegment",
                    F.pmod(F.col("c_custkey"), F.lit(RETRY_VISIBLE_MOD)).alias("_visible_from")))
    queue = RetryQueue(spark, f"{root}/queue",
                       reference=lambda b: cust.filter(F.col("_visible_from") <= F.lit(b)).drop("_visible_from"),
                       keys=["user_id"], ref_keys=["c_custkey"], ref_cols=["c_mktsegment"],
                       max_attempts=RETRY_MAX_ATTEMPTS)
    store = SchemaStore(spark, f"{root}/_schema")
    for b in range(RETRY_BATCHES):
        ev.filter(_arrival_batch(F.col("ts")) == b).write.parquet(f"{landing}/part={b}")
        schema, _ = store.resolve(landing)
        q = (stream_landed(spark, landing, schema).drop("_ingest_source", "_ingest_file", "_ingest_ts", "ts")
             .writeStream.foreachBatch(queue.foreach_batch())
             .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    out = queue.outcome()
    return out.select("event_id", "user_id", "status", F.col("_attempts").cast("int").alias("attempts"),
                      F.col("_batch").cast("int").alias("batch"), "c_mktsegment")


_BOUGHT = f"SELECT * FROM ({O.EVENTS_STD}) b WHERE event_type IN ('purchase', 'error')"
_SEEN = f"SELECT * FROM ({O.EVENTS_STD}) s WHERE event_type NOT IN ('purchase')"


@register("scd2_join_scd2", f"""
SELECT a.user_id, a.value AS bought_value, b.event_type AS seen_type, b.value AS seen_value,
       greatest(a.__START_AT, b.__START_AT) AS __START_AT, least(a.__END_AT, b.__END_AT) AS __END_AT
FROM ({O.scd2_sql(_BOUGHT, 'user_id', O.EVENTS_ORDER_ASC, EV_COLS)}) a
JOIN ({O.scd2_sql(_SEEN, 'user_id', O.EVENTS_ORDER_ASC, EV_COLS)}) b
  ON a.user_id = b.user_id AND (b.__END_AT IS NULL OR a.__START_AT < b.__END_AT) AND (a.__END_AT IS NULL OR b.__START_AT < a.__END_AT)
""")
def scd2_join_scd2(spark, sf_dir):
    """Two histories of the same users (purchases; everything else), both
    ended by errors, joined on the spans in which both are valid."""
    ct = feeds.feed_events(spark, sf_dir)
    spec = feeds.EVENTS_SPEC
    bought = merge.scd2(standardize(ct.filter(F.col("event_type").isin("purchase", "error")), spec), spec)
    seen = merge.scd2(standardize(ct.filter(F.col("event_type") != "purchase"), spec), spec)
    span = ["user_id", "__START_AT", "__END_AT"]
    return joins.scd2_join(bought.select(*span, F.col("value").alias("bought_value")),
                           seen.select(*span, F.col("event_type").alias("seen_type"), F.col("value").alias("seen_value")), ["user_id"])
