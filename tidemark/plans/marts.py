"""Gold marts over the merged tables, incremental refresh, change push,
cost attribution and file compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import checked_broadcast
from ..session import materialise
from ..streaming import fs
from .build import clustered


def daily_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Daily sales at the grain (order day, priority): orders, lines,
    quantity, revenue.  Lines are pre-aggregated per order before the join,
    so the join is one row per order on each side."""
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("l_quantity").alias("_qty"), F.sum("l_extendedprice").alias("_rev"))
    j = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner")
    return j.groupBy(F.to_date("o_orderdate").alias("order_day"), "o_orderpriority").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"), F.sum("_lines").cast("bigint").alias("n_lines"),
        F.round(F.sum("_qty"), 2).alias("total_quantity"), F.round(F.sum("_rev"), 2).alias("revenue"))


def customer_360(customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame,
                 events: DataFrame) -> DataFrame:
    """One row per customer: profile, geography, order and event activity.
    Activity is aggregated per customer first (partial aggregates)."""
    o = orders.groupBy(F.col("o_custkey").alias("customer_key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spend"),
        F.min("o_orderdate").alias("first_order_date"), F.max("o_orderdate").alias("last_order_date"))
    e = events.groupBy(F.col("user_id").alias("customer_key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_events"), F.max_by("event_type", "event_id").alias("last_event_type"),
        F.round(F.sum("value"), 2).alias("total_event_value"))
    geo = (nation.join(checked_broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
           .select("n_nationkey", F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name")))
    c = customer.select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
                        F.col("c_mktsegment").alias("market_segment"), "c_nationkey")
    c = c.join(checked_broadcast(geo), c.c_nationkey == geo.n_nationkey, "left").drop("c_nationkey", "n_nationkey")
    return c.join(o, "customer_key", "left").join(e, "customer_key", "left")


def daily_order_totals(orders: DataFrame) -> DataFrame:
    """Orders per day; ``order_month`` is the storage partition."""
    g = orders.groupBy(F.to_date("o_orderdate").alias("order_day")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))
    return g.withColumn("order_month", F.date_trunc("month", "order_day").cast("date"))


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite", overwrite: str = "static") -> None:
    """Rebalance on the partition column before writing, so each partition
    folder gets few files instead of one per task (AQE splits a skewed
    partition value and coalesces small ones).  ``overwrite='dynamic'``
    replaces only the partitions that ``df`` has; it is an option of this
    write, not of the session."""
    (df.hint("rebalance", partition_col).write.mode(mode).option("partitionOverwriteMode", overwrite)
       .partitionBy(partition_col).parquet(path))


def refresh_partitions(spark: SparkSession, mart_path: str, base: DataFrame, changed: DataFrame,
                       partition_col: str, build, partition_of: Column) -> None:
    """Recompute only the mart partitions touched by ``changed`` (A-INCR).

    ``partition_of`` gives a base row's partition, so the base is cut to the
    touched partitions before the mart is built from it, once.  Rebuilt
    partitions are overwritten; a touched partition that no row is left for is
    deleted.
    """
    touched = materialise(changed.select(partition_col).distinct(), "touched")
    part = base.withColumn(partition_col, partition_of).join(touched, partition_col, "left_semi").drop(partition_col)
    built = materialise(build(part), "rebuilt")
    write_partitioned(built, mart_path, partition_col, overwrite="dynamic")
    left = built.select(partition_col).distinct()
    # folder names of touched partitions, as many as the change has partitions
    for r in touched.join(left, partition_col, "left_anti").select(F.col(partition_col).cast("string")).collect():
        fs.delete(spark, f"{mart_path}/{partition_col}={r[0]}")


def push_changes(spark: SparkSession, changes_path: str, sink_path: str, checkpoint: str) -> None:
    """Push landed change rows to a sink folder (T-PUSH), one sub-folder per
    micro-batch.  A replayed micro-batch overwrites its own folder, so every
    change arrives exactly once."""
    schema = spark.read.parquet(changes_path).schema
    q = (spark.readStream.schema(schema).parquet(changes_path).writeStream.foreachBatch(push_batch(sink_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def push_batch(sink_path: str):
    """The ``foreachBatch`` function of :func:`push_changes`."""
    def send(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/push={batch_id}")
    return send


def usage_cost(usage: DataFrame, prices: DataFrame, n_prices: int, key: str, ts: str, qty: str) -> DataFrame:
    """Usage priced by the price valid at its time (J-COST): equi-join on the
    priced item and a validity range; the price list is a bounded table
    (``n_prices`` rows), broadcast behind the size check."""
    p = checked_broadcast(prices, n_prices)
    j = usage.join(p, (usage[key] == p["item"]) & (usage[ts] >= p["valid_from"]) & (usage[ts] < p["valid_to"]), "left")
    return j.withColumn("cost", F.col(qty) * F.col("unit_price")).drop("item", "valid_from", "valid_to")


def cost_outliers(daily: DataFrame, group_col: str, day_col: str, cost_col: str, lookback: int = 7,
                  z: float = 2.0) -> DataFrame:
    """Spend trend per group: average and deviation of the previous
    ``lookback`` days, day-on-day change, and a jump flag."""
    w = Window.partitionBy(group_col).orderBy(day_col)
    prev = w.rowsBetween(-lookback, -1)
    avg = F.avg(cost_col).over(prev)
    sd = F.stddev(cost_col).over(prev)
    return daily.select(
        group_col, day_col, cost_col,
        F.round(avg, 6).alias("avg_prev"), F.round(sd, 6).alias("stddev_prev"),
        F.round(F.col(cost_col) - F.lag(cost_col).over(w), 5).alias("dod_change"),
        F.coalesce(F.col(cost_col) > avg + F.lit(z) * sd, F.lit(False)).alias("is_jump"))


def compact(spark: SparkSession, src: str, dst: str, cluster_by: list[str], target_rows_per_file: int,
            n_parts: int | None = None) -> None:
    """Rewrite a folder of small files as fewer, clustered files."""
    df = spark.read.parquet(src)
    (clustered(df, cluster_by, n_parts).write.mode("overwrite")
        .option("maxRecordsPerFile", target_rows_per_file).parquet(dst))
