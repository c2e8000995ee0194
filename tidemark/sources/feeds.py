"""Deterministic change feeds derived from the given tables.

The reference lands hand-written scenarios; we land feeds that Spark derives
from the test tables so that every query's work grows with the data.  Each
feed is a landed ``__ct`` (business columns + change header) or ``__full``
(business columns only) DataFrame, plus the spec that describes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import DEFAULT_OP_COL as OP, DEFAULT_SEQ_COL as SEQ, TableSpec
from .tables import table

CHANGE_TS = "header__change_ts"

EVENTS_SPEC = TableSpec(name="events_cdc", keys=("user_id",), scd_types=(1, 2), seq_type="bigint")
LINEITEM_SPEC = TableSpec(name="lineitem_cdc", keys=("l_orderkey", "l_linenumber"), scd_types=(1, 2),
                          seq_type="timestamp_ntz")
ORDERS_SPEC = TableSpec(name="orders_cdc", keys=("o_custkey",), scd_types=(1,), seq_type="bigint")
# The seed is ordered below every change event: event ids start at 0.
CUSTOMER_SEED_SEQ = -1


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change table: key user_id, sequence event_id.

    error -> D, signup -> I, anything else -> U; the event time is carried as
    the source commit time.
    """
    ev = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "error", F.lit("D"))
          .when(F.col("event_type") == "signup", F.lit("I"))
          .otherwise(F.lit("U")))
    return ev.select(
        "user_id", "event_type", "value",
        op.alias(OP), F.col("event_id").alias(SEQ), F.col("ts").alias(CHANGE_TS),
    )


def feed_events_evolved(spark: SparkSession, sf_dir: str, split_event_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The events feed in two halves; the second half gains ``props``."""
    ev = table(spark, sf_dir, "events")
    base = feed_events(spark, sf_dir)
    if split_event_id is None:
        # first id of the second half, as a scalar subquery (no driver round trip)
        split_event_id = ev.agg((F.floor(F.max("event_id") / 2) + 1).cast("bigint")).scalar()
    else:
        split_event_id = F.lit(split_event_id)
    first = base.filter(F.col(SEQ) < split_event_id)
    second = (base.join(ev.select(F.col("event_id").alias(SEQ), "props"), SEQ, "inner")
              .filter(F.col(SEQ) >= split_event_id)
              .select(*base.columns, "props"))
    return first, second


def feed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a change table: key (l_orderkey, l_linenumber), sequence
    l_shipdate (real ties), returnflag 'R' -> D."""
    li = table(spark, sf_dir, "lineitem")
    op = F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        op.alias(OP), F.col("l_shipdate").alias(SEQ),
    )


def feed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a change table: key o_custkey, sequence o_orderkey, status 'P' -> D."""
    o = table(spark, sf_dir, "orders")
    op = F.when(F.col("o_orderstatus") == "P", F.lit("D")).otherwise(F.lit("U"))
    return o.select(
        "o_custkey", "o_totalprice", "o_orderpriority",
        op.alias(OP), F.col("o_orderkey").alias(SEQ), F.col("o_orderdate").alias(CHANGE_TS),
    )


def seed_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as the ``__full`` snapshot of the events feed (no header)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.lit("seed").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )


def with_lineage(df: DataFrame, source: str, file_col: bool = True) -> DataFrame:
    """Lineage columns: source kind, landed file, ingest time."""
    out = df.withColumn("_ingest_source", F.lit(source))
    if file_col:
        out = out.withColumn("_ingest_file", F.lit(None).cast("string"))
    return out.withColumn("_ingest_ts", F.current_timestamp())


def full_and_ct(full: DataFrame, ct: DataFrame) -> DataFrame:
    """Raw table of a dataset = seed rows followed by change rows (batch form)."""
    return with_lineage(full, "full").unionByName(with_lineage(ct, "ct"), allowMissingColumns=True)


def events_with_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_and_ct(seed_customer(spark, sf_dir), feed_events(spark, sf_dir))


def permuted_event_files(spark: SparkSession, sf_dir: str, n_files: int = 4) -> list[DataFrame]:
    """The events feed split by a hash of its sequence into ``n_files`` parts,
    so that sequence order and arrival order disagree."""
    base = feed_events(spark, sf_dir)
    part = F.pmod(F.xxhash64(F.col(SEQ)), F.lit(n_files))
    return [base.filter(part == i) for i in range(n_files)]
