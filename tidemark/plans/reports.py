"""Operational reports: reconciliation, change feed, latency, SLA, lag, run log.

All report rows carry explicit schemas (a column that is NULL in every row
must still have a type), and are produced by one distributed plan per report
rather than one job per dataset.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import active_rows

RECON_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType()), T.StructField("source_count", T.LongType()),
    T.StructField("target_count", T.LongType()), T.StructField("diff", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType())])

LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("source_id", T.StringType()),
    T.StructField("table_group_no", T.IntegerType()), T.StructField("dataset_id", T.StringType()),
    T.StructField("target_table", T.StringType()), T.StructField("phase", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("event_ts", T.TimestampType())])

LATENCY_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("p50_sec", T.DoubleType()), T.StructField("p95_sec", T.DoubleType()),
    T.StructField("max_sec", T.DoubleType()), T.StructField("record_count", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("event_ts", T.TimestampType())])


# -- reconciliation -----------------------------------------------------------

def keyed_count(dataset_id: str, df: DataFrame, active_flag: str | None = None, name: str = "n") -> DataFrame:
    """One row (dataset_id, n): the count of ``df`` (active rows only when
    ``active_flag`` names a soft-delete column that exists)."""
    if active_flag:
        df = active_rows(df, active_flag)
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(name)).select(F.lit(dataset_id).alias("dataset_id"), name)


def jdbc_count(spark: SparkSession, url: str, properties: dict, schema: str, table: str) -> DataFrame:
    """Row count of a database table, for ``recon`` on a real deployment.
    The aggregate is pushed into the source, so one row comes back."""
    rows = spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", f"{schema}.{table}").option(
        "pushDownAggregate", "true").load()
    return rows.agg(F.count(F.lit(1)).alias("CNT"))


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def recon(spark: SparkSession, pairs: list[tuple[str, callable, callable]],
          is_deleted_col: str = "is_deleted") -> DataFrame:
    """Reconcile source and target counts per dataset in one plan.

    ``pairs`` holds ``(dataset_id, source_fn, target_fn)``; each function
    returns a DataFrame (the source's rows, the target table).  A dataset whose
    source or target cannot be planned becomes an ERROR row with the message.
    """
    src, tgt, errors = [], [], []
    for dataset_id, source_fn, target_fn in pairs:
        try:
            s = keyed_count(dataset_id, source_fn(), name="source_count")
            t = keyed_count(dataset_id, target_fn(), is_deleted_col, name="target_count")
            src.append(s)
            tgt.append(t)
        except Exception as e:  # noqa: BLE001 - reported as a row
            errors.append((dataset_id, None, None, None, "ERROR", _short(e)))
    parts = []
    if src:
        j = _union(src).join(_union(tgt), "dataset_id", "full_outer")
        diff = F.col("source_count") - F.col("target_count")
        parts.append(j.select(
            "dataset_id", "source_count", "target_count", diff.alias("diff"),
            F.when(diff == 0, F.lit("OK")).otherwise(F.lit("MISMATCH")).alias("status"),
            F.lit(None).cast("string").alias("message")))
    if errors:
        parts.append(spark.createDataFrame(errors, RECON_SCHEMA))
    return _union(parts) if parts else spark.createDataFrame([], RECON_SCHEMA)


def _short(e: Exception) -> str:
    """The error condition when Spark names one, else the whole message."""
    cond = getattr(e, "getCondition", None)
    if callable(cond) and cond():
        return cond()
    return str(e).strip() or type(e).__name__


# -- change feed --------------------------------------------------------------

def change_feed(before: DataFrame, after: DataFrame, keys: list[str], version: int,
                commit_ts=None) -> DataFrame:
    """Row changes between two snapshots of a keyed target.

    insert (key only after), delete (only before), update_preimage and
    update_postimage (both, any value differs, NULL-safe).  One full outer
    join on the key; both sides hold one row per key.
    """
    keys = list(keys)
    payload = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*[F.col(c) for c in payload]).alias("_b"))
    a = after.select(*keys, F.struct(*[F.col(c) for c in payload]).alias("_a"))
    return change_rows(b.join(a, keys, "full_outer"), keys, payload, version, commit_ts)


def change_rows(pairs: DataFrame, keys: list[str], payload: list[str], version: int, commit_ts=None) -> DataFrame:
    """Row changes from pairs of a key's payload before (``_b``) and after
    (``_a``), either NULL where there is no row."""
    j = pairs.filter(~F.col("_b").eqNullSafe(F.col("_a")))

    def ch(t, v):
        return F.struct(F.lit(t).alias("t"), v.alias("v"))
    changes = (F.when(F.col("_b").isNull(), F.array(ch("insert", F.col("_a"))))
               .when(F.col("_a").isNull(), F.array(ch("delete", F.col("_b"))))
               .otherwise(F.array(ch("update_preimage", F.col("_b")), ch("update_postimage", F.col("_a")))))
    out = j.select(*keys, F.explode(changes).alias("_c"))
    cols = [*[F.col(k) for k in keys], *[F.col("_c.v").getField(c).alias(c) for c in payload],
            F.col("_c.t").alias("_change_type"), F.lit(version).cast("bigint").alias("_commit_version")]
    if commit_ts is not None:
        ts = commit_ts if hasattr(commit_ts, "_jc") else F.lit(commit_ts)
        cols.append(ts.cast("timestamp_ntz").alias("_commit_timestamp"))
    return out.select(*cols)


def latency_rows(cdf: DataFrame, source_commit_col: str, target_commit_col: str = "_commit_timestamp") -> DataFrame:
    """Per-record latency from a change feed: inserts and post-images only
    (pre-images and deletes are not arrivals), NULL latencies dropped."""
    arrivals = cdf.filter(F.col("_change_type").isin("insert", "update_postimage"))
    us = (F.unix_micros(F.col(target_commit_col).cast("timestamp"))
          - F.unix_micros(F.col(source_commit_col).cast("timestamp")))
    return arrivals.withColumn("latency_sec", F.round(us / F.lit(1e6), 3)).filter(F.col("latency_sec").isNotNull())


# -- quantiles ----------------------------------------------------------------

def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str, qs: dict[str, float]) -> DataFrame:
    """Exact continuous quantiles (linear interpolation) per group.

    The values are first reduced to a (group, value, count) histogram by a
    partial aggregate, so a group with a third of all rows is combined
    map-side.  The running count over the sorted distinct values comes from
    ``with_neighbors`` (a group with very many distinct values is chunked),
    and the group totals from a plain aggregate.
    """
    from ..operators.windows import with_neighbors

    g = list(group_cols)
    hist = df.filter(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_c"))
    cum = with_neighbors(hist, g, [F.col(value_col)], cumsum={"_cum": "_c"}).drop("_has_next", "_has_prev")
    if g:
        hist = cum.join(hist.groupBy(*g).agg(F.sum("_c").alias("_n")), g, "inner")
    else:  # one global total, as a scalar subquery
        hist = cum.withColumn("_n", hist.agg(F.sum("_c")).scalar())
    aggs = [F.max("_n").alias("n"), F.max(value_col).alias("_max")]
    for name, q in qs.items():
        h = (F.col("_n") - 1) * F.lit(q)
        lo, hi = F.floor(h), F.ceil(h)
        aggs.append(F.min(F.when(F.col("_cum") > lo, F.col(value_col))).alias(f"_{name}_lo"))
        aggs.append(F.min(F.when(F.col("_cum") > hi, F.col(value_col))).alias(f"_{name}_hi"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_{name}_f"))
    agg = hist.groupBy(*g).agg(*aggs)
    out = [F.col(c) for c in g] + [F.col("n"), F.col("_max").alias(f"max_{value_col}")]
    for name in qs:
        lo, hi, f = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_f")
        out.append((lo + (hi - lo) * f).cast("double").alias(name))
    return agg.select(*out)


def latency_summary(lat: DataFrame, group_cols: list[str], value_col: str = "latency_sec",
                    method: str = "exact", digits: int = 3) -> DataFrame:
    """n, p50, p95, max per group.  ``exact`` interpolates like
    ``quantile_cont``; ``approx`` uses the ``percentile_approx`` sketch
    (bounded memory whatever the number of distinct values)."""
    g = list(group_cols)
    if method == "exact":
        # one pass: the histogram also gives the maximum
        s = (exact_quantiles(lat, g, value_col, {"p50_sec": 0.5, "p95_sec": 0.95})
             .withColumn("max_sec", F.col(f"max_{value_col}").cast("double")))
    else:
        s = lat.groupBy(*g).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(value_col, 0.5).cast("double").alias("p50_sec"),
            F.percentile_approx(value_col, 0.95).cast("double").alias("p95_sec"),
            F.max(value_col).cast("double").alias("max_sec"))
    return s.select(*g, F.round("p50_sec", digits).alias("p50_sec"), F.round("p95_sec", digits).alias("p95_sec"),
                    F.round("max_sec", digits).alias("max_sec"), F.col("n").cast("bigint").alias("record_count"))


#: Size parameter of the latency sketches, and the rank error that it keeps
#: with 99 % confidence (two-sided, from the sketch's documentation).
SKETCH_K, SKETCH_RANK_ERROR = 200, 0.0166


def latency_sketches(lat: DataFrame, group_cols: list[str], value_col: str = "latency_sec") -> DataFrame:
    """One mergeable row per group: count, maximum and a KLL quantile sketch.
    Kept per commit, it stands for that commit's rows in every later report."""
    v = F.col(value_col).cast("double")
    return lat.filter(v.isNotNull()).groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), F.max(v).alias("max_sec"),
                                                              F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("sketch"))


def latency_from_sketches(sketches: DataFrame, group_cols: list[str]) -> DataFrame:
    """The latency summary of any union of kept sketches, without the rows."""
    merged = sketches.groupBy(*group_cols).agg(F.sum("n").alias("record_count"), F.max("max_sec").alias("max_sec"),
                                               F.kll_merge_agg_double("sketch").alias("_s"))
    return merged.select(*group_cols, F.kll_sketch_get_quantile_double("_s", F.lit(0.5)).alias("p50_sec"),
                         F.kll_sketch_get_quantile_double("_s", F.lit(0.95)).alias("p95_sec"), "max_sec", "record_count")


def sla_share(lat: DataFrame, group_cols: list[str], threshold_sec: float, value_col: str = "latency_sec") -> DataFrame:
    """Share of records within the SLA, per group (R-SLA)."""
    return lat.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("record_count"),
        F.count_if(F.col(value_col) <= F.lit(threshold_sec)).cast("bigint").alias("within_sla"),
        F.round(F.count_if(F.col(value_col) <= F.lit(threshold_sec)) / F.count(F.lit(1)), 6).alias("sla_share"))


# -- run log ------------------------------------------------------------------

class RunLog:
    """Buffers log rows of one run on the driver (a few rows per dataset)
    and writes them once, with an explicit schema.  A log folder that cannot
    be written is reported, not raised."""

    def __init__(self, spark: SparkSession, run_id: str, source_id: str, table_group_no: int | None):
        self.spark = spark
        self.run_id = run_id
        self.source_id = source_id
        self.group = int(table_group_no) if table_group_no is not None else None
        self.rows: list[tuple] = []

    def log(self, phase: str, status: str = "INFO", dataset_id: str | None = None,
            target_table: str | None = None, message: str | None = None) -> None:
        self.rows.append((self.run_id, self.source_id, self.group, dataset_id, target_table, phase, status,
                          message, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, LOG_SCHEMA)

    def flush(self, path: str | None) -> DataFrame:
        df = self.frame()
        if path:
            try:
                df.write.mode("append").parquet(path)
            except Exception as e:  # noqa: BLE001 - a log that cannot be written must not fail the run
                logging.getLogger(__name__).error("run log not written to %s: %s", path, _short(e))
        return df
