"""Reports over the datasets of a group, resolved from the control tables:
reconciliation (R-RECON) and latency (R-LATENCY), appended to report tables
(K-REPORT).

The loop over datasets runs on the driver (a bounded list of configuration
rows) and only plans; one plan computes all datasets of a report.  A dataset
that cannot be planned becomes an ERROR row, and the others are still there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import active_rows, current_versions
from . import config as C
from .reports import LATENCY_SCHEMA, _short, _union, latency_rows, latency_summary

# Layout of the reconciliation report table.
RECON_ROW = T.StructType([
    T.StructField("dataset_id", T.StringType()), T.StructField("source_id", T.StringType()),
    T.StructField("table_group_no", T.IntegerType()), T.StructField("source_schema", T.StringType()),
    T.StructField("source_table", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("source_count", T.LongType()), T.StructField("target_count", T.LongType()),
    T.StructField("diff", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()), T.StructField("event_ts", T.TimestampType())])


def datasets_of(meta: dict, source: str, group="ALL", dataset_list="ALL") -> list[Row]:
    """Resolved rows of the enabled datasets of one group, or of every group."""
    return C.resolve(meta, C.select_datasets(meta, source, group, dataset_list)).orderBy("table_group_no", "dataset_id").collect()


def state_target(row: Row) -> tuple[str, str]:
    """('scd1' | 'scd2', its table): where a dataset's latest state is."""
    return ("scd1", row["scd1_target"]) if row["scd1_target"] else ("scd2", row["scd2_target"])


def append_report(df: DataFrame, path: str | None, schema: T.StructType) -> DataFrame:
    """Stamp the rows with one report time, append them, and return them."""
    now = df.sparkSession.range(1).select(F.current_timestamp()).first()[0]
    out = df.withColumn("event_ts", F.lit(now)).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    if path:
        out.write.mode("append").parquet(path)
    return out


def recon_group(spark: SparkSession, meta: dict, source: str, group="ALL", dataset_list="ALL", *,
                source_rows: Callable[[Row], DataFrame], target_rows: Callable[[Row, str], DataFrame],
                report_path: str | None = None) -> DataFrame:
    """Compare the rows of each dataset's source with its target's latest state.

    The target is the latest-state table, or for a history-only dataset its
    open versions; soft-deleted rows do not count.  ``source_rows(row)`` and
    ``target_rows(row, kind)`` give the frames of a resolved dataset row.
    """
    counts, failed = [], []
    for row in datasets_of(meta, source, group, dataset_list):
        kind, table = state_target(row)
        about = [F.lit(row[c]).alias(c) for c in ("dataset_id", "source_id", "table_group_no", "source_schema", "source_table")]
        about.append(F.lit(table).alias("target_table"))
        try:
            rows = target_rows(row, kind)
            rows = active_rows(current_versions(rows) if kind == "scd2" else rows, row["is_deleted_col"])
            n = source_rows(row).agg(F.count(F.lit(1)).alias("source_count"))
            counts.append(n.withColumn("target_count", rows.agg(F.count(F.lit(1))).scalar()).select(*about, "source_count", "target_count"))
        except Exception as e:  # noqa: BLE001 - reported as a row
            failed.append((*[row[c] for c in ("dataset_id", "source_id", "table_group_no", "source_schema", "source_table")], table, _short(e)))
    parts = []
    if counts:
        diff = F.col("source_count") - F.col("target_count")
        parts.append(_union(counts).withColumns({"diff": diff, "status": F.when(diff == 0, "OK").otherwise("MISMATCH"), "message": F.lit(None).cast("string")}))
    if failed:
        bad = spark.createDataFrame(failed, "dataset_id string, source_id string, table_group_no int, source_schema string, source_table string, target_table string, message string")
        none = F.lit(None).cast("bigint")
        parts.append(bad.withColumns({"source_count": none, "target_count": none, "diff": none, "status": F.lit("ERROR")}))
    return append_report(_union(parts) if parts else spark.createDataFrame([], RECON_ROW), report_path, RECON_ROW)


def latency_group(spark: SparkSession, meta: dict, source: str, group="ALL", dataset_list="ALL", *,
                  changes: Callable[[Row, str], DataFrame], commit_col: str = "header__change_ts", from_version: int = 0,
                  report_path: str | None = None) -> DataFrame:
    """Source-commit to target-commit latency of each dataset's arrivals since
    commit ``from_version``.  ``changes(row, kind)`` is the target's change
    feed; one without ``commit_col`` gives an ERROR row, one without arrivals
    NULL percentiles and a count of 0."""
    parts, failed = [], []
    for row in datasets_of(meta, source, group, dataset_list):
        kind, table = state_target(row)
        try:
            feed = changes(row, kind)
            if commit_col not in feed.columns:
                failed.append((row["dataset_id"], table, f"the change feed has no column {commit_col}"))
                continue
            arrived = latency_rows(feed.filter(F.col("_commit_version") >= from_version), commit_col).select("latency_sec")
            parts.append(arrived.select(F.lit(row["dataset_id"]).alias("dataset_id"), F.lit(table).alias("target_table"), "latency_sec"))
            parts.append(spark.range(1).select(F.lit(row["dataset_id"]).alias("dataset_id"), F.lit(table).alias("target_table"), F.lit(None).cast("double").alias("latency_sec")))
        except Exception as e:  # noqa: BLE001 - reported as a row
            failed.append((row["dataset_id"], table, _short(e)))
    out = []
    if parts:
        rows = _union([p.withColumn("latency_sec", F.col("latency_sec").cast("double")) for p in parts])
        by = ["dataset_id", "target_table"]
        known = rows.select(*by).distinct()
        stats = latency_summary(rows.filter(F.col("latency_sec").isNotNull()), by)
        out.append(known.join(stats, by, "left").withColumns({"record_count": F.coalesce("record_count", F.lit(0)), "status": F.lit("OK"), "message": F.lit(None).cast("string")}))
    if failed:
        none = F.lit(None).cast("double")
        out.append(spark.createDataFrame(failed, "dataset_id string, target_table string, message string").withColumns(
            {"p50_sec": none, "p95_sec": none, "max_sec": none, "record_count": F.lit(0).cast("bigint"), "status": F.lit("ERROR")}))
    return append_report(_union(out) if out else spark.createDataFrame([], LATENCY_SCHEMA), report_path, LATENCY_SCHEMA)
