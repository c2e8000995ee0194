"""File layout: clustering on several columns along a space-filling curve, and
compaction of small files only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import fs
from .sizing import checked_broadcast, size_of
from .windows import with_neighbors

TARGET_FILE_BYTES = 128 << 20


def curve_code(df: DataFrame, cols: list[str], bits: int = 4, accuracy: int = 1000) -> Column:
    """Place of a row on a curve that interleaves the bits of its columns'
    rank codes (K-CLUSTER on several columns).  A column's code is the number
    of its ``2^bits - 1`` approximate quantiles below the value, so it does
    not depend on the type or the spread; NULLs come first."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in cols]).first()
    code = F.lit(0)
    for i, c in enumerate(cols):
        value, inner = F.col(c), F.array(*[F.lit(v) for v in cuts[c] or []])
        rank = F.when(value.isNull(), 0).otherwise(F.size(F.filter(inner, lambda cut: cut < value))) if cuts[c] else F.lit(0)
        for b in range(bits):
            code = code + F.shiftleft(F.shiftright(rank, b).bitwiseAND(1), b * len(cols) + i)
    return code


def curve_clustered(df: DataFrame, cols: list[str], target_bytes: int = TARGET_FILE_BYTES, n_rows: int | None = None, bits: int = 4) -> DataFrame:
    """``df`` in ranges of the curve, as many as its estimated bytes ask for:
    a filter on any of ``cols`` meets the min/max range of few files."""
    n = max(1, math.ceil(size_of(df, n_rows if n_rows is not None else df.count()) / target_bytes))
    order = [F.col("_curve"), *[F.col(c) for c in cols]]
    return df.withColumn("_curve", curve_code(df, cols, bits)).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_curve")


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """Files of a Parquet folder with their rows and bytes (K-COMPACT input)."""
    df = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
    return df.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"), F.first("file_size").alias("bytes"))


def _finish(spark: SparkSession, path: str) -> bool:
    """Move a complete result in and delete the files that it replaces."""
    staged = f"{path}/_compaction"
    if not fs.exists(spark, f"{staged}/files/_SUCCESS"):
        fs.delete(spark, staged)
        return False
    for folder in fs.list_names(spark, f"{staged}/data"):
        for name in fs.list_names(spark, f"{staged}/data/{folder}") if folder.startswith("_bin=") else []:
            if name.endswith(".parquet"):
                # a task's files have one name in all bins
                fs.move(spark, f"{staged}/data/{folder}/{name}", f"{path}/{folder[1:].replace('=', '')}-{name}")
    for r in spark.read.parquet(f"{staged}/files").select("file_path").toLocalIterator():
        fs.delete(spark, r["file_path"], False)
    fs.delete(spark, staged)
    return True


def compact_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int | None = None,
                        cluster_by: list[str] | None = None) -> int:
    """Merge the files below ``small_bytes`` (default: half the target) of a
    Parquet folder into files of about ``target_bytes``; larger files are
    neither read nor moved (K-COMPACT).  Returns the number of files made.

    Files are packed in the order of their paths by running size, one bin per
    output file.  The result is staged with the list of the files it replaces
    before anything is moved, so a run that dies is finished by the next one;
    until then readers may see rows of both.
    """
    path = path.rstrip("/")
    _finish(spark, path)
    small = F.col("_metadata.file_size") < F.lit(small_bytes or target_bytes // 2)
    listed = spark.read.parquet(path).filter(small).select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.first("file_size").alias("bytes"))
    run = with_neighbors(listed, [], [F.col("file_path")], cumsum={"_sum": "bytes"}).drop("_has_next", "_has_prev")
    bins = run.select("file_path", F.floor((F.col("_sum") - F.col("bytes")) / target_bytes).cast("int").alias("_bin"))
    found = bins.agg(F.count(F.lit(1)).alias("files"), F.max("_bin").alias("last")).first()
    if not found["files"] or found["files"] <= found["last"] + 1:
        return 0
    rows = spark.read.parquet(path).filter(small).withColumn("_file", F.col("_metadata.file_path"))
    data = rows.join(checked_broadcast(bins.withColumnRenamed("file_path", "_file"), found["files"]), "_file").drop("_file")
    (data.repartition(found["last"] + 1, "_bin").sortWithinPartitions("_bin", *(cluster_by or []))
         .write.mode("overwrite").partitionBy("_bin").parquet(f"{path}/_compaction/data"))
    bins.write.mode("overwrite").parquet(f"{path}/_compaction/files")
    _finish(spark, path)
    return found["last"] + 1
