"""Batch build of one dataset's targets, a full reload, and the group run.

``build_targets`` is the batch twin of the incremental merge: standardise
and fold once (one shuffle, persisted while both targets are written), and
write every target of the spec from it: SCD1 and SCD2 for ``cdc``, the rows
themselves for ``append``; targets with ``cluster_by`` are range-partitioned
and sorted on those columns so readers prune files by min/max.
"""

from __future__ import annotations

import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge
from ..sources.files import read_landed
from ..spec import TableSpec
from ..streaming import fs


def clustered(df: DataFrame, cluster_by: tuple[str, ...] | list[str], n_parts: int | None = None) -> DataFrame:
    """Lay rows out by ``cluster_by`` ranges (K-CLUSTER).  Without
    ``n_parts`` adaptive execution merges neighbouring ranges up to its
    advisory bytes, so the number of files follows the data."""
    if not cluster_by:
        return df
    cols = [F.col(c) for c in cluster_by]
    ranged = df.repartitionByRange(n_parts, *cols) if n_parts else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def build_targets(raw: DataFrame, spec: TableSpec, out_root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write the targets of one dataset; returns {target name: path}.

    With ``overwrite`` a target is written aside and replaces the live one
    when it is complete: a run that fails leaves the live target as it was."""
    out_root = out_root.rstrip("/")
    spark, paths = raw.sparkSession, {}

    def put(df: DataFrame, name: str) -> str:
        path = f"{out_root}/{name}"
        if mode != "overwrite":
            clustered(df, spec.cluster_by).write.mode(mode).parquet(path)
            return path
        staged = f"{out_root}/_building/{name}-{uuid.uuid4().hex[:8]}"
        clustered(df, spec.cluster_by).write.parquet(staged)
        fs.replace(spark, staged, path)
        return path

    if spec.merge_mode == "append":
        return {"append": put(raw, "append")}
    folded = merge.fold(standardize(raw, spec), spec)
    both = len(spec.scd_types) > 1
    if both:
        # one shuffle for both targets; recomputed from lineage if lost
        folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for scd, target in merge.targets_from_fold(folded, spec).items():
            paths[f"scd{scd}"] = put(target, f"scd{scd}")
    finally:
        if both:
            folded.unpersist()
    return paths


def full_reload(spark: SparkSession, spec: TableSpec, target_root: str, ct_path: str,
                full_path: str | None = None) -> dict[str, str]:
    """Full refresh from the landing (M-RELOAD): fold everything landed
    (snapshot then changes) into a new version folder and switch the
    ``CURRENT`` pointer to it; the previous version stays readable until the
    pointer moves, and an incremental checkpoint of the dataset is to be
    reset by the caller (it is not reused)."""
    raw = read_landed(spark, ct_path, spec.file_format, "ct")
    if full_path and spec.include_full_flow:
        raw = read_landed(spark, full_path, spec.file_format, "full").unionByName(raw, allowMissingColumns=True)
    version = uuid.uuid4().hex[:12]
    paths = build_targets(raw, spec, f"{target_root}/v={version}")
    fs.write_text(spark, f"{target_root}/CURRENT", json.dumps({"version": version, "paths": paths}))
    return paths


def current_paths(spark: SparkSession, target_root: str) -> dict[str, str]:
    return json.loads(fs.read_text(spark, f"{target_root}/CURRENT"))["paths"]
