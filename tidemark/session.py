"""Session and shared-folder helpers.

Everything that must survive a lost executor (incremental logs, manifests,
streaming checkpoints, lineage cuts) lives under the folder the cluster names
in ``spark.checkpoint.dir``.  Only when that setting is absent (local runs,
tests) do we create a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tidemark", cpus: int | str = "*", shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Local session with the settings the library expects (UTC, AQE on)."""
    parts = shuffle_partitions or (os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for durable intermediate state.

    Reads ``spark.checkpoint.dir`` (or a checkpoint dir already set on the
    context).  Only a local master gets a private scratch folder when neither
    exists; on a cluster such a folder would be invisible to the executors,
    so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root (never reused)."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again: later uses
    see the same rows, and a lost executor costs a re-read."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
