"""Append-only targets from file streams.

Every landed row is kept (duplicates included) with its lineage.  Each flow
writes its own file-sink folder with its own checkpoint: two file sinks on
one path share one commit log and silently lose rows, so the target is the
union of the per-flow folders, each read through its sink log (committed
files only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import SchemaStore, stream_landed
from . import fs
from .flows import Flow


class AppendTarget:
    def __init__(self, spark: SparkSession, root: str, cluster_by: tuple[str, ...] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cluster_by = tuple(cluster_by)

    def sink_path(self, flow: str) -> str:
        return f"{self.root}/data/src={flow}"

    def run(self, flow: Flow, timeout_s: int | None = None):
        spark = self.spark
        store = SchemaStore(spark, f"{self.root}/_schemas/{flow.name}")
        schema, _ = store.resolve(flow.path, flow.file_format)
        df = stream_landed(spark, flow.path, schema, flow.file_format, source_kind=flow.name,
                           max_files_per_trigger=flow.max_files_per_trigger)
        if self.cluster_by:
            df = df.sortWithinPartitions(*self.cluster_by)
        q = (df.writeStream.format("parquet").outputMode("append")
             .option("path", self.sink_path(flow.name))
             .option("checkpointLocation", f"{self.root}/_checkpoints/{flow.name}")
             .trigger(availableNow=True).start())
        q.awaitTermination(*([] if timeout_s is None else [timeout_s]))
        if q.isActive:
            q.stop()
            raise TimeoutError(f"append flow {flow.name} did not finish")
        if q.exception() is not None:
            raise q.exception()
        return q

    def read(self) -> DataFrame:
        parts = []
        for name in fs.list_names(self.spark, f"{self.root}/data"):
            if name.startswith("src="):
                parts.append(self.spark.read.parquet(f"{self.root}/data/{name}"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out
