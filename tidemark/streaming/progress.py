"""What streams have applied, from their own progress events.

``ProgressLog`` is a ``StreamingQueryListener`` that stores one small record
per micro-batch; ``applied`` and ``lag`` read them back, so a lag report needs
neither the target nor a fold.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from . import fs

SCHEMA = ("flow string, query_id string, batch_id long, event_ts timestamp, input_rows long, end_offset string, batch_ms long, "
          "dropped_by_watermark long, state_rows long")


def flow_of(query_name: str | None) -> str:
    """Flows name their queries ``<flow>-<random>``."""
    return (query_name or "").rsplit("-", 1)[0]


class ProgressLog(StreamingQueryListener):
    """Stores the progress of every query of the session below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"flow": flow_of(p.name), "query_id": str(p.id), "batch_id": p.batchId, "event_ts": p.timestamp, "input_rows": p.numInputRows,
               "end_offset": json.dumps([s.endOffset for s in p.sources]), "batch_ms": p.batchDuration,
               "dropped_by_watermark": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               "state_rows": sum(s.numRowsTotal for s in p.stateOperators)}
        fs.mkdirs(self.spark, self.path)
        # one record per batch: a batch that is reported again replaces its own
        fs.write_text(self.spark, f"{self.path}/{p.id}-{p.batchId:012d}.json", json.dumps(row))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def applied(progress: DataFrame) -> DataFrame:
    """Per flow: batches, rows and the time of the last batch with rows."""
    return progress.groupBy("flow").agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("applied_rows"),
                                        F.max(F.when(F.col("input_rows") > 0, F.col("event_ts"))).alias("applied_ts"))


def lag(progress: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed minus applied per flow; ``landed(flow, landed_rows)`` is counted
    from the landing's file metadata or by the extractor."""
    done = applied(progress)
    return landed.join(done, "flow", "left").select("flow", "landed_rows", F.coalesce("applied_rows", F.lit(0).cast("long")).alias("applied_rows"),
                                                    (F.col("landed_rows") - F.coalesce("applied_rows", F.lit(0))).alias("lag_rows"), "applied_ts")
