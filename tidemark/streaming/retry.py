"""Quarantine-and-retry for lookup misses (a miss is "not yet", not invalid).

Each micro-batch: pending misses of the previous batch + the new rows are
looked up against the reference data as it is now; hits are written as
resolved, misses get one more attempt, and rows that used up
``max_attempts`` are written as expired.  Every batch writes its own
folders (a retried batch overwrites its own), and a small marker file
commits the batch; a batch already committed is skipped.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_split
from . import fs


class RetryQueue:
    def __init__(self, spark: SparkSession, root: str, reference: Callable[[int], DataFrame],
                 keys: list[str], ref_keys: list[str], ref_cols: list[str], max_attempts: int = 3):
        self.spark = spark
        self.root = root.rstrip("/")
        self.reference = reference
        self.keys, self.ref_keys, self.ref_cols = list(keys), list(ref_keys), list(ref_cols)
        self.max_attempts = max_attempts

    def _committed(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in fs.list_names(self.spark, f"{self.root}/_commits")
                      if n.endswith(".json"))

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        spark = self.spark
        done = self._committed()
        if batch_id in done:
            return False
        fresh = batch.withColumn("_attempts", F.lit(0)).withColumn("_first_batch", F.lit(int(batch_id)))
        cand = fresh
        if done:
            prev = spark.read.parquet(f"{self.root}/pending/b={done[-1]}")
            cand = prev.unionByName(fresh)
        cand = cand.withColumn("_attempts", F.col("_attempts") + 1)
        resolved, missed = lookup_split(cand, self.reference(batch_id), self.keys, self.ref_keys, self.ref_cols)
        b = F.lit(int(batch_id))
        resolved.withColumn("_batch", b).write.mode("overwrite").parquet(f"{self.root}/resolved/b={batch_id}")
        missed = missed.persist()
        (missed.filter(F.col("_attempts") >= self.max_attempts).withColumn("_batch", b)
            .write.mode("overwrite").parquet(f"{self.root}/expired/b={batch_id}"))
        (missed.filter(F.col("_attempts") < self.max_attempts)
            .write.mode("overwrite").parquet(f"{self.root}/pending/b={batch_id}"))
        missed.unpersist()
        fs.write_text(spark, f"{self.root}/_commits/{int(batch_id):012d}.json", json.dumps({"batch": int(batch_id)}))
        return True

    def foreach_batch(self):
        def _fn(df, batch_id):
            self.apply(df, batch_id)
        return _fn

    def outcome(self) -> DataFrame:
        """resolved and expired rows of all committed batches, plus the
        rows still pending after the last one."""
        spark = self.spark
        done = self._committed()
        if not done:
            raise ValueError("no committed batch")
        res = spark.read.parquet(*[f"{self.root}/resolved/b={b}" for b in done]).withColumn("status", F.lit("resolved"))
        exp = spark.read.parquet(*[f"{self.root}/expired/b={b}" for b in done]).withColumn("status", F.lit("expired"))
        pen = (spark.read.parquet(f"{self.root}/pending/b={done[-1]}")
               .withColumn("status", F.lit("pending")).withColumn("_batch", F.lit(done[-1])))
        return res.unionByName(exp, allowMissingColumns=True).unionByName(pen, allowMissingColumns=True)
