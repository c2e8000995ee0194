"""Incremental SCD merge over micro-batches, on Spark's own commit.

The target is one partitioned Parquet folder with a row per applied (key,
sequence): the event's payload, its operation (deletes stay as tombstones) and
its validity.  Both targets are views of it: SCD1 the open rows, SCD2 all
rows, without hard deletes.

* ``state/_part=open/_bucket=<b>/``  the newest row of every key, by
  ``pmod(xxhash64(keys), B)``;
* ``state/_part=<batch>/_bucket=-1/``  the rows that a batch closed or added
  behind a newer one.

A micro-batch reads the open rows of the buckets it touches and folds its
events with those of its keys.  Closed rows are read only for keys with an
event older than their open row, and of these only the *suffix*: versions that
end after the key's earliest new sequence.  What a batch without late events
reads therefore does not grow with the history.

Commit and replay are Spark's: ``foreachBatch`` with the query's checkpoint
delivers a batch again until it is done, the fold of a batch that was applied
already changes nothing (equal (key, sequence) events collapse to one winner),
and the result is written with a dynamic overwrite of the partitions it
holds.  That overwrite replaces partitions one by one, so a batch first writes
its whole result aside (``_staged``) and then publishes it; a run that finds a
complete staged result publishes that first.  One writer at a time: the flows
of a target run in turn.

The change rows of a batch come from the same fold of old and new rows
(``changes_scd<n>/_commit=<v>``) and can be read as a stream.
"""

from __future__ import annotations

import json
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import standardize, target_columns
from ..operators import merge
from ..operators.windows import DEFAULT_MAX_GROUP_ROWS
from ..spec import END_COL, START_COL, TableSpec
from . import fs

OPEN = "open"
CLOSED_BUCKET = -1
# Columns of the fold that are no payload.
HELPERS = ("_part", "_bucket", "_known", "_last_live", "_from", START_COL, END_COL)
CHANGE_COLS = ("_change_type", "_commit_version", "_commit_timestamp")


class IncrementalTarget:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int = 64,
                 max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.buckets = buckets
        self.max_group_rows = max_group_rows
        self.state_path = f"{self.root}/state"
        self.staged_path = f"{self.root}/_staged"
        self.quarantine_path = f"{self.root}/quarantine"
        self.rows_read: dict[str, int] = {}  # of the last batch, for tests and reports

    # -- schema and reading --------------------------------------------------
    def _schema_file(self) -> str:
        return f"{self.root}/_schema.json"

    def _schema(self) -> T.StructType | None:
        """The state's columns (without the partition columns)."""
        if not fs.exists(self.spark, self._schema_file()):
            return None
        return T.StructType.fromJson(json.loads(fs.read_text(self.spark, self._schema_file())))

    def _partitioned(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField("_part", T.StringType()), T.StructField("_bucket", T.IntegerType())])

    def state(self) -> DataFrame:
        """Every applied (key, sequence) with its validity, tombstones
        included.  Files without a later column read it as NULL."""
        schema = self._schema()
        if schema is None or not fs.exists(self.spark, self.state_path):
            raise ValueError("the target has no committed batch yet")
        return self.spark.read.schema(self._partitioned(schema)).parquet(self.state_path)

    def _view(self, rows: DataFrame, scd: int) -> DataFrame:
        """A target from state rows."""
        cols = [c for c in rows.columns if c not in (*HELPERS, "_op")]
        live = rows.filter(F.col("_op") != "D")
        if scd == 1:
            return live.filter(F.col("_part") == OPEN).select(*cols)
        return live.select(*cols, START_COL, END_COL)

    def read(self, scd: int) -> DataFrame:
        """The committed target; SCD1 reads the open partitions only."""
        return self._view(self.state(), scd)

    def read_quarantine(self) -> DataFrame:
        """Rows that cannot be merged (NULL key), with their reason."""
        if not fs.exists(self.spark, self.quarantine_path):
            return self.spark.createDataFrame([], "dq_reason string")
        return self.spark.read.option("mergeSchema", "true").parquet(self.quarantine_path).drop("_commit").withColumn("dq_reason", F.lit("null primary_key"))

    def changes_path(self, scd: int) -> str:
        return f"{self.root}/changes_scd{scd}"

    def _changes_schema(self, scd: int) -> T.StructType:
        fields = [f for f in self._schema().fields if f.name not in ("_op", *HELPERS)]
        ends = [T.StructField(c, self._schema()[c].dataType) for c in (START_COL, END_COL)] if scd == 2 else []
        return T.StructType([*fields, *ends, T.StructField("_change_type", T.StringType()), T.StructField("_commit_version", T.LongType()),
                             T.StructField("_commit_timestamp", T.TimestampNTZType())])

    def change_feed(self, scd: int, from_version: int = 0, to_version: int | None = None) -> DataFrame:
        """Row changes of a target, commit by commit (R-CDF): only the
        folders of the commits asked for are read."""
        path = self.changes_path(scd)
        if not fs.exists(self.spark, path):
            return self.spark.createDataFrame([], self._changes_schema(scd))
        out = self.spark.read.schema(T.StructType([*self._changes_schema(scd).fields, T.StructField("_commit", T.LongType())])).parquet(path)
        keep = F.col("_commit") > from_version
        return out.filter(keep if to_version is None else keep & (F.col("_commit") <= to_version)).drop("_commit")

    def stream_changes(self, scd: int) -> DataFrame:
        """The change rows as a stream, one commit's files at a time.  A
        commit's files appear at once and are never rewritten."""
        return (self.spark.readStream.schema(T.StructType([*self._changes_schema(scd).fields, T.StructField("_commit", T.LongType())]))
                .option("maxFilesPerTrigger", "64").parquet(self.changes_path(scd)).drop("_commit"))

    # -- the micro-batch ---------------------------------------------------
    def bucket_expr(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.keys]), F.lit(self.buckets)).cast("int")

    def _version(self) -> int:
        """The next commit's number: one above those with change rows."""
        known = [int(n.split("=")[1]) for scd in (1, 2) for n in fs.list_names(self.spark, self.changes_path(scd)) if n.startswith("_commit=")]
        return max(known, default=0) + 1

    def apply(self, batch: DataFrame, batch_id: int, flow: str = "ct") -> None:
        """Merge one micro-batch.  Applying it again changes nothing."""
        spark, spec = self.spark, self.spec
        self.recover()
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        tag, version = f"{flow}-{query[:8]}-{int(batch_id)}", self._version()
        staged = f"{self.staged_path}/{version}_{tag}"
        landed = standardize(batch, spec)
        # only what the target stores is kept; the lineage and header columns of unmergeable rows are read again
        std = landed.select(*target_columns(landed, spec), "_op", "_seq").persist(StorageLevel.MEMORY_AND_DISK)
        held = [std]
        try:
            key_ok = F.lit(True)
            for k in spec.keys:
                key_ok = key_ok & F.col(k).isNotNull()
            touched = (std.groupBy(*spec.keys).agg(F.min("_seq").alias("_from"), F.count(F.lit(1)).alias("_n"))
                       .withColumn("_bucket", F.when(key_ok, self.bucket_expr())).persist(StorageLevel.MEMORY_AND_DISK))
            held.append(touched)
            size = touched.agg(F.collect_set("_bucket").alias("buckets"), F.sum(F.when(key_ok, F.col("_n"))).alias("n"), F.count_if(~key_ok).alias("bad")).first()
            if size["bad"]:
                landed.filter(~key_ok).write.mode("overwrite").parquet(f"{staged}/quarantine")
            if size["buckets"]:
                self._merge(std.filter(key_ok), touched.filter(key_ok), sorted(size["buckets"]), size["n"], tag, version, staged, held)
            if size["bad"] or size["buckets"]:
                self._publish(staged)
        finally:
            for df in held:
                df.unpersist()

    def _merge(self, valid: DataFrame, touched: DataFrame, buckets: list[int], n_events: int, tag: str, version: int, staged: str,
               held: list) -> None:
        spec, keys = self.spec, list(self.spec.keys)
        events, rest = valid, []
        known, none = self._schema(), F.lit(None)
        self.rows_read = {"batch": n_events, "open": 0, "closed": 0}
        if known is not None and fs.exists(self.spark, self.state_path):
            state = self.state()
            first = touched.select(*keys, "_from")
            newest = (state.filter((F.col("_part") == OPEN) & F.col("_bucket").isin(buckets)).join(first, keys, "left")
                      .persist(StorageLevel.MEMORY_AND_DISK))
            held.append(newest)
            late = newest.filter(F.col("_from") < F.col(START_COL))
            seen = newest.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("_from") < F.col(START_COL), F.col("_from"))).alias("since")).first()
            self.rows_read["open"] = seen["n"]
            before = newest.filter(F.col("_from").isNotNull())
            rest.append(newest.filter(F.col("_from").isNull()))
            if seen["since"] is not None:
                since = late.select(*keys, "_from")
                behind = F.col(END_COL) > F.col("_from")
                closed = state.filter((F.col("_part") != OPEN) & (F.col(END_COL) > F.lit(seen["since"]))).select(*keys, END_COL, "_part")
                # batches that hold rows of the suffix, and how many: keys and ends only
                found = closed.join(since, keys).filter(behind).groupBy("_part").count().collect()
                # their rows are shuffled once, for the fold and for the part that stays
                moved = (state.filter(F.col("_part").isin([*[r["_part"] for r in found], tag])).join(since, keys, "left")
                         .withColumn("_late", F.coalesce(behind, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK))
                held.append(moved)
                before = before.unionByName(moved.filter("_late").drop("_late"))
                rest.append(moved.filter(~F.col("_late")).drop("_late"))
                self.rows_read["closed"] = sum(r["count"] for r in found)
            elif f"_part={tag}" in fs.list_names(self.spark, self.state_path):
                rest.append(state.filter(F.col("_part") == tag).withColumn("_from", none))
            was = [F.col(c).alias(f"_was_{c}") for c in before.columns if c not in (*keys, *HELPERS, "_op")]
            old = (before.withColumn("_seq", F.col(START_COL)).withColumn("_known", F.struct("_seq", "_part", "_op", END_COL, *was))
                   .drop(START_COL, END_COL, "_bucket"))
            if "_last_live" in old.columns:
                # known for the row that the suffix begins with: no event of the batch precedes it
                flag, live = F.col(spec.is_deleted_col), F.col("_last_live")
                # the live event that a delete of the same sequence has won over
                under = old.filter(flag & (live["_at"] == F.col("_seq")))
                shown = {f.name for f in old.schema["_last_live"].dataType.fields} - {"_at"}
                under = under.select(*[live[c].alias(c) if c in shown else F.lit(False).alias(c) if c == spec.is_deleted_col
                                       else none.cast(old.schema[c].dataType).alias(c) if c in ("_known", "_last_live") else F.col(c) for c in old.columns])
                old = old.withColumn("_last_live", F.when(F.col("_seq") < F.col("_from"), live)).unionByName(under)
            # recorded columns first, so the declared order of the payload stays
            events = old.drop("_from", "_part").unionByName(events, allowMissingColumns=True)
        else:
            seq = T.StructField("_seq", valid.schema["_seq"].dataType)
            text = [T.StructField(c, T.StringType()) for c in ("_part", "_op")]
            events = events.withColumn("_known", none.cast(T.StructType([seq, *text, T.StructField(END_COL, seq.dataType)])))
        keep_live = spec.soft and spec.keep_last_values
        if keep_live and "_last_live" not in events.columns:
            payload = [c for c in events.columns if c not in (*keys, spec.is_deleted_col, "_op", "_seq", "_known")]
            kind = T.StructType([f for f in events.schema.fields if f.name in payload] + [T.StructField("_at", events.schema["_seq"].dataType)]).simpleString()
            events = events.withColumn("_last_live", none.cast(kind))
        elif keep_live:
            events = self._widened_live(events, keys)
        # no key can be hot where all rows together are not
        limit = None if self.max_group_rows is None or sum(self.rows_read.values()) <= self.max_group_rows else self.max_group_rows
        folded = merge.fold(events, spec, limit, carry={"_kept": F.col("_known")}, helpers=HELPERS, known_live="_last_live" if keep_live else None)
        winners = merge.last_of_sequence(folded)
        replaced = F.col("_kept").isNotNull() & F.col("_kept._seq").eqNullSafe(F.col("_seq"))
        mine = F.when(replaced & (F.col("_kept._part") != OPEN), F.col("_kept._part"))
        part = F.when(~F.col("_has_next"), F.lit(OPEN)).otherwise(F.coalesce(mine, F.lit(tag)))
        stored = [c for c in events.columns if c not in (*HELPERS, "_op", "_seq")]
        after = winners.select(*stored, "_op", *([F.col("_live").alias("_last_live")] if keep_live else []), F.col("_seq").alias(START_COL),
                               F.col("_next_seq").alias(END_COL), part.alias("_part"), replaced.alias("_replaced"),
                               F.when(replaced | ~F.col("_has_next"), F.col("_kept")).alias("_kept"))
        after = after.withColumn("_bucket", F.when(F.col("_part") == OPEN, self.bucket_expr()).otherwise(F.lit(CLOSED_BUCKET))).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(after)
        out = after.drop("_replaced", "_kept")
        for other in rest:
            out = out.unionByName(other.drop("_from"), allowMissingColumns=True)
        now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
        for scd in spec.scd_types:
            feed = self._changed(after, scd, stored, version, now)
            feed.write.mode("overwrite").parquet(f"{staged}/changes_scd{scd}")
            if self.spark.read.schema(feed.schema).parquet(f"{staged}/changes_scd{scd}").isEmpty():
                fs.delete(self.spark, f"{staged}/changes_scd{scd}")
        fields = [f for f in out.schema.fields if f.name not in ("_part", "_bucket")]
        fs.mkdirs(self.spark, self.root)
        fs.write_text(self.spark, self._schema_file(), T.StructType(fields).json())
        order = [F.col(c) for c in (spec.cluster_by or spec.keys)]
        (out.hint("rebalance", "_part", "_bucket").sortWithinPartitions("_part", "_bucket", *order)
            .write.mode("overwrite").partitionBy("_part", "_bucket").parquet(f"{staged}/state"))

    def _changed(self, after: DataFrame, scd: int, stored: list[str], version: int, now) -> DataFrame:
        """Change rows of a target: every folded row carries the row that it
        replaces (``_kept``: that of its sequence; for an open row, else, the
        key's open row before the batch), so old and new meet without a join."""
        from ..plans.reports import change_rows

        has = {f.name for f in after.schema["_kept"].dataType.fields}
        payload = [c for c in stored if c not in self.spec.keys]
        ends = [END_COL] if scd == 2 else []
        old = [F.col("_kept").getField(f"_was_{c}").cast(after.schema[c].dataType).alias(c) if f"_was_{c}" in has
               else F.lit(None).cast(after.schema[c].dataType).alias(c) for c in payload]
        old += [F.col("_kept").getField(c).alias(c) for c in ends]
        there = F.col("_replaced") if scd == 2 else F.col("_kept._part") == OPEN
        rows = after if scd == 2 else after.filter(F.col("_part") == OPEN)
        keys = [*self.spec.keys, *([START_COL] if scd == 2 else [])]
        pairs = rows.select(*keys, F.when(there & (F.col("_kept._op") != "D"), F.struct(*old)).alias("_b"),
                            F.when(F.col("_op") != "D", F.struct(*payload, *ends)).alias("_a"))
        return change_rows(pairs, keys, [*payload, *ends], version, now)

    def _widened_live(self, events: DataFrame, keys: list[str]) -> DataFrame:
        """``_last_live`` with the fields that the payload has now."""
        has = {f.name for f in events.schema["_last_live"].dataType.fields}
        names = [c for c in events.columns if c not in (*keys, *HELPERS, "_op", "_seq", self.spec.is_deleted_col)]
        names.append("_at")
        fields = [F.col("_last_live").getField(c).alias(c) if c in has else F.lit(None).cast(events.schema[c].dataType).alias(c) for c in names]
        return events.withColumn("_last_live", F.when(F.col("_last_live").isNotNull(), F.struct(*fields)))

    # -- publishing ------------------------------------------------------------
    def recover(self) -> None:
        """Publish a complete staged result that an earlier run left, and
        drop an incomplete one (its batch comes again)."""
        for name in fs.list_names(self.spark, self.staged_path):
            staged = f"{self.staged_path}/{name}"
            if fs.exists(self.spark, f"{staged}/state/_SUCCESS"):
                self._publish(staged)
            else:
                fs.delete(self.spark, staged)

    def _publish(self, staged: str) -> None:
        spark, version = self.spark, staged.rsplit("/", 1)[-1].split("_", 1)[0]
        names = fs.list_names(spark, staged)
        for name in [n for n in names if n.startswith("changes_")]:
            fs.move(spark, f"{staged}/{name}", f"{self.root}/{name}/_commit={version}")
        if "quarantine" in names:
            fs.move(spark, f"{staged}/quarantine", f"{self.quarantine_path}/_commit={staged.rsplit('/', 1)[-1].split('_', 1)[1]}")
        if "state" in names:
            schema = self._partitioned(self._schema())
            (spark.read.schema(schema).parquet(f"{staged}/state")
                .sortWithinPartitions("_part", "_bucket", *(self.spec.cluster_by or self.spec.keys))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part", "_bucket").parquet(self.state_path))
        if "drop.json" in names:  # parts that a compaction replaced
            for part in json.loads(fs.read_text(spark, f"{staged}/drop.json")):
                fs.delete(spark, f"{self.state_path}/_part={part}")
        fs.delete(spark, staged)

    def compact(self, max_bytes: int = 128 << 20) -> int:
        """Merge the closed rows of batches that hold less than ``max_bytes``
        into one part, so that the number of folders follows the data and not
        the number of batches.  Larger parts stay as they are.  Returns how
        many parts were merged."""
        spark = self.spark
        self.recover()
        parts = [n.split("=", 1)[1] for n in fs.list_names(spark, self.state_path) if n.startswith("_part=") and n != f"_part={OPEN}"]
        small = [p for p in parts if fs.size(spark, f"{self.state_path}/_part={p}") < max_bytes]
        if len(small) < 2:
            return 0
        version = self._version()
        merged = f"merged-{time.time_ns()}"
        staged = f"{self.staged_path}/{version}_{merged}"
        fs.mkdirs(spark, staged)
        fs.write_text(spark, f"{staged}/drop.json", json.dumps(small))
        (self.state().filter(F.col("_part").isin(small)).withColumn("_part", F.lit(merged)).hint("rebalance", "_part", "_bucket")
            .sortWithinPartitions("_part", "_bucket", *(self.spec.cluster_by or self.spec.keys))
            .write.mode("overwrite").partitionBy("_part", "_bucket").parquet(f"{staged}/state"))
        self._publish(staged)
        return len(small)

    def foreach_batch(self, flow: str = "ct"):
        """Function for ``writeStream.foreachBatch``."""
        def _fn(df: DataFrame, batch_id: int) -> None:
            self.apply(df, batch_id, flow)
        return _fn
