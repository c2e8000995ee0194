"""Landed files: batch and incremental (streaming) readers, lineage, schemas.

Landing layout: ``<landing_root>/<table><full_suffix>`` (snapshot) and
``<landing_root>/<table><ct_suffix>`` (change table).  Any format Spark
reads by name works (parquet by default; json, csv, orc).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming import fs


def add_lineage(df: DataFrame, source_kind: str) -> DataFrame:
    """``_ingest_source``, ``_ingest_file`` (the landed file), ``_ingest_ts``."""
    return (df.withColumn("_ingest_source", F.lit(source_kind))
              .withColumn("_ingest_file", F.col("_metadata.file_path"))
              .withColumn("_ingest_ts", F.current_timestamp()))


def _nested(reader, partitioned: bool):
    """Recursive lookup turns partition discovery off."""
    return reader if partitioned else reader.option("recursiveFileLookup", "true")


def read_landed(spark: SparkSession, path: str, file_format: str = "parquet", source_kind: str = "ct",
                schema: T.StructType | None = None, options: dict | None = None, partitioned: bool = False) -> DataFrame:
    """Batch read of a landing folder, with lineage.  Without a schema the
    files' schemas are merged (additive evolution).  With ``partitioned`` the
    folders named ``column=value`` are partitions: the column is read and a
    filter on it skips folders.  Without, folder names mean nothing and are
    read however deep they are."""
    r = _nested(spark.read.format(file_format), partitioned)
    if schema is not None:
        r = r.schema(schema)
    elif file_format == "parquet":
        r = r.option("mergeSchema", "true")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return add_lineage(r.load(path), source_kind)


def stream_landed(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                  source_kind: str = "ct", max_files_per_trigger: int | None = None,
                  options: dict | None = None, partitioned: bool = False) -> DataFrame:
    """Incremental once-only read of a landing folder (file stream source);
    the checkpoint of the query that consumes it records which files were
    taken."""
    r = _nested(spark.readStream.format(file_format).schema(schema), partitioned)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return add_lineage(r.load(path), source_kind)


CORRUPT = "_corrupt_record"


def read_checked(spark: SparkSession, path: str, file_format: str, schema: T.StructType, source_kind: str = "ct", options: dict | None = None) -> DataFrame:
    """Batch read of JSON or CSV in which a row that the reader cannot parse
    is kept, as text, in ``_corrupt_record`` (NULL for good rows): a rule on
    it sends the row to quarantine (``quality.load``)."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return read_landed(spark, path, file_format, source_kind, kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})})


class SchemaChangeError(RuntimeError):
    """A landed schema changed in a way that is not purely additive."""


class SchemaStore:
    """Per-flow schema record (the reader's ``schemaLocation``).

    ``resolve`` infers the schema of the files that landed since the recorded
    position (the newest modification time seen), merged into the recorded
    one: a restart reads the footers (for JSON and CSV the rows) of new files
    only.  Columns that were only added give the wider schema (the caller
    restarts its query with it); a type change raises
    :class:`SchemaChangeError`.  ``files_read`` tells how many files were new.
    """

    files_read = 0

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def _file(self) -> str:
        return f"{self.location}/schema.json"

    def recorded(self) -> T.StructType | None:
        if not fs.exists(self.spark, self._file()):
            return None
        return T.StructType.fromJson(json.loads(fs.read_text(self.spark, self._file())))

    def _position(self) -> int | None:
        """Newest modification time seen, in whole seconds."""
        file = f"{self.location}/position.json"
        return json.loads(fs.read_text(self.spark, file))["modified"] if fs.exists(self.spark, file) else None

    def _newer(self, file_format: str, position: int | None):
        """A reader of the files since ``position``; those of its last second
        are read again, as times are whole seconds."""
        r = self.spark.read.format(file_format).option("recursiveFileLookup", "true")
        if position is not None:
            since = dt.datetime.fromtimestamp(position - 1, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
            r = r.option("modifiedAfter", since).option("timeZone", "UTC")
        return r

    def infer(self, path: str, file_format: str = "parquet", position: int | None = None) -> T.StructType:
        r = self._newer(file_format, position)
        if file_format == "parquet":
            r = r.option("mergeSchema", "true")
        elif file_format in ("csv", "json"):
            r = r.option("inferSchema", "true").option("header", "true")
        return r.load(path).schema

    def resolve(self, path: str, file_format: str = "parquet") -> tuple[T.StructType, bool]:
        """(schema to use, changed?)"""
        old, position = self.recorded(), self._position()
        if old is None:
            position = None
        # names and times only: the files' content is not read for this
        seen = self._newer("binaryFile", position).load(path).agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_seconds("modificationTime")).alias("last")).first()
        self.files_read = seen["n"]
        if old is not None and not seen["n"]:
            return old, False
        new = self.infer(path, file_format, position)
        if old is not None:
            types = {f.name: f.dataType for f in new.fields}
            if any(f.name in types and types[f.name] != f.dataType for f in old.fields):
                raise SchemaChangeError(f"non-additive schema change at {path}: {old.simpleString()} -> {new.simpleString()}")
            # keep the recorded column order, append new columns at the end
            names = {f.name for f in old.fields}
            new = T.StructType(list(old.fields) + [f for f in new.fields if f.name not in names])
        changed = old is None or new != old
        fs.mkdirs(self.spark, self.location)
        if changed:
            fs.write_text(self.spark, self._file(), new.json())
        if seen["last"] is not None:
            fs.write_text(self.spark, f"{self.location}/position.json", json.dumps({"modified": seen["last"]}))
        return new, changed and old is not None
