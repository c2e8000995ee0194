"""Small-file access on the shared (Hadoop-compatible) filesystem.

Only tiny control files go through here (schema records, positions); data is
always read and written by Spark.  Works for local paths, HDFS and object
stores alike because it goes through Hadoop's FileSystem of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def _temporary(spark: SparkSession, path: str, text: str):
    """A complete, closed file of unique name next to ``path``."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return fs, tmp, p, jvm


def _rename(spark: SparkSession, tmp, p, jvm, overwrite: bool) -> None:
    """One rename, which replaces the target or fails if it exists."""
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(how, 1)
    options[0] = how.OVERWRITE if overwrite else how.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, p, options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` to ``path``: a complete temporary file, then one rename
    over the target, so a reader finds the old content or the new."""
    fs, tmp, p, jvm = _temporary(spark, path, text)
    try:
        _rename(spark, fs.makeQualified(tmp), fs.makeQualified(p), jvm, overwrite=True)
    except BaseException:
        fs.delete(tmp, False)
        raise


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False if the target is there already (an earlier
    attempt moved it) or the source is gone."""
    fs, p, jvm = _fs(spark, target)
    if fs.exists(p) or not exists(spark, source):
        return False
    fs.mkdirs(p.getParent())
    _rename(spark, fs.makeQualified(jvm.org.apache.hadoop.fs.Path(source)), fs.makeQualified(p), jvm, overwrite=False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder, from its listing."""
    fs, p, _ = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put a complete folder in the place of ``target``: the old one is moved
    aside, and deleted when the new one is there."""
    aside = f"{target}.old-{uuid.uuid4().hex[:8]}"
    had = move(spark, target, aside)
    move(spark, staged, target)
    if had:
        delete(spark, aside)
