"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``, as a regular-expression class.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per application), as
    ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-py-"), "tidemark_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again.

    Cuts the lineage: a lost executor costs a re-read, and a frame used twice
    is computed once.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, or the first lengthened form of it that no column has (column
    names do not differ by case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: Column | str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (the contract's folds)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % buckets


def hash_order(doc_id: Column | str, seed: str) -> Column:
    """A seeded pseudo-random order of ids, the same on every run."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.xxhash64(F.lit(seed), c)


def stratified_sample(df: DataFrame, id_col: str, by: str, limit: int, seed: str, max_strata: int = 1000,
                      total: int | None = None) -> DataFrame:
    """About ``limit`` rows of every value of ``by`` (all, if it has fewer),
    by a seeded hash of the id; column ``_h`` is that hash.

    Two passes: counts per value, then a filter.  The caller trims each value
    to ``limit`` rows in the order of ``_h`` after collecting.  At most
    ``max_strata`` values (the most frequent) are sampled, and of ``total``
    rows each value has an equal part if that is less than ``limit``.
    """
    sizes = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(max_strata).collect()
    h = hash_order(id_col, seed)
    if not sizes:
        return df.filter(F.lit(False)).withColumn("_h", h)
    if total is not None:
        limit = max(1, min(limit, total // len(sizes)))
    spread = 2.0 ** 64
    limits = F.create_map(*[x for r in sizes for x in (
        F.lit(r[by]), F.lit(min(2 ** 63 - 1, int(-(2 ** 63) + spread * min(1.0, 1.25 * (limit + 20) / r["n"])))))])
    return df.withColumn("_h", h).filter(F.col(by).isNotNull()).filter(F.col("_h") <= limits[F.col(by)])
