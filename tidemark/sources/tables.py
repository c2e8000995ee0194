"""Reading the given test tables (and any Parquet table folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of the tables the driver provides.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
