"""Land a known change scenario and check a pipeline's targets against it.

``write_scenario`` lands ``<table>__ct`` (changes with the op / sequence
header) and ``<table>__full`` (by default the latest non-deleted row per key
of the same changes, as a replication tool's initial snapshot would be), and
returns the expected active row count, all computed by Spark.
``check_scenario`` runs the count check and the SCD2 rules on the targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge, rules
from ..spec import DEFAULT_OP_COL, DEFAULT_SEQ_COL, TableSpec


def write_scenario(spark: SparkSession, landing_root: str, table: str, keys: list[str], changes: DataFrame,
                   business_columns: list[str], full: DataFrame | None = None,
                   op_col: str = DEFAULT_OP_COL, seq_col: str = DEFAULT_SEQ_COL,
                   full_suffix: str = "__full", ct_suffix: str = "__ct") -> dict:
    """``changes`` holds the business columns plus ``op_col`` / ``seq_col``."""
    root = landing_root.rstrip("/")
    spec = TableSpec(name=table, keys=tuple(keys), op_col=op_col, seq_col=seq_col)
    latest = merge.scd1(standardize(changes, spec), spec)
    seed = full if full is not None else latest.select(*business_columns)
    full_path, ct_path = f"{root}/{table}{full_suffix}", f"{root}/{table}{ct_suffix}"
    seed.write.mode("overwrite").parquet(full_path)
    changes.select(*business_columns, op_col, seq_col).write.mode("overwrite").parquet(ct_path)
    return {"full_path": full_path, "ct_path": ct_path,
            "expected_active_count": latest.count(), "total_changes": changes.count()}


def check_scenario(scd1_target: DataFrame | None, scd2_target: DataFrame | None, keys: list[str],
                   expected_active: int, is_deleted_col: str = "is_deleted") -> DataFrame:
    """One row per check: ``(rule, violations, passed)``."""
    parts = []
    if scd1_target is not None:
        c = rules.active_count(scd1_target, expected_active, is_deleted_col)
        parts.append(c.select(F.lit("active_count").alias("rule"),
                              F.abs(F.col("actual") - F.col("expected")).cast("bigint").alias("violations"),
                              F.col("passed")))
    if scd2_target is not None:
        parts.append(rules.scd2_rules(scd2_target, keys))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
