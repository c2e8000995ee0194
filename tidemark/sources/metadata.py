"""The five control tables: source_master, source_config, dataset_master,
dataset_config, platform_config.

In production they are tables that operators edit.  ``fleet_metadata``
derives a whole fleet from the given test tables (one source per region, one
dataset per supplier, configuration varied by the supplier's attributes), so
that resolution queries run on data that grows with the scale factor and
exercise blank values, overrides, aliases and disabled rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import table

SOURCE_MASTER = T.StructType([
    T.StructField("source_id", T.StringType(), False), T.StructField("source_name", T.StringType()),
    T.StructField("source_type", T.StringType()), T.StructField("replication_tool", T.StringType()),
    T.StructField("landing_root", T.StringType()), T.StructField("enabled", T.BooleanType())])
KV_SOURCE = T.StructType([T.StructField("source_id", T.StringType(), False),
                          T.StructField("config_key", T.StringType(), False),
                          T.StructField("config_value", T.StringType())])
DATASET_MASTER = T.StructType([
    T.StructField("dataset_id", T.StringType(), False), T.StructField("source_id", T.StringType(), False),
    T.StructField("source_schema", T.StringType()), T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()), T.StructField("table_group_no", T.IntegerType()),
    T.StructField("enabled", T.BooleanType())])
KV_DATASET = T.StructType([T.StructField("dataset_id", T.StringType(), False),
                           T.StructField("config_key", T.StringType(), False),
                           T.StructField("config_value", T.StringType())])
KV_PLATFORM = T.StructType([T.StructField("config_key", T.StringType(), False),
                            T.StructField("config_value", T.StringType())])

# Names of the platform keys that are read, with our defaults.
PLATFORM_DEFAULTS = [
    ("target_catalog", "bronze"),
    ("scd1_schema", "bronze_scd1"),
    ("scd2_schema", "bronze_scd2"),
    ("append_schema", "bronze_append"),
    ("qlik_op_col", "header__change_oper"),
    ("qlik_seq_col", "header__change_seq"),
    ("qlik_delete_code", "D"),
    ("liquid_cluster_auto", "true"),
    ("delete_mode", "hard"),
    ("is_deleted_col", "is_deleted"),
]

# Number of pipeline groups the fleet is spread over.
FLEET_GROUPS = 20


def platform_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLATFORM_DEFAULTS, KV_PLATFORM)


def _kv(df: DataFrame, id_col: str, pairs: list[tuple[str, object]]) -> DataFrame:
    """Unpivot (key, value expression) pairs into config rows; a NULL value
    means "no row" for that key."""
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("config_key"), v.cast("string").alias("config_value"))
                                for k, v in pairs]))
    return (df.select(F.col(id_col), stack.alias("kv"))
              .select(id_col, "kv.config_key", "kv.config_value")
              .filter(F.col("config_value").isNotNull()))


def fleet_metadata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")

    src_id = F.concat(F.lit("SRC_"), F.upper(F.regexp_replace(F.col("r_name"), " ", "_")))
    source_master = region.select(
        src_id.alias("source_id"), F.col("r_name").alias("source_name"), F.lit("oracle").alias("source_type"),
        F.lit("cdc_replicator").alias("replication_tool"),
        F.concat(F.lit("/landing/"), F.lower(F.col("r_name")), F.lit("//")).alias("landing_root"),
        (F.col("r_regionkey") != 4).alias("enabled"))
    source_config = _kv(region.withColumn("source_id", src_id), "source_id", [
        ("file_format", F.lit("parquet")),
        ("full_suffix", F.lit("__full")),
        ("ct_suffix", F.when(F.col("r_regionkey") == 2, F.lit("  ")).otherwise(F.lit("__ct"))),
        ("qlik_op_col", F.when(F.col("r_regionkey") == 1, F.lit("op_code"))),
    ])

    sup = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
           .join(region, nation.n_regionkey == region.r_regionkey)
           .withColumn("source_id", src_id))
    ds_id = F.concat(F.col("source_id"), F.lit(".SUPP"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))
    dataset_master = sup.select(
        ds_id.alias("dataset_id"), "source_id", F.upper(F.col("n_name")).alias("source_schema"),
        F.concat(F.lit("SUPP"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("source_table"),
        F.concat(F.lit("supp_"), F.col("s_suppkey").cast("string")).alias("target_table"),
        (F.pmod(F.col("s_suppkey"), F.lit(FLEET_GROUPS)) + 1).cast("int").alias("table_group_no"),
        (F.col("s_acctbal") >= 0).alias("enabled"))
    k3 = F.pmod(F.col("s_suppkey"), F.lit(3))
    n3 = F.pmod(F.col("s_nationkey"), F.lit(3))
    dataset_config = _kv(sup.withColumn("dataset_id", ds_id), "dataset_id", [
        ("primary_keys", F.when(n3 == 0, F.lit("id")).when(n3 == 1, F.lit(" id , sub_id ,")).otherwise(F.lit("id,line"))),
        ("sequence_by", F.when(k3 == 0, F.lit("")).otherwise(F.lit("header__change_seq"))),
        ("scd_type", F.when(k3 == 0, F.lit("1")).when(k3 == 1, F.lit("2")).otherwise(F.lit("Both"))),
        ("load_type", F.when(n3 == 0, F.lit("incr")).when(n3 == 1, F.lit("full")).otherwise(F.lit("both"))),
        ("cluster_by", F.when(k3 == 1, F.lit("id")).otherwise(F.lit(""))),
        ("delete_mode", F.when(F.col("s_acctbal") > 5000, F.lit("SOFT"))),
        ("merge_mode", F.when(F.pmod(F.col("s_suppkey"), F.lit(10)) == 0, F.lit("append"))),
        ("incr_path", F.when(F.pmod(F.col("s_suppkey"), F.lit(7)) == 0,
                             F.concat(F.lit("/custom/"), F.col("s_suppkey").cast("string"), F.lit("/changes")))),
        ("delete_code", F.when(F.pmod(F.col("s_suppkey"), F.lit(11)) == 0, F.lit("X"))),
    ])
    return {
        "source_master": source_master,
        "source_config": source_config,
        "dataset_master": dataset_master,
        "dataset_config": dataset_config,
        "platform_config": platform_config(spark),
    }


def example_metadata(spark: SparkSession) -> dict[str, DataFrame]:
    """A small deployment of a clinic: visits keep history and latest state
    and land changes only; patients keep history, clustered, reloaded in full."""
    sources = spark.createDataFrame([("CLINIC", "Clinic records", "postgres", "log_reader", "/landing/clinic", True)], SOURCE_MASTER)
    formats = spark.createDataFrame([("CLINIC", k, v) for k, v in (("file_format", "parquet"), ("full_suffix", "__full"), ("ct_suffix", "__ct"))], KV_SOURCE)
    datasets = spark.createDataFrame([(f"CLINIC.{t.upper()}", "CLINIC", "CARE", t.upper(), t, 3, True) for t in ("visits", "patients")], DATASET_MASTER)
    settings = {
        "CLINIC.VISITS": {"primary_keys": "visit_no", "sequence_by": "header__change_seq", "scd_type": "both", "load_type": "incr", "cluster_by": ""},
        "CLINIC.PATIENTS": {"primary_keys": "patient_no", "sequence_by": "header__change_seq", "scd_type": "2", "load_type": "full", "cluster_by": "patient_no"},
    }
    config = spark.createDataFrame([(d, k, v) for d, kv in settings.items() for k, v in kv.items()], KV_DATASET)
    return {"source_master": sources, "source_config": formats, "dataset_master": datasets, "dataset_config": config,
            "platform_config": platform_config(spark)}
