"""Resolving the control tables into one configuration row per dataset.

Everything is a DataFrame plan: key/value rows are pivoted on the known keys
(a partial aggregate, bounded by the number of keys), joined to the masters,
and resolved with ``coalesce(nullif(trim(..)))`` along the override chain
dataset > source > platform > default.  Only the platform table (a handful
of global keys) is read on the driver.  ``TableSpec`` objects for the
driver loop are built from the resolved rows of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import TableSpec

# Configuration keys read by the engine.
DATASET_KEYS = ["landing_table_name", "full_path", "ct_path", "incr_path", "op_col", "sequence_by",
                "delete_code", "delete_mode", "scd_type", "merge_mode", "primary_keys", "cluster_by",
                "load_type", "seed_seq", "seq_type"]
SOURCE_KEYS = ["landing_root", "full_suffix", "ct_suffix", "file_format", "qlik_op_col", "qlik_seq_col",
               "qlik_delete_code"]


class DuplicateConfigError(ValueError):
    pass


def _present(c: Column) -> Column:
    """Blank strings count as absent."""
    return F.when(F.trim(c) != F.lit(""), c)


def _pick(*cols, default=None) -> Column:
    parts = [_present(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def _csv(c: Column) -> Column:
    items = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != F.lit(""))
    return F.array_join(items, ",")


def check_unique(kv: DataFrame, id_cols: list[str]) -> None:
    """Fail on a duplicated (id, key): which row would win is undefined."""
    dup = kv.groupBy(*id_cols, "config_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    row = dup.limit(1).collect()
    if row:
        raise DuplicateConfigError(f"duplicate configuration row: {row[0].asDict()}")


def pivot_kv(kv: DataFrame, id_col: str, keys: list[str], prefix: str) -> DataFrame:
    wide = kv.filter(F.col("config_key").isin(keys)).groupBy(id_col).pivot("config_key", keys).agg(F.max("config_value"))
    return wide.select(id_col, *[F.col(k).alias(prefix + k) for k in keys])


def platform_dict(platform: DataFrame) -> dict:
    """The global keys (a few rows) as a driver-side dict."""
    check_unique(platform, [])
    return {r["config_key"]: r["config_value"] for r in platform.collect()}


def select_datasets(meta: dict, source: str | None = None, table_group_no: int | None = None,
                    dataset_list="ALL") -> DataFrame:
    """Enabled datasets of enabled sources, optionally one source / group /
    list of ids (F-DATASET)."""
    dm = meta["dataset_master"].filter(F.col("enabled"))
    sm = meta["source_master"].filter(F.col("enabled")).select("source_id")
    dm = dm.join(sm, "source_id", "left_semi")
    if source is not None:
        dm = dm.filter(F.col("source_id") == source)
    if table_group_no is not None and table_group_no != "ALL":
        dm = dm.filter(F.col("table_group_no") == int(table_group_no))
    if dataset_list != "ALL":
        # a list, or one string with comma-separated ids
        wanted = dataset_list.split(",") if isinstance(dataset_list, str) else list(dataset_list)
        wanted = [w.strip() for w in wanted if w and w.strip()]
        dm = dm.filter(F.col("dataset_id").isin(wanted))
    return dm


def group_list(meta: dict, source: str | None = None) -> DataFrame:
    """Distinct enabled groups (per source), sorted (A-DISTINCT, O-SORT)."""
    ds = select_datasets(meta, source)
    return ds.select("source_id", "table_group_no").distinct().orderBy("source_id", "table_group_no")


def resolve(meta: dict, datasets: DataFrame | None = None) -> DataFrame:
    """One resolved configuration row per (selected) dataset."""
    check_unique(meta["dataset_config"], ["dataset_id"])
    check_unique(meta["source_config"], ["source_id"])
    p = platform_dict(meta["platform_config"])
    ds = datasets if datasets is not None else select_datasets(meta)
    dcfg = pivot_kv(meta["dataset_config"], "dataset_id", DATASET_KEYS, "d_")
    scfg = pivot_kv(meta["source_config"], "source_id", SOURCE_KEYS, "s_")
    sm = meta["source_master"].select("source_id", F.col("landing_root").alias("m_landing_root"))
    # config tables hold one row per dataset / source: plain keyed joins
    x = ds.join(dcfg, "dataset_id", "left").join(scfg, "source_id", "left").join(sm, "source_id", "left")

    def plat(k):
        v = p.get(k)
        return F.lit(v).cast("string")

    root = F.regexp_replace(_pick(F.col("s_landing_root"), F.col("m_landing_root"), default=""), "/+$", "")
    base = _pick(F.col("d_landing_table_name"), F.col("source_table"))
    full_suffix = _pick(F.col("s_full_suffix"), default="__full")
    ct_suffix = _pick(F.col("s_ct_suffix"), default="__ct")
    scd_type = F.lower(_pick(F.col("d_scd_type"), default="1"))
    catalog = _pick(plat("target_catalog"), default="bronze")
    load_type = F.lower(_pick(F.col("d_load_type"), default="incr"))

    def fq(schema_key, default):
        return F.concat_ws(".", catalog, _pick(plat(schema_key), default=default), F.col("target_table"))

    return x.select(
        "dataset_id", "source_id", "table_group_no", "source_schema", "source_table", "target_table",
        F.coalesce(_present(F.col("d_full_path")), F.concat(root, F.lit("/"), base, full_suffix)).alias("full_path"),
        F.coalesce(_present(F.col("d_ct_path")), _present(F.col("d_incr_path")),
                   F.concat(root, F.lit("/"), base, ct_suffix)).alias("ct_path"),
        _pick(F.col("s_file_format"), default="parquet").alias("file_format"),
        _pick(F.col("d_op_col"), F.col("s_qlik_op_col"), plat("qlik_op_col"), default="header__change_oper").alias("op_col"),
        _pick(F.col("d_sequence_by"), F.col("s_qlik_seq_col"), plat("qlik_seq_col"), default="header__change_seq").alias("seq_col"),
        _pick(F.col("d_delete_code"), F.col("s_qlik_delete_code"), plat("qlik_delete_code"), default="D").alias("delete_code"),
        F.lower(_pick(F.col("d_delete_mode"), plat("delete_mode"), default="hard")).alias("delete_mode"),
        _pick(plat("is_deleted_col"), default="is_deleted").alias("is_deleted_col"),
        scd_type.alias("scd_type"),
        F.when(scd_type.isin("1", "both"), fq("scd1_schema", "bronze_scd1")).alias("scd1_target"),
        F.when(scd_type.isin("2", "both"), fq("scd2_schema", "bronze_scd2")).alias("scd2_target"),
        F.lower(_pick(F.col("d_merge_mode"), default="cdc")).alias("merge_mode"),
        fq("append_schema", "bronze_append").alias("append_target"),
        _csv(F.col("d_primary_keys")).alias("primary_keys"),
        _csv(F.col("d_cluster_by")).alias("cluster_by"),
        (F.lower(_pick(plat("liquid_cluster_auto"), default="true")) == "true").alias("cluster_auto"),
        load_type.alias("load_type"),
        load_type.isin("full", "both").alias("include_full_flow"),
        _pick(F.col("d_seed_seq")).alias("seed_seq"),
        _pick(F.col("d_seq_type")).alias("seq_type"),
    )


def to_specs(resolved_rows) -> list[TableSpec]:
    """TableSpecs from resolved rows of one group (a bounded, small list)."""
    specs = []
    for r in resolved_rows:
        types = tuple(t for t, col in ((1, "scd1_target"), (2, "scd2_target")) if r[col])
        keys = tuple(k for k in (r["primary_keys"] or "").split(",") if k)
        specs.append(TableSpec(
            name=r["dataset_id"], keys=keys, op_col=r["op_col"], seq_col=r["seq_col"],
            delete_code=r["delete_code"], delete_mode=r["delete_mode"], is_deleted_col=r["is_deleted_col"],
            scd_types=types or (1,), merge_mode=r["merge_mode"],
            cluster_by=tuple(k for k in (r["cluster_by"] or "").split(",") if k),
            include_full_flow=bool(r["include_full_flow"]), full_path=r["full_path"], ct_path=r["ct_path"],
            file_format=r["file_format"], seed_seq=r["seed_seq"], seq_type=r["seq_type"]))
    return specs
