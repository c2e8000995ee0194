"""Catalogue: metadata-driven configuration (J-CONFIG, P-CONFIG, F-DATASET,
A-DISTINCT, O-SORT) over a fleet derived from region / nation / supplier."""

from __future__ import annotations


from ..sources import metadata as M
from . import config as C
from .catalog import register


def _pm(x: str, n: int) -> str:
    return f"((({x}) % {n}) + {n}) % {n}"


_SRC_ID = "'SRC_' || upper(replace(r_name, ' ', '_'))"
_PLATFORM = " UNION ALL ".join(f"SELECT '{k}' AS config_key, '{v}' AS config_value" for k, v in M.PLATFORM_DEFAULTS)


def _blank(x: str) -> str:
    return f"CASE WHEN trim({x}) <> '' THEN {x} END"


def _pick(*xs, default=None) -> str:
    parts = [_blank(x) for x in xs] + ([f"'{default}'"] if default is not None else [])
    return f"coalesce({', '.join(parts)})"


def _csv(x: str) -> str:
    return (f"array_to_string(list_filter(list_transform(string_split(coalesce({x}, ''), ','), "
            f"lambda s: trim(s)), lambda s: s <> ''), ',')")


FLEET_SQL = f"""
src_master AS (
  SELECT {_SRC_ID} AS source_id, r_name AS source_name, '/landing/' || lower(r_name) || '//' AS landing_root,
         r_regionkey <> 4 AS enabled, r_regionkey FROM region),
src_cfg AS (
  SELECT source_id, 'parquet' AS s_file_format, '__full' AS s_full_suffix,
         CASE WHEN r_regionkey = 2 THEN '  ' ELSE '__ct' END AS s_ct_suffix,
         CASE WHEN r_regionkey = 1 THEN 'op_code' END AS s_qlik_op_col,
         CAST(NULL AS VARCHAR) AS s_qlik_seq_col, CAST(NULL AS VARCHAR) AS s_qlik_delete_code,
         CAST(NULL AS VARCHAR) AS s_landing_root
  FROM src_master),
sup AS (
  SELECT s.*, n.n_name, {_SRC_ID} AS source_id,
         {_SRC_ID} || '.SUPP' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS dataset_id,
         {_pm('s_suppkey', 3)} AS k3, {_pm('s_nationkey', 3)} AS n3
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
ds_master AS (
  SELECT dataset_id, source_id, upper(n_name) AS source_schema,
         'SUPP' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS source_table,
         'supp_' || CAST(s_suppkey AS VARCHAR) AS target_table,
         CAST({_pm('s_suppkey', M.FLEET_GROUPS)} + 1 AS INTEGER) AS table_group_no,
         s_acctbal >= 0 AS enabled
  FROM sup),
ds_cfg AS (
  SELECT dataset_id,
         CASE WHEN n3 = 0 THEN 'id' WHEN n3 = 1 THEN ' id , sub_id ,' ELSE 'id,line' END AS d_primary_keys,
         CASE WHEN k3 = 0 THEN '' ELSE 'header__change_seq' END AS d_sequence_by,
         CASE WHEN k3 = 0 THEN '1' WHEN k3 = 1 THEN '2' ELSE 'Both' END AS d_scd_type,
         CASE WHEN n3 = 0 THEN 'incr' WHEN n3 = 1 THEN 'full' ELSE 'both' END AS d_load_type,
         CASE WHEN k3 = 1 THEN 'id' ELSE '' END AS d_cluster_by,
         CASE WHEN s_acctbal > 5000 THEN 'SOFT' END AS d_delete_mode,
         CASE WHEN {_pm('s_suppkey', 10)} = 0 THEN 'append' END AS d_merge_mode,
         CASE WHEN {_pm('s_suppkey', 7)} = 0 THEN '/custom/' || CAST(s_suppkey AS VARCHAR) || '/changes' END AS d_incr_path,
         CASE WHEN {_pm('s_suppkey', 11)} = 0 THEN 'X' END AS d_delete_code,
         CAST(NULL AS VARCHAR) AS d_full_path, CAST(NULL AS VARCHAR) AS d_ct_path,
         CAST(NULL AS VARCHAR) AS d_op_col, CAST(NULL AS VARCHAR) AS d_landing_table_name
  FROM sup),
plat AS (SELECT * FROM ({_PLATFORM}) p),
selected AS (
  SELECT d.* FROM ds_master d JOIN src_master s USING (source_id) WHERE d.enabled AND s.enabled)
"""


def _resolved_sql() -> str:
    def plat(k):
        return f"(SELECT config_value FROM plat WHERE config_key = '{k}')"
    root = f"regexp_replace({_pick('c.s_landing_root', 'm.landing_root', default='')}, '/+$', '')"
    base = _pick("d_landing_table_name", "source_table")
    scd = f"lower({_pick('d_scd_type', default='1')})"
    catalog = _pick(plat("target_catalog"), default="bronze")
    load = f"lower({_pick('d_load_type', default='incr')})"

    def fq(k, dflt):
        return f"concat_ws('.', {catalog}, {_pick(plat(k), default=dflt)}, target_table)"
    return f"""
SELECT dataset_id, source_id, table_group_no, source_schema, source_table, target_table,
  coalesce({_blank('d_full_path')}, {root} || '/' || {base} || {_pick('s_full_suffix', default='__full')}) AS full_path,
  coalesce({_blank('d_ct_path')}, {_blank('d_incr_path')}, {root} || '/' || {base} || {_pick('s_ct_suffix', default='__ct')}) AS ct_path,
  {_pick('s_file_format', default='parquet')} AS file_format,
  {_pick('d_op_col', 's_qlik_op_col', plat('qlik_op_col'), default='header__change_oper')} AS op_col,
  {_pick('d_sequence_by', 's_qlik_seq_col', plat('qlik_seq_col'), default='header__change_seq')} AS seq_col,
  {_pick('d_delete_code', 's_qlik_delete_code', plat('qlik_delete_code'), default='D')} AS delete_code,
  lower({_pick('d_delete_mode', plat('delete_mode'), default='hard')}) AS delete_mode,
  {_pick(plat('is_deleted_col'), default='is_deleted')} AS is_deleted_col,
  {scd} AS scd_type,
  CASE WHEN {scd} IN ('1', 'both') THEN {fq('scd1_schema', 'bronze_scd1')} END AS scd1_target,
  CASE WHEN {scd} IN ('2', 'both') THEN {fq('scd2_schema', 'bronze_scd2')} END AS scd2_target,
  lower({_pick('d_merge_mode', default='cdc')}) AS merge_mode,
  {fq('append_schema', 'bronze_append')} AS append_target,
  {_csv('d_primary_keys')} AS primary_keys,
  {_csv('d_cluster_by')} AS cluster_by,
  lower({_pick(plat('liquid_cluster_auto'), default='true')}) = 'true' AS cluster_auto,
  {load} AS load_type,
  {load} IN ('full', 'both') AS include_full_flow,
  CAST(NULL AS VARCHAR) AS seed_seq, CAST(NULL AS VARCHAR) AS seq_type
FROM selected x
LEFT JOIN ds_cfg USING (dataset_id)
LEFT JOIN src_cfg c USING (source_id)
LEFT JOIN src_master m USING (source_id)
"""


@register("config_resolve", f"WITH {FLEET_SQL} {_resolved_sql()}")
def config_resolve(spark, sf_dir):
    meta = M.fleet_metadata(spark, sf_dir)
    return C.resolve(meta)


# Fixed selection parameters of the selection query.
SELECT_SOURCE, SELECT_GROUP = "SRC_AMERICA", 5


@register("dataset_select", f"""
WITH {FLEET_SQL}
SELECT dataset_id, target_table, table_group_no FROM selected
WHERE source_id = '{SELECT_SOURCE}' AND table_group_no = {SELECT_GROUP}
""")
def dataset_select(spark, sf_dir):
    meta = M.fleet_metadata(spark, sf_dir)
    return C.select_datasets(meta, SELECT_SOURCE, SELECT_GROUP).select("dataset_id", "target_table", "table_group_no")


@register("group_list", f"""
WITH {FLEET_SQL}
SELECT DISTINCT source_id, table_group_no FROM selected ORDER BY source_id, table_group_no
""")
def group_list(spark, sf_dir):
    meta = M.fleet_metadata(spark, sf_dir)
    return C.group_list(meta)
