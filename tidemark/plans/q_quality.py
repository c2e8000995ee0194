"""Catalogue: expectations, quarantine, backlog and reprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge, quality
from ..operators.quality import Rule
from ..session import scratch_dir
from ..sources import feeds
from ..sources.tables import table
from . import oracle_sql as O
from .catalog import register
from .q_core import LI_COLS

LI = feeds.LINEITEM_SPEC


def event_rules():
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    return [
        Rule("value_at_most_100", F.col("value") <= 100, "warn"),
        Rule("props_k_below_90", k < 90, "drop"),
        Rule("user_id_present", F.col("user_id").isNotNull(), "drop"),
        Rule("ts_present", F.col("ts").isNotNull(), "fail"),
    ]


def lineitem_rules():
    return [
        Rule("discount_at_most_8pct", F.col("l_discount") <= 0.08, "warn"),
        Rule("tax_below_8pct", F.col("l_tax") < 0.08, "drop"),
        Rule("quantity_at_most_48", F.col("l_quantity") <= 48, "drop"),
        Rule("shipdate_present", F.col("l_shipdate").isNotNull(), "fail"),
    ]


_EV_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _rep(dataset, rule, action, viol, table_):
    return (f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{action}' AS action, "
            f"CAST(count(*) FILTER (WHERE NOT coalesce({viol}, false)) AS BIGINT) AS violations, "
            f"CAST(count(*) AS BIGINT) AS rows_checked FROM {table_}")


@register("dq_expectations", " UNION ALL ".join([
    _rep("events", "value_at_most_100", "warn", "value <= 100", "events"),
    _rep("events", "props_k_below_90", "drop", f"{_EV_K} < 90", "events"),
    _rep("events", "user_id_present", "drop", "user_id IS NOT NULL", "events"),
    _rep("events", "ts_present", "fail", "ts IS NOT NULL", "events"),
    _rep("lineitem", "discount_at_most_8pct", "warn", "l_discount <= 0.08", "lineitem"),
    _rep("lineitem", "tax_below_8pct", "drop", "l_tax < 0.08", "lineitem"),
    _rep("lineitem", "quantity_at_most_48", "drop", "l_quantity <= 48", "lineitem"),
    _rep("lineitem", "shipdate_present", "fail", "l_shipdate IS NOT NULL", "lineitem"),
]))
def dq_expectations(spark, sf_dir):
    """Violations per rule and action, one aggregate pass per dataset;
    fail rules are enforced (the query stops if one is violated)."""
    ev, li = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    quality.enforce(ev, event_rules())
    quality.enforce(li, lineitem_rules())
    return quality.report(ev, event_rules(), "events").unionByName(quality.report(li, lineitem_rules(), "lineitem"))


_LI_REASON = """NULLIF(concat_ws(';', CASE WHEN NOT coalesce(l_tax < 0.08, false) THEN 'tax_below_8pct' END,
                        CASE WHEN NOT coalesce(l_quantity <= 48, false) THEN 'quantity_at_most_48' END,
                        CASE WHEN NOT coalesce(l_shipdate IS NOT NULL, false) THEN 'shipdate_present' END), '')"""


@register("dq_quarantine", f"""
SELECT l_orderkey, l_linenumber, {_LI_REASON} AS dq_reason, {_LI_REASON} IS NULL AS is_valid FROM lineitem
""")
def dq_quarantine(spark, sf_dir):
    """Every line item with its validity and the rules that sent it to
    quarantine (valid and quarantined rows come from one evaluation)."""
    ev = quality.evaluate(table(spark, sf_dir, "lineitem"), lineitem_rules())
    return ev.select("l_orderkey", "l_linenumber", "dq_reason", "is_valid")


@register("dq_backlog", f"""
SELECT reason, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT unnest(string_split({_LI_REASON}, ';')) AS reason FROM lineitem WHERE {_LI_REASON} IS NOT NULL) x
GROUP BY reason
""")
def dq_backlog(spark, sf_dir):
    """Quarantine backlog per reason."""
    _, quar = quality.split(table(spark, sf_dir, "lineitem"), lineitem_rules())
    return quality.backlog(quar)


_FIXED_LI = f"""
SELECT l_orderkey, l_linenumber, least(l_quantity, 48.0) AS l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END AS _op, l_shipdate AS _seq
FROM lineitem
"""


@register("dq_reprocess", O.scd1_sql(_FIXED_LI, "l_orderkey, l_linenumber", O.LINEITEM_ORDER_DESC, LI_COLS))
def dq_reprocess(spark, sf_dir):
    """Quarantined change rows are fixed (quantity capped) and re-emitted;
    valid rows are emitted again as well, and the merge absorbs the replay."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
        "l_tax", "l_discount")
    rules = [r for r in lineitem_rules() if r.name != "tax_below_8pct"]
    valid, quar = quality.split(li, rules)
    fed = quality.reprocess(valid, quar, lambda q: q.withColumn("l_quantity", F.least("l_quantity", F.lit(48.0))))
    fed = fed.unionByName(valid.drop("dq_reason", "dq_warnings", "is_valid"))  # replay of valid rows
    ct = fed.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
                    F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U")).alias("header__change_oper"),
                    F.col("l_shipdate").alias("header__change_seq"))
    return merge.scd1(standardize(ct, LI), LI)


_LI_SOURCE = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_shipdate", "l_extendedprice"]


def _loaded_lines(spark, sf_dir, name):
    root = scratch_dir(spark, name)
    report = quality.load(table(spark, sf_dir, "lineitem").select(*_LI_SOURCE), lineitem_rules(), root, "lineitem", "1")
    return root, report


@register("dq_quarantine_table", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, {_LI_REASON} AS dq_reason FROM lineitem WHERE {_LI_REASON} IS NOT NULL
""")
def dq_quarantine_table(spark, sf_dir):
    """The stored quarantine table of a load whose counts, fail rules and
    both tables come from one pass."""
    root, _ = _loaded_lines(spark, sf_dir, "quarantine")
    return quality.read_quarantine(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "dq_reason")


@register("dq_load_report", " UNION ALL ".join([
    _rep("lineitem", "discount_at_most_8pct", "warn", "l_discount <= 0.08", "lineitem"),
    _rep("lineitem", "tax_below_8pct", "drop", "l_tax < 0.08", "lineitem"),
    _rep("lineitem", "quantity_at_most_48", "drop", "l_quantity <= 48", "lineitem"),
    _rep("lineitem", "shipdate_present", "fail", "l_shipdate IS NOT NULL", "lineitem"),
]))
def dq_load_report(spark, sf_dir):
    """The rule report that the loading job itself observed."""
    return _loaded_lines(spark, sf_dir, "load_report")[1]


@register("dq_reprocess_stored", """
SELECT l_orderkey, l_linenumber, l_extendedprice, least(l_quantity, 48.0) AS l_quantity,
       CASE WHEN coalesce(l_tax < 0.08, false) THEN 'loaded' ELSE 'waiting' END AS place
FROM lineitem
""")
def dq_reprocess_stored(spark, sf_dir):
    """Rejected line items are read back from the quarantine table, their
    quantity is capped, and they are loaded again: those over the tax limit
    wait on, the others are in the table, and no row is lost."""
    root, _ = _loaded_lines(spark, sf_dir, "reprocess")
    quality.reload_quarantine(spark, lineitem_rules(), root, "lineitem", "2", lambda q: q.withColumn("l_quantity", F.least("l_quantity", F.lit(48.0))))
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]
    return quality.read_loaded(spark, root, "lineitem").select(*cols, F.lit("loaded").alias("place")).unionByName(
        quality.read_quarantine(spark, root, "lineitem").select(*cols, F.lit("waiting").alias("place")))
