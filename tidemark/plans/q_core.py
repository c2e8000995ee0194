"""Core catalogue: standardisation and the SCD1 / SCD2 / append merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge
from ..sources import feeds
from ..spec import DEFAULT_OP_COL as OP
from . import oracle_sql as O
from .catalog import register

EV = feeds.EVENTS_SPEC
LI = feeds.LINEITEM_SPEC
EV_COLS = "user_id, event_type, value, header__change_ts"
LI_COLS = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus"


def messy_ops(df):
    """Rewrite the clean op codes into the spellings seen in real landings:
    lower case, padding, full words, blank, NULL and unknown codes.  The
    variant is a function of the sequence, so every row is kept."""
    v = F.pmod(F.col("header__change_seq"), F.lit(8))
    op = F.col(OP)
    word = F.when(op == "I", "insert").when(op == "U", "Update").otherwise("DELETE")
    messy = (F.when(v == 1, F.lower(op)).when(v == 2, F.concat(F.lit("  "), op, F.lit(" ")))
             .when(v == 3, word).when(v == 4, F.lit(None).cast("string")).when(v == 5, F.lit(""))
             .when(v == 6, F.lit("X")).otherwise(op))
    return df.withColumn(OP, messy)


MESSY_CT = f"""
SELECT user_id, event_type, value, header__change_seq, header__change_ts,
  CASE pmod8
    WHEN 1 THEN lower(op) WHEN 2 THEN '  ' || op || ' '
    WHEN 3 THEN CASE op WHEN 'I' THEN 'insert' WHEN 'U' THEN 'Update' ELSE 'DELETE' END
    WHEN 4 THEN NULL WHEN 5 THEN '' WHEN 6 THEN 'X' ELSE op END AS header__change_oper
FROM (SELECT *, header__change_oper AS op, ((header__change_seq % 8) + 8) % 8 AS pmod8 FROM ({O.EVENTS_CT}) c) m
"""

OP_MAP_SQL = """CASE WHEN upper(trim(CAST(header__change_oper AS VARCHAR))) = 'D' THEN 'D'
     WHEN upper(trim(CAST(header__change_oper AS VARCHAR))) IN ('I', 'INSERT') THEN 'I'
     WHEN upper(trim(CAST(header__change_oper AS VARCHAR))) IN ('U', 'UPDATE') THEN 'U'
     ELSE 'U' END"""


@register("cdc_standardize", f"""
SELECT user_id, header__change_oper, {OP_MAP_SQL} AS _op, header__change_seq AS _seq FROM ({MESSY_CT}) m
""")
def cdc_standardize(spark, sf_dir):
    std = standardize(messy_ops(feeds.feed_events(spark, sf_dir)), EV)
    return std.select("user_id", OP, "_op", "_seq")


@register("cdc_standardize_soft", f"""
SELECT user_id, CASE WHEN header__change_oper = 'D' THEN 'U' ELSE header__change_oper END AS _op,
       header__change_seq AS _seq, header__change_oper = 'D' AS is_deleted
FROM ({O.EVENTS_CT}) c
""")
def cdc_standardize_soft(spark, sf_dir):
    std = standardize(feeds.feed_events(spark, sf_dir), EV.with_(delete_mode="soft"))
    return std.select("user_id", "_op", "_seq", "is_deleted")


@register("scd1_hard", O.scd1_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS))
def scd1_hard(spark, sf_dir):
    return merge.scd1(standardize(feeds.feed_events(spark, sf_dir), EV), EV)


_SOFT_STD = f"""
SELECT user_id, event_type, value, header__change_ts,
       CASE WHEN header__change_oper = 'D' THEN 'U' ELSE header__change_oper END AS _op,
       header__change_seq AS _seq, header__change_oper = 'D' AS is_deleted
FROM ({O.EVENTS_CT}) c
"""
_SOFT_DESC = ("_seq DESC NULLS LAST, (_op = 'D') DESC NULLS LAST, is_deleted DESC NULLS LAST, "
              "event_type DESC NULLS LAST, value DESC NULLS LAST, header__change_ts DESC NULLS LAST")
_SOFT_ASC = ("_seq ASC NULLS FIRST, (_op = 'D') ASC NULLS FIRST, is_deleted ASC NULLS FIRST, "
             "event_type ASC NULLS FIRST, value ASC NULLS FIRST, header__change_ts ASC NULLS FIRST")


@register("scd1_soft", O.scd1_sql(_SOFT_STD, "user_id", _SOFT_DESC, EV_COLS + ", is_deleted", soft=True))
def scd1_soft(spark, sf_dir):
    spec = EV.with_(delete_mode="soft")
    return merge.scd1(standardize(feeds.feed_events(spark, sf_dir), spec), spec)


@register("scd1_ties", O.scd1_sql(O.LINEITEM_STD, "l_orderkey, l_linenumber", O.LINEITEM_ORDER_DESC, LI_COLS))
def scd1_ties(spark, sf_dir):
    return merge.scd1(standardize(feeds.feed_lineitem(spark, sf_dir), LI), LI)


@register("scd2_hard", O.scd2_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def scd2_hard(spark, sf_dir):
    return merge.scd2(standardize(feeds.feed_events(spark, sf_dir), EV), EV)


@register("scd2_soft", O.scd2_sql(_SOFT_STD, "user_id", _SOFT_ASC, EV_COLS + ", is_deleted", soft=True))
def scd2_soft(spark, sf_dir):
    spec = EV.with_(delete_mode="soft")
    return merge.scd2(standardize(feeds.feed_events(spark, sf_dir), spec), spec)


@register("scd2_composite_key", O.scd2_sql(O.LINEITEM_STD, "l_orderkey, l_linenumber", O.LINEITEM_ORDER_ASC, LI_COLS))
def scd2_composite_key(spark, sf_dir):
    return merge.scd2(standardize(feeds.feed_lineitem(spark, sf_dir), LI), LI)


SEED_SPEC = EV.with_(seed_seq=feeds.CUSTOMER_SEED_SEQ)

OVERLAP_STD = f"""
SELECT user_id, event_type, value, header__change_ts,
       {OP_MAP_SQL} AS _op, coalesce(header__change_seq, -1) AS _seq
FROM (
  SELECT c_custkey AS user_id, 'seed' AS event_type, c_acctbal AS value,
         CAST(NULL AS VARCHAR) AS header__change_oper, CAST(NULL AS BIGINT) AS header__change_seq,
         CAST(NULL AS TIMESTAMP) AS header__change_ts
  FROM customer
  UNION ALL
  SELECT user_id, event_type, value, header__change_oper, header__change_seq, header__change_ts
  FROM ({O.EVENTS_CT}) c
) raw
"""


@register("scd1_full_ct_overlap", O.scd1_sql(OVERLAP_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS))
def scd1_full_ct_overlap(spark, sf_dir):
    return merge.scd1(standardize(feeds.events_with_seed(spark, sf_dir), SEED_SPEC), SEED_SPEC)


@register("scd2_full_ct_overlap", O.scd2_sql(OVERLAP_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def scd2_full_ct_overlap(spark, sf_dir):
    return merge.scd2(standardize(feeds.events_with_seed(spark, sf_dir), SEED_SPEC), SEED_SPEC)


@register("append_all_rows", f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       CAST(NULL AS VARCHAR) AS header__change_oper, CAST(NULL AS TIMESTAMP) AS header__change_seq,
       'full' AS _ingest_source
FROM lineitem
UNION ALL
SELECT *, 'ct' AS _ingest_source FROM ({O.LINEITEM_CT}) c
""")
def append_all_rows(spark, sf_dir):
    li = feeds.table(spark, sf_dir, "lineitem")
    full = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    raw = feeds.full_and_ct(full, feeds.feed_lineitem(spark, sf_dir))
    return raw.drop("_ingest_file", "_ingest_ts")


_KEEP_STD = f"""
SELECT user_id, _op, _seq, is_deleted,
  CASE WHEN is_deleted AND lv IS NOT NULL THEN lv.event_type ELSE event_type END AS event_type,
  CASE WHEN is_deleted AND lv IS NOT NULL THEN lv.value ELSE value END AS value,
  CASE WHEN is_deleted AND lv IS NOT NULL THEN lv.header__change_ts ELSE header__change_ts END AS header__change_ts
FROM (
  SELECT *, last_value(CASE WHEN NOT is_deleted THEN {{'event_type': event_type, 'value': value,
                                                     'header__change_ts': header__change_ts}} END IGNORE NULLS)
              OVER (PARTITION BY user_id ORDER BY {_SOFT_ASC}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv
  FROM ({_SOFT_STD}) s
) x
"""


@register("scd2_soft_keep_values", O.scd2_sql(_KEEP_STD, "user_id", _SOFT_ASC, EV_COLS + ", is_deleted", soft=True))
def scd2_soft_keep_values(spark, sf_dir):
    """Soft deletes that keep the last known values of the key instead of
    the delete event's own (option ``keep_last_values``)."""
    spec = EV.with_(delete_mode="soft", keep_last_values=True)
    return merge.scd2(standardize(feeds.feed_events(spark, sf_dir), spec), spec)


@register("scd2_fold_summary", f"""
SELECT CAST(count(*) AS BIGINT) AS versions, CAST(count(*) FILTER (WHERE __END_AT IS NULL) AS BIGINT) AS open_versions,
       round(sum(l_quantity), 2) AS total_quantity
FROM ({O.scd2_sql(O.LINEITEM_STD, "l_orderkey, l_linenumber", O.LINEITEM_ORDER_ASC, LI_COLS)}) v
""")
def scd2_fold_summary(spark, sf_dir):
    """The SCD2 fold of the lineitem feed with a narrow output (count, open
    versions, quantity): the fold's own cost without writing the history."""
    h = merge.scd2(standardize(feeds.feed_lineitem(spark, sf_dir), LI), LI)
    return h.agg(F.count(F.lit(1)).cast("bigint").alias("versions"),
                 F.count_if(F.col("__END_AT").isNull()).cast("bigint").alias("open_versions"),
                 F.round(F.sum("l_quantity"), 2).alias("total_quantity"))


# A third of the events on one user, and a threshold far below that count.
SKEW_ROWS = 500


def skewed_events(spark, sf_dir):
    ev = feeds.feed_events(spark, sf_dir)
    return ev.withColumn("user_id", F.when(F.pmod(F.col("header__change_seq"), F.lit(3)) == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))


_SKEW_STD = f"SELECT * REPLACE (CASE WHEN header__change_seq % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM ({O.EVENTS_STD}) e"


@register("skewed_history", O.scd2_sql(_SKEW_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def skewed_history(spark, sf_dir):
    return merge.scd2(standardize(skewed_events(spark, sf_dir), EV), EV, max_group_rows=SKEW_ROWS)


@register("skewed_state", O.scd1_sql(_SKEW_STD, "user_id", O.EVENTS_ORDER_DESC, EV_COLS))
def skewed_state(spark, sf_dir):
    return merge.scd1(standardize(skewed_events(spark, sf_dir), EV), EV, max_group_rows=SKEW_ROWS)


_LEAST = "(-9223372036854775807 - 1)"


@register("scd2_seed_default", O.scd2_sql(OVERLAP_STD.replace("header__change_seq, -1)", f"header__change_seq, {_LEAST})"),
                                          "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def scd2_seed_default(spark, sf_dir):
    """Seeds without a ``seed_seq``: the least value of the sequence's type."""
    return merge.scd2(standardize(feeds.events_with_seed(spark, sf_dir), EV), EV)


_NULL_SEQ_STD = f"""SELECT * REPLACE (CASE WHEN header__change_seq % 7 = 0 THEN {_LEAST} ELSE _seq END AS _seq)
FROM ({O.EVENTS_STD}) e"""


@register("scd2_null_sequence", O.scd2_sql(_NULL_SEQ_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS))
def scd2_null_sequence(spark, sf_dir):
    """Changes that landed without a sequence order first and are not lost."""
    ev = feeds.feed_events(spark, sf_dir)
    seq = F.col("header__change_seq")
    return merge.scd2(standardize(ev.withColumn("header__change_seq", F.when(F.pmod(seq, F.lit(7)) != 0, seq)), EV), EV)
