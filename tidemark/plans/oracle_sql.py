"""Reusable SQL fragments for the DuckDB oracles.

These restate the feed definitions and the merge semantics in plain SQL,
independently of the Spark code paths they check.
"""

# The events feed (key user_id, sequence event_id).
EVENTS_CT = """
SELECT user_id, event_type, value,
       CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I' ELSE 'U' END
           AS header__change_oper,
       event_id AS header__change_seq,
       ts AS header__change_ts
FROM events
"""

# The events feed standardised: _op, _seq.
EVENTS_STD = f"""
SELECT *, header__change_oper AS _op, header__change_seq AS _seq FROM ({EVENTS_CT}) ct
"""

EVENTS_ORDER_DESC = ("_seq DESC NULLS LAST, (_op = 'D') DESC NULLS LAST, event_type DESC NULLS LAST, "
                     "value DESC NULLS LAST, header__change_ts DESC NULLS LAST")
EVENTS_ORDER_ASC = ("_seq ASC NULLS FIRST, (_op = 'D') ASC NULLS FIRST, event_type ASC NULLS FIRST, "
                    "value ASC NULLS FIRST, header__change_ts ASC NULLS FIRST")

LINEITEM_CT = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END AS header__change_oper,
       l_shipdate AS header__change_seq
FROM lineitem
"""

LINEITEM_STD = f"""
SELECT *, header__change_oper AS _op, header__change_seq AS _seq FROM ({LINEITEM_CT}) ct
"""

LINEITEM_ORDER_DESC = ("_seq DESC NULLS LAST, (_op = 'D') DESC NULLS LAST, l_quantity DESC NULLS LAST, "
                       "l_extendedprice DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST")
LINEITEM_ORDER_ASC = ("_seq ASC NULLS FIRST, (_op = 'D') ASC NULLS FIRST, l_quantity ASC NULLS FIRST, "
                      "l_extendedprice ASC NULLS FIRST, l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST")

ORDERS_CT = """
SELECT o_custkey, o_totalprice, o_orderpriority,
       CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE 'U' END AS header__change_oper,
       o_orderkey AS header__change_seq,
       o_orderdate AS header__change_ts
FROM orders
"""


def scd1_sql(std: str, keys: str, order_desc: str, cols: str, soft: bool = False) -> str:
    where = "rn = 1" if soft else "rn = 1 AND _op <> 'D'"
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order_desc}) AS rn FROM ({std}) s)
SELECT {cols} FROM r WHERE {where}
"""


def scd2_sql(std: str, keys: str, order_asc: str, cols: str, soft: bool = False) -> str:
    where = "" if soft else "AND _op <> 'D'"
    return f"""
WITH o AS (SELECT *, lead(_seq) OVER (PARTITION BY {keys} ORDER BY {order_asc}) AS nxt FROM ({std}) s)
SELECT {cols}, _seq AS __START_AT, nxt AS __END_AT FROM o
WHERE (nxt IS NULL OR nxt <> _seq) {where}
"""
