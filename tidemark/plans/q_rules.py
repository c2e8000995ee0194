"""Catalogue: correctness rules over SCD2 targets, clean and with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cdc import standardize
from ..operators import merge, rules
from ..sources import feeds
from ..spec import END_COL, START_COL
from . import oracle_sql as O
from .catalog import register
from .q_core import EV_COLS

EV = feeds.EVENTS_SPEC

_SCD2 = O.scd2_sql(O.EVENTS_STD, "user_id", O.EVENTS_ORDER_ASC, EV_COLS)


def _rules_sql(scd2: str, deletes: str) -> str:
    """The five structural rules in SQL over a SCD2 relation and its deletes."""
    return f"""
WITH v AS ({scd2}),
d AS ({deletes}),
nb AS (SELECT *, lead(__START_AT) OVER w AS nstart, lag(__END_AT) OVER w AS pend,
              count(*) OVER (PARTITION BY user_id ORDER BY __START_AT ASC NULLS FIRST, __END_AT ASC NULLS FIRST
                             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_after
       FROM v WINDOW w AS (PARTITION BY user_id ORDER BY __START_AT ASC NULLS FIRST, __END_AT ASC NULLS FIRST))
SELECT 'scd2_one_current_per_key' AS rule, CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed
FROM (SELECT user_id FROM v WHERE __END_AT IS NULL GROUP BY user_id HAVING count(*) > 1) x
UNION ALL
SELECT 'scd2_only_last_open', count(*), count(*) = 0 FROM nb WHERE __END_AT IS NULL AND n_after > 0
UNION ALL
SELECT 'scd2_no_overlap', count(*), count(*) = 0 FROM nb WHERE pend IS NOT NULL AND __START_AT < pend
UNION ALL
SELECT 'scd2_contiguous_history', count(*), count(*) = 0 FROM nb
WHERE __END_AT IS NOT NULL AND n_after > 0 AND __END_AT <> nstart
  AND NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = nb.user_id AND d._seq = nb.__END_AT)
UNION ALL
SELECT 'scd2_start_before_end', count(*), count(*) = 0 FROM v WHERE __END_AT IS NOT NULL AND __START_AT >= __END_AT
"""


_DELETES = f"SELECT user_id, _seq FROM ({O.EVENTS_STD}) s WHERE _op = 'D'"


@register("scd2_rules", _rules_sql(_SCD2, _DELETES) + f"""
UNION ALL
SELECT 'scd2_current_is_latest', count(*), count(*) = 0 FROM (
  SELECT * FROM (
    SELECT user_id, event_type, value, header__change_ts FROM ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) a
  ) l FULL OUTER JOIN (SELECT user_id, event_type, value, header__change_ts FROM ({_SCD2}) b WHERE __END_AT IS NULL) c
  USING (user_id)
  WHERE l.event_type IS DISTINCT FROM c.event_type OR l.value IS DISTINCT FROM c.value
     OR l.header__change_ts IS DISTINCT FROM c.header__change_ts
     OR (l.event_type IS NULL) <> (c.event_type IS NULL)
) x
UNION ALL
SELECT 'scd2_delete_closes', count(*), count(*) = 0 FROM (
  SELECT DISTINCT user_id, _seq FROM (
    SELECT user_id, _seq, _op, lag(_op) OVER (PARTITION BY user_id ORDER BY _seq) AS prev_op FROM ({O.EVENTS_STD}) s
  ) d
  WHERE _op = 'D' AND prev_op IS NOT NULL AND prev_op <> 'D'
    AND NOT EXISTS (SELECT 1 FROM ({_SCD2}) v2 WHERE v2.user_id = d.user_id AND v2.__END_AT = d._seq)
) x
UNION ALL
SELECT 'scd2_versions_equal_events', count(*), count(*) = 0 FROM (
  SELECT * FROM (SELECT user_id, count(*) AS e FROM ({O.EVENTS_STD}) s WHERE _op <> 'D' GROUP BY user_id) a
  FULL OUTER JOIN (SELECT user_id, count(*) AS n FROM ({_SCD2}) v GROUP BY user_id) b USING (user_id)
  WHERE a.e IS DISTINCT FROM b.n
) x
""")
def scd2_rules(spark, sf_dir):
    std = standardize(feeds.feed_events(spark, sf_dir), EV)
    hist = merge.scd2(std, EV).checkpoint()
    deletes = std.filter(F.col("_op") == "D")
    return rules.scd2_rules(hist, ["user_id"], deletes=deletes).unionByName(rules.history_rules(hist, std, EV))


# Planted faults: each variant rewrites a copy of the whole history under a
# shifted key space, so every rule must report a known, data-derived count.
OFFSET = 1_000_000


def planted_history(hist, deletes):
    """Clean history plus four faulty copies (keys shifted by OFFSET * i):
    1 first version left open; 2 first version's end pushed one past the
    next start (overlap); 3 first version zero-length; 4 second version
    removed (unexplained gap unless a delete explains it)."""
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy(START_COL)
    ranked = hist.withColumn("_rk", F.row_number().over(w))
    out = hist.select("user_id", START_COL, END_COL)

    def shifted(i, df):
        return df.withColumn("user_id", F.col("user_id") + F.lit(OFFSET * i)).select("user_id", START_COL, END_COL)

    first = F.col("_rk") == 1
    out = out.unionByName(shifted(1, ranked.withColumn(END_COL, F.when(first, F.lit(None)).otherwise(F.col(END_COL)))))
    out = out.unionByName(shifted(2, ranked.withColumn(
        END_COL, F.when(first & F.col(END_COL).isNotNull(), F.col(END_COL) + 1).otherwise(F.col(END_COL)))))
    out = out.unionByName(shifted(3, ranked.withColumn(END_COL, F.when(first, F.col(START_COL)).otherwise(F.col(END_COL)))))
    out = out.unionByName(shifted(4, ranked.filter(F.col("_rk") != 2)))
    dels = deletes.select("user_id", "_seq")
    all_dels = dels
    for i in range(1, 5):
        all_dels = all_dels.unionByName(dels.withColumn("user_id", F.col("user_id") + F.lit(OFFSET * i)))
    return out, all_dels


_PLANTED_SQL = f"""
SELECT user_id, __START_AT, __END_AT FROM r
UNION ALL SELECT user_id + {OFFSET}, __START_AT, CASE WHEN rk = 1 THEN NULL ELSE __END_AT END FROM r
UNION ALL SELECT user_id + {2 * OFFSET}, __START_AT, CASE WHEN rk = 1 AND __END_AT IS NOT NULL THEN __END_AT + 1 ELSE __END_AT END FROM r
UNION ALL SELECT user_id + {3 * OFFSET}, __START_AT, CASE WHEN rk = 1 THEN __START_AT ELSE __END_AT END FROM r
UNION ALL SELECT user_id + {4 * OFFSET}, __START_AT, __END_AT FROM r WHERE rk <> 2
"""
_PLANTED_DELS = " UNION ALL ".join(
    f"SELECT user_id + {OFFSET * i} AS user_id, _seq FROM ({_DELETES}) d{i}" for i in range(5))


@register("scd2_rules_planted", _rules_sql(
    f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY __START_AT) AS rk FROM ({_SCD2}) h) {_PLANTED_SQL}",
    _PLANTED_DELS))
def scd2_rules_planted(spark, sf_dir):
    std = standardize(feeds.feed_events(spark, sf_dir), EV)
    hist = merge.scd2(std, EV)
    planted, dels = planted_history(hist, std.filter(F.col("_op") == "D"))
    planted = planted.checkpoint()
    return rules.scd2_rules(planted, ["user_id"], deletes=dels)


@register("active_and_current_counts", f"""
SELECT 'scd1_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM ({O.scd1_sql(O.EVENTS_STD, 'user_id', O.EVENTS_ORDER_DESC, EV_COLS)}) a
UNION ALL
SELECT 'scd1_soft_active_rows', CAST(count(*) AS BIGINT) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _seq DESC) rn FROM ({O.EVENTS_STD}) s) x
  WHERE rn = 1 AND NOT (_op = 'D')
UNION ALL
SELECT 'scd1_soft_rows', CAST(count(DISTINCT user_id) AS BIGINT) FROM events
UNION ALL
SELECT 'scd2_rows', CAST(count(*) AS BIGINT) FROM ({_SCD2}) v
UNION ALL
SELECT 'scd2_current_rows', CAST(count(*) AS BIGINT) FROM ({_SCD2}) v WHERE __END_AT IS NULL
UNION ALL
SELECT 'keys_with_many_versions', CAST(count(*) AS BIGINT) FROM (SELECT user_id FROM ({_SCD2}) v GROUP BY user_id HAVING count(*) <> 1) k
""")
def active_and_current_counts(spark, sf_dir):
    """F-ACTIVE, F-CURRENT, A-COUNT and A-PERKEY over the events targets."""
    std = standardize(feeds.feed_events(spark, sf_dir), EV)
    soft_spec = EV.with_(delete_mode="soft")
    s1 = merge.scd1(std, EV)
    s1_soft = merge.scd1(standardize(feeds.feed_events(spark, sf_dir), soft_spec), soft_spec)
    s2 = merge.scd2(std, EV)

    def metric(name, df):
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")

    per_key = s2.groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") != 1)
    parts = [metric("scd1_rows", s1), metric("scd1_soft_active_rows", merge.active_rows(s1_soft)),
             metric("scd1_soft_rows", s1_soft), metric("scd2_rows", s2),
             metric("scd2_current_rows", merge.current_versions(s2)), metric("keys_with_many_versions", per_key)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
