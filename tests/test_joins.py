"""Joins against brute force on small fixtures derived from the tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark import standardize
from tidemark.operators import joins, merge
from tidemark.sources import feeds
from tidemark.sources.tables import table

SPEC = feeds.EVENTS_SPEC


def test_as_of_join_matches_range_join(spark):
    ct = feeds.feed_events(spark, SF_SMALL)
    state = merge.scd2(standardize(ct.filter(F.col("event_type") != "purchase"), SPEC), SPEC)
    facts = table(spark, SF_SMALL, "events").filter(F.col("event_type") == "purchase").select("user_id", "event_id")
    got = rows(joins.as_of_join(facts, state, ["user_id"], "event_id", ["event_type"]),
               "user_id", "event_id", "event_type", "__START_AT")
    s = state.alias("s")
    f = facts.alias("f")
    cond = ((F.col("s.user_id") == F.col("f.user_id")) & (F.col("s.__START_AT") <= F.col("f.event_id"))
            & (F.col("s.__END_AT").isNull() | (F.col("f.event_id") < F.col("s.__END_AT"))))
    brute = f.join(s, cond, "left").select("f.user_id", "f.event_id", "s.event_type", "s.__START_AT")
    assert got == rows(brute, "user_id", "event_id", "event_type", "__START_AT")
    # hot-key path gives the same answer
    hot = rows(joins.as_of_join(facts, state, ["user_id"], "event_id", ["event_type"], max_group_rows=5),
               "user_id", "event_id", "event_type", "__START_AT")
    assert hot == got


def test_interval_join_matches_brute_force(spark):
    ev = table(spark, SF_SMALL, "events")
    a = ev.filter(F.col("event_type") == "click").select(F.col("event_id").alias("a_id"), "user_id", F.col("ts").alias("a_ts"))
    b = ev.filter(F.col("event_type") == "view").select(F.col("event_id").alias("b_id"), "user_id", F.col("ts").alias("b_ts"))
    got = joins.interval_join(a, b, ["user_id"], "a_ts", "b_ts", -7200, 3600, bucket_sec=1800)
    d = F.unix_micros(F.col("b_ts").cast("timestamp")) - F.unix_micros(F.col("a_ts").cast("timestamp"))
    brute = a.join(b, "user_id").filter((d >= -7200 * 10**6) & (d <= 3600 * 10**6))
    assert rows(got, "a_id", "b_id") == rows(brute, "a_id", "b_id")


def test_orphans_and_grain(spark):
    o = table(spark, SF_SMALL, "orders")
    li = table(spark, SF_SMALL, "lineitem")
    orph = joins.orphans(li, o.filter(F.col("o_orderstatus") == "F"), ["l_orderkey"], ["o_orderkey"]).count()
    expected = li.join(o.filter(F.col("o_orderstatus") == "F"), li.l_orderkey == o.o_orderkey, "left_anti").count()
    assert orph == expected
    g = joins.grain_report(o, table(spark, SF_SMALL, "events"), ["o_custkey"], ["user_id"]).first()
    ev = table(spark, SF_SMALL, "events")
    assert g["join_rows"] == o.join(ev, o.o_custkey == ev.user_id).count()


def test_key_chains_of_any_length_and_cycles(spark):
    from tidemark.operators.patterns import resolve_key_chains

    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (7000, 7000)], "old_key long, new_key long")
    got = {r["old_key"]: r["new_key"] for r in resolve_key_chains(chain).collect()}
    assert got == {**{i: 40 for i in range(40)}, 100: 200}
    with pytest.raises(ValueError):
        resolve_key_chains(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "old_key long, new_key long"))


def test_broadcast_size_counts_long_values(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.sizing import checked_broadcast, size_of

    texts = spark.range(10).select("id", F.repeat(F.lit("x"), 100_000).alias("t"), F.array(F.lit("y" * 50)).alias("a"))
    assert 1_000_000 < size_of(texts, 10) < 1_100_000
    assert size_of(spark.range(10), 10) == 240
    plan = lambda df: spark.range(5).join(df, "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(checked_broadcast(texts, 10)).lower()
    assert "broadcast" not in plan(checked_broadcast(texts, 10, max_bytes=500_000)).lower()


def test_lookup_takes_the_largest_reference_row(spark):
    from tidemark.operators.joins import lookup_split

    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    ref = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 3)], "rk long, name string, at int")
    hit, missed = lookup_split(facts, ref, ["k"], ["rk"], ["name"], ref_order=["at"])
    assert [tuple(r) for r in hit.collect()] == [(1, "a", "new")] and missed.count() == 2
