"""Merge semantics: the reference's scenario, soft deletes, ties, hot keys."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark import TableSpec, scd1, scd2, standardize
from tidemark.sources import feeds

SCHEMA = "customer_id bigint, name string, city string, header__change_oper string, header__change_seq bigint"
# The five-event CUSTOMERS scenario.
CHANGES = [
    (7, "Asha", "Pune", "I", 1),
    (7, "Asha", "Mumbai", "U", 2),
    (8, "Ravi", "Delhi", "I", 3),
    (7, "Asha R", "Mumbai", "U", 4),
    (8, None, None, "D", 5),
]
SPEC = TableSpec(name="customers", keys=("customer_id",), scd_types=(1, 2))


def test_scenario_hard(spark):
    df = standardize(spark.createDataFrame(CHANGES, SCHEMA), SPEC)
    assert rows(scd1(df, SPEC)) == [(7, "Asha R", "Mumbai")]
    got = rows(scd2(df, SPEC), "customer_id", "__START_AT", "__END_AT")
    assert got == [(7, 1, 2), (7, 2, 4), (7, 4, None), (8, 3, 5)]


def test_scenario_soft(spark):
    spec = SPEC.with_(delete_mode="soft")
    df = standardize(spark.createDataFrame(CHANGES, SCHEMA), spec)
    s1 = rows(scd1(df, spec), "customer_id", "is_deleted")
    assert s1 == [(7, False), (8, True)]
    got = rows(scd2(df, spec), "customer_id", "__START_AT", "__END_AT", "is_deleted")
    assert got == [(7, 1, 2, False), (7, 2, 4, False), (7, 4, None, False),
                   (8, 3, 5, False), (8, 5, None, True)]


def test_order_independent_and_replay(spark):
    shuffled = list(reversed(CHANGES)) + CHANGES[:2]
    a = standardize(spark.createDataFrame(CHANGES, SCHEMA), SPEC)
    b = standardize(spark.createDataFrame(shuffled, SCHEMA).repartition(3), SPEC)
    assert rows(scd1(a, SPEC)) == rows(scd1(b, SPEC))
    assert rows(scd2(a, SPEC)) == rows(scd2(b, SPEC))


def test_ties_pick_total_order_winner(spark):
    data = [(1, "a", "X", "U", 5), (1, "b", "X", "U", 5), (1, "z", "X", "D", 5), (2, "q", "Y", "U", 1)]
    df = standardize(spark.createDataFrame(data, SCHEMA), SPEC)
    # the delete wins the tie at seq 5, so key 1 is gone (hard)
    assert rows(scd1(df, SPEC)) == [(2, "q", "Y")]
    soft = SPEC.with_(delete_mode="soft")
    dfs = standardize(spark.createDataFrame(data, SCHEMA), soft)
    assert rows(scd2(dfs, soft), "customer_id", "name", "__START_AT", "__END_AT") == [(1, "z", 5, None), (2, "q", 1, None)]


def test_null_key_not_merged(spark):
    data = CHANGES + [(None, "n", "n", "I", 9)]
    df = standardize(spark.createDataFrame(data, SCHEMA), SPEC)
    assert all(r[0] is not None for r in rows(scd1(df, SPEC)))
    assert all(r[0] is not None for r in rows(scd2(df, SPEC)))


def test_hot_key_chunks_equal_plain_window(spark):
    # Put a third of all events on one user: the chunked path must give the
    # same history as the single-window path.
    ct = feeds.feed_events(spark, SF_SMALL)
    ct = ct.withColumn("user_id", F.when(F.col("header__change_seq") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    spec = feeds.EVENTS_SPEC
    std = standardize(ct, spec)
    plain = rows(scd2(std, spec, max_group_rows=None))
    chunked = rows(scd2(std, spec, max_group_rows=40))
    assert plain == chunked
    assert len(plain) > 0


def test_write_and_check_scenario(spark):
    from tidemark.operators.rules import with_total
    from tidemark.session import scratch_dir
    from tidemark.sources.scenario import check_scenario, write_scenario
    from tidemark.sources.files import read_landed

    root = scratch_dir(spark, "scenario")
    changes = spark.createDataFrame(CHANGES, SCHEMA)
    info = write_scenario(spark, root, "CUSTOMERS", ["customer_id"], changes, ["customer_id", "name", "city"])
    assert info["expected_active_count"] == 1 and info["total_changes"] == 5
    ct = read_landed(spark, info["ct_path"])
    std = standardize(ct, SPEC)
    res = check_scenario(scd1(std, SPEC), scd2(std, SPEC), ["customer_id"], info["expected_active_count"])
    (total,) = with_total(res).filter("rule = 'all rules'").collect()
    assert total["passed"] and total["violations"] == 0
    bad = with_total(res.unionByName(res.limit(1).withColumn("violations", F.lit(3).cast("long")).withColumn("passed", F.lit(False))))
    assert [(r["violations"], r["passed"]) for r in bad.filter("rule = 'all rules'").collect()] == [(3, False)]
    # the snapshot is the latest non-deleted row per key
    assert rows(read_landed(spark, info["full_path"]), "customer_id", "name") == [(7, "Asha R")]
