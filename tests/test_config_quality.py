"""Config resolution on the example deployment, duplicates, quality rules."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import quality
from tidemark.operators.quality import Rule
from tidemark.plans import config as C
from tidemark.sources import metadata as M
from tidemark.sources.tables import table


def test_example_resolution(spark):
    meta = M.example_metadata(spark)
    got = {r["dataset_id"]: r for r in C.resolve(meta).collect()}
    o = got["CLINIC.VISITS"]
    assert o["full_path"] == "/landing/clinic/VISITS__full"
    assert o["ct_path"] == "/landing/clinic/VISITS__ct"
    assert o["scd1_target"] == "bronze.bronze_scd1.visits" and o["scd2_target"] == "bronze.bronze_scd2.visits"
    assert o["include_full_flow"] is False and o["cluster_by"] == ""
    c = got["CLINIC.PATIENTS"]
    assert c["scd1_target"] is None and c["scd2_target"] == "bronze.bronze_scd2.patients"
    assert c["include_full_flow"] is True and c["cluster_by"] == "patient_no"
    specs = {s.name: s for s in C.to_specs(got.values())}
    assert specs["CLINIC.VISITS"].scd_types == (1, 2)
    assert specs["CLINIC.PATIENTS"].keys == ("patient_no",)


def test_duplicate_config_key_fails(spark):
    meta = M.example_metadata(spark)
    dup = spark.createDataFrame([("CLINIC.VISITS", "scd_type", "1")], M.KV_DATASET)
    meta["dataset_config"] = meta["dataset_config"].unionByName(dup)
    with pytest.raises(C.DuplicateConfigError):
        C.resolve(meta)


def test_disabled_source_has_no_datasets(spark):
    meta = M.example_metadata(spark)
    meta["source_master"] = meta["source_master"].withColumn("enabled", F.lit(False))
    assert C.select_datasets(meta).count() == 0


def test_fail_rule_raises_and_split(spark):
    li = table(spark, SF_SMALL, "lineitem")
    with pytest.raises(quality.ExpectationFailed):
        quality.enforce(li, [Rule("tiny_quantity", F.col("l_quantity") < 5, "fail")])
    rules = [Rule("q", F.col("l_quantity") <= 48, "drop"), Rule("d", F.col("l_discount") <= 0.08, "warn")]
    valid, quar = quality.split(li, rules)
    assert valid.count() + quar.count() == li.count()
    assert quar.filter(F.col("l_quantity") <= 48).count() == 0


def test_a_load_is_one_pass_and_fails_whole(spark):
    """The observed counts agree with both stored tables although the input
    changes with every evaluation; a violated fail rule leaves both tables."""
    from tidemark.operators import quality
    from tidemark.operators.quality import ExpectationFailed, Rule
    from tidemark.session import scratch_dir

    root = scratch_dir(spark, "load")
    df = spark.range(20_000).withColumn("u", F.rand())
    rules = [Rule("high", F.col("u") < 0.9, "drop"), Rule("id", F.col("id").isNotNull(), "fail"), Rule("low", F.col("u") > 0.5, "warn")]
    told = {r["rule"]: r["violations"] for r in quality.load(df, rules, root, "t", "1").collect()}
    kept, waiting = quality.read_loaded(spark, root, "t"), quality.read_quarantine(spark, root, "t")
    assert waiting.count() == told["high"] > 0 and kept.count() + waiting.count() == 20_000 and told["id"] == 0
    assert kept.filter("u <= 0.5").count() + waiting.filter("u <= 0.5").count() == told["low"]
    with pytest.raises(ExpectationFailed):
        quality.load(df.withColumn("id", F.when(F.col("id") > 0, F.col("id"))), rules, root, "t", "2")
    assert kept.count() + waiting.count() == 20_000 and {r["_load"] for r in kept.select("_load").distinct().collect()} == {1}
    quality.reload_quarantine(spark, rules, root, "t", "3", lambda q: q.withColumn("u", F.lit(0.1)))
    assert quality.read_loaded(spark, root, "t").count() == 20_000


def test_a_failed_build_keeps_the_live_target(spark):
    from conftest import SF_SMALL
    from tidemark.plans.build import build_targets
    from tidemark.session import scratch_dir
    from tidemark.sources import feeds

    root = scratch_dir(spark, "build")
    ct = feeds.feed_events(spark, SF_SMALL)
    paths = build_targets(ct, feeds.EVENTS_SPEC, root)
    n = spark.read.parquet(paths["scd1"]).count()
    with pytest.raises(Exception):  # noqa: B017
        build_targets(ct.withColumn("value", F.raise_error(F.lit("lost"))), feeds.EVENTS_SPEC, root)
    assert spark.read.parquet(paths["scd1"]).count() == n
    build_targets(ct.limit(0), feeds.EVENTS_SPEC, root)
    assert spark.read.parquet(paths["scd1"]).count() == 0


def test_compaction_finishes_what_a_run_left(spark):
    from tidemark.operators import layout
    from tidemark.session import scratch_dir
    from tidemark.streaming import fs

    path = f"{scratch_dir(spark, 'small')}/t"
    spark.range(50_000).repartition(12).write.parquet(path)
    made = layout._finish
    try:
        layout._finish = lambda s, p: False
        assert layout.compact_small_files(spark, path, 1 << 20, cluster_by=["id"]) == 1
    finally:
        layout._finish = made
    assert layout.compact_small_files(spark, path, 1 << 20) == 0        # finished first, nothing left to merge
    files = layout.files_of(spark, path).collect()
    assert len(files) == 1 and files[0]["rows"] == 50_000 and not fs.exists(spark, f"{path}/_compaction")
    assert spark.read.parquet(path).distinct().count() == 50_000
