"""A whole pipeline group run from the control tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans.group import GroupRunError, run_group
from tidemark.plans.q_marts import feed_metadata
from tidemark.session import scratch_dir
from tidemark.sources import feeds


def _land(spark, root):
    landing = f"{root}/landing"
    feeds.seed_customer(spark, SF_SMALL).write.parquet(f"{landing}/events__full")
    feeds.feed_events(spark, SF_SMALL).write.parquet(f"{landing}/events__ct")
    feeds.feed_lineitem(spark, SF_SMALL).write.parquet(f"{landing}/lineitem__ct")
    feeds.feed_orders(spark, SF_SMALL).write.parquet(f"{landing}/orders__ct")
    return feed_metadata(spark, landing)


def test_parallel_group_run_logs_every_dataset(spark):
    root = scratch_dir(spark, "grp")
    meta = _land(spark, root)
    log = run_group(spark, meta, "FEEDS", 1, f"{root}/targets", parallelism=3).collect()
    by = {}
    for r in log:
        by.setdefault(r["dataset_id"], []).append(r["phase"])
    assert by[None] == ["GROUP_START"]
    assert by["FEEDS.BROKEN"] == ["REGISTERED", "DERIVE", "ERROR"]
    for d in ("FEEDS.EVENTS", "FEEDS.LINEITEM", "FEEDS.ORDERS"):
        assert by[d] == ["REGISTERED", "DERIVE", "READER", "WRITER", "DONE"]
    assert "FEEDS.ARCHIVE" not in by          # disabled dataset
    written = spark.read.parquet(f"{root}/targets/orders/scd1")
    assert "is_deleted" in written.columns     # soft deletes configured for orders
    assert written.filter(F.col("is_deleted")).count() > 0


def test_stop_on_first_error(spark):
    root = scratch_dir(spark, "grp2")
    meta = _land(spark, root)
    with pytest.raises(GroupRunError):
        run_group(spark, meta, "FEEDS", 1, f"{root}/targets", continue_on_error=False,
                  log_path=f"{root}/log")
    log = spark.read.parquet(f"{root}/log").collect()
    assert "ERROR" in {r["phase"] for r in log if r["dataset_id"] == "FEEDS.BROKEN"}
    # datasets after the failing one (in id order) were not started
    assert not [r for r in log if r["dataset_id"] == "FEEDS.EVENTS"]
