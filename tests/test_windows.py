"""The hot-key (chunked) path of with_neighbors equals the plain window."""

from pyspark.sql import functions as F

from conftest import SF_BIG, SF_SMALL, rows
from tidemark.operators.windows import with_neighbors
from tidemark.sources.tables import table


def _skewed(spark):
    ev = table(spark, SF_SMALL, "events")
    # a third of the rows on one key
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _run(df, **kw):
    out = with_neighbors(df, ["user_id"], [F.col("event_id")],
                         nxt={"n_id": "event_id"}, prev={"p_val": "value"},
                         carry={"last_click": F.when(F.col("event_type") == "click", F.col("event_id"))},
                         number="rn", **kw)
    return rows(out, "event_id", "user_id", "n_id", "p_val", "last_click", "rn", "_has_next", "_has_prev")


def test_chunked_equals_plain(spark):
    df = _skewed(spark)
    plain = _run(df, max_group_rows=None)
    chunked = _run(df, max_group_rows=50, chunk_rows=40)
    assert plain == chunked


def test_single_group_numbering(spark):
    df = table(spark, SF_SMALL, "orders").select("o_orderkey")
    a = rows(with_neighbors(df, [], [F.col("o_orderkey")], number="rn", max_group_rows=None), "o_orderkey", "rn")
    b = rows(with_neighbors(df, [], [F.col("o_orderkey")], number="rn", max_group_rows=100), "o_orderkey", "rn")
    assert a == b
    assert [r[1] for r in a] == list(range(1, len(a) + 1))


def test_cumsum_and_exact_quantiles_chunked(spark):
    from tidemark.plans.reports import exact_quantiles

    ev = table(spark, SF_SMALL, "events")
    a = rows(with_neighbors(ev, ["event_type"], [F.col("event_id")], cumsum={"cv": "value"}, max_group_rows=None),
             "event_id", "cv")
    b = rows(with_neighbors(ev, ["event_type"], [F.col("event_id")], cumsum={"cv": "value"}, max_group_rows=30),
             "event_id", "cv")
    assert [(i, round(x, 6)) for i, x in a] == [(i, round(x, 6)) for i, x in b]
    q = {r["event_type"]: r for r in exact_quantiles(ev, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}).collect()}
    for t, r in q.items():
        vals = sorted(x["value"] for x in ev.filter(F.col("event_type") == t).select("value").collect())
        h = (len(vals) - 1) * 0.5
        lo, hi = int(h), min(int(h) + 1, len(vals) - 1)
        assert abs(r["p50"] - (vals[lo] + (vals[hi] - vals[lo]) * (h - int(h)))) < 1e-9
        assert r["n"] == len(vals)


def test_chunked_equals_plain_on_a_wide_frame(spark):
    """Bounds need fewer columns than the window: both must see one chunking."""
    li = table(spark, SF_BIG, "lineitem")
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")]

    def run(limit):
        return with_neighbors(li, [], order, nxt={"n": "l_extendedprice"}, prev={"p": "l_extendedprice"}, number="rn",
                              max_group_rows=limit, chunk_rows=50_000)
    plain, chunked = run(None), run(1000)
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0
    assert chunked.select("rn").distinct().count() == li.count()


def test_skewed_targets_at_scale(spark):
    """Every column of every target, batch and incremental, with a third of the feed on one key."""
    from tidemark.functions.cdc import standardize
    from tidemark.operators import merge
    from tidemark.plans.q_core import skewed_events
    from tidemark.session import scratch_dir
    from tidemark.sources.feeds import EVENTS_SPEC
    from tidemark.streaming.incremental import IncrementalTarget

    ev = skewed_events(spark, SF_BIG)
    for mode in ("hard", "soft"):
        spec = EVENTS_SPEC.with_(delete_mode=mode)
        std = standardize(ev, spec)
        plain, hot = merge.scd_targets(std, spec, None), merge.scd_targets(std, spec, 2000)
        for scd in (1, 2):
            assert hot[scd].exceptAll(plain[scd]).count() == 0 and plain[scd].exceptAll(hot[scd]).count() == 0
    spec = EVENTS_SPEC
    target = IncrementalTarget(spark, scratch_dir(spark, "skew"), spec, buckets=4, max_group_rows=2000)
    for i in range(2):
        target.apply(ev.filter(F.pmod(F.xxhash64("header__change_seq"), F.lit(2)) == i), i)
    plain = merge.scd_targets(standardize(ev, spec), spec, None)
    for scd in (1, 2):
        got = target.read(scd).select(*plain[scd].columns)
        assert got.exceptAll(plain[scd]).count() == 0 and plain[scd].exceptAll(got).count() == 0


def test_skewed_identities_are_unique(spark):
    from tidemark.operators.patterns import synthetic_identity

    li = table(spark, SF_BIG, "lineitem")
    out = synthetic_identity(li, ["l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber"], max_group_rows=2000, with_hash=False)
    assert out.select("l_returnflag", "l_linestatus", "_dup_no").distinct().count() == li.count()


def test_hot_null_key(spark):
    """A NULL key above the threshold is chunked like any other: every output
    equals that of the plain window."""
    li = table(spark, SF_SMALL, "lineitem").select(F.when(F.col("l_linenumber") > 2, F.lit(None)).otherwise(F.col("l_returnflag")).alias("k"),
                                                   F.when(F.col("l_linenumber") > 1, F.lit(None)).otherwise(F.col("l_linestatus")).alias("k2"),
                                                   "l_orderkey", "l_linenumber", "l_extendedprice", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_quantity")).alias("q"))

    def run(limit):
        return with_neighbors(li, ["k", "k2"], [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")], nxt={"n": "q", "no": "l_orderkey"}, prev={"p": "l_orderkey"},
                              carry={"c": "q"}, number="rn", cumsum={"s": F.coalesce("q", F.lit(0))}, max_group_rows=limit, chunk_rows=300)
    plain, chunked = run(None), run(200)
    assert chunked.columns == plain.columns
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0
    assert chunked.groupBy("k", "k2").agg(F.count_if(~F.col("_has_next")).alias("ends")).filter("ends != 1").count() == 0
