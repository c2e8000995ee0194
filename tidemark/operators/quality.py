"""Data-quality expectations, quarantine and reprocessing.

A rule is a boolean Column that is true for good rows, with an action:
``warn`` (keep and count), ``drop`` (route to quarantine and count) or
``fail`` (stop the load when any row violates it).  Evaluation is one
projection; the report is one aggregate with a ``count_if`` per rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..streaming import fs


@dataclass(frozen=True)
class Rule:
    name: str
    check: Column       # true = the row satisfies the rule
    action: str = "warn"  # warn | drop | fail

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")


class ExpectationFailed(RuntimeError):
    pass


def _violated(r: Rule) -> Column:
    # a NULL check result counts as a violation
    return ~F.coalesce(r.check, F.lit(False))


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``dq_reason`` (failed drop/fail rules, ';'-joined, NULL when
    none), ``dq_warnings`` (failed warn rules) and ``is_valid``."""
    blocking = [F.when(_violated(r), F.lit(r.name)) for r in rules if r.action in ("drop", "fail")]
    warning = [F.when(_violated(r), F.lit(r.name)) for r in rules if r.action == "warn"]
    reason = F.concat_ws(";", *blocking) if blocking else F.lit("")
    warn = F.concat_ws(";", *warning) if warning else F.lit("")
    return (df.withColumn("dq_reason", F.when(reason != "", reason))
              .withColumn("dq_warnings", F.when(warn != "", warn))
              .withColumn("is_valid", F.col("dq_reason").isNull()))


def report(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """Violations per rule (one aggregate pass), as rows."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(_violated(r)).alias(f"_v{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                 F.col(f"_v{i}").cast("bigint").alias("violations")) for i, r in enumerate(rules)]))
    return one.select(F.lit(dataset).alias("dataset"), rows.alias("r"), F.col("_rows").cast("bigint").alias("rows_checked")) \
              .select("dataset", "r.rule", "r.action", "r.violations", "rows_checked")


def enforce(df: DataFrame, rules: list[Rule]) -> None:
    """Raise when a ``fail`` rule has a violation (one small job)."""
    fails = [r for r in rules if r.action == "fail"]
    if not fails:
        return
    cond = _violated(fails[0])
    for r in fails[1:]:
        cond = cond | _violated(r)
    bad = df.filter(cond).limit(1).collect()
    if bad:
        raise ExpectationFailed(f"fail rule violated by {bad[0].asDict()}")


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) from one evaluated frame."""
    ev = evaluate(df, rules)
    return ev.filter(F.col("is_valid")), ev.filter(~F.col("is_valid"))


def backlog(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per reason (a row failing two rules counts for both)."""
    return (quarantine.select(F.explode(F.split(F.col("dq_reason"), ";")).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def reprocess(valid: DataFrame, quarantine: DataFrame, fix) -> DataFrame:
    """Re-emit fixed quarantine rows into the feed (the merge is idempotent,
    so re-emitting rows that were already applied changes nothing)."""
    fixed = fix(quarantine).drop("dq_reason", "dq_warnings", "is_valid")
    return valid.drop("dq_reason", "dq_warnings", "is_valid").unionByName(fixed)


# -- loads with a stored quarantine -------------------------------------------

QUALITY_COLS = ("dq_reason", "dq_warnings", "is_valid")


def quarantine_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}_quarantine"


def load(df: DataFrame, rules: list[Rule], root: str, name: str, load_id: str) -> DataFrame:
    """Load ``df`` into ``<root>/<name>`` and its rejected rows, with their
    reasons, into ``<root>/<name>_quarantine``; returns the rule report.

    One pass: the rows are written once, parted by validity, and the counts
    of every rule are metrics that the same job observes.  The result is
    written aside and moved into both tables only if no ``fail`` rule is
    violated, so a failed load leaves both as they were.  Loading ``load_id``
    again keeps the first result.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    seen = Observation(f"{name}-{load_id}")
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(_violated(r)).alias(f"v{i}") for i, r in enumerate(rules)]]
    staged = f"{root}/_staged/{name}-{load_id}"
    evaluate(df.observe(seen, *metrics), rules).withColumn("_ok", F.col("is_valid")).write.mode("overwrite").partitionBy("_ok").parquet(staged)
    counts = seen.get
    broken = {r.name: counts[f"v{i}"] for i, r in enumerate(rules) if r.action == "fail" and counts[f"v{i}"]}
    if broken:
        fs.delete(spark, staged)
        raise ExpectationFailed(f"load {load_id} of {name}: rows that violate fail rules: {broken}")
    fs.move(spark, f"{staged}/_ok=true", f"{root}/{name}/_load={load_id}")
    fs.move(spark, f"{staged}/_ok=false", f"{quarantine_path(root, name)}/_load={load_id}")
    fs.delete(spark, staged)
    return spark.createDataFrame([(name, r.name, r.action, int(counts[f"v{i}"]), int(counts["rows"])) for i, r in enumerate(rules)],
                                 "dataset string, rule string, action string, violations long, rows_checked long")


def read_loaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}").drop(*QUALITY_COLS)


def read_quarantine(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rejected rows that wait for a fix, with ``dq_reason`` and ``_load``."""
    return spark.read.parquet(quarantine_path(root, name))


def reload_quarantine(spark: SparkSession, rules: list[Rule], root: str, name: str, load_id: str, fix) -> DataFrame:
    """Fix the waiting rows and load them like any others: those that pass
    now go to the table, the rest waits under the new load.  The loads they
    came from are kept in ``<name>_reprocessed``."""
    root, waiting = root.rstrip("/"), quarantine_path(root, name)
    loads = [n for n in fs.list_names(spark, waiting) if n.startswith("_load=") and n != f"_load={load_id}"]
    rows = spark.read.option("basePath", waiting).parquet(*[f"{waiting}/{n}" for n in loads])
    out = load(fix(rows.drop("_load", *QUALITY_COLS)), rules, root, name, load_id)
    for n in loads:
        fs.move(spark, f"{waiting}/{n}", f"{root}/{name}_reprocessed/{n}")
    return out
