"""Hierarchical token budgeting over a domain > language > source tree.

A budget goes down the tree.  Among siblings it is shared by weight, and a
child that cannot use its share (its subtree's tokens times the epochs
allowed) gives the rest back to its siblings; because a node's capacity is
that of its whole subtree, a shortage leaves a family for the ancestors'
siblings only when every sibling is exhausted.  Each leaf then takes whole
seeded epochs of its documents and a token-prefix of one more.

The sibling rule has a closed form: with children ordered by capacity over
weight, ``level_i = (budget - capacities before i) / weights from i on``; the
family's level is the largest of them, and a child gets the lesser of its
capacity and weight times level.  So each tree level is one window over the
node table (one row per domain, language and source), never over documents.

Defined cases: null domain, language or source are nodes named 'other',
'und' and 'unknown'; a null text has no tokens; documents without tokens
follow their place in the leaf's order; rows with the same id tie and are
taken or left together; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

LEVELS = ("domain", "language", "source")


@dataclass(frozen=True)
class MixPlan:
    """Weights are whole numbers; nodes that are not named have weight 1."""
    budget_share: float                      # of all tokens of the input
    max_epochs: int = 1
    seed: str = "mix-1"
    domain_weights: dict = field(default_factory=dict)
    language_weights: dict = field(default_factory=dict)
    source_weights: dict = field(default_factory=dict)

    def weights(self, level: str) -> dict:
        return getattr(self, f"{level}_weights")


#: Production plan of the query; its SQL holds the same numbers.
QUERY_PLAN = MixPlan(0.6, 2, "mix-1", {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1})


def default_domain(source: Column) -> Column:
    """Domain of a source: its number modulo 4 (no number: null)."""
    n = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(n != "", F.concat(F.lit("d"), (F.substring(n, -9, 9).cast("long") % 4).cast("string")))


def document_tokens(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """``doc_id, domain, language, source, n_tokens``; tokens are words."""
    dom = domain if domain is not None else default_domain(F.col("source"))
    return docs.select("doc_id", F.coalesce(dom, F.lit("other")).alias("domain"), F.coalesce("lang", F.lit("und")).alias("language"),
                       F.coalesce("source", F.lit("unknown")).alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))


def _weight(level: str, plan: MixPlan) -> Column:
    out = F.lit(1).cast("long")
    for name, w in plan.weights(level).items():
        out = F.when(F.col(level) == name, F.lit(int(w)).cast("long")).otherwise(out)
    return out


def allocate(leaves: DataFrame, plan: MixPlan) -> DataFrame:
    """``leaves`` (domain, language, source, available) with ``leaf_budget``.

    Three windows over the node table, each partitioned by parent.
    """
    nodes = leaves.withColumn("_cap", F.col("available") * plan.max_epochs)
    total = F.sum("available").over(Window.partitionBy(F.lit(1)))  # over the node table
    budget = nodes.withColumn("_budget", F.least(F.floor(total * plan.budget_share), total * plan.max_epochs))
    for depth, level in enumerate(LEVELS):
        parents, path = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        fam = budget.groupBy(*path, "_budget").agg(F.sum("_cap").alias("_c")).withColumn("_w", _weight(level, plan)).filter("_w > 0")
        by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
        order = by.orderBy(F.col("_c") / F.col("_w"), level)
        before = F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        after = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        fam = (fam.withColumn("_level", (F.col("_budget") - before).cast("double") / after)
               .withColumn("_level", F.max("_level").over(by))
               .withColumn("_share", F.least(F.col("_c"), F.floor(F.col("_w") * F.col("_level")))))
        budget = (budget.drop("_budget").join(fam.select(*path, F.greatest("_share", F.lit(0).cast("long")).alias("_budget")), path))
    return budget.select(*LEVELS, "available", F.col("_budget").alias("leaf_budget"))


def select_tokens(tokens: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per document and epoch taken: ``doc_id, epoch`` and the leaf.

    The partial epoch's order is the MD5 of seed, epoch and id.  Its prefix is
    found in 4096 equal slices of the hash range per leaf: whole slices are
    taken or left by their token sums, and only the slice that holds the
    boundary is ordered by document, so no task orders a whole leaf.
    """
    tok = written(tokens, "mix-tokens")
    leaves = tok.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available"))
    alloc = written(allocate(leaves, plan), "mix-budgets")
    full = F.when(F.col("available") > 0, F.floor(F.col("leaf_budget") / F.col("available"))).otherwise(F.lit(0))
    alloc = alloc.withColumn("_full", F.least(full, F.lit(plan.max_epochs)).cast("long")).withColumn(
        "_rest", F.col("leaf_budget") - F.col("_full") * F.col("available"))
    docs = tok.join(alloc, list(LEVELS))
    cols = ["doc_id", *LEVELS, "n_tokens", "leaf_budget"]
    whole = (docs.filter("_full > 0").select(*cols, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)).alias("epoch")))
    key = F.md5(F.concat_ws(":", F.lit(plan.seed), F.col("_full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    part = docs.filter("_rest > 0").withColumn("_key", key).withColumn("_slice", F.substring("_key", 1, 3))
    sums = part.groupBy(*LEVELS, "_slice", "_rest").agg(F.sum("n_tokens").alias("_n"))
    upto = Window.partitionBy(*LEVELS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (sums.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
            .filter("_start <= _rest").select(*LEVELS, "_slice", "_start", "_end"))
    part = part.join(cuts, [*LEVELS, "_slice"])
    inside = part.filter("_end <= _rest")
    run = Window.partitionBy(*LEVELS, "_slice").orderBy("_key")
    edge = (part.filter("_end > _rest").withColumn("_run", F.col("_start") + F.sum("n_tokens").over(run)).filter("_run <= _rest"))
    return whole.unionByName(inside.select(*cols, F.col("_full").alias("epoch"))).unionByName(
        edge.select(*cols, F.col("_full").alias("epoch")))


def mix(docs: DataFrame, plan: MixPlan) -> DataFrame:
    return select_tokens(document_tokens(docs), plan)
