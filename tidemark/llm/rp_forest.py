"""Approximate nearest neighbours by cosine: a forest of random-projection
trees, searched through one priority queue, then exact reranking.

* Equal vectors form one class (a third of all rows may be copies of one
  vector); a class keeps its ``k + 1`` smallest ids, which is all that a top-k
  with ties to smaller ids can use.  Trees, search and reranking work on
  classes.
* A tree splits along one random direction per level.  The upper levels split
  every node at the median of a bounded sample (``sample_rows`` classes, fewer
  for very long vectors); deeper levels, which the sample cannot resolve,
  split at the sample's median of the whole level.  So the broadcast model is
  bounded while the depth follows the number of classes (about ``leaf_rows``
  of them per leaf).  Every class is in one leaf of every tree.
* The queue of a query holds the open nodes of all trees; the cost of a node
  is the sum of the squared distances to the planes that separate the query
  from it.  The nearest ``visits`` leaves of the whole forest are searched.
* ``visits`` is measured: ``calibration`` query classes are compared with
  every class, and the visits that find a share ``recall`` of their true
  neighbours are used for all.  On directionless data (independent normal
  components) that is a good part of the forest; no forest can do better there.
* Leaves and their queries meet in blocks: a leaf with more than
  ``block_rows`` classes or queries is dealt into several, and every block of
  one side meets every block of the other.  A block yields each query's best
  ``k + 1`` classes by the exact cosine, summed in the order of the components
  in double precision, so that a pair has one score wherever it is met.

Defined cases: rows whose id is null, or whose vector is null, empty, zero or
holds null or non-finite components take no part, nor do vectors that do not
have the commonest length; of rows that repeat an id, the one whose vector has
the smallest digest counts.  A query with fewer than ``k`` candidates in its
leaves has fewer rows.  An empty table gives an empty result.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import checked_broadcast
from .common import map_arrow, ship, written

#: Bytes of the sample that the driver receives, whatever the vectors' length.
SAMPLE_BYTES = 64 << 20
#: Sample points per node at the deepest level that is split by node.
NODE_POINTS = 16
#: Scores this close to a block's cut are compared exactly.
NEAR = 1e-9
#: Queries of a block that are multiplied at once.
SLICE = 256


@dataclass
class Forest:
    """``directions[dim, tree * depth + level]``, node medians of the upper
    ``fitted`` levels per tree, one median per tree and deeper level."""

    directions: np.ndarray
    node_cuts: np.ndarray   # [tree, 2^fitted - 1]
    level_cuts: np.ndarray  # [tree, depth]
    trees: int
    depth: int
    fitted: int

    def project(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.directions).reshape(len(unit), self.trees, self.depth)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        out, at = np.zeros((len(unit), self.trees), np.int64), self.project(unit)
        for t in range(self.trees):
            for level in range(self.depth):
                cut = self.node_cuts[t][(1 << level) - 1 + out[:, t]] if level < self.fitted else self.level_cuts[t, level]
                out[:, t] = 2 * out[:, t] + (at[:, t, level] > cut)
        return out

    def leaves(self, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """Leaves ``(tree, code)`` of the forest, nearest first, for one
        query's projections: one queue over all trees."""
        at, depth = at.tolist(), self.depth
        nodes, levels = self.node_cuts.tolist(), self.level_cuts.tolist()
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        while queue:
            cost, t, level, code = heapq.heappop(queue)
            while level < depth:
                margin = at[t][level] - (nodes[t][(1 << level) - 1 + code] if level < self.fitted else levels[t][level])
                side = margin > 0
                heapq.heappush(queue, (cost + margin * margin, t, level + 1, 2 * code + (not side)))
                code, level = 2 * code + side, level + 1
            yield t, code


def fit(sample: np.ndarray, rows: int, trees: int, leaf_rows: int, seed: int) -> Forest:
    """A forest for about ``rows`` unit vectors, fitted on ``sample``."""
    depth = min(40, max(1, math.ceil(math.log2(max(rows, 1) / leaf_rows)) if rows > leaf_rows else 1))
    fitted = min(depth, max(0, int(math.log2(max(len(sample), 1) / NODE_POINTS)) if len(sample) > NODE_POINTS else 0))
    directions = np.random.default_rng(seed).standard_normal((sample.shape[1], trees * depth))
    directions /= np.linalg.norm(directions, axis=0)
    forest = Forest(directions, np.zeros((trees, (1 << fitted) - 1)), np.zeros((trees, depth)), trees, depth, fitted)
    at = forest.project(sample)
    forest.level_cuts = np.median(at, axis=0)
    for t in range(trees):
        code = np.zeros(len(sample), np.int64)
        for level in range(fitted):
            for node in range(1 << level):
                here = at[code == node, t, level]
                forest.node_cuts[t][(1 << level) - 1 + node] = np.median(here) if len(here) else forest.level_cuts[t, level]
            code = 2 * code + (at[:, t, level] > forest.node_cuts[t][(1 << level) - 1 + code])
    return forest


# ---- exact scores ----------------------------------------------------------------

def doubles(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch as doubles; extreme magnitudes are brought near 1,
    which leaves a cosine as it is."""
    out = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    top = np.abs(out).max(axis=1, initial=0.0)
    far = (top > 1e100) | (top < 1e-100)
    if far.any():
        out[far] /= top[far][:, None]
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, each sum taken in the order of the components."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        aa += a[:, j] * a[:, j]
        bb += b[:, j] * b[:, j]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def block_best(queries: np.ndarray, vectors: np.ndarray, first_ids: np.ndarray, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every query its ``keep`` best rows of ``vectors``, ties to the
    smaller first id: ``(query, rows, scores)``."""
    uq, uv = unit(queries), unit(vectors)
    for lo in range(0, len(uq), SLICE):
        near = uq[lo:lo + SLICE] @ uv.T
        if near.shape[1] > keep:
            cut = np.partition(near, -keep, axis=1)[:, -keep] - NEAR
        else:
            cut = np.full(len(near), -np.inf)
        at_q, at_v = np.nonzero(near >= cut[:, None])
        scores = cosines(queries[lo + at_q], vectors[at_v])
        order = np.lexsort((first_ids[at_v], -scores, at_q))
        at_q, at_v, scores = at_q[order], at_v[order], scores[order]
        starts = np.searchsorted(at_q, np.arange(len(near) + 1))
        for i in range(len(near)):
            s = slice(starts[i], min(starts[i + 1], starts[i] + keep))
            yield lo + i, at_v[s], scores[s]


# ---- classes ---------------------------------------------------------------------

def classes(table: DataFrame, is_query: Column, keep: int, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, int]:
    """``(key, vec, ids, asked)`` per distinct vector and ``(query_id, key)``
    per query, both written; the vectors' length."""
    raw = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ok = raw.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0))
    sizes = ok.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0
    ok = ok.filter(F.size("vec") == dim).withColumn("key", F.md5(F.concat_ws(",", F.transform("vec", lambda v: v.cast("string")))))
    ids = written(ok.groupBy("id").agg(F.min("key").alias("key"), F.max("asked").alias("asked")), "vector-ids")
    smallest = (ids.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("_r") <= keep)
                .groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = ids.filter("asked").select("key", F.col("asked")).distinct()
    vectors = ok.groupBy("key").agg(F.first("vec").alias("vec"))
    found = vectors.join(smallest, "key").join(asked, "key", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return written(found, "vector-classes"), ids.filter("asked").select(F.col("id").alias("query_id"), "key"), dim


def _placed(batches, forest: Forest, dim: int, bare: bool):
    for b in batches:
        codes = forest.codes(unit(doubles(b.column("vec"), dim))) if b.num_rows else np.zeros((0, forest.trees), np.int64)
        rows = np.repeat(np.arange(b.num_rows), forest.trees)
        tree = pa.array(np.tile(np.arange(forest.trees), b.num_rows).astype(np.int32))
        cols = [tree, pa.array(codes.reshape(-1))]
        yield pa.RecordBatch.from_arrays(cols if bare else cols + [b.column(c).take(pa.array(rows)) for c in ("key", "vec", "ids")],
                                         names=["tree", "leaf"] + ([] if bare else ["key", "vec", "ids"]))


def _visits(batches, forest: Forest, dim: int, visits: int):
    for b in batches:
        if not b.num_rows:
            continue
        at = forest.project(unit(doubles(b.column("vec"), dim)))
        rows, trees, leaves = [], [], []
        for i in range(b.num_rows):
            for _, (t, code) in zip(range(visits), forest.leaves(at[i])):  # noqa: B905 - the shorter of the two
                rows.append(i)
                trees.append(t)
                leaves.append(code)
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int32()), pa.array(leaves, pa.int64()), b.column("key").take(take),
                                          b.column("vec").take(take)], names=["tree", "leaf", "key", "vec"])


# ---- calibration -----------------------------------------------------------------

def _scan(batches, queries: list[tuple[str, list[float]]], forest: Forest, dim: int, keep: int):
    """Each task's best classes for every sample query, with their leaves."""
    asked = doubles(pa.array([v for _, v in queries]), dim)
    best: dict[int, list] = {i: [] for i in range(len(queries))}
    for b in batches:
        if not b.num_rows:
            continue
        vectors = doubles(b.column("vec"), dim)
        codes, keys = forest.codes(unit(vectors)), b.column("key").to_pylist()
        for i, rows, scores in block_best(asked, vectors, np.arange(len(vectors)), keep):
            best[i] += [(float(s), keys[r], codes[r].tolist()) for r, s in zip(rows, scores, strict=True) if keys[r] != queries[i][0]]
            best[i] = heapq.nlargest(keep, best[i])
    rows = [(i, *x) for i, found in best.items() for x in found]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (
        pa.int32(), pa.float64(), pa.string(), pa.list_(pa.int64())), strict=True)], names=["q", "score", "key", "leaves"])


def measure_visits(found: DataFrame, forest: Forest, dim: int, k: int, recall: float, calibration: int) -> int:
    """Leaves to visit so that ``recall`` of the true neighbours of at most
    ``calibration`` query classes are among the candidates."""
    sample = [(r["key"], list(r["vec"])) for r in found.filter("asked").orderBy("key").limit(calibration).select("key", "vec").collect()]
    if not sample:
        return forest.trees
    scanned = map_arrow(found.select("key", "vec"), partial(_scan, queries=sample, forest=forest, dim=dim, keep=k), "q int, score double, key string, leaves array<long>")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    truth: dict[int, list] = {}
    for r in scanned.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).collect():  # calibration * k rows
        truth.setdefault(r["q"], []).append(r["leaves"])
    at = forest.project(unit(doubles(pa.array([v for _, v in sample]), dim)))
    open_leaves = {(q, j): set(enumerate(leaves)) for q, found_ in truth.items() for j, leaves in enumerate(found_)}
    wanted, visits = math.ceil(recall * len(open_leaves)), 0
    missing, walks = dict(open_leaves), {q: forest.leaves(at[q]) for q in truth}
    by_query = {q: [(q, j) for j in range(len(x))] for q, x in truth.items()}
    while len(open_leaves) - len(missing) < wanted:
        visits += 1
        for q, walk in walks.items():
            leaf = next(walk, None)
            for pair in by_query[q]:
                if pair in missing and leaf in missing[pair]:
                    del missing[pair]
    return max(visits, forest.trees)


# ---- search ----------------------------------------------------------------------

_FOUND = "qkey string, key string, score double, ids array<long>"


def _leaf(queries: pd.DataFrame, vectors: pd.DataFrame, keep: int) -> pd.DataFrame:
    rows: list[tuple] = []
    if len(queries) and len(vectors):
        dim = len(vectors["vec"].iloc[0])
        q, v = (doubles(pa.array(np.concatenate(list(x["vec"])).reshape(-1, dim).tolist()), dim) for x in (queries, vectors))
        ids, keys, qkeys = list(vectors["ids"]), vectors["key"].to_numpy(), queries["key"].to_numpy()
        for i, at, scores in block_best(q, v, np.array([x[0] for x in ids]), keep):
            rows += [(qkeys[i], keys[j], float(s), list(map(int, ids[j]))) for j, s in zip(at, scores, strict=True)]
    return pd.DataFrame(rows, columns=["qkey", "key", "score", "ids"])


def _dealt(df: DataFrame, crowded: DataFrame, mine: str, other: str) -> DataFrame:
    """Rows dealt to the blocks of their leaf: one block of their own side,
    every block of the other."""
    spread = df.join(checked_broadcast(crowded), ["tree", "leaf"], "left")
    own = F.pmod(F.xxhash64("key"), F.coalesce(F.col(mine), F.lit(1)).cast("long")).alias(f"_{mine}")
    return spread.withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), F.lit(1)).cast("long") - 1))).select("*", own)


def search(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = 8,
           leaf_rows: int = 512, recall: float = 0.96, calibration: int = 128, sample_rows: int = 16_384, block_rows: int = 4096,
           seed: int = 13) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: the ``k`` nearest candidates found
    for every row that ``is_query`` marks, among all other rows."""
    spark, keep = table.sparkSession, k + 1
    ship(spark)
    found, asked, dim = classes(table, is_query, keep, id_col, vector_col)
    rows = found.count()
    limit = min(sample_rows, SAMPLE_BYTES // (8 * max(dim, 1)))
    sample = [r["vec"] for r in found.orderBy("key").limit(limit).select("vec").collect()]
    sample_units = unit(doubles(pa.array(sample), dim)) if sample else np.zeros((0, max(dim, 1)))
    if not sample:  # no vector takes part
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias(id_col), F.lit(0.0).alias("score")).filter(F.lit(False))
    forest = fit(sample_units, rows, trees, leaf_rows, seed)
    visits = measure_visits(found, forest, dim, k, recall, calibration)
    vec_type = found.schema["vec"].dataType.simpleString()
    id_type = found.schema["ids"].dataType.elementType.simpleString()

    tours = written(map_arrow(found.filter("asked").select("key", "vec"), partial(_visits, forest=forest, dim=dim, visits=visits),
                              f"tree int, leaf long, key string, vec {vec_type}"), "visits")
    sizes = map_arrow(found.select("vec"), partial(_placed, forest=forest, dim=dim, bare=True), "tree int, leaf long").groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("c"))
    calls = tours.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("q"))
    crowded = written(sizes.join(calls, ["tree", "leaf"]).select("tree", "leaf", F.ceil(F.col("c") / block_rows).alias("vectors"),
                                                                  F.ceil(F.col("q") / block_rows).alias("queries"))
                      .filter("vectors > 1 or queries > 1"), "crowded-leaves")
    placed = map_arrow(found.select("key", "vec", "ids"), partial(_placed, forest=forest, dim=dim, bare=False),
                       f"tree int, leaf long, key string, vec {vec_type}, ids array<{id_type}>")
    at = ["tree", "leaf", "_queries", "_vectors"]
    q = _dealt(tours, crowded, "queries", "vectors").select(*at, "key", "vec")
    v = _dealt(placed, crowded, "vectors", "queries").select(*at, "key", "vec", "ids")
    met = q.groupBy(*at).cogroup(v.groupBy(*at)).applyInPandas(lambda a, b: _leaf(a, b, keep), _FOUND.replace("array<long>", f"array<{id_type}>"))
    # A pair that several trees find has one score, so its rows tie.
    near = F.dense_rank().over(Window.partitionBy("qkey").orderBy(F.desc("score"), F.col("ids")[0]))
    best = met.withColumn("_r", near).filter(F.col("_r") <= keep).dropDuplicates(["qkey", "key"])
    listed = best.select(F.col("qkey").alias("key"), F.explode("ids").alias("id"), "score").groupBy("key").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), F.col("id")))), 1, keep).alias("near"))
    told = asked.join(listed, "key").select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    return told.select("query_id", F.posexplode("near").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias(id_col), (-F.col("x.far")).alias("score"))
