"""Nearest neighbours by inner product: a forest of random-projection trees.

Vectors get one more component that brings all of them to the largest norm, so
the largest inner product is the smallest angle.  Every inner node of a tree
splits by the direction between two random sample vectors, at the sample's
median.  The trees are fitted on a bounded sample; every vector is then routed
to its leaf in each tree.

A query descends all trees at once through one priority queue, ordered by the
smallest margin on the way, and visits the ``probes`` best leaves.  How many
that are is calibrated on the sample, for a target recall against brute
force: data without structure needs many, clustered data few.  Leaf
candidates are scored exactly.

Equal vectors form a class that is indexed and searched once; a class keeps
its smallest ids, which is all that a result can show.  Leaves and their
queries are cut into cells of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.llm.common import stored

SAMPLE = 20_000
TREES = 8
LEAF_SAMPLE = 256  # sample vectors a leaf holds, at least
TARGET_RECALL = 0.96
CALIBRATION_QUERIES = 150
CELL_VECTORS, CELL_QUERIES = 16_384, 4_096


class Forest:
    """Directions and thresholds of complete binary trees of one depth, node 1
    the root, children of i at 2i and 2i+1."""

    def __init__(self, sample: np.ndarray, norm: float, trees: int = TREES, seed: int = 7):
        self.norm = norm
        self.depth = max(0, int(np.log2(max(1, len(sample) / LEAF_SAMPLE))))
        size = 1 << self.depth
        lifted = self.lift(sample)
        rng = np.random.default_rng(seed)
        self.way = np.zeros((trees, size, lifted.shape[1]))
        self.cut = np.zeros((trees, size))
        for t in range(trees):
            held = {1: np.arange(len(sample))}
            for node in range(1, size):
                at = held.pop(node)
                for _ in range(8):
                    if len(at) < 2:
                        break
                    i, j = rng.choice(at, 2, replace=False)
                    line = lifted[i] - lifted[j]
                    length = np.linalg.norm(line)
                    if length > 0:
                        self.way[t, node] = line / length
                        self.cut[t, node] = np.median(lifted[at] @ self.way[t, node])
                        break
                right = lifted[at] @ self.way[t, node] >= self.cut[t, node]
                held[2 * node], held[2 * node + 1] = at[~right], at[right]
        self.probes = trees * size

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm ** 2 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree: (vectors, trees)."""
        lifted = self.lift(x)
        out = np.ones((len(x), len(self.way)), dtype=np.int64)
        for t in range(len(self.way)):
            for _ in range(self.depth):
                node = out[:, t]
                right = (lifted * self.way[t, node]).sum(axis=1) >= self.cut[t, node]
                out[:, t] = 2 * node + right
        return out

    def visits(self, q: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
        """For each query, the (tree, leaf) pairs in the order of one shared
        priority queue, ``probes`` of them."""
        scaled = q * (self.norm / np.linalg.norm(q, axis=1))[:, None]
        scaled = np.column_stack([scaled, np.zeros(len(q))])
        trees, size, dim = self.way.shape
        margins = (scaled @ self.way.reshape(trees * size, dim).T).reshape(len(q), trees, size) - self.cut
        out = []
        for margin in margins.tolist():
            queue = [(float("-inf"), t, 1) for t in range(trees)]
            found = []
            while queue and len(found) < probes:
                worst, t, node = heapq.heappop(queue)
                if node >= size:
                    found.append((t, node))
                    continue
                m = margin[t][node]
                heapq.heappush(queue, (max(worst, m), t, 2 * node))
                heapq.heappush(queue, (max(worst, -m), t, 2 * node + 1))
            out.append(found)
        return out

    def calibrate(self, sample: np.ndarray, k: int, target: float, queries: int) -> int:
        """Least number of probes whose mean recall over sample queries
        reaches the target."""
        own = self.leaves(sample)
        step = max(1, len(sample) // queries)
        asked = np.arange(0, len(sample), step)
        every = self.way.shape[0] * self.way.shape[1]
        gained = np.zeros(every + 1)
        counted = 0
        for i, order in zip(asked, self.visits(sample[asked], every)):
            score = sample @ sample[i]
            score[i] = -np.inf
            best = np.argsort(-score, kind="stable")[:min(k, len(sample) - 1)]
            if not len(best):
                continue
            place = {leaf: p for p, leaf in enumerate(order)}
            for v in best:
                p = min(place.get((t, leaf), every) for t, leaf in enumerate(own[v]))
                gained[p] += 1 / len(best)
            counted += 1
        share = np.cumsum(gained[:every]) / max(1, counted)
        return int(min(every, np.searchsorted(share, target) + 1))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed in order of
    the components, so a pair scores the same wherever it is met."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def best_in_cell(qid, q, vid, v, keep: int) -> pd.DataFrame:
    """The ``keep`` best candidates of each query of a cell, ties to smaller ids."""
    out = []
    for at in range(0, len(q), 512):
        block = q[at:at + 512]
        rough = block @ v.T
        if v.shape[0] > keep:
            edge = np.partition(rough, -keep, axis=1)[:, -keep]
            slack = 1e-9 * (1 + np.abs(edge))
            i, j = np.nonzero(rough >= (edge - slack)[:, None])
        else:
            i, j = np.nonzero(np.ones_like(rough, dtype=bool))
        score = dot(block[i], v[j])
        order = np.lexsort((vid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        start = np.searchsorted(i, np.arange(len(block)))
        fine = np.arange(len(i)) - start[i] < keep
        out.append(pd.DataFrame({"q": qid[at + i[fine]], "v": vid[j[fine]], "score": score[fine]}))
    return pd.concat(out)


def stacked(column) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column])


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, e, e as doubles) of the rows that take part."""
    e = F.col("e")
    ok = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x)
                                    & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    return (vectors.select(vectors[id_col].cast("long").alias("id"),
                           vectors[vector_col].cast("array<double>").alias("e"))
            .where(F.col("id").isNotNull() & F.col("e").isNotNull()).where(ok))


def forest_search(vectors: DataFrame, k: int = 20, query_every: int = 20, sample_rows: int = SAMPLE,
                  trees: int = TREES, target: float = TARGET_RECALL, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by
    ``query_every``, its ``k`` nearest other rows by inner product, ties to
    the smaller id.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    rows with a null id, and vectors whose length is not the table's most
    common one (ties to the longer) take no part.  A row repeated with the same id
    and vector counts once.  An empty table gives no rows; other columns are
    not read.
    """
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vector_col)
    size = F.size("e")
    top = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(size == top["d"]).distinct()
    keep = k + 1  # a query may find itself

    # classes of equal vectors, named by their smallest id
    classes = stored(rows.groupBy("e").agg(F.min("id").alias("cid")), "vector-classes")
    named = stored(rows.join(classes, "e").select("id", "cid"), "vector-ids")
    least = Window.partitionBy("cid").orderBy("id")
    members = (named.withColumn("r", F.row_number().over(least)).where(F.col("r") <= keep).select("cid", "id"))

    norm2 = classes.agg(F.max(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    sample = (classes.orderBy(F.xxhash64("cid"), "cid").limit(sample_rows)).toPandas()  # bounded by sample_rows
    points = stacked(sample["e"])
    forest = Forest(points, float(norm2) ** 0.5 * (1 + 1e-12), trees)
    forest.probes = forest.calibrate(points, k, target, CALIBRATION_QUERIES)
    shared = spark.sparkContext.broadcast(forest)  # trees * 2^depth directions, bounded by the sample

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = shared.value.leaves(stacked(b["e"])) if len(b) else np.zeros((0, trees), dtype=np.int64)
            yield pd.DataFrame({"cid": b["cid"], "leaves": list(at)})

    leaves = classes.mapInPandas(place, "cid long, leaves array<long>")
    placed = leaves.select("cid", F.posexplode("leaves").alias("tree", "leaf"))
    asked = stored(named.where(F.col("id") % query_every == 0).select("cid").distinct()
                   .join(classes, "cid"), "query-classes")

    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = shared.value
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                found = f.visits(stacked(part["e"]), f.probes)
                yield pd.DataFrame({"cid": part["cid"], "tree": [[t for t, _ in x] for x in found],
                                    "leaf": [[n for _, n in x] for x in found]})

    visits = (asked.mapInPandas(seek, "cid long, tree array<int>, leaf array<long>")
              .select("cid", F.explode(F.arrays_zip("tree", "leaf")).alias("z"))
              .select("cid", F.col("z.tree").alias("tree"), F.col("z.leaf").alias("leaf")))
    placed, visits = stored(placed, "placed"), stored(visits, "visits")

    # leaves and their queries in cells of bounded size; the counts are a table of trees * 2^depth rows
    counts = (placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
              .join(visits.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("m")), ["tree", "leaf"])
              .select("tree", "leaf", F.ceil(F.col("n") / CELL_VECTORS).cast("int").alias("nv"),
                      F.ceil(F.col("m") / CELL_QUERIES).cast("int").alias("nq")))
    counts = F.broadcast(stored(counts, "cells"))
    sides = []
    for side, mine, other, vectors_of in ((placed, "nv", "nq", classes), (visits, "nq", "nv", asked)):
        own = F.pmod(F.xxhash64("cid"), F.col(mine)).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        cut = side.join(counts, ["tree", "leaf"]).select("tree", "leaf", "cid", own.alias("own"), spread.alias("across"))
        sides.append(cut.join(vectors_of, "cid"))
    left = sides[1].select("tree", "leaf", F.col("own").alias("a"), F.col("across").alias("b"), "cid", "e")
    right = sides[0].select("tree", "leaf", F.col("across").alias("a"), F.col("own").alias("b"), "cid", "e")

    def search(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(held):
            return pd.DataFrame({"q": [], "v": [], "score": []}).astype({"q": "int64", "v": "int64"})
        return best_in_cell(queries["cid"].to_numpy(), stacked(queries["e"]),
                            held["cid"].to_numpy(), stacked(held["e"]), keep)

    keys = ["tree", "leaf", "a", "b"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInPandas(search, "q long, v long, score double"))
    by_q = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    near = (found.groupBy("q", "v").agg(F.max("score").alias("score"))
            .withColumn("r", F.row_number().over(by_q)).where(F.col("r") <= keep))
    # classes to their smallest ids, best k + 1 ids of each query class
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ids = (near.join(members, F.col("v") == F.col("cid")).select("q", "id", "score")
           .withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= keep)
           .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("best")))
    queries = named.where(F.col("id") % query_every == 0).withColumnRenamed("id", "query_id")
    best = F.filter("best", lambda x: x["id"] != F.col("query_id"))
    return (queries.join(ids, F.col("cid") == F.col("q"))
            .select("query_id", F.posexplode(F.slice(best, 1, k)).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"),
                    F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))
