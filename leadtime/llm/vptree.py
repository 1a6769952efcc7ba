"""Nearest neighbours by vantage-point trees, one per shard of vectors.

Largest inner product becomes smallest distance by one more coordinate, so
that the triangle inequality holds: a subtree is skipped if no point in it can be
nearer than the neighbours found so far. ``factor`` relaxes the rule: bounds are
multiplied by it, which skips more; with factor 1 the search is exact. A task searches the trees of a
few shards for a block of queries, so neither all vectors nor all queries
ever meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.llm.common import cut_lineage

#: Vectors of a tree and of a leaf, trees of a task, queries of a block.
TREE, LEAF, TREES_PER_TASK, BLOCK = 4096, 128, 2, 1024


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim) of vectors that take part: an id, finite components, not all zero, no NULL inside."""
    v = F.col(vector).cast("array<double>")
    good = (F.col(key).isNotNull() & F.col(vector).isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return vectors.where(good).select(F.col(key).cast("long").alias("id"), v.alias("v"), F.size(vector).alias("dim"))


def build_tree(points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Order of the points and the nodes of their tree.

    A node is (first, end, vantage row, inner node, outer node, and the least and
    greatest distance from the vantage point to each half). A leaf has no children. Halves are cut by rank, so that
    equal points do not stop the splitting.
    """
    order = np.arange(len(points))
    nodes: list[list[int]] = []
    bounds: list[list[float]] = []
    todo = [(0, len(points), None)]
    while todo:
        first, end, parent = todo.pop()
        if parent is not None:
            nodes[parent[0]][parent[1]] = len(nodes)
        me = len(nodes)
        nodes.append([first, end, -1, -1, -1])
        bounds.append([0.0, 0.0, 0.0, 0.0])
        if end - first <= leaf:
            continue
        part = order[first:end]
        center = points[part].mean(0)
        vantage = part[np.argmax(((points[part] - center) ** 2).sum(1))]  # a point at the rim splits best
        d = np.sqrt(np.maximum(((points[part] - points[vantage]) ** 2).sum(1), 0))
        by = np.argsort(d, kind="stable")
        order[first:end] = part[by]
        d, half = d[by], (end - first) // 2
        nodes[me][2] = vantage
        bounds[me] = [d[0], d[half - 1], d[half], d[-1]]
        todo += [(first, first + half, (me, 3)), (first + half, end, (me, 4))]
    return {"order": order, "nodes": np.array(nodes, np.int64), "bounds": np.array(bounds)}


def exact_scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component in order: the same for equal vectors wherever they stand."""
    columns = np.ascontiguousarray(points.T)
    total = np.zeros((len(queries), len(points)))
    step = np.empty_like(total)
    for i in range(points.shape[1]):
        np.multiply(queries[:, i:i + 1], columns[i], out=step)
        total += step
    return total


class Search:
    """The neighbours found so far for a block of queries, over one tree after another."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.ids, self.queries, self.k, self.factor = ids, queries, k, factor
        self.found_ids = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.full((len(ids), k), -np.inf)
        self.visited = 0

    def run(self, ids: np.ndarray, points: np.ndarray, tree: dict[str, np.ndarray], top: float) -> None:
        """``top``: the largest norm of all vectors, which makes distances of inner products comparable."""
        norms = (points ** 2).sum(1)
        wide = np.hstack([points, np.sqrt(np.maximum(top * top - norms, 0))[:, None]])
        wide_queries = np.hstack([self.queries, np.zeros((len(self.queries), 1))])
        own = (self.queries ** 2).sum(1)
        todo = [(0, np.arange(len(self.ids)), np.zeros(len(self.ids)))]
        while todo:
            node, who, bound = todo.pop()
            # the distance of the k-th neighbour, as a bound on what can still be useful; a little slack keeps ties
            reach = np.sqrt(np.maximum(own[who] + top * top - 2 * self.found[who, -1], 0)) * (1 + 1e-9) + 1e-9
            who = who[bound * self.factor <= reach]
            if not len(who):
                continue
            first, end, vantage, inner, outer = tree["nodes"][node]
            if vantage < 0:
                self._leaf(who, ids[tree["order"][first:end]], points[tree["order"][first:end]])
                continue
            d = np.sqrt(np.maximum(own[who] + top * top - 2 * (wide_queries[who] @ wide[vantage]), 0))
            a, b, c, e = tree["bounds"][node]
            near_in, near_out = np.maximum(0, np.maximum(a - d, d - b)), np.maximum(0, np.maximum(c - d, d - e))
            halves = [(outer, who, near_out), (inner, who, near_in)]  # the last is searched first: the one nearer to most queries
            todo += halves if 2 * (near_in <= near_out).sum() >= len(who) else halves[::-1]

    def _leaf(self, who: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        self.visited += len(who) * len(ids)
        for part in np.array_split(who, -(-len(who) // 256)):
            scores = exact_scores(self.queries[part], points)
            scores[self.ids[part][:, None] == ids] = -np.inf
            hit = (scores >= self.found[part, -1:]).any(1)
            some = part[hit]
            scores = np.hstack([self.found[some], scores[hit]])
            names = np.hstack([self.found_ids[some], np.broadcast_to(ids, (len(some), len(ids)))])
            best = np.lexsort((names, -scores), axis=-1)[:, :self.k]
            self.found[some], self.found_ids[some] = np.take_along_axis(scores, best, 1), np.take_along_axis(names, best, 1)


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, factor: float = 1.0,
            tree: int = TREE, trees_per_task: int = TREES_PER_TASK, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row whose key is divisible by ``every``.

    Vectors of different lengths never meet. Rows with one key are each a candidate
    for others, never for each other; of a repeated query key one row (the smallest vector) asks. Equal scores
    go by the smaller id.
    """
    points = cut_lineage(usable(vectors, key, vector), "vectors")
    facts = points.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("top")).first()
    shards = max(1, -(-facts["n"] // tree))
    groups, blocks = max(1, -(-shards // trees_per_task)), max(1, -(-(facts["n"] // every + 1) // block))
    top = (facts["top"] or 0.0) * (1 + 1e-12)
    shard = F.pmod(F.xxhash64("id", F.lit("shard"), "v"), F.lit(shards)).cast("int")

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x = np.stack(pdf["v"].to_numpy())
        wide = np.hstack([x, np.sqrt(np.maximum(top * top - (x ** 2).sum(1), 0))[:, None]])
        t = build_tree(wide)
        return pd.DataFrame([{"dim": pdf["dim"].iloc[0], "shard": pdf["shard"].iloc[0], "ids": pdf["id"].to_numpy(np.int64).tobytes(), "points": x.tobytes(),
                              "nodes": t["nodes"].tobytes(), "bounds": t["bounds"].tobytes(), "order": t["order"].tobytes()}])

    trees = cut_lineage(points.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(
        index, "dim int, shard int, ids binary, points binary, nodes binary, bounds binary, order binary"), "vp-trees")
    asked = points.where(F.col("id") % every == 0).groupBy("dim", "id").agg(F.min("v").alias("v"))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int"))
             .select("dim", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "id", "v"))
    dealt = (trees.withColumn("grp", F.pmod("shard", F.lit(groups)))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def search(asked_part: pd.DataFrame, tree_part: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(asked_part) and len(tree_part):
            asked_part = asked_part.sort_values("id")
            found = Search(asked_part["id"].to_numpy(np.int64), np.stack(asked_part["v"].to_numpy()), k, factor)
            for t in tree_part.sort_values("shard").itertuples():
                ids = np.frombuffer(t.ids, np.int64)
                found.run(ids, np.frombuffer(t.points).reshape(len(ids), -1),
                          {"order": np.frombuffer(t.order, np.int64), "nodes": np.frombuffer(t.nodes, np.int64).reshape(-1, 5),
                           "bounds": np.frombuffer(t.bounds).reshape(-1, 4)}, top)
            row, at = np.nonzero(np.isfinite(found.found))
            out = {"query_id": found.ids[row], "vec_id": found.found_ids[row, at], "score": found.found[row, at]}
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = asked.groupBy("dim", "block", "grp").cogroup(dealt.groupBy("dim", "block", "grp")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
