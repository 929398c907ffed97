"""Approximate nearest neighbours: random-projection trees searched through one priority queue."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import store


class Forest:
    """Trees over a sample. A node holds a plane between two of its points; leaves are numbered per tree."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.trees = [self._grow(sample, leaf, rng) for _ in range(trees)]

    def _grow(self, sample: np.ndarray, leaf: int, rng) -> tuple:
        planes, offsets, children = [], [], []
        todo = [(np.arange(len(sample)), -1, 0)]
        leaves = 0
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(sample[rows], rng) if len(rows) > leaf else None
            if split is None:
                here = -1 - leaves
                leaves += 1
            else:
                normal, offset, right = split
                here = len(planes)
                planes.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                todo += [(rows[~right], here, 0), (rows[right], here, 1)]
            if parent >= 0:
                children[parent][side] = here
        width = sample.shape[1]
        return np.array(planes).reshape(-1, width), np.array(offsets), np.array(children, np.int64).reshape(-1, 2)

    @staticmethod
    def _split(points: np.ndarray, rng):
        """A plane halfway between two points, tried a few times; None where the points are equal."""
        for _ in range(5):
            a, b = points[rng.integers(len(points), size=2)]
            normal = a - b
            if not np.abs(normal).max() > 0:
                continue
            normal = normal / np.linalg.norm(normal)
            side = points @ normal
            offset = float(np.median(side))
            right = side > offset
            if 0 < right.sum() < len(points):
                return normal, offset, right
        return None

    def leaves(self, tree: int, points: np.ndarray) -> np.ndarray:
        planes, offsets, children = self.trees[tree]
        if not len(planes):
            return np.zeros(len(points), np.int64)
        at = np.zeros(len(points), np.int64)
        active = np.arange(len(points))
        while len(active):
            node = at[active]
            right = np.einsum("ij,ij->i", points[active], planes[node]) > offsets[node]
            at[active] = children[node, right.astype(np.int64)]
            active = active[at[active] >= 0]
        return -1 - at

    def search(self, point: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The `visits` most promising (tree, leaf) of the whole forest: every tree feeds one queue."""
        margins = [planes @ point - offsets for planes, offsets, _ in self.trees]
        queue = [(-np.inf, t, 0 if len(p[0]) else -1) for t, p in enumerate(self.trees)]
        found = []
        while queue and len(found) < visits:
            cost, t, node = heapq.heappop(queue)
            if node < 0:
                found.append((t, -1 - node))
                continue
            m = float(margins[t][node])
            near, far = self.trees[t][2][node][:: -1 if m > 0 else 1]
            heapq.heappush(queue, (cost, t, int(near)))
            heapq.heappush(queue, (max(cost, abs(m)), t, int(far)))
        return found


def needed_visits(forest: Forest, points: np.ndarray, ids: np.ndarray, probes: list[tuple[int, np.ndarray]], k: int, recall: float) -> int:
    """Visits with which the probes find this share of their k nearest among `points`, and so at least as much among more rows."""
    leaves = [forest.leaves(t, points) for t in range(len(forest.trees))]
    every = sum(len(planes) + 1 for planes, _, _ in forest.trees)
    turns = []
    for probe, w in probes:
        d = ((points - w) ** 2).sum(1)
        d[ids == probe] = np.inf
        near = np.argsort(d, kind="stable")[:k]
        near = near[np.isfinite(d[near])]
        first = np.full(len(near), every)
        found = forest.search(w, every)
        turn = {at: i + 1 for i, at in enumerate(found)}
        for t, leaf in enumerate(leaves):
            first = np.minimum(first, [turn[t, int(x)] for x in leaf[near]])
        turns.append(first)
    turns = np.sort(np.concatenate([*turns, np.zeros(0, np.int64)]))
    return int(turns[min(len(turns) - 1, int(np.ceil(recall * len(turns))) - 1)]) if len(turns) else 0


def _usable(column: str):
    size = F.size(column)
    return (
        F.col(column).isNotNull()
        & (size > 0)
        & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(column, lambda x: x != 0)
    )


def _close(x: np.ndarray, w: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query, rows that hold its k nearest other ids: by a matrix product, with room for its rounding."""
    every = np.arange(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        xx, ww = (x * x).sum(1), (w * w).sum(1)
        d = xx[:, None] + ww - 2 * (x @ w.T)
        room = 1e-9 * (xx.max() + ww)
    if len(x) <= k + 1 or len(np.unique(ids)) < len(ids) or not np.isfinite(d).all() or not (room > 1e-250).all():
        return [every] * len(w)
    # One more than k, as the query itself may be among them.
    bound = np.partition(d, k, axis=0)[k] + room
    return [np.flatnonzero(d[:, j] <= bound[j]) for j in range(len(w))]


def nearest(
    spark: SparkSession,
    rows: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    trees: int = 4,
    leaf: int = 64,
    visits: int = 80,
    recall: float = 0.95,
    probes: int = 200,
    sample: int = 20_000,
    chunk: int = 4096,
) -> DataFrame:
    """Each query's k nearest rows found: query_id, rank, vec_id, score (Euclidean distance, double).

    The trees are fitted on at most `sample` rows, smallest hash first; every row is indexed in each tree.
    How many leaves a query visits, its best over all trees, is measured: so many that `probes` of the queries find
    the share `recall` of their nearest sampled rows, `visits` at least. Vectors without any structure need a fixed
    share of all leaves, so their work grows with rows times queries; others need less. Leaves of more than `chunk` rows are split by
    hash, each part being searched. Distances are exact, on the given vectors; ties go to the smaller id.
    A query is not its own candidate. Vectors that are null, zero or hold null or non-finite parts, and
    rows without id, take no part; vectors of another length than the most common one do not either.
    Repeated ids count once per distinct vector in the index, and once in a result, at their smallest distance.
    """
    good = rows.where(F.col(key).isNotNull() & _usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = queries.where(F.col(key).isNotNull() & _usable(vector)).select(F.col(key).cast("long").alias("q"), F.col(vector).alias("w"))
    widths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = widths["d"], widths["count"]
    good, asked = good.where(F.size("v") == width), asked.where(F.size("w") == width)
    drawn = good.select("id", "v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(sample).toPandas()
    points = np.array([np.asarray(p, np.float64) for p in drawn["v"]])
    forest = Forest(points, trees, max(2, int(leaf * min(1.0, len(points) / total))))
    tried = [(r["q"], np.asarray(r["w"], np.float64)) for r in asked.orderBy(F.xxhash64("q", "w")).limit(probes).collect()]
    all_visits = max(visits, needed_visits(forest, points, drawn["id"].to_numpy(), tried, k, recall))
    shared = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array([np.asarray(v, np.float64) for v in b["v"]])
                yield pd.concat([b.assign(tree=t, leaf=shared.value.leaves(t, x)) for t in range(trees)])

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for q, w in zip(b["q"], b["w"]):
                found = shared.value.search(np.asarray(w, np.float64), all_visits)
                later = np.arange(len(found)) >= visits
                yield pd.DataFrame({"q": q, "w": [w] * len(found), "tree": [t for t, _ in found], "leaf": [f for _, f in found], "later": later})

    kind = dict(good.dtypes)["v"]
    index = good.mapInPandas(place, f"id long, v {kind}, tree int, leaf long")
    counts = store(spark, index.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("parts")), "ann-leaves")
    index = index.join(counts, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")
    wanted = asked.mapInPandas(visit, f"q long, w {dict(asked.dtypes)['w']}, tree int, leaf long, later boolean")
    wanted = wanted.join(counts, ["tree", "leaf"]).withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts")

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"q": [], "id": [], "score": []}
        if len(left) and len(right):
            x = np.array([np.asarray(v, np.float64) for v in left["v"]])
            ids = left["id"].to_numpy()
            asking, bound = right["q"].to_numpy(), right["bound"].to_numpy()
            for start in range(0, len(right), 256):
                w = np.array([np.asarray(v, np.float64) for v in right["w"].iloc[start : start + 256]])
                for j, near in enumerate(_close(x, w, ids, k)):
                    q = asking[start + j]
                    d = np.sqrt(((x[near] - w[j]) ** 2).sum(1))
                    near, d = near[d <= bound[start + j]], d[d <= bound[start + j]]
                    order = np.lexsort((ids[near], d))
                    order = order[ids[near][order] != q]
                    # Repeated ids are passed over here, so that k different ones remain.
                    _, first = np.unique(ids[near][order], return_index=True)
                    order = order[np.sort(first)[:k]]
                    found["q"].append(np.full(len(order), q))
                    found["id"].append(ids[near][order])
                    found["score"].append(d[order])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in found.items()})

    keys = ["tree", "leaf", "part"]
    order = Window.partitionBy("q").orderBy("score", "id")

    def best(asks: DataFrame, *more: DataFrame) -> DataFrame:
        found = index.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(rank, "q long, id long, score double")
        for other in more:
            found = found.unionByName(other.select("q", "id", "score"))
        found = found.groupBy("q", "id").agg(F.min("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    ranked = best(wanted.where("NOT later").withColumn("bound", F.lit(float("inf"))))
    if all_visits > visits:
        # The k-th distance of the first visits bounds what later ones have to hand over.
        ranked = store(spark, ranked, "ann-first")
        bounds = ranked.where(F.col("rank") == k).select("q", F.col("score").alias("bound"))
        asks = wanted.where("later").join(bounds, "q", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        ranked = best(asks, ranked)
    return ranked.select(F.col("q").alias("query_id"), F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")
