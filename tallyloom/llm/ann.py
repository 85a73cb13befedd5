"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all trees, exact reranking.

Trees are fitted on at most about SAMPLE vectors chosen by the hash of their id: a node's hyperplane lies midway between two random members, and
splits until LEAF of the sample are left. Every vector is then filed under its leaf in every tree. A query enters all trees at once: one
heap, ordered by how far the query is on the wrong side of the worst hyperplane so far, gives the leaves to open, until they hold a
share of all rows (counted in every tree). That share is calibrated: sample vectors are searched among the sample, and the smallest share that
finds RECALL of their true neighbours is taken. Vectors with structure need a small one, uniform noise in 64 dimensions over half. Candidates
are ranked exactly, in double precision on the stored vectors.

Equal vectors are one class with its k + 1 smallest ids, so a vector with very many copies takes one place in a leaf, and each query still finds the
copies with the smallest ids. Classes and queries meet by blocks of leaves, cut into parts on both sides; a task keeps the best k per query
before anything is shuffled.

Defined results: vectors that are null, all zero, of another length than the first, or that hold null or non-finite values take no part; fewer
than k candidates are all returned; ties go to the smaller id; rows that repeat an id count once; rows without id take no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import columns
from tallyloom.llm.grouping import small
from tallyloom.runtime import stage

TREES = 16
LEAF = 64
SAMPLE = 20_000
RECALL = 0.96
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 1.0, 1.5, 2.5, 5.0)
# Sample vectors that calibrate the share, and the rows opened at least.
PROBES = 80
LEAST = 1_000
# Rows of a block of leaves, and queries that open some of them, that meet in one task; more of either become several parts.
PART = 20_000
QUERIES = 2_000
# Queries that search the trees in one task, and whose opened leaves it hands on at once.
SEARCHED = 200
YIELD = 50


class Forest:
    """Trees as flat arrays: normal and offset of each inner node, children (a leaf is -1 - its number)."""

    def __init__(self, x: np.ndarray, trees: int, leaf: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            normals, offsets, children, leaves = [], [], [], 0
            todo = [(np.arange(len(x)), None)]
            while todo:
                rows, place = todo.pop()
                halves = self._halves(x, rows, rng) if len(rows) > leaf else None
                if halves is None:
                    name = -1 - leaves
                    leaves += 1
                else:
                    name = len(children)
                    normals.append(halves[0])
                    offsets.append(halves[1])
                    children.append([0, 0])
                    todo += [(halves[3], (name, 1)), (halves[2], (name, 0))]
                if place:
                    children[place[0]][place[1]] = name
            self.trees.append((np.array(normals).reshape(-1, x.shape[1]), np.array(offsets), np.array(children, int).reshape(-1, 2), leaves))

    @staticmethod
    def _halves(x, rows, rng):
        for _ in range(5):
            a, b = x[rng.choice(rows, 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            if size == 0:
                continue
            normal = normal / size
            offset = normal @ (a + b) / 2
            side = x[rows] @ normal >= offset
            if 0.05 < side.mean() < 0.95:
                return normal, offset, rows[~side], rows[side]
        return None

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row in every tree."""
        out = np.zeros((len(x), len(self.trees)), np.int32)
        for t, (normals, offsets, children, _) in enumerate(self.trees):
            at = np.zeros(len(x), int) if len(children) else np.full(len(x), -1)
            while True:
                live = np.flatnonzero(at >= 0)
                if not len(live):
                    break
                n = at[live]
                side = np.einsum("ij,ij->i", x[live], normals[n]) >= offsets[n]
                at[live] = children[n, side.astype(int)]
            out[:, t] = -1 - at
        return out

    def search(self, q: np.ndarray, sizes: list[np.ndarray], wanted: int) -> list[tuple[int, int]]:
        """(tree, leaf) pairs in the order of one queue over all trees, until they hold the wanted number of rows."""
        queue = [(0.0, t, 0 if len(children) else -1) for t, (_, _, children, _) in enumerate(self.trees)]
        heapq.heapify(queue)
        opened, held = [], 0
        while queue and held < wanted:
            wrong, t, node = heapq.heappop(queue)
            normals, offsets, children, _ = self.trees[t]
            while node >= 0:
                margin = float(normals[node] @ q - offsets[node])
                near, far = (1, 0) if margin >= 0 else (0, 1)
                heapq.heappush(queue, (max(wrong, abs(margin)), t, int(children[node][far])))
                node = int(children[node][near])
            opened.append((t, -1 - node))
            held += int(sizes[t][-1 - node])
        return opened


def calibrated(forest: Forest, x: np.ndarray, k: int, target: float = RECALL) -> float:
    """The smallest of SHARES with which sample vectors find the wanted part of their k nearest others in the sample."""
    filed = forest.leaf_of(x)
    sizes = [np.bincount(filed[:, t], minlength=f[3]) for t, f in enumerate(forest.trees)]
    probes = np.arange(len(x))[:: max(1, len(x) // PROBES)][:PROBES]
    truth = []
    for q in probes:
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        truth.append(np.argsort(d, kind="stable")[:min(k, len(x) - 1)])
    for share in SHARES:
        found = 0
        for q, true in zip(probes, truth):
            opened = set(forest.search(x[q], sizes, max(1, int(share * len(x)))))
            found += sum(any((t, int(leaf)) in opened for t, leaf in enumerate(filed[i])) for i in true)
        if found >= target * sum(map(len, truth)):
            return share
    return float(len(forest.trees))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): one row per id with a finite non-zero vector of doubles; the length of most vectors is the right one."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = columns(vectors, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.coalesce(sound, F.lit(False)))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (size["n"] if size else 0)).groupBy("id").agg(F.min("v").alias("v"))


def nearest(vectors: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, leaf: int = LEAF,
            sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that the SQL condition `queries` on `id` picks, its k nearest other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    classes = stage(ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("cid", F.col("ids")[0]))
    total = classes.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cut = int(min(1.0, sample / total) * 1_000_000)
    picked = classes.filter(F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < F.lit(cut)).select("cid", "v").toPandas().sort_values("cid")
    if not len(picked):
        picked = classes.select("cid", "v").orderBy("cid").limit(1).toPandas()
    points = np.stack(picked["v"].to_numpy())
    forest = Forest(points, trees, leaf)
    search = max(LEAST, int(calibrated(forest, points, k, recall) * total))
    shared = spark.sparkContext.broadcast(forest)

    def file_rows(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"cid": batch["cid"].to_numpy(), "leaves": list(shared.value.leaf_of(np.stack(batch["v"].to_numpy())))})

    filed = stage(classes.select("cid", "v").mapInPandas(file_rows, "cid long, leaves array<int>"))
    placed = filed.select("cid", F.posexplode("leaves").alias("tree", "leaf"))
    # A number per leaf: bounded by the sample and the number of trees.
    counted = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).toPandas()
    sizes = [np.zeros(f[3], np.int64) for f in forest.trees]
    for t, part in counted.groupby("tree"):
        sizes[t][part["leaf"].to_numpy()] = part["n"].to_numpy()
    blocks = [np.cumsum(n) // PART for n in sizes]
    sized = spark.sparkContext.broadcast((sizes, blocks))
    asked = stage(rows.filter(queries).select(F.col("id").alias("q"), "v"))

    def open_leaves(batches):
        sizes, blocks = sized.value
        for batch in batches:
            for at in range(0, len(batch), YIELD):
                out = []
                for q, v in zip(batch["q"].iloc[at:at + YIELD], batch["v"].iloc[at:at + YIELD]):
                    opened: dict[tuple[int, int], list[int]] = {}
                    for t, leaf in shared.value.search(np.asarray(v), sizes, search):
                        opened.setdefault((t, int(blocks[t][leaf])), []).append(leaf)
                    out += [(q, t, block, leaves) for (t, block), leaves in opened.items()]
                yield pd.DataFrame(out, columns=["q", "tree", "block", "leaves"])

    tasks = max(1, -(-asked.count() // SEARCHED))
    opened = stage(asked.repartition(tasks, "q").mapInPandas(open_leaves, "q long, tree int, block int, leaves array<int>"))
    # Neighbouring leaves share a block, so that a query's vector is sent once for all it opens there; both sides of a block are dealt over tasks.
    of_leaf = spark.createDataFrame([(t, leaf, int(x)) for t, per in enumerate(blocks) for leaf, x in enumerate(per)], "tree int, leaf int, block int")
    held = placed.join(F.broadcast(of_leaf), ["tree", "leaf"])
    load = lambda df, name, most: df.groupBy("tree", "block").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    loads = small(stage(load(held, "parts", PART).join(load(opened, "turns", QUERIES), ["tree", "block"])))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = opened.join(loads, ["tree", "block"]).select("tree", "block", every("parts").alias("part"), dealt("q", "turns").alias("turn"), "q", "leaves")
    left = left.join(small(asked, 8 * points.shape[1] + 16), "q")
    right = held.join(loads, ["tree", "block"]).select("tree", "block", dealt("cid", "parts").alias("part"), every("turns").alias("turn"), "cid", "leaf").join(classes, "cid")

    def rank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("leaf", kind="stable")
            x, ids, leaf = np.stack(right["v"].to_numpy()), right["ids"].tolist(), right["leaf"].to_numpy()
            for q, v, leaves in zip(left["q"], left["v"], left["leaves"]):
                some = np.concatenate([np.arange(a, b) for a, b in zip(np.searchsorted(leaf, leaves), np.searchsorted(leaf, leaves, "right"))])
                if not len(some):
                    continue
                d = np.sqrt(((x[some] - np.asarray(v)) ** 2).sum(axis=1))
                # The k + 1 nearest classes and all that tie with the last of them hold the k nearest rows of this block.
                edge = np.partition(d, k)[k] if len(d) > k + 1 else np.inf
                for i in np.flatnonzero(d <= edge):
                    out += [(q, c, float(d[i])) for c in ids[some[i]] if c != q]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    at = ["tree", "block", "part", "turn"]
    near = left.groupBy(*at).cogroup(right.select(*at, "leaf", "v", "ids").groupBy(*at)).applyInPandas(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = near.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
