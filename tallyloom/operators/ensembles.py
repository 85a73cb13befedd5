"""Forests and boosted trees fitted on all rows through counted cells.

Trees cut a feature at no more than maxBins - 1 values, so rows that share their bins in every feature take the same way through every tree. They are
counted once, by label: the cells are as many as the bins allow however long the table is, and the fit on them is the fit on all rows. Cuts are exact quantiles
of all rows. A row drawn with replacement has a Poisson weight, a cell of n rows the Poisson weight of mean n; without replacement it is a binomial one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import classification as MC
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import running_totals, stage

# Cells that a fit holds in memory (32 bins of four features are 1,048,576); a table of more cells is fitted row by row by Spark.
MOST_CELLS = 2_000_000
# Rows that a task counts at once.
COUNTED = 500_000


def quantile_cuts(rows: DataFrame, n: int, width: int, bins: int) -> list[np.ndarray]:
    """Where the array x is cut: all values but the largest of a feature with at most `bins` values, otherwise distinct quantiles k / bins of all rows."""
    values = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(values, ["j", "v"], {"upto": "n"}).withColumn("upto", F.col("upto") - F.col("j") * F.lit(n))
    few = [r["j"] for r in placed.groupBy("j").agg(F.count(F.lit(1)).alias("k")).collect() if r["k"] <= bins]
    ranks = F.array(*[F.lit(math.floor(k / bins * (n - 1))) for k in range(1, bins)])
    hit = F.exists(ranks, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    found: dict[int, set[float]] = {}
    for r in placed.filter((F.col("upto") < n) & (hit | F.col("j").isin(few))).select("j", "v").collect():  # fewer than `bins` a feature
        found.setdefault(r["j"], set()).add(r["v"])
    return [np.array(sorted(found.get(j, ())), dtype=float) for j in range(width)]


def count_cells(df: DataFrame, label: str, features: str, cuts: list[np.ndarray]) -> DataFrame:
    """(label, bins, n): rows by label and by the number of cuts below every feature, one byte a feature. Rows without a label are counted too."""
    width = len(cuts)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            y = batch.column(0)
            key = np.zeros((len(y), width + 9), np.uint8)
            for j, cut in enumerate(cuts):
                key[:, j] = np.searchsorted(cut, batch.column(j + 1).to_numpy(zero_copy_only=False), "left")
            key[:, width] = y.is_null().to_numpy(zero_copy_only=False)
            key[:, width + 1:] = np.ascontiguousarray(y.fill_null(0.0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            held.append(key)
            size += len(key)
            if size >= COUNTED:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def counted(held):
        found, n = np.unique(np.concatenate(held).view(f"V{width + 9}").ravel(), return_counts=True)
        key = found.view(np.uint8).reshape(-1, width + 9)
        y = pa.array(np.ascontiguousarray(key[:, width + 1:]).view(float).ravel(), mask=key[:, width] > 0)
        return pa.RecordBatch.from_arrays([y, pa.array([k.tobytes() for k in key[:, :width]], pa.binary()), pa.array(n)], names=["y", "bins", "n"])

    x = df.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")).select("y", *[F.col("x")[j].alias(f"x{j}") for j in range(width)])
    cells = x.mapInArrow(run, "y double, bins binary, n long").groupBy("y", "bins").agg(F.sum("n").alias("n"))
    return cells.select(F.col("y").cast(df.schema[label].dataType).alias(label), "bins", "n")


class _Cells:
    """The counted cells of a table of labelled rows: bins (a row per cell) and counts by class."""

    def __init__(self, df: DataFrame, label: str, features: str, bins: int):
        rows = df.select(F.col(label).cast("double").alias("y"), F.col(features).alias("v"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y").isNull() | (F.col("y") < 0) | (F.col("y") != F.floor("y"))).alias("odd"),
                         F.max("y").alias("top"), F.max(F.size(vector_to_array("v"))).alias("width")).first()
        if not facts["n"] or facts["odd"]:
            raise ValueError("labels have to be whole numbers from 0, and there has to be a row")
        self.classes = max(int(facts["top"]) + 1, 2)
        self.cuts = quantile_cuts(rows.select(vector_to_array("v").alias("x")), facts["n"], facts["width"], bins)
        cells = stage(count_cells(rows, "y", "v", self.cuts))
        self.many = cells.count() > MOST_CELLS
        if self.many:
            return
        table = cells.toArrow().combine_chunks()
        key = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(-1, len(self.cuts))
        plain, place = np.unique(np.ascontiguousarray(key).view(f"V{len(self.cuts)}").ravel(), return_inverse=True)
        # In the order of their bins, so that what a fit draws does not depend on partitioning.
        self.bins = plain.view(np.uint8).reshape(-1, len(self.cuts))
        self.counts = np.zeros((len(plain), self.classes), np.int64)
        np.add.at(self.counts, (place.ravel(), table["y"].to_numpy().astype(int)), table["n"].to_numpy())


class Tree:
    """Arrays by node: what it asks (bins of `feature` above `cut` go to left + 1), its mean, weight and gain. A leaf leads to itself."""

    def __init__(self, feature, cut, left, value, gain):
        self.feature, self.cut, self.left, self.value, self.gain = feature, cut, left, value, gain

    def place(self, bins: np.ndarray, depth: int) -> np.ndarray:
        at, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
        for _ in range(depth):
            at = self.left[at] + (bins[rows, self.feature[at]] > self.cut[at])
        return at


def grow(bins: np.ndarray, weight: np.ndarray, sums: np.ndarray, width: int, depth: int, subset: int = 0, rng=None) -> Tree:
    """One tree over cells, level by level.

    `sums` holds what is averaged: the weights of the classes (the cut that lowers the Gini impurity most) or weighted values (that lowers the variance most).
    With `subset`, every node looks at that many features, drawn anew.
    """
    p, k = bins.shape[1], sums.shape[1]
    rows = np.flatnonzero(weight > 0)
    slot = np.zeros(len(rows), np.int64)
    mean = lambda s, w: s / np.maximum(w, 1e-300)[:, None]
    feature, cut, left, gains = [np.zeros(1, np.int16)], [np.full(1, 255, np.int16)], [np.zeros(1, np.int32)], [np.zeros(1)]
    values, first, nodes = [mean(sums.sum(0)[None], weight.sum(keepdims=True))], 0, 1
    for _ in range(depth):
        m = len(left[-1])
        seen = np.empty((k + 1, m, p, width))
        w, s = weight[rows], [sums[rows, i] for i in range(k)]
        for j in range(p):
            at = slot * width + bins[rows, j]
            for i, x in enumerate([w, *s]):
                seen[i, :, j] = np.bincount(at, weights=x, minlength=m * width).reshape(m, width)
        below = seen.cumsum(axis=3)
        whole = below[:, :, :1, -1:]
        low, high = below[..., :-1], whole - below[..., :-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (low[1:] ** 2).sum(0) / low[0] + (high[1:] ** 2).sum(0) / high[0] - (whole[1:] ** 2).sum(0) / whole[0]
        gain[~((low[0] > 0) & (high[0] > 0))] = -np.inf
        if subset and subset < p:
            asked = np.zeros((m, p), bool)
            np.put_along_axis(asked, rng.random((m, p)).argsort(axis=1)[:, :subset], True, axis=1)
            gain[~asked] = -np.inf
        best = gain.reshape(m, -1).argmax(axis=1)
        top = gain.reshape(m, -1)[np.arange(m), best]
        split = np.flatnonzero(top > 0)
        if not len(split):
            break
        j, c = np.divmod(best, width - 1)
        feature[-1][split], cut[-1][split], gains[-1][split] = j[split], c[split], top[split]
        left[-1][split] = nodes + 2 * np.arange(len(split))
        sides = np.stack([low[:, split, j[split], c[split]], high[:, split, j[split], c[split]]], axis=2).reshape(k + 1, -1)
        values.append(mean(sides[1:].T, sides[0]))
        new = len(split) * 2
        feature.append(np.zeros(new, np.int16))
        cut.append(np.full(new, 255, np.int16))
        left.append((nodes + np.arange(new)).astype(np.int32))
        gains.append(np.zeros(new))
        to = np.full(m, -1)
        to[split] = np.arange(len(split))
        going = to[slot] >= 0
        rows, slot = rows[going], slot[going]
        slot = 2 * to[slot] + (bins[rows, j[slot]] > c[slot])
        first, nodes = nodes, nodes + new
    return Tree(*[np.concatenate(a) for a in (feature, cut, left, values, gains)])


class TreesModel:
    """Trees over bins. `vote` turns the summed values of the trees into a class."""

    def __init__(self, cuts: list[np.ndarray], trees: list[Tree], scales: list[float], depth: int, vote, features: str):
        self.cuts, self.trees, self.scales, self.depth, self.vote, self.features = cuts, trees, scales, depth, vote, features
        self._sent = None

    @property
    def featureImportances(self) -> np.ndarray:
        """What the cuts of a feature gain, by tree and then over all trees in shares of one."""
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            gains = np.bincount(tree.feature, weights=tree.gain, minlength=len(self.cuts))
            total += gains / gains.sum() if gains.sum() else gains
        return total / total.sum() if total.sum() else total

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction`."""
        if self._sent is None:
            self._sent = df.sparkSession.sparkContext.broadcast((self.cuts, self.trees, self.scales))
        sent, depth, vote = self._sent, self.depth, self.vote

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            cuts, trees, scales = sent.value
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(cuts)))
            bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, rows.T)], axis=1).astype(np.uint8)
            total = 0.0
            for tree, scale in zip(trees, scales):
                total = total + scale * tree.value[tree.place(bins, depth)]
            return pd.Series(vote(total))

        return df.withColumn("prediction", predict(vector_to_array(self.features)))


class Forest:
    """Trees of bootstrapped rows, each node on the square root of the features; every tree says the shares of the classes in its leaf."""

    def __init__(self, numTrees: int = 20, maxDepth: int = 5, seed: int = 1, maxBins: int = 32, labelCol: str = "label", featuresCol: str = "features"):
        self.settings = dict(numTrees=numTrees, maxDepth=maxDepth, seed=seed, maxBins=maxBins, labelCol=labelCol, featuresCol=featuresCol)

    def fit(self, df: DataFrame):
        at = self.settings
        cells = _Cells(df, at["labelCol"], at["featuresCol"], at["maxBins"])
        if cells.many:
            return MC.RandomForestClassifier(**at).fit(df)
        sc, width, subset = df.sparkSession.sparkContext, at["maxBins"], math.ceil(math.sqrt(len(cells.cuts)))
        sent = sc.broadcast((cells.bins, cells.counts))
        seed, depth = at["seed"], at["maxDepth"]

        def run(batches):
            bins, counts = sent.value
            for batch in batches:
                for number in batch["id"]:
                    rng = np.random.default_rng([seed, int(number)])
                    drawn = rng.poisson(counts).astype(float)
                    tree = grow(bins, drawn.sum(axis=1), drawn, width, depth, subset, rng)
                    yield pd.DataFrame({"id": [number], **{name: [getattr(tree, name).tobytes()] for name in ("feature", "cut", "left", "value", "gain")}})

        tasks = min(at["numTrees"], 4 * sc.defaultParallelism)
        grown = df.sparkSession.range(0, at["numTrees"], 1, tasks).mapInPandas(run, "id long, feature binary, cut binary, left binary, value binary, gain binary")
        trees = []
        for r in sorted(grown.collect(), key=lambda r: r["id"]):  # at most 2^depth leaves a tree, whatever the rows
            trees.append(Tree(np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.int16), np.frombuffer(r["left"], np.int32),
                              np.frombuffer(r["value"], float).reshape(-1, cells.classes), np.frombuffer(r["gain"], float)))
        sent.destroy()
        return TreesModel(cells.cuts, trees, [1.0] * len(trees), depth, _largest, at["featuresCol"])


class Boosted:
    """Trees of pseudo-residuals of the logistic loss on labels 0/1: the first has weight 1, those after it the step size; each sees a share of the rows."""

    def __init__(self, maxIter: int = 20, maxDepth: int = 5, stepSize: float = 0.1, subsamplingRate: float = 1.0, seed: int = 1, maxBins: int = 32,
                 labelCol: str = "label", featuresCol: str = "features"):
        self.settings = dict(maxIter=maxIter, maxDepth=maxDepth, stepSize=stepSize, subsamplingRate=subsamplingRate, seed=seed, maxBins=maxBins,
                             labelCol=labelCol, featuresCol=featuresCol)

    def fit(self, df: DataFrame):
        at = self.settings
        cells = _Cells(df, at["labelCol"], at["featuresCol"], at["maxBins"])
        if cells.classes > 2:
            raise ValueError("labels have to be 0 or 1")
        if cells.many:
            return MC.GBTClassifier(**at).fit(df)
        rng, trees, scales, said = np.random.default_rng(at["seed"]), [], [], np.zeros(len(cells.bins))
        for number in range(at["maxIter"]):
            drawn = rng.binomial(cells.counts, at["subsamplingRate"]).astype(float)
            aim = (np.full(len(said), -1.0), np.ones(len(said)))
            if number:
                aim = (-4 / (1 + np.exp(-2 * said)), 4 / (1 + np.exp(2 * said)))
            tree = grow(cells.bins, drawn.sum(axis=1), (drawn[:, 0] * aim[0] + drawn[:, 1] * aim[1])[:, None], at["maxBins"], at["maxDepth"])
            trees.append(tree)
            scales.append(at["stepSize"] if number else 1.0)
            said += scales[-1] * tree.value[tree.place(cells.bins, at["maxDepth"]), 0]
        return TreesModel(cells.cuts, trees, scales, at["maxDepth"], _positive, at["featuresCol"])


def _largest(total: np.ndarray) -> np.ndarray:
    return total.argmax(axis=1).astype(float)


def _positive(total: np.ndarray) -> np.ndarray:
    return (total[:, 0] > 0).astype(float)
