"""Classifiers: Spark ML estimators with the customary settings, and those built from aggregates."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml import classification as MC
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ensembles import Boosted, Forest, count_cells
from tallyloom.runtime import persisted, running_totals, stage, unit_hash


def logistic(**kw):
    return MC.LogisticRegression(**{"maxIter": 20, "regParam": 0.3, "elasticNetParam": 0.0, **kw})


def tree(**kw):
    return MC.DecisionTreeClassifier(**{"maxDepth": 6, "minInstancesPerNode": 10, "seed": 1, **kw})


def forest(**kw):
    return Forest(**{"numTrees": 500, "maxDepth": 10, "seed": 1, **kw})


def boosted(**kw):
    return Boosted(**{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.9, "seed": 1, **kw})


def perceptron(inputs: int, classes: int = 2, **kw):
    return MC.MultilayerPerceptronClassifier(**{"layers": [inputs, 100, classes], "seed": 1, "maxIter": 200, **kw})


def gaussian_bayes(**kw):
    return MC.NaiveBayes(modelType="gaussian", **kw)


def text_pipeline(token_columns: list[str], numeric: list[str], buckets: int = 2000, min_df: int = 10) -> Pipeline:
    """Hashed term frequencies and idf for every token column, assembled with numeric columns."""
    stages = []
    for c in token_columns:
        stages += [HashingTF(numFeatures=buckets, inputCol=c, outputCol=f"{c}_tf"),
                   IDF(minDocFreq=min_df, inputCol=f"{c}_tf", outputCol=f"{c}_tfidf")]
    stages.append(VectorAssembler(inputCols=[f"{c}_tfidf" for c in token_columns] + numeric, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def vocabulary_pipeline(tokens: str, min_df: int = 10) -> Pipeline:
    """Counted vocabulary of all terms, and idf; the largest size that can be stated leaves none out."""
    return Pipeline(stages=[CountVectorizer(inputCol=tokens, outputCol="tf", vocabSize=2**31 - 1),
                            IDF(minDocFreq=min_df, inputCol="tf", outputCol="features")])


# --- Gaussian naive Bayes from grouped moments -------------------------------------------------------------------

def bayes_table(df: DataFrame, label: str, columns: list[str], smoothing: float = 1e-9) -> DataFrame:
    """(label, feature, n, mean, variance): population variance plus `smoothing` times the largest column variance."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[a for c in columns for a in (
        F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}"))])
    top = df.agg(F.greatest(F.lit(0.0), *[F.var_pop(c) for c in columns])).first()[0] or 0.0
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                               (F.col(f"v_{c}") + smoothing * top).alias("variance")) for c in columns])
    return per.select(label, F.col("_n").alias("n"), F.explode(cells).alias("x")).select(label, "n", "x.*")


def bayes_predict(df: DataFrame, table: DataFrame, label: str, columns: list[str], name: str = "prediction") -> DataFrame:
    """Most likely class of every row, ties to the smaller class; the table holds one row per class and feature."""
    rows = table.collect()
    sizes = {r[label]: r["n"] for r in rows}
    total = sum(sizes.values())
    scores = []
    for cls in sorted(sizes):
        score = F.lit(math.log(sizes[cls] / total))
        for r in rows:
            if r[label] == cls:
                gap = F.col(r["feature"]) - F.lit(r["mean"])
                score = score - F.lit(0.5 * math.log(2 * math.pi * r["variance"])) - gap * gap / F.lit(2 * r["variance"])
        scores.append(F.struct((-score).alias("s"), F.lit(cls).alias("c")))
    return df.withColumn(name, F.array_min(F.array(*scores))["c"])


# --- bounded samples of labelled rows ------------------------------------------------------------------------------

# Labelled rows that a classifier is fitted on where its rounds or trees make all of them too dear.
FIT_ROWS = 5_000


def fit_sample(df: DataFrame, key: str, rows: int = FIT_ROWS) -> DataFrame:
    """About `rows` rows chosen by key hash, or all of them if there are fewer, written once in slices of about FIT_ROWS rows.

    A forest adds up the statistics of every node of every slice, and boosting goes over the slices in every round: slices have to follow the rows of the
    sample, not those of the table it comes from. A slice is in the order of its keys, so what a fit draws does not depend on partitioning.
    """
    total = df.count()
    share = min(1.0, rows / max(total, 1))
    chosen = df if share == 1.0 else df.filter(unit_hash(key, F.lit("fit")) < share)
    plain = [c for c, kind in df.dtypes if c != key and kind in ("double", "float", "int", "bigint", "string")]
    return stage(chosen.repartition(max(1, round(min(total, rows) / FIT_ROWS)), key).sortWithinPartitions(key, *plain))


# --- scoring by many trees -----------------------------------------------------------------------------------------

def thresholds(model, width: int) -> list[list[float]]:
    """The distinct values at which the trees of a forest, or of boosted trees, cut each feature (at most maxBins - 1 a feature)."""
    if hasattr(model, "cuts"):
        return [list(map(float, c)) for c in model.cuts]
    cuts: list[set[float]] = [set() for _ in range(width)]
    for tree in model.trees:
        for j, value in re.findall(r"feature (\d+) <= ([-\w.]+)", tree.toDebugString):
            cuts[int(j)].add(float(value))
    return [sorted(c) for c in cuts]


def score_cells(model, df: DataFrame, label: str, width: int) -> DataFrame:
    """(label, n, prediction): rows of one label that no threshold of the model tells apart are counted first and scored once.

    There are at most maxBins cells a feature, whatever the number of rows; rows in one cell take the same way through every tree.
    """
    cuts = thresholds(model, width)
    # Scoring is the dear step: cells are few rows, which would otherwise be packed into few tasks.
    dealt = stage(count_cells(df, label, "features", [np.array(c, dtype=float) for c in cuts])).repartition(df.sparkSession.sparkContext.defaultParallelism)

    @F.pandas_udf("array<double>")
    def within(bins: pd.Series) -> pd.Series:
        """A point of every cell: its upper cuts, which belong to it."""
        upper = [np.array([*c, math.inf]) for c in cuts]
        return pd.Series([[float(u[b]) for u, b in zip(upper, key)] for key in bins])

    ready = dealt.select(label, "n", array_to_vector(within("bins")).alias("features"))
    return model.transform(ready).select(label, "n", "prediction")


# --- boosted stumps ----------------------------------------------------------------------------------------------

class AdaBoost:
    """Discrete boosting of depth-1 trees on labels 0/1 over all rows, scored as compiled column expressions.

    Features are cut once at exact quantiles. A vote is a function of one feature's bin, so the votes so far are one table per feature, and a row's weight
    follows from its bins and its label: nothing about a row is rewritten between rounds. Each round is one job over the binned rows, kept in
    blocks of a batch; a task returns the weighted signs per feature and bin.
    """

    def __init__(self, rounds: int = 200, features: str = "features", label: str = "label", bins: int = 64):
        self.rounds, self.features, self.label, self.bins = rounds, features, label, bins
        self.stumps: list[tuple[int, float, float]] = []  # feature, threshold, vote for class 1 above it (negative: below)

    def _cuts(self, rows: DataFrame, n: int) -> list[np.ndarray]:
        """Distinct quantiles k / bins (the lower of two values) of every feature, from the counts of its values."""
        values = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
        placed = running_totals(values, ["j", "v"], {"upto": "n"}).withColumn("upto", F.col("upto") - F.col("j") * F.lit(n))
        ranks = F.array(*[F.lit(math.floor(k / self.bins * (n - 1))) for k in range(1, self.bins)])
        hit = placed.filter(F.exists(ranks, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))).select("j", "v").collect()
        found: dict[int, list[float]] = {}
        for r in hit:
            found.setdefault(r["j"], []).append(r["v"])
        return [np.array(sorted(found[j])) for j in range(len(found))]

    def _blocks(self, rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
        """(bins, signs): the binned rows, a block for every batch of a task."""
        def run(batches):
            for batch in batches:
                x = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, len(cuts)))
                places = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)]).astype(np.uint16)
                yield pd.DataFrame({"bins": [places.tobytes()], "signs": [np.where(batch["y"].to_numpy() > 0, 1, -1).astype(np.int8).tobytes()]})

        return rows.mapInPandas(run, "bins binary, signs binary")

    def fit(self, df: DataFrame) -> "AdaBoost":
        rows = stage(df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y")))
        self.stumps, n = [], rows.count()
        if not n:
            return self
        cuts = self._cuts(rows, n)
        p, wide = len(cuts), max(map(len, cuts)) + 1
        with persisted(self._blocks(rows, cuts)) as blocks:
            # Votes for class 1 by feature and bin.
            votes = np.zeros((p, wide))
            for _ in range(self.rounds):
                signs, weight = self._signs(blocks, votes)
                best = (0.5, None)
                for j, cut in enumerate(cuts):
                    # Error of "class 1 above the cut" for every cut, from the weighted signs per bin.
                    bins = signs[j, :len(cut) + 1] / weight
                    above = bins.sum() - np.cumsum(bins)[:-1]
                    edge = (2 * above - bins.sum()) / 2
                    for at in (edge.argmax(), edge.argmin()) if len(edge) else ():
                        if 0.5 - abs(edge[at]) < best[0] - 1e-12:
                            best = (0.5 - abs(edge[at]), (j, int(at), 1.0 if edge[at] > 0 else -1.0))
                err, stump = best
                if stump is None:
                    break
                alpha = math.log((1 - err) / max(err, 1e-16))
                j, at, side = stump
                self.stumps.append((j, float(cuts[j][at]), alpha * side))
                if err <= 1e-12:
                    break
                votes[j] += alpha * side * np.where(np.arange(wide) > at, 1.0, -1.0)
        return self

    def _signs(self, blocks: DataFrame, votes: np.ndarray) -> tuple[np.ndarray, float]:
        """(weighted signs by feature and bin, sum of weights) under the votes so far."""
        p, wide = votes.shape

        def run(batches):
            out = np.zeros(p * wide + 1)
            for batch in batches:
                for bins, signs in zip(batch["bins"], batch["signs"]):
                    sign = np.frombuffer(signs, np.int8).astype(float)
                    place = np.frombuffer(bins, np.uint16).reshape(p, len(sign))
                    said = sum(votes[j][place[j]] for j in range(p))
                    # Every wrong vote multiplies the weight by the exponential of its size; the scale does not matter.
                    weight = np.exp(-sign * said / 2)
                    for j in range(p):
                        out[j * wide:(j + 1) * wide] += np.bincount(place[j], weights=weight * sign, minlength=wide)
                    out[-1] += weight.sum()
            yield pd.DataFrame({"sums": [out]})

        # A few hundred numbers from every task.
        sums = sum(np.asarray(r["sums"]) for r in blocks.mapInPandas(run, "sums array<double>").collect())
        return sums[:-1].reshape(p, wide), float(sums[-1])

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `score` (weighted vote in -1..1) and `prediction`."""
        total = sum(abs(v) for *_, v in self.stumps) or 1.0
        by: dict[int, dict[float, float]] = {}
        for j, c, v in self.stumps:
            by.setdefault(j, {})[c] = by.setdefault(j, {}).get(c, 0.0) + v / total
        x, score = vector_to_array(self.features), F.lit(0.0)
        for j, steps in sorted(by.items()):
            # The sum of a feature's votes is a step function of its value.
            value, at = -sum(steps.values()), None
            for c, v in sorted(steps.items()):
                low = F.col("_x")[j] <= c
                at = F.when(low, value) if at is None else at.when(low, value)
                value += 2 * v
            score = score + at.otherwise(value)
        return df.withColumn("_x", x).withColumn("score", score).drop("_x").withColumn("prediction", F.when(F.col("score") > 0, 1.0).otherwise(0.0))


# --- RBF support vectors by random features ----------------------------------------------------------------------

LIFTED = 1_000  # rows whose features are computed at once


def _waves(p: int, gamma: float | None, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(scale=math.sqrt(2 * (gamma if gamma is not None else 1.0 / p)), size=(p, size)), rng.uniform(0, 2 * math.pi, size)


def _lifted(x: np.ndarray, w: np.ndarray, shift: np.ndarray):
    """(first row, features) of slices of rows."""
    for s in range(0, len(x), LIFTED):
        part = x[s:s + LIFTED] @ w
        part += shift
        np.cos(part, out=part)
        part *= math.sqrt(2 / len(shift))
        yield s, part


def random_features(df: DataFrame, columns: list[str], gamma: float | None = None, size: int = 200, seed: int = 1, name: str = "features") -> DataFrame:
    """Random Fourier features of the Gaussian kernel exp(-gamma |x - y|^2); gamma defaults to 1 / number of columns."""
    w, shift = _waves(len(columns), gamma, size, seed)

    @F.pandas_udf("array<double>")
    def lift(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        out = np.empty((len(x), size))
        # In slices, so that a batch is held once.
        for s, part in _lifted(x, w, shift):
            out[s:s + len(part)] = part
        return pd.Series(list(out))

    return df.withColumn(name, array_to_vector(lift(*[F.col(c).cast("double") for c in columns])))


class KernelMachine:
    """Support vectors with the Gaussian kernel over all rows: the hinge loss on random Fourier features, with a quadratic penalty on standardised features.

    A pass over the rows gives the loss and its gradient, from which limited-memory BFGS steps on. The features of a row are made anew from its columns in
    every pass and never written: they are fifty times as wide as four columns.
    """

    def __init__(self, columns: list[str], gamma: float | None = None, size: int = 200, seed: int = 1, maxIter: int = 100, regParam: float = 1e-4, tol: float = 1e-6,
                 label: str = "label"):
        self.columns, self.label, self.rounds, self.penalty, self.tol = columns, label, maxIter, regParam, tol
        self.waves = _waves(len(columns), gamma, size, seed)
        self.weights, self.intercept, self.losses = np.zeros(size), 0.0, []

    def _blocks(self, df: DataFrame) -> DataFrame:
        p = len(self.columns)

        def run(batches):
            for batch in batches:
                x = batch.to_numpy(dtype=np.float32)
                yield pd.DataFrame({"x": [x[:, :p].tobytes()], "signs": [np.where(x[:, p] > 0, 1, -1).astype(np.int8).tobytes()]})

        plain = df.select(*[F.col(c).cast("double") for c in self.columns], F.col(self.label).cast("double").alias("_y"))
        return plain.mapInPandas(run, "x binary, signs binary")

    def _sums(self, blocks: DataFrame, of, width: int) -> np.ndarray:
        """What `of(features, signs)` gives, added up over all rows: `width` numbers from every task."""
        w, shift = (a.astype(np.float32) for a in self.waves)

        def run(batches):
            out = np.zeros(width)
            for batch in batches:
                for x, signs in zip(batch["x"], batch["signs"]):
                    sign = np.frombuffer(signs, np.int8).astype(np.float32)
                    for s, part in _lifted(np.frombuffer(x, np.float32).reshape(len(sign), -1), w, shift):
                        out += of(part, sign[s:s + len(part)])
            yield pd.DataFrame({"sums": [out]})

        return sum(np.asarray(r["sums"]) for r in blocks.mapInPandas(run, "sums array<double>").collect())

    def fit(self, df: DataFrame) -> "KernelMachine":
        size = len(self.weights)
        with persisted(self._blocks(df)) as blocks:
            first = self._sums(blocks, lambda z, y: np.concatenate([z.sum(0, dtype=float), np.square(z).sum(0, dtype=float), [len(y)]]), 2 * size + 1)
            n = first[-1]
            if not n:
                return self
            mean = first[:size] / n
            scale = np.sqrt(np.maximum(first[size:-1] / n - mean ** 2, 0.0))
            scale = np.where(scale > 1e-12, scale, np.inf)

            def loss(at):
                """Loss and gradient at coefficients of centred, scaled features and an intercept."""
                u, c = at[:-1] / scale, at[-1] - at[:-1] / scale @ mean
                u = u.astype(np.float32)

                def of(z, y):
                    gap = 1 - y * (z @ u + np.float32(c))
                    wrong = np.where(gap > 0, y, np.float32(0))
                    return np.concatenate([wrong @ z, [wrong.sum(dtype=float), np.maximum(gap, 0).sum(dtype=float)]])

                got = self._sums(blocks, of, size + 2) / n
                slope = np.append((got[:size] - got[size] * mean) / scale, got[size])
                return got[-1] + self.penalty / 2 * (at[:-1] @ at[:-1]), self.penalty * np.append(at[:-1], 0.0) - slope

            best, self.losses = _lbfgs(loss, np.zeros(size + 1), self.rounds, self.tol)
        self.weights, self.intercept = best[:-1] / scale, float(best[-1] - best[:-1] / scale @ mean)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction`."""
        (w, shift), weights, intercept = self.waves, self.weights, self.intercept

        @F.pandas_udf("double")
        def say(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            return pd.Series(np.concatenate([np.zeros(0), *[part @ weights + intercept > 0 for _, part in _lifted(x, w, shift)]]).astype(float))

        return df.withColumn("prediction", say(*[F.col(c).cast("double") for c in self.columns]))


def _lbfgs(loss, at: np.ndarray, rounds: int, tol: float, memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """(best point, losses by round): ends when ten rounds have gained less than `tol` of the loss, or no step lowers it."""
    value, slope = loss(at)
    pairs, losses = [], [value]
    for _ in range(rounds):
        way, held = slope.copy(), []
        for s, y in reversed(pairs):
            a = s @ way / (s @ y)
            way -= a * y
            held.append(a)
        if pairs:
            way *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1])
        for (s, y), a in zip(pairs, reversed(held)):
            way += (a - y @ way / (s @ y)) * s
        fall = slope @ way
        step = 1.0 if pairs else 1.0 / max(np.linalg.norm(slope), 1e-12)
        for _ in range(20):
            to = at - step * way
            new, turned = loss(to)
            if new <= value - 1e-4 * step * fall:
                break
            step /= 2
        else:
            break
        s, y = to - at, turned - slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        at, value, slope = to, new, turned
        losses.append(value)
        if len(losses) > 10 and losses[-11] - value <= tol * abs(value) or np.linalg.norm(slope) <= 1e-9:
            break
    return at, losses


def kernel_svm(columns: list[str], **kw):
    """Support-vector classifier on `random_features` of the columns: an approximation of the one with the RBF kernel, fitted on all rows."""
    return KernelMachine(columns, **{"maxIter": 100, "regParam": 1e-4, **kw})
