"""Fits that see every row of their training part."""

import numpy as np
import pytest
from pyspark.ml import classification as MC
from pyspark.sql import functions as F

from tallyloom.operators import classify as K
from tallyloom.operators import ensembles
from tallyloom.operators.features import as_vector
from tallyloom.plans import models
from tallyloom.plans.registry import Tables


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A folder with order lines of our own."""
    folder = str(tmp_path_factory.mktemp("lines"))
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(1, 500)), int(rng.integers(1, 90)), i % 7, "N", float(rng.integers(1, 51)), float(rng.integers(0, 11)) / 100,
             float(rng.integers(0, 9)) / 100, float(np.round(rng.uniform(900, 90_000), 2))) for i in range(3_000)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_quantity double, l_discount double, l_tax double, "
                                "l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, folder)


@pytest.fixture(scope="module")
def steps(spark):
    """Rows of few distinct values, so that the cuts are the same wherever they are taken from."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, size=(4_000, 3))
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 6) ^ (rng.random(4_000) < 0.2)).astype(float)
    plain = spark.createDataFrame([(float(c), *map(float, r)) for c, r in zip(y, x)], "label double, a double, b double, c double")
    return as_vector(plain, ["a", "b", "c"]).persist()


def _no_sample(monkeypatch):
    monkeypatch.setattr(K, "fit_sample", lambda *a, **kw: pytest.fail("fitted on a sample"))
    monkeypatch.setattr(K, "FIT_ROWS", 50)


def test_boosted_trees_see_all_rows(lines, monkeypatch):
    _no_sample(monkeypatch)
    seen, grow = [], ensembles.grow
    monkeypatch.setattr(ensembles, "grow", lambda bins, weight, *a: seen.append(weight.sum()) or grow(bins, weight, *a))
    models.boosted_cells(lines)
    train = models.split_rows(lines)[0].count()
    assert len(seen) == 500 and abs(np.mean(seen) / train - 0.9) < 0.01


def test_boosted_trees_are_those_of_spark(steps):
    settings = dict(maxIter=12, maxDepth=3, stepSize=0.3, seed=1)
    ours, theirs = K.boosted(subsamplingRate=1.0, **settings).fit(steps), MC.GBTClassifier(**settings).fit(steps)
    both = ours.transform(steps).withColumnRenamed("prediction", "ours").join(
        theirs.transform(steps).select("a", "b", "c", "prediction").distinct(), ["a", "b", "c"])
    assert both.filter("ours <> prediction").count() == 0


def test_cells_hold_every_row_in_any_partitioning(steps, monkeypatch):
    monkeypatch.setattr(ensembles, "COUNTED", 70)
    held = [ensembles._Cells(steps.repartition(n), "label", "features", 32) for n in (2, 7)]
    assert [h.counts.sum() for h in held] == [4_000, 4_000]
    assert np.array_equal(held[0].bins, held[1].bins) and np.array_equal(held[0].counts, held[1].counts)
    want = {(r["a"], r["b"], r["c"], r["label"]): r["n"] for r in steps.groupBy("a", "b", "c", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert want == {(*map(float, b), float(c)): n for b, row in zip(held[0].bins, held[0].counts) for c, n in enumerate(row) if n}


def test_cuts_are_exact_quantiles_of_all_rows(spark):
    x = np.random.default_rng(5).normal(size=3_000).round(3)
    rows = spark.createDataFrame([([float(v), float(i % 2)],) for i, v in enumerate(x)], "x array<double>")
    wide, two = ensembles.quantile_cuts(rows.repartition(5), 3_000, 2, 32)
    assert np.array_equal(wide, np.unique(np.sort(x)[[k * 2_999 // 32 for k in range(1, 32)]]))
    assert list(two) == [0.0]


def test_the_forest_sees_all_rows(lines, monkeypatch):
    _no_sample(monkeypatch)
    fits, counted = [], ensembles._Cells.__init__
    monkeypatch.setattr(ensembles._Cells, "__init__", lambda self, *a: counted(self, *a) or fits.append(self.counts.sum()))
    importances, cells = models.forest_fit(lines)
    train, test = models.split_rows(lines)
    assert fits == [train.count()] and sum(c[2] for c in cells) == test.count()
    assert abs(sum(v for _, v in importances) - 1) < 1e-9 and max(importances, key=lambda r: r[1])[0] == "qty"


def test_the_forest_learns_what_one_tree_cannot(steps):
    model = K.forest(numTrees=30, maxDepth=6).fit(steps)
    right = model.transform(steps).filter("label = prediction").count()
    spark_right = MC.RandomForestClassifier(numTrees=30, maxDepth=6, seed=1).fit(steps).transform(steps).filter("label = prediction").count()
    assert right > 0.75 * 4_000 and abs(right - spark_right) < 0.03 * 4_000
    assert [t.value.tolist() for t in model.trees] == [t.value.tolist() for t in K.forest(numTrees=30, maxDepth=6).fit(steps.repartition(5)).trees]
    assert model.featureImportances[:2].sum() > 0.8


def test_the_kernel_machine_sees_all_rows(lines, monkeypatch):
    _no_sample(monkeypatch)
    seen, sums = [], K.KernelMachine._sums
    monkeypatch.setattr(K.KernelMachine, "_sums", lambda self, blocks, of, width: seen.append(sums(self, blocks, lambda z, y: np.array([len(y)]), 1)[0])
                        or sums(self, blocks, of, width))
    monkeypatch.setattr(K, "kernel_svm", lambda columns: K.KernelMachine(columns, maxIter=2))
    cells = models.svm_cells(lines)
    train, test = models.split_rows(lines)
    assert set(seen) == {train.count()} and sum(c[2] for c in cells) == test.count()


def test_the_kernel_machine_reaches_the_loss_of_sparks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1_500, 2))
    y = ((x ** 2).sum(1) < 1.4) ^ (rng.random(1_500) < 0.1)
    rows = spark.createDataFrame([(float(c), *map(float, r)) for c, r in zip(y, x)], "label double, a double, b double").repartition(3).persist()
    ours = K.kernel_svm(["a", "b"], size=40, regParam=1e-3).fit(rows)
    lifted = K.random_features(rows, ["a", "b"], size=40)
    theirs = MC.LinearSVC(maxIter=100, regParam=1e-3).fit(lifted)
    z, sign = np.array([r[0].toArray() for r in lifted.select("features").collect()]), np.array([r[0] for r in lifted.select("label").collect()]) * 2 - 1
    loss = lambda w, b: np.maximum(0, 1 - sign * (z @ w + b)).mean() + 5e-4 * ((w * z.std(axis=0)) ** 2).sum()
    assert loss(ours.weights, ours.intercept) <= loss(theirs.coefficients.toArray(), theirs.intercept) * 1.005
    right = [m.transform(d).filter("label = prediction").count() for m, d in ((ours, rows), (theirs, lifted))]
    assert abs(right[0] - right[1]) < 15 and right[0] > 1_250


def test_starts_of_all_fits_are_found_together(spark, monkeypatch):
    from tallyloom.operators import cluster as C
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(loc=c, scale=0.3, size=(120, 2)) for c in ((0, 0), (5, 0), (0, 5), (5, 5), (9, 9))])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double").repartition(3)
    spark_costs = {k: C.best_kmeans(rows, ["a", "b"], k, restarts=4).cost for k in (2, 5)}
    monkeypatch.setattr(C, "KMeans", lambda **kw: pytest.fail("a fit of its own for every start"))
    got = {r["k"]: r["cost"] for r in C.elbow(rows, "id", ["a", "b"], [2, 5], restarts=4).collect()}
    assert all(got[k] <= spark_costs[k] * 1.01 for k in got) and set(got) == {2, 5}
    few = spark.createDataFrame([(1, 1.0, 2.0)] * 5 + [(2, 3.0, 4.0)] * 5, "id long, a double, b double")
    assert [len(s) for s in C._starts(few.select("a", "b"), [(2, 0), (4, 0)], 1)] == [2, 2]
