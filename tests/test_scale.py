"""Steps whose work has to follow the rows, not slices, settings or copies of the work."""

import numpy as np
import pytest
from pyspark.ml import classification as MC
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallyloom import runtime
from tallyloom.operators import classify as K
from tallyloom.operators import evaluate as E
from tallyloom.operators.features import as_vector
from tallyloom.plans import load_all

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(400, 2)), 2)
    y = ((x[:, 0] + x[:, 1] ** 2 + rng.normal(scale=0.4, size=400)) > 0.8).astype(float)
    plain = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(400)], "key long, label double, a double, b double")
    return as_vector(plain, COLUMNS).persist()


def test_sample_for_a_fit_is_one_slice_in_order(rows):
    got = [K.fit_sample(rows.repartition(n), "key", 150) for n in (3, 37)]
    assert [d.rdd.getNumPartitions() for d in got] == [1, 1]
    keys = [[r["key"] for r in d.collect()] for d in got]
    assert keys[0] == keys[1] == sorted(keys[0]) and 100 < len(keys[0]) < 200
    assert K.fit_sample(rows.repartition(9), "key").count() == 400


@pytest.mark.parametrize("make", [lambda: K.forest(numTrees=7, maxDepth=5), lambda: K.boosted(maxIter=6)])
def test_cells_are_scored_like_their_rows(spark, rows, make):
    model = make().fit(K.fit_sample(rows, "key"))
    odd = spark.createDataFrame([(1.0, float("nan"), 0.1), (0.0, float("inf"), float("-inf")), (1.0, -0.0, 0.0)], "label double, a double, b double")
    many = as_vector(rows.select("label", *COLUMNS).unionByName(odd).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))), COLUMNS)
    scored = K.score_cells(model, many, "label", 2)
    want = E.confusion(model.transform(many), "label", "prediction").collect()
    assert sorted(map(tuple, E.confusion(scored, "label", "prediction", "n").collect())) == sorted(map(tuple, want))
    assert scored.count() <= 403
    assert all(len(c) <= 31 for c in K.thresholds(model, 2))


def test_depths_share_a_fit(rows, monkeypatch):
    est = K.tree()
    grid = ParamGridBuilder().addGrid(est.maxDepth, [0, 1, 3]).addGrid(est.minInstancesPerNode, [5, 40]).build()
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    df = rows.withColumn("fold", (F.col("key") % 2).cast("int")).persist()
    want = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=2, foldCol="fold", parallelism=2).fit(df)
    fits, fit = [], MC.DecisionTreeClassifier._fit
    monkeypatch.setattr(MC.DecisionTreeClassifier, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    model, table = E.grid_search(df, est, grid, ev, 2, "fold")
    assert np.allclose(model.avgMetrics, want.avgMetrics) and np.allclose(model.stdMetrics, want.stdMetrics)
    assert model.bestModel.toDebugString.split("\n")[1:] == want.bestModel.toDebugString.split("\n")[1:]
    assert table.count() == 6 and len(fits) == 2 * 2 + 1


def test_searched_trees_share_fits_and_scores(rows, monkeypatch):
    space = {"maxDepth": [0, 1, 2, 4], "minInfoGain": [0.0, 0.01, 0.05], "minInstancesPerNode": [5, 40]}
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    marked = rows.withColumn("fold", E.hash_fold("key", 5, "rung-fold"))
    want = {}
    for rung, share in enumerate((0.5, 1.0)):
        part = marked.filter(E.unit_hash("key", F.lit("rung")) < share).persist()
        for i, s in enumerate(E.drawn_settings(space, 24, 1)):
            want[rung, i] = ev.evaluate(K.tree(**s).fit(part.filter("fold <> 0")).transform(part.filter("fold = 0")))
    fits, fit = [], MC.DecisionTreeClassifier._fit
    monkeypatch.setattr(MC.DecisionTreeClassifier, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    best, model, rungs, trials = E.halving_search(rows, "key", K.tree, space, ev, draws=24, factor=2, rungs=2)
    got = {(r["rung"], r["draw"]): r["score"] for r in trials.collect()}
    assert len(got) == 36 and all(np.isclose(x, want[k]) for k, x in got.items()) and len(set(got.values())) > 4
    assert [r["settings"] for r in rungs.orderBy("rung").collect()] == [24, 12]
    # One fit a rung for every value of the one parameter that changes a tree throughout, and the last.
    assert len(fits) <= 2 + 2 + 1
    assert model.toDebugString.split("\n")[1:] == K.tree(**best).fit(rows).toDebugString.split("\n")[1:]


def test_counted_score_is_that_of_the_rows(rows):
    scored = K.tree().fit(rows).transform(rows)
    for name in ("precisionByLabel", "f1", "accuracy", "hammingLoss"):
        ev = MulticlassClassificationEvaluator(metricName=name, metricLabel=1.0)
        assert np.isclose(E.counted_score(ev, scored), ev.evaluate(scored))


def test_random_features_in_slices(spark, rows, monkeypatch):
    lifted = lambda: [r["f"] for r in K.random_features(rows.select("key", *COLUMNS), COLUMNS, size=20, name="f").orderBy("key").collect()]
    whole = lifted()
    monkeypatch.setattr(K, "LIFTED", 7)
    assert np.allclose([v.toArray() for v in whole], [v.toArray() for v in lifted()])


def test_spread_deals_few_large_files_into_bounded_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(30_000).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert runtime.spread(scan, "id").rdd.getNumPartitions() == max(cores, 3)
    assert runtime.spread(scan, "id", rows=100).rdd.getNumPartitions() == max(cores, 300)
    monkeypatch.setattr(runtime, "SPREAD_BYTES", 1_000)
    assert runtime.spread(scan, "id").rdd.getNumPartitions() > max(cores, 50)


def _texts(spark, folder, n=60):
    words = ["Apple", "river", "stone", "Cloud", "garden", "window", "paper"]
    texts = [(i, " ".join(words[(i * k + k) % 7] for k in range(1, 3 + i % 9)) if i % 11 else "1 2 3", [None, "en", "de"][i % 3], "s", 10 + i % 9) for i in range(n)]
    texts += [(n, None, "en", "s", None), (n + 1, "", "fr", "s", 0)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(n) if i % 4], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_token_lists_read_the_texts_once(spark, tmp_path):
    _texts(spark, tmp_path)
    out = load_all().QUERIES["distinct_token_lists"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    texts = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    want = {}
    for r in texts:
        tokens = [w for w in (r["text"] or "").split() if w.isalpha()]
        if tokens and r["lang"] is not None:
            lists, words = want.setdefault(r["lang"], (set(), set()))
            lists.add(" ".join(tokens))
            words.update(tokens)
    assert {(r["lang"], r["token_lists"], r["words"]) for r in out.collect()} == {(k, len(a), len(b)) for k, (a, b) in want.items()}


def test_ngrams_are_hashed_once(spark, tmp_path, monkeypatch):
    _texts(spark, tmp_path, 200)
    hashed, transform = [], HashingTF._transform
    monkeypatch.setattr(HashingTF, "_transform", lambda self, df: hashed.append(1) or transform(self, df))
    out = load_all().QUERIES["helpfulness_scores"](spark, str(tmp_path))
    assert len(hashed) == 1 and sum(r["n"] for r in out.collect()) == 52
