"""Steps that have to stay bounded where tables grow."""

from itertools import count
from threading import Barrier

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, LDAModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from tallyloom import runtime
from tallyloom.functions import text as X
from tallyloom.functions import wordlists as W
from tallyloom.operators import classify as K
from tallyloom.operators import cluster as C
from tallyloom.operators import evaluate as E
from tallyloom.operators import impute
from tallyloom.operators import text as O
from tallyloom.operators.features import as_vector
from tallyloom.operators.topics import fit_topics
from tallyloom.plans import flows
from tallyloom.plans.registry import QUERIES


def points(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"x{j} double" for j in range(x.shape[1])))


def test_long_runs_of_nouns_and_adjectives(spark):
    """Runs far beyond the stack of a recursive match, and runs of adjectives that end without a noun."""
    noun = next(w for w in W.NOUNS if w.isalpha() and w not in W.STOP_WORDS)
    adjective = next(w for w in W.ADJECTIVES if w.isalpha() and w not in W.STOP_WORDS)
    other = "qqq"
    texts = [" ".join([noun] * 30_000), " ".join([adjective] * 20_000), " ".join([adjective] * 20_000 + [noun]), f"{adjective} {other} {adjective} {noun} {noun} {other} {noun} {adjective} {noun}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["grammar"], r["phrase"].count(" ") + 1) for r in O.phrase_rows(rows, ["doc_id"], "text").collect()}
    assert got == {(0, "NN", 30_000), (2, "JN", 20_001), (3, "JN", 2), (3, "NN", 2)}
    lexicon = spark.createDataFrame([(noun, "N"), (adjective, "J")], "word string, tag string")
    again = O.phrase_rows_by_lexicon(rows, "doc_id", "text", lexicon).collect()
    assert {(r["doc_id"], r["grammar"], r["phrase"].count(" ") + 1) for r in again} == got
    assert set(X._RUNS) == set(X.GRAMMARS)


def test_fits_of_several_k_move_together(spark):
    """The same centres and costs as Spark's own fits from the same seeds, rows with gaps apart."""
    rng = np.random.default_rng(4)
    df = points(spark, np.vstack([rng.normal(c, 0.3, (60, 2)) for c in (0, 2, 5)])).repartition(3, "id").persist()
    fits = C.best_kmeans_of(df, ["x0", "x1"], [2, 3], restarts=2, seed=7)
    data = as_vector(df.select("x0", "x1"), ["x0", "x1"]).select("features").persist()
    for k, fit in fits.items():
        want = min((KMeans(k=k, seed=7 + i, maxIter=100).fit(data) for i in range(2)), key=lambda m: m.summary.trainingCost)
        assert np.isclose(fit.cost, want.summary.trainingCost)
        assert np.allclose(sorted(map(tuple, fit.clusterCenters())), sorted(map(tuple, want.clusterCenters())))
    gappy = df.unionByName(spark.createDataFrame([(900, None, 1.0), (901, float("nan"), 1.0)], "id long, x0 double, x1 double"))
    again = C.best_kmeans(gappy, ["x0", "x1"], 3, restarts=2, seed=7)
    assert {r["cluster"] for r in C.assign(gappy, again, ["x0", "x1"]).filter("id >= 900").collect()} == {None}
    assert C.assign(gappy, again, ["x0", "x1"]).filter("cluster IS NOT NULL").count() == 180


def test_sweep_never_makes_a_row_per_row_and_setting(spark, monkeypatch):
    def refuse(*args):
        raise AssertionError("a row for every row and setting")

    monkeypatch.setattr(C, "_labelled", refuse)
    monkeypatch.setattr(C, "SWEEP_CELLS", 10)
    monkeypatch.setattr(C, "HELD_DISTANCES", 7)
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.2, (30, 2)) for c in (0, 3)] + [np.full((4, 2), 9.0), [[20.0, 20.0]]])
    got = {r["eps"]: r for r in C.dbscan_sweep(points(spark, x), "id", ["x0", "x1"], [1.0, 100.0], [3]).collect()}
    assert (got[1.0]["clusters"], got[1.0]["noise"]) == (3, 1) and (got[100.0]["clusters"], got[100.0]["silhouette"]) == (1, -1.0)
    label = np.array([0] * 30 + [1] * 30 + [2] * 4 + [3])
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    score = []
    for i in range(len(x)):
        mine = label == label[i]
        b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
        a = d[i][mine].sum() / (mine.sum() - 1) if mine.sum() > 1 else None
        score.append(0.0 if a is None else (b - a) / max(a, b))
    assert np.isclose(got[1.0]["silhouette"], np.mean(score))


def test_imputation_in_parts(spark, monkeypatch):
    """Parts give what one part gives, with ties, and a step leaves one table behind."""
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal()), None if i % 3 == 0 else float(rng.normal()), None if i % 5 == 0 else float(rng.normal())) for i in range(400)]
    # Copies under other keys, so that predictions tie, and a row without a key.
    rows += [(1000 + r[0], *r[1:]) for r in rows[100:250]] + [(None, 1.0, None, 2.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    run = lambda: sorted(map(tuple, impute.chained_equations(df, "id", ["a", "b", "c"], m=2, iterations=2).collect()), key=str)
    whole = run()
    held = len(runtime._WRITTEN[spark.sparkContext.applicationId])
    monkeypatch.setattr(impute, "PART", 40)
    assert run() == whole
    assert len(runtime._WRITTEN[spark.sparkContext.applicationId]) == held + 1


def test_topic_quality_infers_once(spark, monkeypatch):
    docs = spark.createDataFrame([(["tea", "milk", "cup"][: 1 + i % 3] * 2,) for i in range(60)], "tk array<string>")
    original, calls = LDAModel.logLikelihood, []
    monkeypatch.setattr(LDAModel, "logPerplexity", lambda self, data: pytest.fail("a second inference"))
    monkeypatch.setattr(LDAModel, "logLikelihood", lambda self, data: calls.append(data) or original(self, data))
    counter, model, (likelihood, perplexity) = fit_topics(docs, "tk", k=2, iterations=2, min_df=1)
    assert len(calls) == 1
    monkeypatch.undo()
    from tallyloom.operators.classify import vocabulary_pipeline
    data = vocabulary_pipeline("tk", 1).fit(docs).transform(docs).select("features")
    assert perplexity > 0 and np.isclose(likelihood / perplexity, model.logLikelihood(data) / model.logPerplexity(data))


def test_linkage_takes_few_exact_distances(monkeypatch):
    asked = []
    exact = C.METRICS["euclidean"]
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(300, 8)), np.round(rng.normal(size=(100, 8)))])
    monkeypatch.setitem(C.METRICS, "minkowski", exact)
    want = C._tree(x, np.arange(len(x)), "minkowski")
    monkeypatch.setitem(C.METRICS, "euclidean", lambda a, b: asked.append(len(b)) or exact(a, b))
    got = C._tree(x, np.arange(len(x)), "euclidean")
    assert got.equals(want) and sum(asked) < len(x) ** 2 / 4


def test_rare_terms_are_not_counted_by_document(spark, monkeypatch):
    """The vocabulary and its weights, with ids that repeat or are null; terms that cannot be in it are never written, even if a second count is needed."""
    rng = np.random.default_rng(9)
    rows = [(None if i % 20 == 0 else i % 150, [f"w{int(x)}" for x in rng.zipf(1.6, 30) if x < 40] + [f"rare{i}_{j}" for j in range(40)]) for i in range(200)]
    df = spark.createDataFrame([*rows, (900, []), (901, None)], "id long, g array<string>")
    counts = {}
    for i, terms in rows:
        for term in terms:
            counts[(i, term)] = counts.get((i, term), 0) + 1
    docs, total = {}, {}
    for (_, term), n in counts.items():
        docs[term], total[term] = docs.get(term, 0) + 1, total.get(term, 0) + n
    kept, written = O.stage, []
    monkeypatch.setattr(O, "stage", lambda d: (written.append(kept(d)), written[-1])[1])
    for most, buckets in ((6, 1 << 18), (6, 7), (1000, 64)):
        monkeypatch.setattr(O, "TERM_BUCKETS", buckets, raising=False)
        chosen = sorted((t for t in docs if docs[t] >= 10), key=lambda t: (-total[t], t))[:most]
        idf = {t: np.log((len(rows) + 3.0) / (docs[t] + 1.0)) + 1 for t in chosen}
        raw = {(i, t): n * idf[t] for (i, t), n in counts.items() if t in idf}
        length = {}
        for (i, _), w in raw.items():
            length[i] = length.get(i, 0.0) + w * w
        got = {(r["id"], r["term"]): r["weight"] for r in O.tfidf_top_terms(df, "id", "g", min_df=10, max_terms=most).collect()}
        assert got.keys() == raw.keys()
        assert all(np.isclose(got[k], raw[k] / length[k[0]] ** 0.5) for k in raw)
        if buckets == 1 << 18:
            assert all("term" not in d.columns or d.filter("term LIKE 'rare%'").count() == 0 for d in written)


def test_models_of_a_fold_share_what_is_prepared(spark):
    """The same scores as with a scaler inside every estimator, fitted once a fold and not once for every model."""
    fitted = []

    class Counted(StandardScaler):
        def fit(self, df, params=None):
            fitted.append(1)
            return super().fit(df, params)

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    rows = [(float(a + 0.5 * rng.normal() > 0), i % 3, DenseVector([a, 5 * b])) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, ["label", "fold", "plain"]).persist()
    models = {"logistic": K.logistic(), "tree": K.tree()}
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC")
    scaler = Counted(inputCol="plain", outputCol="features", withMean=True)
    got = E.compare_models(spark, df, models, ev, 3, "fold", prepare=scaler).collect()
    assert len(fitted) == 3
    whole = {n: Pipeline(stages=[StandardScaler(inputCol="plain", outputCol="features", withMean=True), m]) for n, m in models.items()}
    for row in got:
        scores = E.cross_validate(df, whole[row["model"]], ev, 3, "fold")
        assert np.isclose(row["mean_score"], np.mean(scores)) and np.isclose(row["std_score"], np.std(scores))
    assert [r["model"] for r in E.compare_models(spark, df.withColumnRenamed("plain", "features"), models, ev, 3, "fold").collect()] == [r["model"] for r in got]
    df.unpersist()


def test_parts_of_the_risk_model_do_not_wait_for_each_other(spark, tmp_path, monkeypatch):
    """Two folds are over-sampled at the same time, and every part of the report comes out."""
    n = 240
    customers = [(i, f"c{i}", 0, float((i * 37) % 500 - 60), "A") for i in range(n)]
    orders = [(j, j % n, "O", 100.0 + (j * 7919) % 9000, "1-URGENT" if (j * 31 + j // n * 17) % 10 < 2 + 3 * (j % n % 2) else "5-LOW") for j in range(6 * n)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    both, first, smote = Barrier(2), count(), flows.N.smote

    def met(*args, **kw):
        if next(first) < 2:
            both.wait(timeout=60)
        return smote(*args, **kw)

    monkeypatch.setattr(flows.N, "smote", met)
    rows = QUERIES["risk_model_report"](spark, str(tmp_path)).collect()
    assert {r["model"] for r in rows} == {"tree", "logistic"}
    assert all(0 <= r[c] <= 1 for r in rows for c in ("mean_score", "held_out_auc"))
