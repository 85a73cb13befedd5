"""Queries over classifiers, searches and topic models."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.operators import classify as K
from tallyloom.operators import evaluate as E
from tallyloom.operators import linear
from tallyloom.operators.features import as_vector
from tallyloom.operators.sampling import hash_fold, hash_split
from tallyloom.operators.topics import fit_topics, top_terms
from tallyloom.plans.common import rounded
from tallyloom.plans.linear import ROWS_SQL, logit_rows
from tallyloom.plans.registry import by_folder, once, query
from tallyloom.plans.text import CLEAN, GRAMS, STEMS, _phrase_sql
from tallyloom.runtime import key_hash, spread, stage

COLUMNS = ["qty", "disc", "tax", "price"]


def keyed_rows(t):
    return logit_rows(t).withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")).select("key", "label", *COLUMNS)


@once
def split_rows(t):
    """(train, test) with scaled features, written once; the test rows are scaled with the training statistics."""
    from tallyloom.operators.features import apply_scaling, scaling_params
    parts = stage(spread(hash_split(keyed_rows(t), "key", {"train": 0.7, "test": 0.3}, "models"), rows=1_000_000))
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    params = scaling_params(train, COLUMNS)
    return [as_vector(apply_scaling(d, params), COLUMNS) for d in (train, test)]


def scaler():
    """The scaler of the columns, to be fitted to the training part of every fold."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    return Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="plain", handleInvalid="keep"),
                            StandardScaler(inputCol="plain", outputCol="features", withMean=True)])


def report(t, estimator):
    train, test = split_rows(t)
    scored = estimator.fit(train).transform(test)
    return E.classification_report(scored.select("label", "prediction"), "label", "prediction")


CELLS = "label double, prediction double, n long, row_share double"


def _cells(fit):
    """The confusion rows, at most one per pair of classes, of a model fitted on the training part or a sample of it."""
    def run(t):
        train, test = split_rows(t)
        return [tuple(r) for r in E.confusion(fit(train).transform(test), "label", "prediction").select("label", "prediction", "n", "row_share").collect()]
    return run


def _tree_cells(model, test):
    """The confusion rows of a model of many trees, whose thresholds cut the test rows into cells that are scored once."""
    cells = E.confusion(K.score_cells(model, test, "label", len(COLUMNS)), "label", "prediction", "n")
    return [tuple(r) for r in cells.select("label", "prediction", "n", "row_share").collect()]


@by_folder
def boosted_cells(t):
    train, test = split_rows(t)
    return _tree_cells(K.boosted(maxIter=500, stepSize=0.05).fit(train), test)


svm_cells = by_folder(_cells(lambda d: K.kernel_svm(COLUMNS).fit(d)))
perceptron_cells = by_folder(_cells(lambda d: K.perceptron(len(COLUMNS)).fit(K.fit_sample(d, "key"))))
adaboost_cells = by_folder(_cells(lambda d: K.AdaBoost(rounds=200).fit(d)))
tree_cells = by_folder(_cells(lambda d: K.tree().fit(d)))
logistic_cells = by_folder(_cells(lambda d: K.logistic().fit(d)))


@by_folder
def forest_fit(t):
    """(importances by feature, confusion rows on the test part) of the full forest."""
    train, test = split_rows(t)
    model = K.forest().fit(train)
    return [(c, float(model.featureImportances[i])) for i, c in enumerate(COLUMNS)], _tree_cells(model, test)


@query("M03 M18 F05")
def logistic_classifier_auc(t):
    train, test = split_rows(t)
    scored = K.logistic().fit(train).transform(test)
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored)
    exact = E.auc_rank(scored.select("label", vector_to_array("probability")[1].alias("score")), "label", "score")
    return exact.withColumn("auc_ml", F.lit(float(auc)))


@query("M04 M20")
def decision_tree_report(t):
    return report(t, K.tree())


@query("M05 M37 L03")
def forest_importance(t):
    return t.spark.createDataFrame(forest_fit(t)[0], "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(15)


@query("M06 M19")
def boosted_trees_confusion(t):
    return t.spark.createDataFrame(boosted_cells(t), CELLS)


@query("M07 M20")
def adaboost_report(t):
    train, test = split_rows(t)
    scored = K.AdaBoost(rounds=200).fit(train).transform(test)
    return E.classification_report(scored.select("label", "prediction"), "label", "prediction")


LABELLED_SQL = f"""
    f0 AS (SELECT *, CASE WHEN y > 58 THEN 1.0 ELSE 0.0 END::DOUBLE AS l0 FROM ({ROWS_SQL})),
    f AS (SELECT *, CASE WHEN (l_partkey * 31 + l_orderkey * 17) % 10 < 2 THEN 1.0 - l0 ELSE l0 END AS label FROM f0)"""


@query("M08", f"WITH {LABELLED_SQL}" + " UNION ALL ".join(f"""
    SELECT label, count(*) AS n, '{c}' AS feature, round(avg({c}), 8) AS mean,
           round(var_pop({c}) + 1e-9 * (SELECT greatest(var_pop(qty), var_pop(disc), var_pop(tax), var_pop(price)) FROM f), 6) AS variance
    FROM f GROUP BY label""" for c in COLUMNS))
def naive_bayes_moments(t):
    table = K.bayes_table(keyed_rows(t), "label", COLUMNS)
    return rounded(rounded(table, 8, "mean"), 6, "variance")


_NB = " - ".join(["ln(n / (SELECT sum(n) FROM m))"] + [
    f"0.5 * ln(2 * pi() * v_{c}) - (f.{c} - m_{c}) ** 2 / (2 * v_{c})" for c in ("qty", "disc")])


@query("M08 M19", f"""
    WITH {LABELLED_SQL.replace("f AS (SELECT *,", "f1 AS (SELECT *,")},
    f AS (SELECT row_number() OVER () AS rid, qty, disc, label FROM f1),
    t AS (SELECT 1e-9 * greatest(var_pop(qty), var_pop(disc)) AS e FROM f),
    m AS (SELECT label AS cls, count(*) AS n, avg(qty) AS m_qty, avg(disc) AS m_disc, var_pop(qty) + max(e) AS v_qty, var_pop(disc) + max(e) AS v_disc
          FROM f, t GROUP BY label),
    s AS (SELECT rid, label, cls, {_NB} AS score FROM f, m),
    p AS (SELECT label, arg_max(cls, score) AS prediction FROM s GROUP BY rid, label)
    SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label), 8) AS row_share FROM (
        SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL)""")
def naive_bayes_confusion(t):
    rows = keyed_rows(t)
    scored = K.bayes_predict(rows, K.bayes_table(rows, "label", ["qty", "disc"]), "label", ["qty", "disc"])
    return rounded(E.confusion(scored, "label", "prediction"), 8, "row_share")


@query("M08")
def naive_bayes_ml_confusion(t):
    train, test = split_rows(t)
    return E.confusion(K.gaussian_bayes().fit(train).transform(test), "label", "prediction")


@query("M09 M19")
def discriminant_confusion(t):
    rows = keyed_rows(t)
    model = linear.fit_discriminant(rows, "label", COLUMNS)
    return E.confusion(linear.apply_discriminant(rows, model, COLUMNS), "label", "prediction")


@query("M11 M19")
def kernel_svm_confusion(t):
    return t.spark.createDataFrame(svm_cells(t), CELLS)


@query("M12 M19")
def perceptron_confusion(t):
    return t.spark.createDataFrame(perceptron_cells(t), CELLS)


@query("M21")
def model_comparison(t):
    """Cross-validated AUC of several classifiers, best first."""
    rows = keyed_rows(t).select("label", *COLUMNS, hash_fold("key", 5, "cv").alias("fold")).persist()
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC")
    out = E.compare_models(t.spark, rows, {"logistic": K.logistic(), "tree": K.tree(), "bayes": K.gaussian_bayes()}, ev, 5, "fold", prepare=scaler())
    rows.unpersist()
    return out


@query("M22 M34")
def searched_tree(t):
    """Grid search by precision of the positive class; the refitted best model scores the held-out rows."""
    from pyspark.ml.tuning import ParamGridBuilder
    train, test = split_rows(t)
    train = train.withColumn("fold", hash_fold("key", 5, "grid")).persist()
    est = K.tree()
    grid = ParamGridBuilder().addGrid(est.maxDepth, [2, 4, 6]).addGrid(est.minInstancesPerNode, [10, 50, 200]).build()
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    model, table = E.grid_search(train, est, grid, ev, 5, "fold")
    held_out = float(ev.evaluate(model.transform(test)))
    train.unpersist()
    return table.withColumn("held_out_precision", F.lit(held_out))


# 8 x 6 x 3 x 4 = 576 settings.
TREE_SPACE = {"maxDepth": [2, 3, 4, 5, 6, 7, 8, 9], "minInstancesPerNode": [1, 5, 10, 50, 100, 200], "maxBins": [16, 32, 64], "minInfoGain": [0.0, 0.0005, 0.002, 0.01]}


@once
def random_search(t):
    """Drawn settings of the tree, by precision of the positive class."""
    train, _ = split_rows(t)
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    return E.halving_search(train, "key", K.tree, TREE_SPACE, ev, draws=18, factor=3, rungs=3, seed=5)


@query("M22 M34")
def random_searched_tree(t):
    """All trials of the random search, and how the winner, fitted on the whole training part, does on the held-out rows."""
    _, model, _, trials = random_search(t)
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    return trials.withColumn("held_out_precision", F.lit(float(E.counted_score(ev, model.transform(split_rows(t)[1])))))


_RUNG = f"""
    f AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS key FROM ({ROWS_SQL})),
    s AS (SELECT ('0x' || substr(md5(key || '|rung'), 1, 8))::BIGINT / 4294967296.0 AS u, ('0x' || substr(md5(key || '|rung-fold'), 1, 8))::BIGINT % 5 AS fold
          FROM f WHERE ('0x' || substr(md5(key || '|models'), 1, 8))::BIGINT / 4294967296.0 < 0.7)"""


@query("M22 L07", f"""WITH {_RUNG}, r(rung, settings, kept, part) AS (VALUES (0, 18, 6, 1.0 / 9), (1, 6, 2, 1.0 / 3), (2, 2, 1, 1.0))
    SELECT rung, settings, count(*) FILTER (fold <> 0) AS train_rows, count(*) FILTER (fold = 0) AS valid_rows, kept
    FROM r JOIN s ON u < part GROUP BY rung, settings, kept""")
def search_rungs(t):
    """Budget of every rung of the random search: settings, rows that fit them and rows that judge them, and how many go on."""
    return random_search(t)[2].drop("best_score")


def token_documents(t):
    docs = X.with_ngrams(spread(t.documents, "doc_id"), "text", "grams", stemmed=True)
    docs = X.with_phrases(docs.withColumn("tokens", X.tokens("text")), "tokens")
    return docs.select("doc_id", "grams", F.transform("phrases", lambda p: p["phrase"]).alias("phrases"), F.col("n_chars").cast("double").alias("n_chars"))


BUCKETS = 2000
_BUCKET_SQL = f"CAST(('0x' || substr(md5(term), 1, 8))::BIGINT % {BUCKETS} AS INTEGER)"


@query("F01", _phrase_sql("documents", "doc_id") + f""",
    term AS (SELECT doc_id, 'grams' AS source, unnest({GRAMS}) AS term FROM (SELECT doc_id, {STEMS} AS s FROM documents)
             UNION ALL SELECT doc_id, 'phrases', phrase FROM p)
    SELECT source, {_BUCKET_SQL} AS bucket, count(DISTINCT doc_id) AS docs, count(*) AS total FROM term GROUP BY ALL""")
def hashed_term_buckets(t):
    """Documents and total count per hash bucket of n-grams and phrases: hashed terms, grouped; nothing is written for empty buckets."""
    docs = stage(token_documents(t))
    rows = docs.select("doc_id", F.explode(F.array(F.struct(F.lit("grams").alias("source"), F.col("grams").alias("terms")),
                                                   F.struct(F.lit("phrases").alias("source"), F.col("phrases").alias("terms")))).alias("x"))
    cells = rows.select("doc_id", "x.source", F.explode("x.terms").alias("term")).select("doc_id", "source", (key_hash("term") % BUCKETS).cast("int").alias("bucket"))
    per = cells.groupBy("doc_id", "source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))


@query("F02 F03", f"""
    WITH v AS (SELECT DISTINCT doc_id, unnest({CLEAN}) AS term FROM documents)
    SELECT term, round(CASE WHEN count(*) < 10 THEN 0.0 ELSE ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) END, 10) AS idf FROM v GROUP BY term""")
def vocabulary_weights(t):
    """Every term with its idf weight, 0 for those of fewer than ten documents."""
    docs = spread(t.documents, "doc_id").select(X.clean_tokens("text").alias("tk"))
    n = t.documents.count()
    counts = docs.select(F.explode(F.array_distinct("tk")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.select("term", F.round(F.when(F.col("df") < 10, 0.0).otherwise(F.log((n + 1.0) / (F.col("df") + 1.0))), 10).alias("idf"))


@query("F13 F05 M03 M18")
def text_classifier_auc(t):
    """Hashed n-gram and phrase weights with a length feature, fitted as one pipeline, scored on held-out documents."""
    docs = stage(token_documents(t)).join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), on="doc_id")
    parts = stage(hash_split(docs, "doc_id", {"train": 0.7, "test": 0.3}, "text"))
    prepared = K.text_pipeline(["grams", "phrases"], ["n_chars"]).fit(parts.filter("split = 'train'"))
    model = K.logistic().fit(prepared.transform(parts.filter("split = 'train'")))
    scored = model.transform(prepared.transform(parts.filter("split = 'test'")))
    out = E.auc_rank(scored.select("label", vector_to_array("probability")[1].alias("score")), "label", "score")
    return out.withColumn("auc_ml", F.lit(float(BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored))))


@query("M16 M39 U04")
def topic_terms(t):
    """Ten leading terms of every topic, with the fit measures of the model."""
    docs = spread(t.documents, "doc_id").select(X.clean_tokens("text").alias("tk"))
    counter, model, (likelihood, perplexity) = fit_topics(docs, "tk", k=50, iterations=4)
    return top_terms(counter, model, 10).withColumns({"log_likelihood": F.lit(likelihood), "log_perplexity": F.lit(perplexity)})
