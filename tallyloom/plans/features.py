"""Queries over scaling, transforms, imputation, neighbours and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import evaluate as E
from tallyloom.operators import features as FE
from tallyloom.operators import neighbors as N
from tallyloom.plans.common import CUSTOMER_FEATURES, CUSTOMER_SQL, customer_features, rounded
from tallyloom.plans.registry import once, query
from tallyloom.runtime import stage
from tallyloom.plans.relational import duck_hash


@query("F06", f"WITH f AS ({CUSTOMER_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS scale FROM f" for c in CUSTOMER_FEATURES))
def scaling_parameters(t):
    params = FE.scaling_params(customer_features(t), CUSTOMER_FEATURES)
    return rounded(FE.params_table(t.spark, params), 4, "mean", "scale")


@query("F06", f"WITH f AS ({CUSTOMER_SQL}) SELECT c_custkey, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_samp({c}) FROM f), 6) AS {c}" for c in CUSTOMER_FEATURES) + " FROM f")
def standardised_rows(t):
    scaled = FE.standardise(customer_features(t), CUSTOMER_FEATURES, ddof=1)
    return rounded(scaled.select("c_custkey", *CUSTOMER_FEATURES), 6, *CUSTOMER_FEATURES)


@query("F06 M38", f"WITH f AS ({CUSTOMER_SQL}) SELECT c_custkey, round(balance, 4) AS balance, round(spend, 2) AS spend FROM f")
def scaling_round_trip(t):
    f = customer_features(t).select("c_custkey", "balance", "spend")
    params = FE.scaling_params(f, ["balance", "spend"])
    back = FE.invert_scaling(FE.apply_scaling(f, params), params)
    return rounded(rounded(back, 4, "balance"), 2, "spend")


_YJ = "CASE WHEN {x} >= 0 THEN (pow({x} + 1, {l}) - 1) / {l} ELSE -(pow(1 - {x}, 2 - {l}) - 1) / (2 - {l}) END"


@query("F07", "SELECT c_custkey, round(" + _YJ.format(x="c_acctbal", l=0.7) + ", 6) AS powered FROM customer")
def yeo_johnson_given(t):
    out = FE.apply_yeo_johnson(t.customer.select("c_custkey", F.col("c_acctbal").alias("powered")), {"powered": 0.7})
    return rounded(out, 6, "powered")


@query("F07")
def yeo_johnson_fitted(t):
    """Fitted exponents with the mean and spread of the transformed columns."""
    cols = ["balance", "n_orders", "avg_price"]
    f = customer_features(t)
    _, lambdas, params = FE.power_transform(f, cols)
    rows = [(c, lambdas[c], params[c][0], params[c][1]) for c in cols]
    return rounded(t.spark.createDataFrame(rows, "column string, lambda double, mean double, scale double"), 4, "lambda")


@query("F07", "SELECT c_custkey, round(c_acctbal, 4) AS balance FROM customer")
def yeo_johnson_round_trip(t):
    f = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"))
    lam = {"balance": 1.3}
    return rounded(FE.invert_yeo_johnson(FE.apply_yeo_johnson(f, lam), lam), 4, "balance")


@query("F12 C07", "SELECT o_orderkey, round(ln(o_totalprice), 10) AS log_price FROM orders")
def log_feature(t):
    return t.orders.select("o_orderkey", F.round(F.ln("o_totalprice"), 10).alias("log_price"))


# --- neighbours --------------------------------------------------------------------------------------------------

def vectors(t):
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


_DIST = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("J07", f"""
    SELECT vec_id, neighbour, round(d, 6) AS distance, CAST(rn AS INTEGER) AS rank FROM (
        SELECT a.vec_id, b.vec_id AS neighbour, {_DIST} AS d,
               row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id) AS rn
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rn <= 5""")
def nearest_neighbours(t):
    v = vectors(t)
    return rounded(N.knn_join(v, v, 5, "vec_id", "vec_id", "vec", "vec", exclude_self=True), 6, "distance")


_IN_TEST = f"{duck_hash('vec_id', 'knn')} / 4294967296.0 >= 0.7"


@query("M10", f"""
    WITH a AS (SELECT * FROM embeddings WHERE {_IN_TEST}), b AS (SELECT * FROM embeddings WHERE NOT ({_IN_TEST})),
    nn AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id) AS rn FROM a, b),
    v AS (SELECT vec_id, label, count(*) AS n FROM nn WHERE rn <= 15 GROUP BY ALL)
    SELECT vec_id, prediction FROM (SELECT vec_id, CAST(label AS DOUBLE) AS prediction,
        row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS rn FROM v) WHERE rn = 1""")
def knn_classes(t):
    from tallyloom.operators.sampling import hash_split
    parts = hash_split(vectors(t), "vec_id", {"train": 0.7, "test": 0.3}, "knn")
    return N.knn_classify(parts.filter("split = 'train'"), parts.filter("split = 'test'"), "vec_id", "vec", "label", 15)


GAPPY = ["balance", "n_orders", "avg_price", "max_price"]
# Zeros stand for missing values, and so does a negative balance.
GAP_SQL = f"""
    SELECT c_custkey, CASE WHEN balance >= 0 THEN balance / 1000 END AS balance, n_orders, nullif(avg_price, 0) / 10000 AS avg_price,
           nullif(max_price, 0) / 10000 AS max_price FROM ({CUSTOMER_SQL})"""


def gappy_customers(t):
    return customer_features(t).select(
        "c_custkey", F.when(F.col("balance") >= 0, F.col("balance") / 1000).alias("balance"), "n_orders",
        (F.nullif("avg_price", F.lit(0.0)) / 10000).alias("avg_price"), (F.nullif("max_price", F.lit(0.0)) / 10000).alias("max_price"))


def _impute_sql(c: str) -> str:
    terms = " + ".join(f"CASE WHEN a.{x} IS NOT NULL AND b.{x} IS NOT NULL THEN (a.{x} - b.{x}) ** 2 ELSE 0 END" for x in GAPPY)
    shared = " + ".join(f"CASE WHEN a.{x} IS NOT NULL AND b.{x} IS NOT NULL THEN 1 ELSE 0 END" for x in GAPPY)
    return f"""SELECT c_custkey, avg(v) AS v FROM (
        SELECT a.c_custkey, b.{c} AS v, row_number() OVER (PARTITION BY a.c_custkey
            ORDER BY sqrt(({terms}) * {len(GAPPY)}.0 / ({shared})), b.c_custkey) AS rn
        FROM f a JOIN f b ON a.{c} IS NULL AND b.{c} IS NOT NULL WHERE ({shared}) > 0) WHERE rn <= 5 GROUP BY c_custkey"""


@query("F08", f"WITH f AS ({GAP_SQL}), " + ", ".join(f"fill_{c} AS ({_impute_sql(c)})" for c in GAPPY if c != "n_orders") + """
    SELECT c_custkey, round(coalesce(f.balance, fill_balance.v), 10) AS balance, n_orders, round(coalesce(f.avg_price, fill_avg_price.v), 10) AS avg_price,
           round(coalesce(f.max_price, fill_max_price.v), 10) AS max_price
    FROM f """ + " ".join(f"LEFT JOIN fill_{c} USING (c_custkey)" for c in GAPPY if c != "n_orders"))
def knn_imputed(t):
    return rounded(N.knn_impute(gappy_customers(t), "c_custkey", GAPPY, 5), 10, "balance", "avg_price", "max_price")


_HOP = ["balance", "n_orders", "avg_price"]


def _hash2(i: str, j) -> str:
    return f"('0x' || substr(md5({i} || '|{j}|hopkins'), 1, 8))::BIGINT / 4294967296.0"


_SCALED_HOP = f"WITH f0 AS ({CUSTOMER_SQL}), f AS (SELECT c_custkey AS id, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM f0)) / (SELECT stddev_pop({c}) FROM f0) AS {c}" for c in _HOP) + " FROM f0)"
_GAPS = " + ".join(f"(a.{c} - f.{c}) ** 2" for c in _HOP)


@query("M26", _SCALED_HOP + f""",
    real AS (SELECT * FROM f ORDER BY ('0x' || substr(md5(id || '|hopkins'), 1, 8))::BIGINT, id LIMIT 150),
    even AS (SELECT i AS id, """ + ", ".join(
        f"(SELECT min({c}) FROM f) + ((SELECT max({c}) FROM f) - (SELECT min({c}) FROM f)) * {_hash2('i', j)} AS {c}" for j, c in enumerate(_HOP)) + f"""
        FROM range(150) r(i)),
    w AS (SELECT sum(d) AS w FROM (SELECT min(sqrt({_GAPS})) AS d FROM real a JOIN f ON a.id <> f.id GROUP BY a.id)),
    u AS (SELECT sum(d) AS u FROM (SELECT min(sqrt({_GAPS})) AS d FROM even a, f GROUP BY a.id))
    SELECT round(u / (u + w), 8) AS hopkins_u_share FROM u, w""")
def hopkins_statistic(t):
    scaled = FE.standardise(customer_features(t), _HOP)
    return rounded(N.hopkins(scaled, "c_custkey", _HOP, 150), 8, "hopkins_u_share")


def quality_rows(t):
    """Length features and the quality label of the labelled documents."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars", F.size(F.split("text", " ")).alias("n_words")), on="doc_id")
    return rows.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.col("n_words").cast("double").alias("n_words"), "quality")


@query("F10 M40")
def smote_class_sizes(t):
    """Class sizes and mean features after over-sampling the rarer label of the documents."""
    rows = quality_rows(t)
    made = N.smote(rows, "doc_id", ["n_chars", "n_words"], "quality", 0)
    every = rows.select("n_chars", "n_words", "quality", F.lit(0).alias("synthetic")).unionByName(made.withColumn("synthetic", F.lit(1)))
    return every.groupBy("quality", "synthetic").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"))


@once
def completed(t):
    """The five completed data sets of thirty rounds."""
    from tallyloom.operators.impute import chained_equations
    return stage(chained_equations(gappy_customers(t), "c_custkey", GAPPY, m=5, iterations=30))


def pooled(sets, y: str, x: str):
    """Pooled slope of y on x over the completed sets (imputation, ...): one grouped aggregate fits them all."""
    from tallyloom.operators import linear
    s = sets.groupBy("imputation").agg(
        F.regr_slope(y, x).alias("estimate"), F.count(F.lit(1)).alias("n"), F.regr_sxx(y, x).alias("sxx"),
        (F.regr_syy(y, x) - F.pow(F.regr_sxy(y, x), F.lit(2)) / F.regr_sxx(y, x)).alias("rss"))
    return linear.pool(s.select("imputation", F.lit(x).alias("term"), "estimate", F.sqrt(F.col("rss") / (F.col("n") - 2) / F.col("sxx")).alias("std_error")))


@query("M33 F09")
def pooled_imputed_fits(t):
    """The five completed sets of chained imputation, each fitted and pooled: price of the dearest order on the mean price."""
    return pooled(completed(t), "max_price", "avg_price")


@query("F09")
def chained_imputation(t):
    """Means of the imputed columns in each of five completed data sets."""
    return completed(t).groupBy("imputation").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in GAPPY])


# --- evaluation --------------------------------------------------------------------------------------------------

SCORED_SQL = """
    SELECT doc_id, quality AS label, (n_chars % 89) / 89.0 + 0.3 * quality AS score,
           CASE WHEN (n_chars % 89) / 89.0 + 0.3 * quality > 0.6 THEN 1 ELSE 0 END AS prediction
    FROM documents JOIN labels USING (doc_id)"""


def scored_documents(t):
    score = (F.col("n_chars") % 89) / 89.0 + 0.3 * F.col("quality")
    return t.documents.select("doc_id", "n_chars").join(t.labels, on="doc_id").select(
        "doc_id", F.col("quality").alias("label"), score.alias("score"), F.when(score > 0.6, 1).otherwise(0).alias("prediction"))


@query("M19", f"""
    SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label), 8) AS row_share
    FROM (SELECT label, prediction, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL)""")
def confusion_counts(t):
    return rounded(E.confusion(scored_documents(t), "label", "prediction"), 8, "row_share")


@query("M19", f"SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM ({SCORED_SQL})")
def accuracy_score(t):
    return rounded(E.accuracy(scored_documents(t), "label", "prediction"), 8, "accuracy")


@query("M20", f"""
    WITH s AS ({SCORED_SQL}), c AS (SELECT unnest([0, 1]) AS k),
    p AS (SELECT k, count(*) FILTER (label = k AND prediction = k) AS tp, count(*) FILTER (prediction = k) AS pp,
                 count(*) FILTER (label = k) AS support FROM s, c GROUP BY k),
    r AS (SELECT CAST(k AS VARCHAR) AS class, tp, coalesce(tp / nullif(pp, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall, support FROM p),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM r)
    SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f
    UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8),
        round(sum(f1 * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(t):
    return rounded(E.classification_report(scored_documents(t), "label", "prediction"), 8, "precision", "recall", "f1")


@query("M18", f"""
    WITH s AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM ({SCORED_SQL})),
    n AS (SELECT sum(r) FILTER (label = 1) AS r, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM s)
    SELECT round((r - p * (p + 1) / 2) / (p * q), 8) AS auc, p AS positives, q AS negatives FROM n""")
def auc_rank(t):
    return rounded(E.auc_rank(scored_documents(t).withColumn("score", F.round("score", 9)), "label", "score"), 8, "auc")


@query("M18", f"""
    WITH s AS (SELECT round(score, 9) AS score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM ({SCORED_SQL}) GROUP BY 1)
    SELECT score AS threshold, round(sum(p) OVER w / (SELECT sum(p) FROM s), 8) AS tpr, round(sum(q) OVER w / (SELECT sum(q) FROM s), 8) AS fpr
    FROM s WINDOW w AS (ORDER BY score DESC)""")
def roc_points(t):
    return rounded(E.roc_points(scored_documents(t).withColumn("score", F.round("score", 9)), "label", "score"), 8, "tpr", "fpr")
