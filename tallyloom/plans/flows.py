"""Whole analyses composed from the operators."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.functions import scalar as S
from tallyloom.functions import text as X
from tallyloom.operators import basket as B
from tallyloom.operators import classify as K
from tallyloom.operators import clean
from tallyloom.operators import cluster as C
from tallyloom.operators import evaluate as E
from tallyloom.operators import features as FE
from tallyloom.operators import neighbors as N
from tallyloom.operators import text as O
from tallyloom.operators.joins import enrich
from tallyloom.operators.sampling import downsample_class, hash_fold, hash_split
from tallyloom.plans.basket import RULES_SQL, _rules
from tallyloom.plans.common import customer_features, rounded, views
from tallyloom.plans.features import GAPPY, gappy_customers
from tallyloom.plans.registry import query
from tallyloom.plans.text import CLEAN, WORDS, _in
from tallyloom.functions import wordlists as W
from tallyloom.runtime import spread, stage
from tallyloom.sources import io


_LEX = ", ".join(f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, p, s in W.SENTIMENT)


@query("P19 P14 C01 C02 C03 T10 J03 S09", rf"""
    WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1),
    lex AS (SELECT * FROM (VALUES {_LEX}) v(word, polarity, subjectivity)),
    pr AS (SELECT doc_id, unnest(list_zip(list_concat([''], w[:-2]), w)) AS p FROM (SELECT doc_id, {WORDS} AS w FROM d) WHERE len(w) > 0),
    sc AS (SELECT doc_id, avg(greatest(-1.0, least(1.0, polarity * CASE WHEN p[1] IN {_in(W.NEGATIONS)} THEN {W.NEGATION_FACTOR}
               WHEN p[1] IN {_in(W.INTENSIFIERS)} THEN {W.INTENSIFIER_FACTOR} ELSE 1.0 END))) AS v, avg(subjectivity) AS sj
           FROM pr JOIN lex ON p[2] = word GROUP BY doc_id)
    SELECT lang AS Category, source AS Origin, quality AS Useful, round(coalesce(v, 0.0), 10) AS Polarity, round(coalesce(sj, 0.0), 10) AS Subjectivity,
           CAST(len(string_split(text, ' ')) AS INTEGER) AS WordCount, CAST(len({CLEAN}) AS INTEGER) AS WordCountNormalized,
           CAST(length(text) AS INTEGER) AS CharCount
    FROM d LEFT JOIN labels USING (doc_id) LEFT JOIN sc USING (doc_id)""")
def review_table(t):
    """One row per (source, text), counts, sentiment, labels, published names."""
    docs = spread(t.documents, "doc_id").select("doc_id", "lang", "source", "text")
    # The text itself is only carried once per surviving row: the first row per key is chosen on digests.
    first = clean.first_per_key(docs.select("doc_id", "source", F.md5("text").alias("digest")), ["source", "digest"], ["doc_id"])
    docs = stage(docs.join(first.select("doc_id"), on="doc_id", how="left_semi"))
    counts = docs.withColumns({"words": F.size(F.split("text", " ")), "clean": F.size(X.clean_tokens("text")), "chars": F.length("text")})
    scores = O.sentiment(docs.select("doc_id", "text"), "doc_id", "text", O.sentiment_lexicon(t.spark))
    table = enrich(enrich(counts, scores, ["doc_id"]), t.labels, ["doc_id"])
    table = rounded(table, 10, "polarity", "subjectivity")
    return io.publish(table, {"lang": "Category", "source": "Origin", "quality": "Useful", "polarity": "Polarity", "subjectivity": "Subjectivity",
                              "words": "WordCount", "clean": "WordCountNormalized", "chars": "CharCount"})


@query("L06 F01 F03 F05 M03 M18 M34")
def helpfulness_scores(t):
    """Split, thin the larger class of the training part, weigh terms, fit, report AUC on untouched rows, and score the unlabelled documents."""
    labelled = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = X.with_ngrams(spread(t.documents, "doc_id"), "text", "grams", stemmed=True).select(
        "doc_id", F.coalesce("grams", F.array().cast("array<string>")).alias("grams"), F.col("n_chars").cast("double").alias("n_chars"))
    # Hashed once: the fits and scores below read the counted terms, not the n-grams.
    weigh = K.text_pipeline(["grams"], ["n_chars"], min_df=5).getStages()
    docs = stage(weigh[0].transform(docs).drop("grams").join(labelled, on="doc_id", how="left"))
    parts = hash_split(docs.filter("label IS NOT NULL"), "doc_id", {"train": 0.7, "test": 0.3}, "help")
    train, test = downsample_class(parts.filter("split = 'train'"), "label", 1.0, "doc_id", 0.6, "thin"), parts.filter("split = 'test'")
    prep = Pipeline(stages=weigh[1:]).fit(train)
    model = K.logistic().fit(prep.transform(train))
    prob = vector_to_array("probability")[1].alias("score")
    auc = E.auc_rank(model.transform(prep.transform(test)).select("label", prob), "label", "score").first()["auc"]
    scored = model.transform(prep.transform(docs.filter("label IS NULL"))).select("prediction", prob)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score")).withColumn("auc", F.lit(auc))


@query("M17 M17b M17e L03 S06", RULES_SQL + """
    SELECT '{' || antecedent || '} => {' || consequent || '}' AS rule, round(support, 8) AS support, round(confidence, 8) AS confidence, round(lift, 8) AS lift
    FROM rules r WHERE size = 0 OR (lift > 1 + 1e-12 AND NOT EXISTS (
        SELECT 1 FROM rules q WHERE q.consequent = r.consequent AND q.size > 0 AND q.size < r.size AND q.confidence >= r.confidence
        AND list_has_all(string_split(r.antecedent, ','), string_split(q.antecedent, ','))))
    ORDER BY round(lift, 8) DESC, rule LIMIT 30""")
def basket_report(t):
    """The thirty strongest rules that no shorter rule makes redundant."""
    listed = rounded(B.label_rules(B.nonredundant(_rules(t))), 8, *B.MEASURES)
    return listed.orderBy(F.desc("lift"), "rule").limit(30)


@query("S07 L01 P16 J01 J02", """
    SELECT c_mktsegment, count(*) AS n, round(avg(share), 8) AS mean_share, round(max(o_totalprice), 2) AS largest FROM (
        SELECT c_mktsegment, o_totalprice, CASE WHEN o_totalprice + c_acctbal <> 0 THEN c_acctbal / (o_totalprice + c_acctbal) END AS share
        FROM orders JOIN customer ON o_custkey = c_custkey) WHERE share < 0.5 GROUP BY c_mktsegment""")
def sql_string_report(t):
    with views(t.spark, orders_sheet=t.orders, customer_sheet=t.customer):
        return t.spark.sql("""
        SELECT c_mktsegment, count(*) AS n, round(avg(share), 8) AS mean_share, round(max(o_totalprice), 2) AS largest FROM (
            SELECT c_mktsegment, o_totalprice, try_divide(c_acctbal, o_totalprice + c_acctbal) AS share
            FROM orders_sheet JOIN customer_sheet ON o_custkey = c_custkey) WHERE share < 0.5
        GROUP BY c_mktsegment ORDER BY largest DESC""")


@query("F08 P09 F06 L07 F10 M21 M18 M19")
def risk_model_report(t):
    """Split, impute from training donors, then inside every fold and for the held-out rows: scale and over-sample the training part only."""
    urgent = customer_features(t).select("c_custkey", S.flag(F.col("urgent_share") > 0.35).alias("label"))
    given = stage(hash_split(gappy_customers(t).join(urgent, on="c_custkey"), "c_custkey", {"train": 0.7, "test": 0.3}, "risk"))
    full = N.knn_impute(given, "c_custkey", GAPPY, 5, donors=F.col("split") == "train")
    rows = stage(full.join(given.select("c_custkey", "label", "split"), on="c_custkey").withColumn("fold", hash_fold("c_custkey", 5, "risk")))
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC")
    models = {"tree": K.tree(), "logistic": K.logistic(regParam=0.01)}

    def areas(fit_on, judged):
        params = FE.scaling_params(fit_on, GAPPY)
        known, asked = stage(FE.apply_scaling(fit_on, params)), FE.apply_scaling(judged, params)
        made = N.smote(known, "c_custkey", GAPPY, "label", 1)
        as_label = [*GAPPY, F.col("label").cast("double").alias("label")]
        ready = FE.as_vector(stage(known.select(*as_label).unionByName(made.select(*as_label))), GAPPY)
        asked = FE.as_vector(asked.select(*as_label), GAPPY)
        return {name: float(ev.evaluate(est.fit(ready).transform(asked))) for name, est in models.items()}

    # Every part is many short jobs, which leave most cores idle one after the other.
    parts = [(train.filter(F.col("fold") != k), train.filter(F.col("fold") == k)) for k in range(5)] + [(train, test)]
    with ThreadPool(3) as pool:
        *folds, held = pool.starmap(areas, parts, chunksize=1)
    table = []
    for name in models:
        scores = [f[name] for f in folds]
        mean = sum(scores) / len(scores)
        table.append((name, mean, (sum((x - mean) ** 2 for x in scores) / len(scores)) ** 0.5, held[name]))
    return t.spark.createDataFrame(table, "model string, mean_score double, std_score double, held_out_auc double").orderBy(F.desc("mean_score"), "model")


@query("P13 P15 F07 M26 M24 M13 M38 A11")
def segmentation_profile(t):
    """Clean, power-transform, check clusterability, cluster, profile in original units."""
    cols = ["balance", "n_orders", "avg_price"]
    base = customer_features(t).select("c_custkey", *cols)
    base = stage(clean.sentinels_out(base, ["n_orders", "avg_price"], 0.0))
    powered, _, _ = FE.power_transform(base, cols)
    powered = stage(powered)
    tendency = N.hopkins(powered, "c_custkey", cols, 150).first()["hopkins_u_share"]
    model = C.best_kmeans(powered, cols, 4, restarts=10)
    labelled = C.assign(powered, model, cols).select("c_custkey", "cluster")
    profile = labelled.join(base, on="c_custkey").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])
    return profile.withColumn("hopkins_u_share", F.lit(tendency))
