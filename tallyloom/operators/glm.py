"""Logistic models with inference: coefficients, joint tests, pseudo R-squared, scoring."""

from __future__ import annotations

import numpy as np
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import dist
from tallyloom.operators.features import as_vector
from tallyloom.operators.linear import NARROW, partial_products
from tallyloom.runtime import persisted


def fit_logistic(df: DataFrame, label: str, terms: list[str]):
    """Binomial logit model by iteratively reweighted least squares."""
    data = as_vector(df.na.drop("any", subset=[label, *terms]), terms).select(label, "features")
    # Every iteration, and the summary that is read here, goes over the rows again.
    with persisted(data) as kept:
        model = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label, featuresCol="features", maxIter=50, tol=1e-10).fit(kept)
        model.measures = _measures(model)
    return model


def _measures(model) -> dict:
    """What the summary says, read while the rows are at hand."""
    s = model.summary
    return {"errors": list(s.coefficientStandardErrors), "t": list(s.tValues), "p": list(s.pValues), "deviance": float(s.deviance), "null": float(s.nullDeviance)}


def coefficients(model, terms: list[str]) -> dict[str, float]:
    return {"(Intercept)": float(model.intercept), **{t: float(b) for t, b in zip(terms, model.coefficients)}}


def probability(df: DataFrame, coefs: dict[str, float], name: str = "probability") -> DataFrame:
    """Score from a coefficient table."""
    eta = F.lit(coefs["(Intercept)"])
    for term, b in coefs.items():
        if term != "(Intercept)":
            eta = eta + F.lit(b) * F.col(term)
    return df.withColumn(name, 1.0 / (1.0 + F.exp(-eta)))


def coefficient_table(spark: SparkSession, model, terms: list[str]) -> DataFrame:
    """estimate, standard error, z, p and the odds ratio with its probability o / (1 + o)."""
    s = model.measures
    # The summary lists the intercept last.
    order = [len(terms), *range(len(terms))]
    est = [*map(float, model.coefficients), float(model.intercept)]
    rows = [(["(Intercept)", *terms][k], est[i], s["errors"][i], s["t"][i], s["p"][i])
            for k, i in enumerate(order)]
    table = spark.createDataFrame(rows, "term string, estimate double, std_error double, z_value double, p_value double")
    odds = F.exp("estimate")
    return table.withColumn("odds_ratio", odds).withColumn("odds_probability", odds / (1 + odds))


def covariance(df: DataFrame, terms: list[str], coefs: dict[str, float]) -> np.ndarray:
    """(X'WX)^-1 at the fitted coefficients from one aggregate, intercept first."""
    scored = probability(df.na.drop("any", subset=terms), coefs, "_p").withColumn("_w", F.sqrt(F.col("_p") * (1 - F.col("_p"))))
    cols = ["_w0", *[f"_w{i + 1}" for i in range(len(terms))]]
    scaled = scored.select(F.col("_w").alias("_w0"), *[(F.col(t).cast("double") * F.col("_w")).alias(f"_w{i + 1}") for i, t in enumerate(terms)])
    k = len(cols)
    info = np.zeros((k, k))
    if k <= NARROW:
        row = scaled.agg(*[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"s{i}_{j}") for i in range(k) for j in range(i, k)]).first()
        for i in range(k):
            for j in range(i, k):
                info[i, j] = info[j, i] = row[f"s{i}_{j}"]
    else:
        for r in partial_products(scaled, cols, np.zeros(k)).collect():  # k(k+1)/2 rows
            info[r["i"], r["j"]] = info[r["j"], r["i"]] = r["v"]
    if np.linalg.cond(info) > 1e14:
        raise ValueError("information matrix is singular: predictors are collinear or the classes are separated")
    return np.linalg.inv(info)


def wald_test(spark: SparkSession, coefs: dict[str, float], cov: np.ndarray, hypotheses: list[dict[str, float]]) -> DataFrame:
    """Joint test that every given linear combination of coefficients is zero."""
    names = list(coefs)
    r = np.array([[h.get(n, 0.0) for n in names] for h in hypotheses])
    b = np.array([coefs[n] for n in names])
    gap = r @ b
    chi2 = float(gap @ np.linalg.solve(r @ cov @ r.T, gap))
    return spark.createDataFrame([(len(hypotheses), chi2, dist.chi2_tail(chi2, len(hypotheses)))],
                                 "df int, chi2 double, p_value double")


def pseudo_r2(spark: SparkSession, model) -> DataFrame:
    s = model.measures
    return spark.createDataFrame([(s["deviance"], s["null"], 1 - s["deviance"] / s["null"])],
                                 "deviance double, null_deviance double, mcfadden double")
