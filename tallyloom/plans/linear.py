"""Queries over linear and logistic models with inference.

The response is a stated function of lineitem columns plus a pseudo-noise term computed from the keys, because the
given columns are nearly uncorrelated.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import glm, linear
from tallyloom.operators.features import factor_columns
from tallyloom.operators.sampling import hash_split
from tallyloom.plans.common import rounded
from tallyloom.plans.registry import query
from tallyloom.plans.relational import duck_hash

ROWS_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity AS qty, l_discount AS disc, l_tax AS tax,
           l_extendedprice / 1000 AS price,
           10 + 2 * l_quantity - 40 * l_discount + 15 * l_tax + ((l_partkey * 7919 + l_orderkey * 104729) % 1000) / 100.0 AS y
    FROM lineitem"""


def regression_rows(t):
    noise = ((F.col("l_partkey") * 7919 + F.col("l_orderkey") * 104729) % 1000) / 100.0
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"), (F.col("l_extendedprice") / 1000).alias("price"),
        (10 + 2 * F.col("l_quantity") - 40 * F.col("l_discount") + 15 * F.col("l_tax") + noise).alias("y"))


COLUMNS = ["y", "qty", "disc", "tax", "price"]
TERMS = COLUMNS[1:]


@query("M01", f"WITH f AS ({ROWS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(avg({a}), 10) AS mean_a, round(avg({b}), 10) AS mean_b, round(covar_pop({a}, {b}), 6) AS value FROM f"
    for i, a in enumerate(COLUMNS) for b in COLUMNS[i:]))
def gram_matrix(t):
    g = linear.gram(regression_rows(t), COLUMNS)
    return rounded(rounded(g.table(t.spark).withColumn("value", F.col("value") / g.n), 10, "mean_a", "mean_b"), 6, "value")


@query("M01", f"WITH f AS ({ROWS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}), 6) AS value FROM f"
    for i, a in enumerate(COLUMNS) for b in COLUMNS[i:]))
def gram_matrix_wide_form(t):
    """The same cross-products through one partial matrix per task."""
    g = linear.gram(regression_rows(t), COLUMNS, wide=True)
    return rounded(g.table(t.spark).select("a", "b", (F.col("value") / g.n).alias("value")), 6, "value")


_SIMPLE = f"""
    WITH f AS ({ROWS_SQL}), s AS (
        SELECT count(*) AS n, avg(qty) AS mx, regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a, regr_sxx(y, qty) AS sxx,
               regr_syy(y, qty) - regr_sxy(y, qty) ** 2 / regr_sxx(y, qty) AS rss, regr_syy(y, qty) AS tss FROM f)"""


@query("M01 M28", _SIMPLE + """
    SELECT 'qty' AS term, round(b, 6) AS estimate, round(sqrt(rss / (n - 2) / sxx), 6) AS std_error,
           round(b / sqrt(rss / (n - 2) / sxx), 2) AS t_value FROM s
    UNION ALL SELECT '(Intercept)', round(a, 6), round(sqrt(rss / (n - 2) * (1.0 / n + mx * mx / sxx)), 6),
           round(a / sqrt(rss / (n - 2) * (1.0 / n + mx * mx / sxx)), 2) FROM s""")
def simple_regression(t):
    model = linear.fit(linear.gram(regression_rows(t), ["y", "qty"]), "y", ["qty"])
    table = linear.coefficient_table(t.spark, [model]).select("term", "estimate", "std_error", "t_value")
    return rounded(rounded(table, 6, "estimate", "std_error"), 2, "t_value")


_PAIR = f"""
    WITH f AS ({ROWS_SQL}), c AS (
        SELECT count(*) AS n, avg(y) AS my, avg(qty) AS m1, avg(disc) AS m2, covar_pop(qty, qty) AS s11, covar_pop(qty, disc) AS s12,
               covar_pop(disc, disc) AS s22, covar_pop(qty, y) AS s1y, covar_pop(disc, y) AS s2y, covar_pop(y, y) AS syy FROM f),
    b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                 (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM c),
    r AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, n * (syy - b1 * s1y - b2 * s2y) AS rss2, n * (syy - s1y * s1y / s11) AS rss1 FROM b)"""


@query("M01", _PAIR + """
    SELECT '(Intercept)' AS term, round(b0, 6) AS estimate FROM r UNION ALL SELECT 'qty', round(b1, 6) FROM r
    UNION ALL SELECT 'disc', round(b2, 6) FROM r""")
def two_term_regression(t):
    model = linear.fit(linear.gram(regression_rows(t), ["y", "qty", "disc"]), "y", ["qty", "disc"])
    return rounded(linear.coefficient_table(t.spark, [model]).select("term", "estimate"), 6, "estimate")


@query("M30", _PAIR + """
    SELECT round(rss1, 2) AS rss_small, round(rss2, 2) AS rss_large, 1 AS df1, CAST(n - 3 AS INTEGER) AS df2,
           round((rss1 - rss2) / (rss2 / (n - 3)), 3) AS f_value FROM r""")
def nested_f_test(t):
    g = linear.gram(regression_rows(t), ["y", "qty", "disc"])
    table = linear.anova(t.spark, linear.fit(g, "y", ["qty"]), linear.fit(g, "y", ["qty", "disc"]))
    return rounded(rounded(table.select("rss_small", "rss_large", "df1", "df2", "f_value"), 2, "rss_small", "rss_large"), 3, "f_value")


@query("M29", f"WITH f AS ({ROWS_SQL}) " + " UNION ALL ".join(f"""
    SELECT 'y ~ {x}' AS model, count(*) AS n, round(regr_r2(y, {x}), 8) AS r2,
           round(1 - (1 - regr_r2(y, {x})) * (count(*) - 1) / (count(*) - 2), 8) AS adj_r2,
           round(regr_r2(y, {x}) / ((1 - regr_r2(y, {x})) / (count(*) - 2)), 4) AS f_value FROM f""" for x in TERMS))
def fit_statistics(t):
    """One scan for all four single-term models."""
    g = linear.gram(regression_rows(t), COLUMNS)
    table = linear.fit_table(t.spark, [linear.fit(g, "y", [x]) for x in TERMS]).select("model", "n", "r2", "adj_r2", "f_value")
    return rounded(rounded(table, 8, "r2", "adj_r2"), 4, "f_value")


@query("M01 M28 M29")
def nested_model_family(t):
    """Coefficients with intervals of a family of nested models, all from one aggregate."""
    g = linear.gram(regression_rows(t), COLUMNS)
    models = [linear.fit(g, "y", TERMS[:k]) for k in range(1, len(TERMS) + 1)]
    return linear.coefficient_table(t.spark, models)


@query("M35 M34 L07", f"""
    WITH f AS (SELECT *, {duck_hash("l_orderkey || '-' || l_linenumber || '-' || l_partkey", 'ols')} / 4294967296.0 < 0.75 AS train FROM ({ROWS_SQL})),
    m AS (SELECT regr_slope(y, qty) AS b, regr_intercept(y, qty) AS a FROM f WHERE train)
    SELECT count(*) AS n, round(1 - sum((y - a - b * qty) ** 2) / (var_pop(y) * count(*)), 8) AS r2,
           round(corr(y, a + b * qty) ** 2, 8) AS squared_correlation FROM f, m WHERE NOT train""")
def holdout_r2(t):
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    parts = hash_split(regression_rows(t), key, {"train": 0.75, "test": 0.25}, "ols")
    model = linear.fit(linear.gram(parts.filter("split = 'train'"), ["y", "qty"]), "y", ["qty"])
    scored = linear.predict(parts.filter("split = 'test'"), model.coefficients())
    return rounded(linear.holdout_scores(scored, "y"), 8, "r2", "squared_correlation")


@query("M36", _SIMPLE + """
    SELECT l_orderkey, l_linenumber, l_partkey, round(a + b * qty, 6) AS fitted, round(y - a - b * qty, 6) AS residual,
           round(1.0 / n + (qty - mx) ** 2 / sxx, 12) AS leverage,
           round((y - a - b * qty) / sqrt(rss / (n - 2) * (1 - (1.0 / n + (qty - mx) ** 2 / sxx))), 6) AS std_residual,
           round(((y - a - b * qty) / sqrt(rss / (n - 2) * (1 - (1.0 / n + (qty - mx) ** 2 / sxx)))) ** 2
                 * (1.0 / n + (qty - mx) ** 2 / sxx) / (2 * (1 - (1.0 / n + (qty - mx) ** 2 / sxx))), 10) AS cooks_distance
    FROM f, s""")
def residual_diagnostics(t):
    rows = regression_rows(t)
    g = linear.gram(rows, ["y", "qty"])
    out = linear.diagnostics(rows, g, linear.fit(g, "y", ["qty"])).select(
        "l_orderkey", "l_linenumber", "l_partkey", "fitted", "residual", "leverage", "std_residual", "cooks_distance")
    out = rounded(out, 6, "fitted", "residual", "std_residual")
    return rounded(rounded(out, 12, "leverage"), 10, "cooks_distance")


@query("M27", _SIMPLE + """
    SELECT 'qty' AS term, round(b, 6) AS mean, round(sqrt((0.001 + rss) / (0.001 + n - 4) / sxx), 8) AS sd FROM s
    UNION ALL SELECT '(Intercept)', round(a, 6), round(sqrt((0.001 + rss) / (0.001 + n - 4) * (1.0 / n + mx * mx / sxx)), 8) FROM s""")
def bayesian_regression(t):
    model = linear.fit(linear.gram(regression_rows(t), ["y", "qty"]), "y", ["qty"])
    table = linear.posterior(t.spark, model).filter("term <> 'sigma2'").select("term", "mean", "sd")
    return rounded(rounded(table, 6, "mean"), 8, "sd")


@query("M33", f"""
    WITH f AS (SELECT *, l_partkey % 5 AS imputation FROM ({ROWS_SQL})),
    m AS (SELECT imputation, regr_slope(y, qty) AS b,
                 sqrt((regr_syy(y, qty) - regr_sxy(y, qty) ** 2 / regr_sxx(y, qty)) / (count(*) - 2) / regr_sxx(y, qty)) AS se
          FROM f GROUP BY imputation)
    SELECT 'qty' AS term, count(*) AS m, round(avg(b), 8) AS estimate, round(avg(se * se), 10) AS within, round(var_samp(b), 10) AS between,
           round(sqrt(avg(se * se) + (1 + 1.0 / count(*)) * var_samp(b)), 8) AS std_error FROM m""")
def pooled_fits(t):
    """Five fits on five slices of the rows stand in for five imputed data sets; one grouped aggregate fits all."""
    s = regression_rows(t).withColumn("imputation", F.col("l_partkey") % 5).groupBy("imputation").agg(
        F.regr_slope("y", "qty").alias("estimate"), F.count(F.lit(1)).alias("n"), F.regr_sxx("y", "qty").alias("sxx"),
        (F.regr_syy("y", "qty") - F.pow(F.regr_sxy("y", "qty"), F.lit(2)) / F.regr_sxx("y", "qty")).alias("rss"))
    fits = s.select("imputation", F.lit("qty").alias("term"), "estimate", F.sqrt(F.col("rss") / (F.col("n") - 2) / F.col("sxx")).alias("std_error"))
    out = linear.pool(fits).drop("total_variance")
    return rounded(rounded(out, 8, "estimate", "std_error"), 10, "within", "between")


@query("F11 M01", f"""
    WITH f AS (SELECT qty, tax, y, CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END AS flag_N,
                      CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS flag_R, qty * tax AS qty_tax FROM ({ROWS_SQL}))
    SELECT round(sum(flag_N)::DOUBLE, 1) AS n_flag, round(sum(flag_R)::DOUBLE, 1) AS r_flag, round(sum(qty_tax), 4) AS qty_tax,
           round(covar_pop(qty_tax, y), 6) AS cross FROM f""")
def formula_columns(t):
    """Factor contrasts and an interaction as columns."""
    rows = regression_rows(t)
    f = rows.select("y", *[c.alias(n.replace("l_returnflag", "flag")) for n, c in factor_columns("l_returnflag", ["A", "N", "R"]).items()],
                    (F.col("qty") * F.col("tax")).alias("qty_tax"))
    return f.agg(F.round(F.sum("flag_N"), 1).alias("n_flag"), F.round(F.sum("flag_R"), 1).alias("r_flag"),
                 F.round(F.sum("qty_tax"), 4).alias("qty_tax"), F.round(F.covar_pop("qty_tax", "y"), 6).alias("cross"))


@query("F11 M28")
def formula_regression(t):
    """y on a factor, a number and an interaction."""
    rows = regression_rows(t)
    f = rows.select("y", "qty", "tax", (F.col("qty") * F.col("tax")).alias("qty:tax"),
                    *[c.alias(n) for n, c in factor_columns("l_returnflag", ["A", "N", "R"]).items()])
    terms = [c for c in f.columns if c != "y"]
    quoted = f.toDF(*[c.replace(":", "_x_") for c in f.columns])
    g = linear.gram(quoted, quoted.columns)
    return linear.coefficient_table(t.spark, [linear.fit(g, "y", [c.replace(":", "_x_") for c in terms])])


@query("F11")
def formula_vectors(t):
    """R formula as an ML feature vector, unfolded to one row per (row, term)."""
    from pyspark.ml.functions import vector_to_array

    from tallyloom.operators.features import formula
    rows = regression_rows(t)
    model = formula(rows, "y ~ l_returnflag + qty + qty:tax")
    out = model.transform(rows).select("l_returnflag", vector_to_array("features").alias("v"))
    return out.select("l_returnflag", F.posexplode("v")).groupBy("l_returnflag", "pos").agg(F.avg("col").alias("mean"))


LOGIT_TERMS = ["qty", "disc", "tax"]


def logit_rows(t):
    return regression_rows(t).withColumn("label", F.when(F.col("y") > 58, 1.0).otherwise(0.0)).withColumn(
        "label", F.when((F.col("l_partkey") * 31 + F.col("l_orderkey") * 17) % 10 < 2, 1.0 - F.col("label")).otherwise(F.col("label")))


def _logit(t):
    rows = logit_rows(t).select("label", *LOGIT_TERMS)
    return rows, glm.fit_logistic(rows, "label", LOGIT_TERMS)


@query("M02 M28 C08")
def logistic_glm(t):
    _, model = _logit(t)
    return glm.coefficient_table(t.spark, model, LOGIT_TERMS)


@query("M31")
def wald_joint_test(t):
    rows, model = _logit(t)
    coefs = glm.coefficients(model, LOGIT_TERMS)
    cov = glm.covariance(rows, LOGIT_TERMS, coefs)
    return glm.wald_test(t.spark, coefs, cov, [{"disc": 1.0}, {"tax": 1.0}])


@query("M32")
def pseudo_r2(t):
    _, model = _logit(t)
    return glm.pseudo_r2(t.spark, model)


@query("M34 C09 M19")
def logistic_holdout_confusion(t):
    """Fit on 70 percent, score the rest, cut at one half, compare with the test labels."""
    from tallyloom.functions.scalar import threshold_class
    parts = hash_split(logit_rows(t), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"), {"train": 0.7, "test": 0.3}, "glm")
    model = glm.fit_logistic(parts.filter("split = 'train'"), "label", LOGIT_TERMS)
    scored = glm.probability(parts.filter("split = 'test'"), glm.coefficients(model, LOGIT_TERMS))
    return scored.withColumn("prediction", threshold_class("probability")).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
