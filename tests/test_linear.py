import math

import numpy as np
import pytest

from tallyloom.functions import dist
from tallyloom.operators import glm, linear


def frame(spark, cols):
    names = list(cols)
    return spark.createDataFrame(list(zip(*[list(map(float, cols[n])) for n in names])), ", ".join(f"{n} double" for n in names)).repartition(3)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x1, x2, x3 = rng.normal(1000, 2, 400), rng.uniform(0, 1, 400), rng.normal(size=400)
    y = 3 + 0.5 * x1 - 2 * x2 + 0.1 * rng.normal(size=400)
    return {"y": y, "x1": x1, "x2": x2, "x3": x3}


def reference_fit(data, terms):
    x = np.column_stack([np.ones(len(data["y"])), *[data[t] for t in terms]])
    beta, *_ = np.linalg.lstsq(x, data["y"], rcond=None)
    e = data["y"] - x @ beta
    s2 = e @ e / (len(e) - x.shape[1])
    return x, beta, e, s2, np.linalg.inv(x.T @ x)


def test_fit_matches_numpy(spark, data):
    df = frame(spark, data)
    for wide in (False, True):
        g = linear.gram(df, ["y", "x1", "x2", "x3"], wide=wide)
        m = linear.fit(g, "y", ["x1", "x2", "x3"])
        _, beta, e, s2, inv = reference_fit(data, ["x1", "x2", "x3"])
        assert np.allclose(m.beta, beta, rtol=1e-7)
        assert np.allclose(m.std_errors(), np.sqrt(np.diag(inv) * s2), rtol=1e-6)
        assert math.isclose(m.rss, e @ e, rel_tol=1e-6)


def test_residuals_are_orthogonal_and_r2_is_squared_correlation(spark, data):
    df = frame(spark, data)
    g = linear.gram(df, ["y", "x2"])
    m = linear.fit(g, "y", ["x2"])
    scored = linear.predict(df, m.coefficients())
    row = linear.holdout_scores(scored, "y").first()
    assert math.isclose(row["r2"], row["squared_correlation"], rel_tol=1e-9)
    assert math.isclose(row["r2"], m.r2, rel_tol=1e-9)


def test_f_of_one_added_term_is_t_squared(spark, data):
    g = linear.gram(frame(spark, data), ["y", "x1", "x2", "x3"])
    small, large = linear.fit(g, "y", ["x1", "x2"]), linear.fit(g, "y", ["x1", "x2", "x3"])
    f = linear.anova(spark, small, large).first()
    t = linear.coefficient_table(spark, [large]).filter("term = 'x3'").first()
    assert math.isclose(f["f_value"], t["t_value"] ** 2, rel_tol=1e-6)
    assert math.isclose(f["p_value"], t["p_value"], rel_tol=1e-6)


def test_diagnostics(spark, data):
    df = frame(spark, data)
    g = linear.gram(df, ["y", "x1", "x2"])
    m = linear.fit(g, "y", ["x1", "x2"])
    x, beta, e, s2, inv = reference_fit(data, ["x1", "x2"])
    h = np.einsum("ij,jk,ik->i", x, inv, x)
    r = e / np.sqrt(s2 * (1 - h))
    cook = r * r * h / (3 * (1 - h))
    got = linear.diagnostics(df, g, m).toPandas().set_index("y").loc[data["y"]]
    assert np.allclose(got["leverage"], h, atol=1e-8)
    assert np.allclose(got["std_residual"], r, atol=1e-6)
    assert np.allclose(got["cooks_distance"], cook, atol=1e-7)


def test_collinear_term_is_aliased(spark, data):
    df = frame(spark, {**data, "x4": data["x1"] * 2 + data["x2"]})
    g = linear.gram(df, ["y", "x1", "x2", "x4"])
    table = {r["term"]: r["estimate"] for r in linear.coefficient_table(spark, [linear.fit(g, "y", ["x1", "x2", "x4"])]).collect()}
    assert table["x4"] is None and table["x1"] is not None


def test_posterior_centres_on_least_squares(spark, data):
    m = linear.fit(linear.gram(frame(spark, data), ["y", "x1"]), "y", ["x1"])
    row = linear.posterior(spark, m).filter("term = 'x1'").first()
    assert math.isclose(row["mean"], m.beta[1]) and row["ci_low"] < row["mean"] < row["ci_high"]


def test_pool_uses_rubins_rules(spark):
    df = spark.createDataFrame([(i, "x", b, s) for i, (b, s) in enumerate([(1.0, 0.1), (1.2, 0.2), (0.9, 0.1)])],
                               "imputation int, term string, estimate double, std_error double")
    row = linear.pool(df).first()
    b = np.var([1.0, 1.2, 0.9], ddof=1)
    assert math.isclose(row["total_variance"], np.mean([0.01, 0.04, 0.01]) + (1 + 1 / 3) * b, rel_tol=1e-12)


def test_discriminant_matches_numpy(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, (60, 2)), rng.normal(1.5, 1, (40, 2))
    df = spark.createDataFrame([(*map(float, r), 0) for r in a] + [(*map(float, r), 1) for r in b], "p double, q double, c int")
    model = linear.fit_discriminant(df, "c", ["p", "q"])
    pooled = ((a - a.mean(0)).T @ (a - a.mean(0)) + (b - b.mean(0)).T @ (b - b.mean(0))) / 98
    w = np.linalg.inv(pooled)
    score = lambda x, m, p: x @ w @ m - 0.5 * m @ w @ m + math.log(p)
    x = np.vstack([a, b])
    want = (score(x, b.mean(0), 0.4) > score(x, a.mean(0), 0.6)).astype(int)
    got = linear.apply_discriminant(df, model, ["p", "q"]).toPandas().set_index(["p", "q"])["prediction"]
    assert [got[(p, q)] for p, q in x] == list(want)


def test_logistic_inference_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 2))
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-(0.3 + x @ [1.0, -0.5])))).astype(float)
    df = frame(spark, {"y": y, "a": x[:, 0], "b": x[:, 1]})
    model = glm.fit_logistic(df, "y", ["a", "b"])
    d, beta = np.column_stack([np.ones(500), x]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-d @ beta))
        beta = beta + np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d, d.T @ (y - p))
    p = 1 / (1 + np.exp(-d @ beta))
    cov = np.linalg.inv((d * (p * (1 - p))[:, None]).T @ d)
    coefs = glm.coefficients(model, ["a", "b"])
    assert np.allclose(list(coefs.values()), beta, atol=1e-6)
    ours = glm.covariance(df, ["a", "b"], coefs)
    assert np.allclose(ours, cov, atol=1e-7)
    table = glm.coefficient_table(spark, model, ["a", "b"]).toPandas().set_index("term")
    assert np.allclose(table.loc[["(Intercept)", "a", "b"], "std_error"], np.sqrt(np.diag(cov)), atol=1e-6)
    wald = glm.wald_test(spark, coefs, ours, [{"a": 1.0}, {"b": 1.0}]).first()
    want = beta[1:] @ np.linalg.inv(cov[1:, 1:]) @ beta[1:]
    assert math.isclose(wald["chi2"], want, rel_tol=1e-5) and wald["p_value"] < 1e-6
    ll = np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))
    null = len(y) * (y.mean() * math.log(y.mean()) + (1 - y.mean()) * math.log(1 - y.mean()))
    assert math.isclose(glm.pseudo_r2(spark, model).first()["mcfadden"], 1 - ll / null, rel_tol=1e-5)


def test_separated_classes_are_reported(spark):
    df = frame(spark, {"a": [1, 2, 3, 4], "b": [2, 4, 6, 8]})
    with pytest.raises(ValueError):
        glm.covariance(df, ["a", "b"], {"(Intercept)": 0.0, "a": 0.0, "b": 0.0})


def test_tail_probabilities():
    # Published table values.
    assert math.isclose(dist.t_quantile(0.975, 10), 2.228139, abs_tol=1e-5)
    assert math.isclose(dist.chi2_tail(3.841459, 1), 0.05, abs_tol=1e-6)
    assert math.isclose(dist.chi2_tail(18.307038, 10), 0.05, abs_tol=1e-6)
    assert math.isclose(dist.f_tail(4.964603, 1, 10), 0.05, abs_tol=1e-6)
    assert math.isclose(dist.normal_two_sided(1.959964), 0.05, abs_tol=1e-6)


def test_pooling_of_imputed_sets(spark):
    """Rubin's rules over the sets that chained imputation gives, each fitted by NumPy."""
    from tallyloom.operators.impute import chained_equations
    from tallyloom.plans.features import pooled
    from tallyloom.runtime import stage
    rng = np.random.default_rng(31)
    x = rng.normal(size=120)
    y = 2 * x + rng.normal(size=120)
    rows = [(i, None if i % 5 == 0 else float(a), None if i % 7 == 1 else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    sets = stage(chained_equations(spark.createDataFrame(rows, "id long, x double, y double"), "id", ["x", "y"], m=3, iterations=2))
    slopes, variances = [], []
    for _, part in sets.toPandas().groupby("imputation"):
        a, b = part["x"].to_numpy(), part["y"].to_numpy()
        sxx = ((a - a.mean()) ** 2).sum()
        slope = ((a - a.mean()) * (b - b.mean())).sum() / sxx
        e = b - b.mean() - slope * (a - a.mean())
        slopes.append(slope)
        variances.append((e @ e) / (len(a) - 2) / sxx)
    got = pooled(sets, "y", "x").first()
    between = np.var(slopes, ddof=1)
    assert got["m"] == 3 and between > 0 and np.isclose(got["estimate"], np.mean(slopes)) and np.isclose(got["between"], between)
    assert np.isclose(got["std_error"], math.sqrt(np.mean(variances) + (1 + 1 / 3) * between))
