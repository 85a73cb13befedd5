"""Linear models from one cross-product aggregate.

The data are read once: Spark sums the centred cross-products of every column pair, and every model, test and
posterior over those columns is then solved from a matrix whose size is the number of columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import dist

NARROW = 15  # up to here plain aggregate expressions, beyond it one partial matrix per task


@dataclass
class Gram:
    columns: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray  # centred sums of products

    def index(self, names: list[str]) -> list[int]:
        return [self.columns.index(c) for c in names]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(a, b, float(self.mean[i]), float(self.mean[j]), float(self.cross[i, j]))
                for i, a in enumerate(self.columns) for j, b in enumerate(self.columns) if i <= j]
        return spark.createDataFrame(rows, "a string, b string, mean_a double, mean_b double, value double")


def gram(df: DataFrame, columns: list[str], wide: bool | None = None) -> Gram:
    """Count, means and centred cross-products over rows without gaps in `columns`."""
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop("any")
    p = len(columns)
    if not (wide if wide is not None else p > NARROW):
        row = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[
            F.covar_pop(columns[i], columns[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]).first()
        n = row["n"]
        cross = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                cross[i, j] = cross[j, i] = (row[f"s{i}_{j}"] or 0.0) * n
        return Gram(list(columns), n, np.array([row[f"m{i}"] or 0.0 for i in range(p)]), cross)

    head = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    mean = np.array([head[f"m{i}"] or 0.0 for i in range(p)])
    cross = np.zeros((p, p))
    for r in partial_products(data, columns, mean).collect():  # p(p+1)/2 rows
        cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = r["v"]
    return Gram(list(columns), head["n"], mean, cross)


def partial_products(data: DataFrame, columns: list[str], shift: np.ndarray) -> DataFrame:
    """(i, j, v): sums of shifted products, one partial matrix per task added up by Spark."""
    upper = np.triu_indices(len(columns))

    def partial(batches):
        total = np.zeros((len(columns), len(columns)))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            total += x.T @ x
        yield pd.DataFrame({"i": upper[0].astype("int32"), "j": upper[1].astype("int32"), "v": total[upper]})

    return data.select(*columns).mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))


@dataclass
class OLS:
    name: str
    response: str
    terms: list[str]          # without the intercept
    beta: np.ndarray          # intercept first; NaN for an aliased term
    inverse: np.ndarray       # (X'X)^-1 in the same order
    rss: float
    tss: float
    n: int

    @property
    def p(self) -> int:
        return int(np.sum(~np.isnan(self.beta[1:])))

    @property
    def df(self) -> int:
        return self.n - self.p - 1

    @property
    def sigma2(self) -> float:
        return self.rss / self.df if self.df > 0 else math.nan

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss if self.tss > 0 else math.nan

    @property
    def adj_r2(self) -> float:
        return 1 - (1 - self.r2) * (self.n - 1) / self.df if self.df > 0 else math.nan

    @property
    def f_value(self) -> float:
        return ((self.tss - self.rss) / self.p) / self.sigma2 if self.p and self.df > 0 else math.nan

    def std_errors(self) -> np.ndarray:
        return np.sqrt(np.diag(self.inverse) * self.sigma2)

    def coefficients(self) -> dict[str, float]:
        return {t: float(b) for t, b in zip(["(Intercept)", *self.terms], self.beta)}


def fit(g: Gram, response: str, terms: list[str], name: str | None = None) -> OLS:
    """Least squares over a subset of the cross-product matrix; a term that repeats earlier ones is aliased (NaN)."""
    y = g.columns.index(response)
    kept: list[str] = []
    for t in terms:
        idx, j = g.index(kept), g.columns.index(t)
        left = g.cross[j, j]
        if idx:
            left -= g.cross[j, idx] @ np.linalg.solve(g.cross[np.ix_(idx, idx)], g.cross[idx, j])
        if left > 1e-10 * max(g.cross[j, j], 1e-300):
            kept.append(t)
    idx = g.index(kept)
    inv = np.linalg.inv(g.cross[np.ix_(idx, idx)]) if idx else np.zeros((0, 0))
    slope = inv @ g.cross[idx, y] if idx else np.zeros(0)
    m = g.mean[idx]
    rss = float(g.cross[y, y] - slope @ g.cross[idx, y]) if idx else float(g.cross[y, y])
    size = len(terms) + 1
    beta, inverse = np.full(size, np.nan), np.full((size, size), np.nan)
    at = [0] + [terms.index(t) + 1 for t in kept]
    beta[at] = [g.mean[y] - slope @ m, *slope]
    full = np.zeros((len(at), len(at)))
    full[0, 0] = 1 / g.n + m @ inv @ m
    full[0, 1:] = full[1:, 0] = -(inv @ m)
    full[1:, 1:] = inv
    inverse[np.ix_(at, at)] = full
    return OLS(name or f"{response} ~ {' + '.join(terms) or '1'}", response, list(terms), beta, inverse, max(rss, 0.0),
               float(g.cross[y, y]), g.n)


def _num(x) -> float | None:
    return None if x is None or math.isnan(x) else float(x)


def coefficient_table(spark: SparkSession, models: list[OLS], level: float = 0.95) -> DataFrame:
    rows = []
    for m in models:
        q = dist.t_quantile(0.5 + level / 2, m.df) if m.df > 0 else math.nan
        for term, b, se in zip(["(Intercept)", *m.terms], m.beta, m.std_errors()):
            t = b / se if se and se > 0 else math.nan
            p = dist.t_two_sided(t, m.df) if not math.isnan(t) else math.nan
            rows.append((m.name, term, *map(_num, (b, se, t, p, b - q * se, b + q * se))))
    return spark.createDataFrame(rows, "model string, term string, estimate double, std_error double, t_value double, "
                                       "p_value double, ci_low double, ci_high double")


def fit_table(spark: SparkSession, models: list[OLS]) -> DataFrame:
    rows = [(m.name, m.n, m.p, *map(_num, (m.rss, m.r2, m.adj_r2, m.f_value,
             dist.f_tail(m.f_value, m.p, m.df) if not math.isnan(m.f_value) else math.nan))) for m in models]
    return spark.createDataFrame(rows, "model string, n bigint, terms int, rss double, r2 double, adj_r2 double, "
                                       "f_value double, p_value double")


def anova(spark: SparkSession, small: OLS, large: OLS) -> DataFrame:
    """F test of nested models."""
    d1 = small.df - large.df
    f = ((small.rss - large.rss) / d1) / large.sigma2 if d1 > 0 else math.nan
    p = dist.f_tail(f, d1, large.df) if d1 > 0 else math.nan
    return spark.createDataFrame([(small.name, large.name, small.rss, large.rss, d1, large.df, _num(f), _num(p))],
                                 "small string, large string, rss_small double, rss_large double, df1 int, df2 int, "
                                 "f_value double, p_value double")


def predict(df: DataFrame, coefficients: dict[str, float], name: str = "fitted") -> DataFrame:
    """Score with a coefficient table; aliased terms count as zero."""
    out: Column = F.lit(float(coefficients.get("(Intercept)", 0.0)))
    for term, b in coefficients.items():
        if term != "(Intercept)" and not math.isnan(b):
            out = out + F.lit(float(b)) * F.col(term)
    return df.withColumn(name, out)


def holdout_scores(df: DataFrame, response: str, fitted: str = "fitted") -> DataFrame:
    """1 - SSE/SST and the squared correlation on the given rows, one aggregate."""
    e = F.col(response) - F.col(fitted)
    return df.agg(F.count(F.lit(1)).alias("n"), (1 - F.try_divide(F.sum(e * e), F.var_pop(response) * F.count(response))).alias("r2"),
                  F.pow(F.corr(response, fitted), F.lit(2.0)).alias("squared_correlation"))


def diagnostics(df: DataFrame, g: Gram, model: OLS) -> DataFrame:
    """fitted, residual, leverage, standardised residual and Cook's distance for every row, no shuffle."""
    kept = [t for t, b in zip(model.terms, model.beta[1:]) if not math.isnan(b)]
    idx = g.index(kept)
    root = np.linalg.inv(np.linalg.cholesky(g.cross[np.ix_(idx, idx)]))
    out = predict(df, model.coefficients()).withColumn("residual", F.col(model.response) - F.col("fitted"))
    leverage: Column = F.lit(1.0 / g.n)
    for k in range(len(kept)):
        z = F.lit(0.0)
        for j in range(k + 1):
            z = z + F.lit(float(root[k, j])) * (F.col(kept[j]) - F.lit(float(g.mean[idx[j]])))
        leverage = leverage + z * z
    out = out.withColumn("leverage", leverage)
    spread = F.lit(math.sqrt(model.sigma2)) * F.sqrt(1 - F.col("leverage"))
    out = out.withColumn("std_residual", F.try_divide(F.col("residual"), spread))
    r, h = F.col("std_residual"), F.col("leverage")
    return out.withColumn("cooks_distance", F.try_divide(r * r * h, F.lit(float(model.p + 1)) * (1 - h)))


def posterior(spark: SparkSession, model: OLS, c0: float = 0.001, d0: float = 0.001, level: float = 0.95) -> DataFrame:
    """Posterior mean, sd and credible interval under a flat prior on the coefficients and an inverse-gamma(c0/2, d0/2)
    prior on the error variance: a t law in closed form."""
    k = model.p + 1
    nu = c0 + model.n - k
    scale2 = (d0 + model.rss) / nu
    q = dist.t_quantile(0.5 + level / 2, nu)
    rows = []
    for term, b, v in zip(["(Intercept)", *model.terms], model.beta, np.diag(model.inverse)):
        s = math.sqrt(v * scale2) if not math.isnan(v) else math.nan
        rows.append((term, *map(_num, (b, s * math.sqrt(nu / (nu - 2)), b - q * s, b + q * s))))
    shape, rate = nu / 2, (d0 + model.rss) / 2
    mean = rate / (shape - 1)
    rows.append(("sigma2", mean, mean / math.sqrt(shape - 2), None, None))
    return spark.createDataFrame(rows, "term string, mean double, sd double, ci_low double, ci_high double")


def pool(fits: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rubin's rules over a table (imputation, term, estimate, std_error)."""
    group = [*(by or []), "term"]
    m = F.count(F.lit(1))
    between = F.coalesce(F.var_samp("estimate"), F.lit(0.0))
    within = F.avg(F.col("std_error") * F.col("std_error"))
    return fits.groupBy(*group).agg(m.alias("m"), F.avg("estimate").alias("estimate"), within.alias("within"),
                                    between.alias("between")).withColumn(
        "total_variance", F.col("within") + (1 + 1 / F.col("m")) * F.col("between")).withColumn(
        "std_error", F.sqrt("total_variance"))


# --- linear discriminant -----------------------------------------------------------------------------------------

def fit_discriminant(df: DataFrame, label: str, columns: list[str]) -> dict:
    """Linear discriminant functions {class: (constant, coefficients)} from class sums and one pooled cross-product."""
    p = len(columns)
    rows = df.na.drop("any", subset=[label, *columns]).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[
            F.covar_pop(columns[i], columns[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]).collect()  # one row per class
    n = sum(r["n"] for r in rows)
    pooled = np.zeros((p, p))
    for r in rows:
        for i in range(p):
            for j in range(i, p):
                v = r[f"s{i}_{j}"] * r["n"]
                pooled[i, j] += v
                if i != j:
                    pooled[j, i] += v
    inv = np.linalg.pinv(pooled / max(n - len(rows), 1))
    out = {}
    for r in sorted(rows, key=lambda r: r[label]):
        m = np.array([r[f"m{i}"] for i in range(p)])
        w = inv @ m
        out[r[label]] = (float(-0.5 * m @ w + math.log(r["n"] / n)), [float(x) for x in w])
    return out


def apply_discriminant(df: DataFrame, model: dict, columns: list[str], name: str = "prediction") -> DataFrame:
    scores = []
    for cls, (const, w) in model.items():
        s = F.lit(const)
        for c, b in zip(columns, w):
            s = s + F.lit(b) * F.col(c)
        scores.append(F.struct(s.alias("s"), F.lit(cls).alias("c")))
    return df.withColumn(name, F.array_max(F.array(*scores))["c"])
