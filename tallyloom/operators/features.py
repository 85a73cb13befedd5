"""Scaling, power transforms and other feature construction."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- standardising -----------------------------------------------------------------------------------------------

def scaling_params(df: DataFrame, columns: list[str], ddof: int = 0) -> dict[str, tuple[float, float]]:
    """{column: (mean, std)} from one pass; a constant column gets scale 1, as usual for scalers."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[a for c in columns for a in (F.avg(c).alias(f"m_{c}"), std(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def params_table(spark, params: dict[str, tuple[float, float]]) -> DataFrame:
    return spark.createDataFrame([(c, float(m), float(s)) for c, (m, s) in params.items()],
                                 "column string, mean double, scale double")


def apply_scaling(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def invert_scaling(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(s) + F.lit(m) for c, (m, s) in params.items()})


def standardise(df: DataFrame, columns: list[str], ddof: int = 0) -> DataFrame:
    return apply_scaling(df, scaling_params(df, columns, ddof))


# --- Yeo-Johnson -------------------------------------------------------------------------------------------------

def yeo_johnson(x: Column, lam: Column) -> Column:
    """Power transform for a given exponent column or literal."""
    up = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / F.when(F.abs(lam) < 1e-12, 1.0).otherwise(lam))
    other = F.lit(2.0) - lam
    down = F.when(F.abs(other) < 1e-12, -F.log1p(-x)).otherwise(
        -(F.pow(1 - x, other) - 1) / F.when(F.abs(other) < 1e-12, 1.0).otherwise(other))
    return F.when(x >= 0, up).otherwise(down)


def yeo_johnson_inverse(y: Column, lam: float) -> Column:
    other = 2.0 - lam
    up = F.exp(y) - 1 if abs(lam) < 1e-12 else F.pow(y * lam + 1, F.lit(1.0 / lam)) - 1
    down = 1 - F.exp(-y) if abs(other) < 1e-12 else 1 - F.pow(1 - y * other, F.lit(1.0 / other))
    return F.when(y >= 0, up).otherwise(down)


def fit_yeo_johnson(df: DataFrame, columns: list[str], low: float = -5.0, high: float = 5.0, grid: int = 33,
                    rounds: int = 5) -> dict[str, float]:
    """Maximum-likelihood exponent per column.

    Every round scores a grid of exponents for all columns in one aggregate over the whole data (the grid is
    exploded in the task and reduced map-side, so the shuffle carries one row per grid point), then narrows the
    interval of each column around its best point.
    """
    span = {c: (low, high) for c in columns}
    fixed = df.agg(*[a for c in columns for a in (
        F.count(c).alias(f"n_{c}"), F.sum(F.signum(c) * F.log1p(F.abs(F.col(c)))).alias(f"g_{c}"))]).first()
    for _ in range(rounds):
        points = {c: [lo + (hi - lo) * i / (grid - 1) for i in range(grid)] for c, (lo, hi) in span.items()}
        step = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_i")
        lam = {c: F.lit(span[c][0]) + F.col("_i") * F.lit((span[c][1] - span[c][0]) / (grid - 1)) for c in columns}
        scored = df.select(*columns, step).groupBy("_i").agg(
            *[F.var_pop(yeo_johnson(F.col(c).cast("double"), lam[c])).alias(c) for c in columns])
        rows = {r["_i"]: r for r in scored.collect()}  # one row per grid point
        for c in columns:
            n, g = fixed[f"n_{c}"], fixed[f"g_{c}"] or 0.0
            best, top = None, None
            for i in range(grid):
                var = rows[i][c] if i in rows else None
                if not var or var != var or var == float("inf"):
                    continue
                score = -0.5 * n * math.log(var) + (points[c][i] - 1) * g
                if top is None or score > top:
                    best, top = i, score
            if best is None:  # constant or empty column: leave it as it is
                span[c] = (1.0, 1.0)
                continue
            lo, hi = points[c][max(best - 1, 0)], points[c][min(best + 1, grid - 1)]
            span[c] = (lo, hi)
    return {c: (lo + hi) / 2 for c, (lo, hi) in span.items()}


def apply_yeo_johnson(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    return df.withColumns({c: yeo_johnson(F.col(c).cast("double"), F.lit(float(l))) for c, l in lambdas.items()})


def invert_yeo_johnson(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    return df.withColumns({c: yeo_johnson_inverse(F.col(c), float(l)) for c, l in lambdas.items()})


def power_transform(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, float], dict[str, tuple[float, float]]]:
    """Fit, transform and standardise; returns the data with the parameters needed for the inverse."""
    lambdas = fit_yeo_johnson(df, columns)
    powered = apply_yeo_johnson(df, lambdas)
    params = scaling_params(powered, columns)
    return apply_scaling(powered, params), lambdas, params


# --- formulas ----------------------------------------------------------------------------------------------------

def as_vector(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    """ML vector column from numeric columns, for fitting: rows with gaps are dropped. Score with `scored`, which keeps them."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=columns, outputCol=name, handleInvalid="skip").transform(df)


def scored(df: DataFrame, model, columns: list[str], name: str = "prediction") -> DataFrame:
    """All rows with the model's prediction; rows with gaps get none."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rest = df.filter(~whole)
    known = model.transform(as_vector(df.filter(whole), columns)).withColumnRenamed("prediction", name)
    return known.select(*df.columns, name).unionByName(rest.withColumn(name, F.lit(None).cast(known.schema[name].dataType)))


def as_array(df: DataFrame, columns: list[str], name: str = "vec") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in columns]))


def formula(df: DataFrame, text: str):
    """Fitted R formula (factors, interactions); the alphabetically first level is the base, as in R."""
    from pyspark.ml.feature import RFormula
    return RFormula(formula=text, featuresCol="features", labelCol="label", stringIndexerOrderType="alphabetDesc").fit(df)


def interaction(*cols: str) -> Column:
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out * F.col(c)
    return out


def factor_columns(col: str, levels: list[str]) -> dict[str, Column]:
    """Treatment contrasts: one 0/1 column per level but the first in alphabetical order."""
    return {f"{col}_{level}": F.when(F.col(col) == level, 1.0).otherwise(0.0) for level in sorted(levels)[1:]}


def vector_size(df: DataFrame, name: str = "features") -> int:
    meta = df.schema[name].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return meta["num_attrs"]
    row = df.select(name).first()
    return 0 if row is None else len(row[0])


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)
