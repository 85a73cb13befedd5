"""Counts, summaries, exact quantiles, null patterns, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import hot_split_join, running_totals, small, stage


def top_groups(df: DataFrame, key: str, k: int, count: str = "n") -> DataFrame:
    """The k most frequent values, ties by value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc_nulls_last(key)).limit(k)


def distinct_sketches(df: DataFrame, by: list, column: str, lg_k: int = 12) -> DataFrame:
    """(by..., sketch): a mergeable sketch of the distinct values of every group, of 2^lg_k registers at most."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def sketched_counts(sketches: DataFrame, by: list) -> DataFrame:
    """(by..., estimate): distinct values of unions of groups, from their sketches alone; the relative standard error is about 1.04 / sqrt(2^lg_k)."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column, value, n) of the non-null values, reduced map-side before its only shuffle."""
    by = by or []
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(by, columns, "column", "value")
    return long.filter(F.col("value").isNotNull()).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(counts: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Linearly interpolated quantiles of every (by..., column) of a `value_counts` table.

    Positions come from one distributed running total, so no group is ever gathered into one task. Returns
    (by..., column, prob, value).
    """
    group = [*(by or []), "column"]
    ranked = running_totals(counts, [*group, "value"], {"_upto": "n"})
    bounds = ranked.groupBy(*group).agg(F.min(F.col("_upto") - F.col("n")).alias("_start"), F.sum("n").alias("_total"))
    position = (F.col("_total") - 1) * F.col("prob")
    targets = bounds.select(*group, "_start", "_total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    targets = targets.select(*group, "prob", (position - F.floor(position)).alias("_frac"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), (F.col("_start") + 1 + F.floor(position)).alias("at")),
        F.struct(F.lit(1).alias("side"), (F.col("_start") + 1 + F.ceil(position)).alias("at")),
    )).alias("t")).select(*group, "prob", "_frac", "t.side", "t.at")
    # Two rows per group, column and probability: broadcast unless there are very many groups, so that a large group stays spread.
    hit = ranked.join(small(targets) if by else F.broadcast(targets), on=group).filter((F.col("at") > F.col("_upto") - F.col("n")) & (F.col("at") <= F.col("_upto")))
    ends = hit.groupBy(*group, "prob").agg(
        F.max("_frac").alias("_frac"),
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("_lo"),
        F.max(F.when(F.col("side") == 1, F.col("value"))).alias("_hi"),
    )
    return ends.select(*group, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"))


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}"


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None,
             probs: tuple[float, ...] = (0.25, 0.5, 0.75), shape: bool = False) -> DataFrame:
    """Tidy (by..., column, stat, value): count, mean, std, min, quantiles, max; `shape` adds the profile measures.

    Every moment comes from the (column, value, n) table, which is already reduced, and so do distinct, zeros and
    mode; sample standard deviation as usual for summaries.
    """
    by = by or []
    counts = stage(value_counts(df, columns, by))
    group = [*by, "column"]
    n, v = F.col("n"), F.col("value")
    first = counts.groupBy(*group).agg(
        F.sum("n").alias("_n"), (F.sum(n * v) / F.sum("n")).alias("_mean"), F.min("value").alias("_min"),
        F.max("value").alias("_max"), F.count(F.lit(1)).alias("_distinct"),
        F.sum(F.when(v == 0, n).otherwise(0)).alias("_zeros"), F.min(F.struct((-n).alias("a"), v.alias("b"))).alias("_mode"))
    gap = v - F.col("_mean")
    means = first.select(*group, "_mean")
    # One row per group and column: broadcast unless there are very many groups.
    powers = counts.join(small(means) if by else F.broadcast(means), on=group).groupBy(*group).agg(
        *[F.sum(n * F.pow(gap, F.lit(p))).alias(f"_m{p}") for p in (2, 3, 4)])
    moments = first.join(powers, on=group)
    stats = {
        "count": F.col("_n").cast("double"), "mean": F.col("_mean"),
        "std": F.sqrt(F.try_divide(F.col("_m2"), F.col("_n") - 1)), "min": F.col("_min"), "max": F.col("_max"),
    }
    if shape:
        stats.update({
            "distinct": F.col("_distinct").cast("double"), "zeros": F.col("_zeros").cast("double"),
            "mode": F.col("_mode.b"),
            "skewness": F.try_divide(F.sqrt(F.col("_n").cast("double")) * F.col("_m3"), F.pow("_m2", F.lit(1.5))),
            "kurtosis": F.try_divide(F.col("_n") * F.col("_m4"), F.col("_m2") * F.col("_m2")) - 3,
        })
    tidy = moments.select(*group, *[expr.alias(name) for name, expr in stats.items()]).unpivot(
        group, list(stats), "stat", "value")
    quants = exact_quantiles(counts, list(probs), by)
    names = F.create_map(*[x for p in probs for x in (F.lit(float(p)), F.lit(quantile_name(p)))])
    return tidy.unionByName(quants.select(*group, names[F.col("prob")].alias("stat"), "value"))


def missing_report(df: DataFrame) -> DataFrame:
    """(column, type, rows, missing) for every column, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = F.create_map(*[x for name, kind in df.dtypes for x in (F.lit(name), F.lit(kind))])
    return one.unpivot(["_rows"], df.columns, "column", "missing").select(
        "column", types[F.col("column")].alias("type"), F.col("_rows").alias("rows"), "missing")


def null_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by presence pattern: one 1/0 per column, 1 meaning missing."""
    mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.select(mask.alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def group_deviation(df: DataFrame, group: str, columns: list[str], relative: bool = False) -> DataFrame:
    """Group mean minus population mean per feature, long form; `relative` divides by the population mean.

    Population means are recovered from the group sums, so the data are read once.
    """
    per = df.groupBy(group).agg(*[a for c in columns for a in (F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s_{c}").cast("double").alias("s"),
                               F.col(f"n_{c}").alias("n")) for c in columns])
    long = stage(per.select(group, F.explode(cells).alias("x")).select(group, "x.*"))
    whole = long.groupBy("feature").agg((F.sum("s") / F.sum("n")).alias("population"))
    out = long.join(F.broadcast(whole), on="feature").withColumn("mean", F.try_divide("s", "n"))
    change = F.col("mean") - F.col("population")
    if relative:
        change = F.try_divide(change, F.col("population"))
    return out.select(group, "feature", "mean", change.alias("importance"))


def histogram(df: DataFrame, column: str, low: float, width: float, name: str = "bin") -> DataFrame:
    """Counts by bin number floor((x - low) / width)."""
    return df.filter(F.col(column).isNotNull()).groupBy(
        F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("long").alias(name)
    ).agg(F.count(F.lit(1)).alias("n"))


def pearson_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for every pair of columns, one pass."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                      for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(cells).alias("p")).select("p.*")


def average_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, rank): average rank of every distinct value."""
    counts = value_counts(df, columns)
    ranked = running_totals(counts, ["column", "value"], {"_upto": "n"})
    starts = ranked.groupBy("column").agg(F.min(F.col("_upto") - F.col("n")).alias("_start"))
    below = F.col("_upto") - F.col("n") - F.col("_start")
    return ranked.join(F.broadcast(starts), on="column").select(
        "column", "value", "n", (below + (F.col("n") + 1) / 2).alias("rank"))


def spearman_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rank correlation of every pair, over rows with no gap in the columns.

    Each column's ranks are joined back by value; values shared by many rows are broadcast, the rest shuffled.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop("any")
    ranks = stage(average_ranks(rows, columns))
    for c in columns:
        mine = ranks.filter(F.col("column") == c).select(F.col("value").alias(c), "n", F.col("rank").alias(f"{c}__rank"))
        rows = hot_split_join(rows, mine, [c], "n").drop("n")
    ranked = rows.select(*[F.col(f"{c}__rank").alias(c) for c in columns])
    return pearson_pairs(ranked, columns)


def baskets(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct items of every basket, sorted. Duplicates go before the gathering, so an array is no longer than the catalogue."""
    return df.select(basket, item).na.drop("any").distinct().groupBy(basket).agg(
        F.sort_array(F.collect_list(item)).alias("items"))


def scalars(df: DataFrame, **exprs: Column) -> DataFrame:
    return df.agg(*[e.alias(name) for name, e in exprs.items()])
