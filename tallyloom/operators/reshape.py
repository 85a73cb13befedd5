"""Unions and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_position(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), frames)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids: list[str], values: list[str], key: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, key, value)


def transpose_summary(summary: DataFrame, column: str = "column", stat: str = "stat", value: str = "value",
                      stats: list[str] | None = None) -> DataFrame:
    """Tidy (column, stat, value) to one row per column and one column per statistic."""
    return summary.groupBy(column).pivot(stat, stats).agg(F.first(value))


def scaled_profile(df: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """Mean of every feature in every cluster, long form (the table behind a snake plot)."""
    means = df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in features])
    return means.unpivot([cluster], features, "feature", "mean")
