"""Row and column cleaning on whole relations."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalar import sentinel_to_null


def keep(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def drop_list(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored with a warning."""
    known = {c.lower() for c in df.columns}
    unknown = [n for n in names if n.lower() not in known]
    if unknown:
        warnings.warn(f"columns to drop are not there: {unknown}", stacklevel=2)
    return df.drop(*names)


def slice_columns(df: DataFrame, start: int = 0, stop: int | None = None, without: tuple[int, ...] = ()) -> DataFrame:
    """Columns by 0-based position, half-open, leaving out some positions."""
    picked = [c for i, c in enumerate(df.columns) if i not in without][start:stop] if without else df.columns[start:stop]
    return df.select(*picked)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the smallest by `order_by` then by the remaining columns.

    Written as an aggregate, so that copies of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order_by, *rest)).alias("_row"))
    fields = set(order_by + rest)
    return best.select(*[F.col(f"_row.{c}").alias(c) if c in fields and c not in keys else F.col(c) for c in df.columns])


def dedup_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: row count before and after keeping one row per key, without building the deduplicated set."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("rows_removed"),
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def sentinels_out(df: DataFrame, columns: list[str], sentinel=0) -> DataFrame:
    """Sentinel to NULL in the named columns, then drop every row with a gap in them."""
    return df.withColumns({c: sentinel_to_null(c, sentinel) for c in columns}).na.drop("any", subset=columns)


def correlated_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, r) whose |r| passes the threshold."""
    return pairs.filter(F.abs("r") > threshold)


def prune_correlated(df: DataFrame, pairs: DataFrame, threshold: float) -> tuple[DataFrame, list[str]]:
    """Drop the later column of every strongly correlated pair (a, b are column names: bounded by the schema)."""
    order = {c: i for i, c in enumerate(df.columns)}
    doomed: set[str] = set()
    found = [(r["a"], r["b"]) for r in correlated_pairs(pairs, threshold).select("a", "b").collect()]
    for a, b in sorted(found, key=lambda p: sorted((order[p[0]], order[p[1]]))):
        first, second = sorted((a, b), key=order.get)
        if first not in doomed:
            doomed.add(second)
    return df.drop(*doomed), sorted(doomed, key=order.get)
