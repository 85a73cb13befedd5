"""Keyed joins, key audits and nearest-row-to-centre."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in USING form: key columns appear once."""
    return left.join(right, on=keys, how="left")


def bind_columns(frames: list[DataFrame], row_id: str) -> DataFrame:
    """Bind columns of relations that share a row id."""
    return reduce(lambda a, b: a.join(b, on=[row_id], how="inner"), frames)


def key_audit(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row telling whether two relations match one to one on a key.

    Each side is reduced to (key, count) before the outer join, so a key with many rows costs one row here.
    """
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"))
    both = a.join(b, on=keys, how="full_outer")
    has_l, has_r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return both.agg(
        F.count_if(has_l & ~has_r).alias("left_only"),
        F.count_if(has_r & ~has_l).alias("right_only"),
        F.count_if(has_l & has_r).alias("matched"),
        F.count_if(F.coalesce(F.col("_l"), F.lit(0)) > 1).alias("left_repeated"),
        F.count_if(F.coalesce(F.col("_r"), F.lit(0)) > 1).alias("right_repeated"),
        F.coalesce(F.sum(F.coalesce(F.col("_l") * F.col("_r"), F.lit(0))), F.lit(0)).cast("long").alias("joined_rows"),
    )


def exemplars(points: DataFrame, centres: list[tuple], id_col: str, vector: str) -> DataFrame:
    """The row nearest to each centre, over all rows.

    `centres` is a fitted model's list of (centre id, coordinates): bounded by the number of clusters. Each
    centre is one `min` aggregate in a single pass, so no row is paired with a centre outside its own task.
    """
    def distance(coords):
        lit = F.array(*[F.lit(float(x)) for x in coords])
        gaps = F.zip_with(F.col(vector), lit, lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g))

    best = points.agg(*[
        F.min(F.struct(distance(coords).alias("distance"), F.col(id_col).alias("row_id"))).alias(f"c{i}")
        for i, (_, coords) in enumerate(centres)
    ])
    rows = F.array(*[
        F.struct(F.lit(cid).alias("centre"), F.col(f"c{i}.row_id").alias("row_id"),
                 F.col(f"c{i}.distance").alias("distance"))
        for i, (cid, _) in enumerate(centres)
    ])
    return best.select(F.explode(rows).alias("r")).select("r.*")
