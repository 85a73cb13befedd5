"""Samples and splits that depend on keys, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import BROADCAST_ROWS, global_row_number, hot_split_join, key_hash, running_totals, stage, unit_hash

# Copies of one row that one task unfolds.
CHUNK = 10_000


def bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own seeded sample (depends on how rows are partitioned)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key, fraction: float, salt: str = "") -> DataFrame:
    """Sample by key hash: the same rows however the data are partitioned."""
    return df.filter(unit_hash(key, F.lit(salt)) < fraction)


def downsample_class(df: DataFrame, label: str, majority, key, fraction: float, salt: str = "") -> DataFrame:
    """Keep every row outside the majority class and a hash sample of the majority, in one pass."""
    return df.filter(~F.col(label).eqNullSafe(F.lit(majority)) | (unit_hash(key, F.lit(salt)) < fraction))


def hash_split(df: DataFrame, key, weights: dict[str, float], salt: str = "", name: str = "split") -> DataFrame:
    """Label rows with a split chosen by key hash and cumulative weights."""
    total = sum(weights.values())
    u, edge, out = unit_hash(key, F.lit(salt)), 0.0, None
    labels = list(weights)
    for label in labels[:-1]:
        edge += weights[label] / total
        out = F.when(u < edge, F.lit(label)) if out is None else out.when(u < edge, F.lit(label))
    return df.withColumn(name, out.otherwise(F.lit(labels[-1])))


def hash_fold(key, folds: int, salt: str = "") -> Column:
    return (key_hash(key, F.lit(salt)) % folds).cast("int")


def take_positions(df: DataFrame, order_by: list, first: int, last: int) -> DataFrame:
    """Rows at 1-based positions first..last of a stated total order."""
    return global_row_number(df, order_by, "_row_no").filter(F.col("_row_no").between(first, last)).drop("_row_no")


def stratified_split(df: DataFrame, label: str, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Exactly ceil(fraction * n) training rows in every class, chosen by hash order within the class.

    Classes are counted, ranked with one global running total ordered by (class, hash, key) and compared with
    the class total; a class that holds most rows is spread over slices like any other.
    """
    hashed = df.withColumn("_h", key_hash(key, F.lit(salt))).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(hashed, [label, "_h", key], {"_pos": "_one"})
    sizes = ranked.groupBy(label).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    placed = _with_sizes(ranked, sizes, label)
    in_class = F.col("_pos") - F.col("_first") + 1
    wanted = F.ceil(F.col("_n") * F.lit(fraction))
    return placed.withColumn("split", F.when(in_class <= wanted, "train").otherwise("test")).select(*df.columns, "split")


def _with_sizes(ranked: DataFrame, sizes: DataFrame, label: str) -> DataFrame:
    """Rows with the place and size of their class; rows without a label are a class of their own. Many classes are joined by shuffle."""
    kept = stage(sizes.withColumnRenamed(label, "_label"))
    match = ranked[label].eqNullSafe(F.col("_label"))
    if kept.count() <= BROADCAST_ROWS:
        return ranked.join(F.broadcast(kept), match).drop("_label")
    return hot_split_join(ranked.withColumn("_key", F.to_json(F.struct(label))),
                          kept.select(F.to_json(F.struct(F.col("_label").alias(label))).alias("_key"), "_first", "_n"), ["_key"], "_n").drop("_key")


def complement(df: DataFrame, taken: DataFrame, row_id: str) -> DataFrame:
    return df.join(taken.select(row_id), on=row_id, how="left_anti")


def upsample_to_parity(df: DataFrame, label: str, key: str, salt: str = "") -> DataFrame:
    """Bring every class to the size of the largest: whole copies plus a draw of the remainder without replacement.

    Each row carries `copy` (0 for the original). The remainder goes to the rows first in hash order, so class
    counts are exactly equal and the result does not depend on partitioning.
    """
    hashed = df.withColumn("_h", key_hash(key, F.lit(salt))).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(hashed, [label, "_h", key], {"_pos": "_one"})
    sizes = ranked.groupBy(label).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # Rows without a label stay as they are and do not set the size to reach.
    top = sizes.filter(F.col(label).isNotNull()).agg(F.max("_n")).first()[0] or 0
    placed = _with_sizes(ranked, sizes, label)
    in_class = F.col("_pos") - F.col("_first") + 1
    whole = F.floor(F.lit(top) / F.col("_n"))
    extra = F.lit(top) - whole * F.col("_n")
    copies = F.when(F.col(label).isNull(), 1).otherwise(whole + F.when(in_class <= extra, 1).otherwise(0)).cast("int")
    # A row with very many copies gets them in chunks, which are dealt out before they are unfolded.
    chunks = placed.withColumn("_copies", copies).withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(CHUNK))))
    if chunks.filter(F.col("_copies") > CHUNK).limit(1).count():
        chunks = chunks.repartition(F.col(key), F.col("_from"))
    return chunks.withColumn("copy", F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK, F.col("_copies")) - 1))).select(*df.columns, "copy")
