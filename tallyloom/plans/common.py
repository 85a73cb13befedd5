"""Derived relations shared by several queries."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

CUSTOMER_FEATURES = ["balance", "n_orders", "spend", "avg_price", "max_price", "urgent_share"]

# The same per-customer table for the oracle side.
CUSTOMER_SQL = """
    SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance, CAST(count(o_orderkey) AS DOUBLE) AS n_orders,
           coalesce(sum(o_totalprice), 0.0) AS spend, coalesce(avg(o_totalprice), 0.0) AS avg_price,
           coalesce(max(o_totalprice), 0.0) AS max_price,
           coalesce(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) FILTER (o_orderkey IS NOT NULL), 0.0)
               AS urgent_share
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL"""


def customer_features(t) -> DataFrame:
    """One row per customer; orders are reduced to one row per customer before the join."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.sum("o_totalprice").alias("spend"),
        F.avg("o_totalprice").alias("avg_price"), F.max("o_totalprice").alias("max_price"),
        F.avg(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)).alias("urgent_share"))
    joined = t.customer.join(per, on="c_custkey", how="left").na.fill(0.0, subset=[c for c in per.columns if c != "c_custkey"])
    return joined.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
                         *CUSTOMER_FEATURES[1:])


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def money_mean(c: str):
    """Mean of an amount to four digits. Whole cents are added up, so the order of the rows cannot change the last digit."""
    cents = f"cast(round({c} * 100) AS bigint)"
    return F.expr(f"signum(sum({cents})) * ((abs(sum({cents})) * 200 + count({c})) div (2 * nullif(count({c}), 0))) / 10000D")


def money_mean_sql(c: str) -> str:
    """The same for the oracle side."""
    cents = f"CAST(round({c} * 100) AS BIGINT)"
    return f"sign(sum({cents})) * ((abs(sum({cents})) * 200 + count({c})) // (2 * nullif(count({c}), 0))) / 10000.0"


@contextmanager
def views(spark, **frames: DataFrame):
    """Temporary views that are gone again once the query has been analysed."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
