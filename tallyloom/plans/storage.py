"""Queries through files and catalog tables written from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyloom.plans.registry import query
from tallyloom.runtime import persisted, scratch_path, stage
from tallyloom.sources import io
from tallyloom.sources.schemas import _D, _L, _S, schema

CUSTOMER = schema(c_custkey=_L, c_name=_S, c_acctbal=_D, c_mktsegment=_S)


@query("S02 S05", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS bad_line FROM customer")
def csv_round_trip(t):
    """Customers through a CSV file with a header, read back with a declared schema."""
    path = scratch_path(t.spark, "customers.csv")
    io.save_csv(t.customer.select(*CUSTOMER.names), path, header=True)
    return io.scan_csv(t.spark, path, CUSTOMER, corrupt_column="bad_line")


@query("S05", "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment")
def csv_without_header(t):
    path = scratch_path(t.spark, "plain.csv")
    io.save_csv(t.customer.select(*CUSTOMER.names), path, header=False)
    back = io.scan_csv(t.spark, path, CUSTOMER, header=False)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("S02", """
    SELECT count(*) AS n, count(*) FILTER (c_name IN ('Customer#000000000', 'Customer#000000001')) AS named, 0::BIGINT AS fitting
    FROM customer""")
def csv_bad_lines(t):
    """A declared type that no line fits: every line is kept, with its text, and counted."""
    path = scratch_path(t.spark, "bad.csv")
    io.save_csv(t.customer.select("c_name", "c_mktsegment"), path, header=True)
    back = io.scan_csv(t.spark, path, schema(c_name=_S, c_mktsegment=_D), corrupt_column="bad_line")
    return back.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_name").isin("Customer#000000000", "Customer#000000001")).alias("named"),
                    F.count_if(F.col("bad_line").isNull()).alias("fitting"))


@query("S03 J01", """
    SELECT r_name, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def sheets_joined(t):
    """Several relations registered together as one workbook and queried by name."""
    names = io.register_sheets(t.spark, {f"sheet_{n}": f"{t.folder}/{n}.parquet" for n in ("customer", "nation", "region")})
    joined = t.spark.sql("""
        SELECT r_name, n_name, count(*) AS customers FROM sheet_customer JOIN sheet_nation ON c_nationkey = n_nationkey
        JOIN sheet_region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
    for name in names:
        t.spark.catalog.dropTempView(name)
    return joined


@query("S04 S01", "SELECT 'orders' AS type, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def saved_table_scan(t):
    """Orders saved as a managed table of the catalog, scanned back with a provenance tag, and dropped."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    io.save_table(t.orders.select("o_orderstatus", "o_totalprice"), name)
    try:
        # One row per status.
        return stage(io.scan_table(t.spark, name, "orders").groupBy("type", "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("S08 P20", """
    SELECT count(*) AS before_filter, count(*) FILTER (value > 50) AS after_filter, count(DISTINCT user_id) FILTER (value > 50) AS users FROM events""")
def persisted_audit(t):
    """Row counts before and after a step, several actions on one kept intermediate."""
    with persisted(t.events.select("user_id", "value")) as kept:
        before = kept.count()
        step = kept.filter("value > 50")
        after, users = step.count(), step.agg(F.count_distinct("user_id")).first()[0]
    return t.spark.createDataFrame([(before, after, users)], "before_filter long, after_filter long, users long")
