"""Queries over counts, summaries, profiles, correlations and cluster profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import profile as P
from tallyloom.operators import reshape
from tallyloom.operators.features import standardise
from tallyloom.plans.common import CUSTOMER_FEATURES, CUSTOMER_SQL, LINE_COLUMNS, customer_features, money_mean, money_mean_sql, rounded
from tallyloom.plans.registry import query
from tallyloom.runtime import stage


def _stat_sql(source: str, columns: list[str], stats: dict[str, str], by: str = "") -> str:
    """UNION of one (column, stat, value) select per column and statistic, for the oracle."""
    group = f"GROUP BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"WITH f AS ({source}) " + " UNION ALL ".join(
        f"SELECT {head}'{c}' AS \"column\", '{name}' AS stat, CAST({expr.format(c=c)} AS DOUBLE) AS value "
        + ("" if "SELECT" in expr else f"FROM f {group}")
        for c in columns for name, expr in stats.items())


SUMMARY = {"count": "count({c})", "mean": "round(avg({c}), 4)", "std": "round(stddev_samp({c}), 4)",
           "min": "round(min({c}), 4)", "max": "round(max({c}), 4)", "p25": "round(quantile_cont({c}, 0.25), 4)",
           "p50": "round(quantile_cont({c}, 0.5), 4)", "p75": "round(quantile_cont({c}, 0.75), 4)"}
# Population moments written out, because SQL engines differ in their bias corrections.
SHAPE = {"distinct": "count(DISTINCT {c})", "zeros": "count(*) FILTER ({c} = 0)",
         "skewness": "round((SELECT sqrt(count(*)) * sum(pow(x.{c} - m, 3)) / pow(sum(pow(x.{c} - m, 2)), 1.5) FROM f x, "
                     "(SELECT avg({c}) AS m FROM f)), 4)",
         "kurtosis": "round((SELECT count(*) * sum(pow(x.{c} - m, 4)) / pow(sum(pow(x.{c} - m, 2)), 2) - 3 FROM f x, "
                     "(SELECT avg({c}) AS m FROM f)), 4)",
         "mode": "(SELECT x.{c} FROM f x GROUP BY x.{c} ORDER BY count(*) DESC, x.{c} LIMIT 1)"}


@query("A01 M40", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def group_counts(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("A02", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def distinct_users(t):
    return t.events.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@query("A02", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS customers, TRUE AS close FROM orders GROUP BY 1
    UNION ALL SELECT NULL, count(DISTINCT o_custkey), TRUE FROM orders""")
def distinct_customers_sketched(t):
    """Distinct customers of every year and of all, estimated from sketches per month, next to the exact numbers: within three standard errors."""
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    months = stage(P.distinct_sketches(rows, ["year", "month"], "o_custkey", 12))
    estimates = P.sketched_counts(months, ["year"]).unionByName(P.sketched_counts(months, [F.lit(None).cast("int").alias("year")]))
    exact = rows.groupBy("year").agg(F.count_distinct("o_custkey").alias("customers"))
    exact = exact.unionByName(rows.groupBy(F.lit(None).cast("int").alias("year")).agg(F.count_distinct("o_custkey").alias("customers")))
    both = exact.join(F.broadcast(estimates.withColumnRenamed("year", "_y")), F.col("year").eqNullSafe(F.col("_y")))
    return both.select("year", "customers", (F.abs(F.col("estimate") - F.col("customers")) <= 3 * 1.04 / 64 * F.col("customers")).alias("close"))


@query("A04", """
    SELECT lang, max(n_chars) AS longest, min(n_chars) AS shortest, round(avg(n_chars), 4) AS mean FROM documents GROUP BY lang""")
def group_min_max_avg(t):
    return t.documents.groupBy("lang").agg(F.max("n_chars").alias("longest"), F.min("n_chars").alias("shortest"),
                                           F.round(F.avg("n_chars"), 4).alias("mean"))


@query("A05", """
    SELECT CAST(sum(quality) AS BIGINT) AS good, CAST(sum(toxic) AS BIGINT) AS toxic, round(avg(quality), 6) AS rate FROM labels""")
def global_scalars(t):
    return P.scalars(t.labels, good=F.sum("quality"), toxic=F.sum("toxic"), rate=F.round(F.avg("quality"), 6))


@query("A06", _stat_sql("SELECT * FROM lineitem", LINE_COLUMNS, SUMMARY))
def numeric_summary(t):
    return rounded(P.describe(t.lineitem, LINE_COLUMNS), 4, "value")


@query("A07", _stat_sql("SELECT o_totalprice, o_custkey FROM orders", ["o_totalprice", "o_custkey"], {**SUMMARY, **SHAPE}))
def profile_report(t):
    return rounded(P.describe(t.orders, ["o_totalprice", "o_custkey"], shape=True), 4, "value")


@query("A07 A08", """
    WITH d AS (SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'doc_id' AS "column", 'bigint' AS type, count(*) AS rows, count(*) - count(doc_id) AS missing FROM d
    UNION ALL SELECT 'lang', 'string', count(*), count(*) - count(lang) FROM d
    UNION ALL SELECT 'n_chars', 'bigint', count(*), count(*) - count(n_chars) FROM d
    UNION ALL SELECT 'quality', 'int', count(*), count(*) - count(quality) FROM d
    UNION ALL SELECT 'toxic', 'int', count(*), count(*) - count(toxic) FROM d""")
def missing_report(t):
    joined = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, on="doc_id", how="left")
    return P.missing_report(joined)


@query("A08", """
    SELECT (CASE WHEN l_discount = 0 THEN '1' ELSE '0' END) || (CASE WHEN l_tax = 0 THEN '1' ELSE '0' END) ||
           (CASE WHEN l_quantity = 1 THEN '1' ELSE '0' END) AS pattern, count(*) AS n FROM lineitem GROUP BY 1""")
def null_patterns(t):
    gaps = t.lineitem.select(F.nullif("l_discount", F.lit(0.0)).alias("d"), F.nullif("l_tax", F.lit(0.0)).alias("x"),
                             F.nullif("l_quantity", F.lit(1.0)).alias("q"))
    return P.null_patterns(gaps, ["d", "x", "q"])


@query("A09", _stat_sql("SELECT * FROM lineitem", ["l_quantity", "l_extendedprice"], SUMMARY, "l_returnflag"))
def group_describe(t):
    return rounded(P.describe(t.lineitem, ["l_quantity", "l_extendedprice"], by=["l_returnflag"]), 4, "value")


@query("A10", f"""
    SELECT segment, {money_mean_sql('balance')} AS balance, round(avg(n_orders), 4) AS n_orders, {money_mean_sql('spend')} AS spend
    FROM ({CUSTOMER_SQL}) GROUP BY segment""")
def group_means(t):
    f = customer_features(t)
    return f.groupBy("segment").agg(money_mean("balance").alias("balance"), F.round(F.avg("n_orders"), 4).alias("n_orders"),
                                    money_mean("spend").alias("spend"))


@query("A11", f"WITH f AS ({CUSTOMER_SQL}) " + " UNION ALL ".join(
    f"SELECT segment, '{c}' AS feature, round(avg({c}), 3) AS mean, round(avg({c}) - (SELECT avg({c}) FROM f), 3) AS importance"
    f" FROM f GROUP BY segment" for c in CUSTOMER_FEATURES))
def relative_importance(t):
    return rounded(P.group_deviation(customer_features(t), "segment", CUSTOMER_FEATURES), 3, "mean", "importance")


@query("A12", """
    SELECT CAST(floor(l_extendedprice / 5000) AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1""")
def price_histogram(t):
    return P.histogram(t.lineitem, "l_extendedprice", 0.0, 5000.0)


@query("A13", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(LINE_COLUMNS) for b in LINE_COLUMNS[i + 1:]))
def pearson_pairs(t):
    return rounded(P.pearson_pairs(t.lineitem, LINE_COLUMNS), 6, "r")


_RANKED = "WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in LINE_COLUMNS) + " FROM lineitem) "


@query("A14", _RANKED + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM r"
    for i, a in enumerate(LINE_COLUMNS) for b in LINE_COLUMNS[i + 1:]))
def spearman_pairs(t):
    return rounded(P.spearman_pairs(t.lineitem, LINE_COLUMNS), 6, "r")


@query("A15", """
    SELECT l_returnflag, year(l_shipdate) AS year, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL""")
def two_key_sum(t):
    return t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").cast("bigint").alias("year")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("A19", " UNION ALL ".join(
    f"SELECT '{x}' AS relation, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_columns FROM {x}"
    for x, n in [("lineitem", 11), ("orders", 6), ("documents", 5), ("events", 6)]))
def relation_shapes(t):
    parts = []
    for name in ("lineitem", "orders", "documents", "events"):
        df = getattr(t, name)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("relation"), "n_rows", F.lit(len(df.columns)).alias("n_columns")))
    return reshape.union_by_name(*parts)


@query("G06", """
    SELECT "column", CAST(n AS DOUBLE) AS count, round(m, 4) AS mean, mn AS min, mx AS max FROM (
    """ + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, avg({c}) AS m, min({c}) AS mn, max({c}) AS mx FROM lineitem"
                             for c in LINE_COLUMNS) + ")")
def transposed_summary(t):
    tidy = P.describe(t.lineitem, LINE_COLUMNS)
    return rounded(reshape.transpose_summary(tidy, stats=["count", "mean", "min", "max"]), 4, "mean")


@query("G07 F06", f"WITH f AS ({CUSTOMER_SQL}) " + " UNION ALL ".join(
    f"SELECT segment, '{c}' AS feature, round(avg(({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f)), 6) AS mean"
    f" FROM f GROUP BY segment" for c in CUSTOMER_FEATURES))
def snake_table(t):
    scaled = standardise(customer_features(t), CUSTOMER_FEATURES)
    return rounded(reshape.scaled_profile(scaled, "segment", CUSTOMER_FEATURES), 6, "mean")
