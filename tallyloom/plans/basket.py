"""Market-basket queries: an order is a basket, the brands of its parts are the items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import basket as B
from tallyloom.operators.profile import baskets, describe
from tallyloom.plans.common import rounded
from tallyloom.plans.registry import query
from tallyloom.sources.io import flatten_rules

SUPPORT, CONFIDENCE = 0.005, 0.1


def brand_lines(t):
    return t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), on="l_partkey").select("l_orderkey", "p_brand")


def segment_lines(t):
    owner = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("c_mktsegment").alias("segment"))
    return brand_lines(t).join(owner, on="l_orderkey")


BI = "bi AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey)"

# All item sets of every basket, grown one item at a time, then one rule per item on the right.
RULES_SQL = f"""
    WITH RECURSIVE {BI}, n AS (SELECT count(DISTINCT o) AS n FROM bi),
    sub AS (SELECT o, [i] AS s, i AS last FROM bi
            UNION ALL SELECT sub.o, list_append(s, bi.i), bi.i FROM sub JOIN bi ON bi.o = sub.o AND bi.i > sub.last WHERE len(s) < 10),
    sets AS (SELECT s, count(*) AS c FROM sub GROUP BY s),
    freq AS (SELECT s, c FROM sets, n WHERE c >= ceil({SUPPORT} * n)),
    cand AS (SELECT s, c, unnest(s) AS consequent FROM freq),
    ante AS (SELECT list_filter(s, lambda x: x <> consequent) AS a, consequent, c FROM cand),
    rules AS (
        SELECT array_to_string(ante.a, ',') AS antecedent, len(ante.a) AS size, consequent, ante.c / n AS support,
               ante.c / coalesce(f.c, n) AS confidence, ante.c / coalesce(f.c, n) / (g.c / n) AS lift
        FROM ante JOIN n ON true LEFT JOIN freq f ON f.s = ante.a JOIN freq g ON g.s = [consequent]
        WHERE ante.c / coalesce(f.c, n) >= {CONFIDENCE})"""


def _rules(t):
    return B.association_rules(brand_lines(t), "l_orderkey", "p_brand", SUPPORT, CONFIDENCE)


@query("A16", f"WITH {BI} SELECT o AS l_orderkey, string_agg(i, ',' ORDER BY i) AS items FROM bi GROUP BY o")
def brand_baskets(t):
    return baskets(brand_lines(t), "l_orderkey", "p_brand").select("l_orderkey", F.concat_ws(",", "items").alias("items"))


@query("A17 A12", f"WITH {BI} SELECT size, count(*) AS baskets FROM (SELECT o, count(*) AS size FROM bi GROUP BY o) GROUP BY size")
def basket_sizes(t):
    return B.basket_sizes(brand_lines(t), "l_orderkey", "p_brand")


@query("A17", f"""
    WITH {BI} SELECT count(*) AS baskets, CAST(sum(size) AS BIGINT) AS items, max(size) AS largest FROM (
        SELECT o, count(*) AS size FROM bi GROUP BY o)""")
def basket_totals(t):
    return B.basket_sizes(brand_lines(t), "l_orderkey", "p_brand").agg(
        F.sum("baskets").alias("baskets"), F.sum(F.col("size") * F.col("baskets")).alias("items"), F.max("size").alias("largest"))


@query("A18", f"""
    WITH {BI} SELECT i AS p_brand, count(*) AS n, round(count(*) / (SELECT count(DISTINCT o) FROM bi), 8) AS share FROM bi
    GROUP BY i ORDER BY n DESC, i LIMIT 20""")
def item_frequency(t):
    freq = B.item_frequency(brand_lines(t), "l_orderkey", "p_brand")
    return rounded(freq.orderBy(F.desc("n"), "p_brand").limit(20), 8, "share")


@query("M17 S06", RULES_SQL + """
    SELECT antecedent, consequent, round(support, 8) AS support, round(confidence, 8) AS confidence, round(lift, 8) AS lift FROM rules""")
def assoc_rules(t):
    return rounded(flatten_rules(_rules(t)), 8, *B.MEASURES)


@query("M17b", RULES_SQL + """
    SELECT antecedent, consequent, round(confidence, 8) AS confidence FROM rules r WHERE size = 0 OR (lift > 1 + 1e-12 AND NOT EXISTS (
        SELECT 1 FROM rules q WHERE q.consequent = r.consequent AND q.size > 0 AND q.size < r.size AND q.confidence >= r.confidence
        AND list_has_all(string_split(r.antecedent, ','), string_split(q.antecedent, ','))))""")
def nonredundant_rules(t):
    return rounded(flatten_rules(B.nonredundant(_rules(t))).select("antecedent", "consequent", "confidence"), 8, "confidence")


@query("M17c", f"""
    WITH RECURSIVE bi AS (SELECT DISTINCT c_mktsegment AS g, l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey
                JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT g, count(DISTINCT o) AS n FROM bi GROUP BY g),
    sub AS (SELECT g, o, [i] AS s, i AS last FROM bi
            UNION ALL SELECT sub.g, sub.o, list_append(s, bi.i), bi.i FROM sub JOIN bi ON bi.o = sub.o AND bi.i > sub.last WHERE len(s) < 10),
    sets AS (SELECT g, s, count(*) AS c FROM sub GROUP BY g, s),
    freq AS (SELECT g, s, c, n FROM sets JOIN n USING (g) WHERE c >= ceil({SUPPORT} * n)),
    ante AS (SELECT g, n, list_filter(s, lambda x: x <> k) AS a, k, c FROM (SELECT *, unnest(s) AS k FROM freq WHERE len(s) > 1))
    SELECT ante.g AS segment, array_to_string(ante.a, ',') AS antecedent, k AS consequent, round(ante.c / ante.n, 8) AS support,
           round(ante.c / f.c, 8) AS confidence, round(ante.c / f.c / (h.c / ante.n), 8) AS lift
    FROM ante JOIN freq f ON f.g = ante.g AND f.s = ante.a JOIN freq h ON h.g = ante.g AND h.s = [k]
    WHERE ante.c / f.c >= {CONFIDENCE}""")
def segment_rules(t):
    rules = B.grouped_rules(segment_lines(t), "segment", "l_orderkey", "p_brand", SUPPORT, CONFIDENCE)
    return rounded(flatten_rules(rules), 8, *B.MEASURES)


@query("M17d L03", RULES_SQL + """,
    top AS (SELECT * FROM rules ORDER BY round(confidence, 10) DESC, support DESC, antecedent, consequent LIMIT 20)
    SELECT unnest(string_split(antecedent, ',')) AS source, '{' || antecedent || '} => {' || consequent || '}' AS target FROM top WHERE size > 0
    UNION ALL SELECT '{' || antecedent || '} => {' || consequent || '}', consequent FROM top""")
def rule_graph_edges(t):
    return B.rule_graph(B.top_rules(_rules(t).withColumn("confidence", F.round("confidence", 10)), 20))


@query("M17e", RULES_SQL + " SELECT CAST(size + 1 AS INTEGER) AS length, count(*) AS rules FROM rules GROUP BY 1")
def rule_lengths(t):
    return B.rule_lengths(_rules(t))


@query("M17e A06", RULES_SQL + ", ".join([""]) + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS \"column\", '{name}' AS stat, round({expr.format(c=m)}, 6) AS value FROM rules"
    for m in ("support", "confidence", "lift")
    for name, expr in {"count": "count({c})::DOUBLE", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})",
                       "max": "max({c})", "p25": "quantile_cont({c}, 0.25)", "p50": "quantile_cont({c}, 0.5)",
                       "p75": "quantile_cont({c}, 0.75)"}.items()))
def rule_measures(t):
    return rounded(describe(_rules(t), B.MEASURES), 6, "value")


@query("M17e L01", RULES_SQL + """
    SELECT '{' || antecedent || '} => {' || consequent || '}' AS rule, round(support, 8) AS support,
           round(confidence, 8) AS confidence, round(lift, 8) AS lift FROM rules""")
def labelled_rules(t):
    return rounded(B.label_rules(_rules(t)), 8, *B.MEASURES).orderBy(F.desc("lift"), "rule")
