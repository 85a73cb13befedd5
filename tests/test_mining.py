"""Grouped item sets against every subset of every basket, and one large group among very many small ones."""

from collections import Counter
from itertools import combinations
from math import ceil

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import basket as B


def plain_sets(rows, support, max_len=10):
    baskets = {}
    for g, b, i in rows:
        if None not in (g, b, i):
            baskets.setdefault((g, b), set()).add(i)
    n = Counter(g for g, _ in baskets)
    counts = Counter((g, s) for (g, _), items in baskets.items() for k in range(1, max_len + 1) for s in combinations(sorted(items), k))
    return {(g, s): c for (g, s), c in counts.items() if c >= max(1, ceil(n[g] * support))}, n


def test_item_sets_and_rules_by_group(spark):
    rng = np.random.default_rng(21)
    rows = [(f"g{g}", int(b), f"i{i}") for g in range(4) for b in range(20 + 40 * g) for i in rng.choice(9, rng.integers(1, 6), replace=False)]
    rows += [("g0", 0, "i0"), ("g0", 0, "i0"), (None, 1, "i1"), ("g1", None, "i1"), ("g1", 1, None), ("solo", 1, "a"), ("solo", 1, "b")]
    df = spark.createDataFrame(rows, "grp string, b long, item string")
    want, n = plain_sets(rows, 0.08)
    got = {(r["g"], tuple(r["items"])): r["freq"] for r in B.grouped_item_sets(df, "grp", "b", "item", 0.08).collect()}
    assert got == want and max(len(s) for _, s in want) >= 3
    short = B.grouped_item_sets(df, "grp", "b", "item", 0.08, 2).collect()
    assert {(r["g"], tuple(r["items"])) for r in short} == {k for k in want if len(k[1]) <= 2}
    rules = {(r["grp"], tuple(r["antecedent"]), r["consequent"]): (round(r["support"], 9), round(r["confidence"], 9), round(r["lift"], 9))
             for r in B.grouped_rules(df, "grp", "b", "item", 0.08, 0.3).collect()}
    plain = {}
    for (g, s), c in want.items():
        for i in s if len(s) > 1 else ():
            left = tuple(x for x in s if x != i)
            conf = c / want[g, left]
            if conf >= 0.3:
                plain[g, left, i] = (round(c / n[g], 9), round(conf, 9), round(conf / (want[g, (i,)] / n[g]), 9))
    assert rules == plain and len(plain) > 20
    assert B.grouped_rules(df.limit(0), "grp", "b", "item", 0.1, 0.1).count() == 0


def test_a_thousand_small_groups_beside_a_large_one(spark):
    small = [(f"s{g}", b, f"i{(g + b * k) % 40}") for g in range(1000) for b in range(3) for k in range(1, 5)]
    large = spark.range(100_000).select(F.lit("large").alias("grp"), F.col("id").alias("b"), F.explode(F.array(
        F.concat(F.lit("x"), F.col("id") % 7), F.concat(F.lit("y"), F.col("id") % 11), F.concat(F.lit("z"), F.col("id") % 5000))).alias("item"))
    df = spark.createDataFrame(small, "grp string, b long, item string").unionByName(large)
    found = B.grouped_item_sets(df, "grp", "b", "item", 0.005)
    got = {}
    for r in found.collect():
        got.setdefault(r["g"], {})[tuple(r["items"])] = r["freq"]
    want, _ = plain_sets(small, 0.005)
    assert {(g, s): c for g, sets in got.items() if g != "large" for s, c in sets.items()} == want
    # 500 baskets are needed in the large group: no z item, and every pair of x and y.
    assert {len(s) for s in got["large"]} == {1, 2} and len(got["large"]) == 7 + 11 + 77 and not any(i[0] == "z" for s in got["large"] for i in s)
