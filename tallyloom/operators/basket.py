"""Market-basket operators: item frequencies, association rules and what is derived from them."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.profile import baskets
from tallyloom.runtime import small, stage

MEASURES = ["support", "confidence", "lift"]


def item_frequency(df: DataFrame, basket: str, item: str) -> DataFrame:
    """(item, n, share): baskets holding the item, absolute and relative to all baskets."""
    pairs = df.select(basket, item).na.drop("any").distinct()
    total = pairs.agg(F.count_distinct(basket)).first()[0]
    return pairs.groupBy(item).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.try_divide(F.col("n"), F.lit(total)))


def basket_sizes(df: DataFrame, basket: str, item: str) -> DataFrame:
    """(size, baskets): how many baskets have how many different items; no basket is gathered for it."""
    sizes = df.select(basket, item).na.drop("any").distinct().groupBy(basket).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("baskets"))


def _fit(sets: DataFrame, min_support: float, min_confidence: float):
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(sets)


def association_rules(df: DataFrame, basket: str, item: str, min_support: float, min_confidence: float,
                      min_len: int = 1, max_len: int = 10) -> DataFrame:
    """Rules (antecedent, consequent, support, confidence, lift) with one item on the right.

    `min_len` 1 admits rules with an empty left side; `max_len` bounds the items of a rule.
    """
    sets = stage(baskets(df, basket, item))
    n = float(max(sets.count(), 1))
    # Mined once; rules and the supports of their sides are joins of the kept item sets.
    found = stage(_fit(sets, min_support, min_confidence).freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    single = found.filter(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), (F.col("freq") / F.lit(n)).alias("_share"))
    whole = found.filter(F.size("items") > 1).select("freq", "items", F.explode("items").alias("consequent"))
    whole = whole.select("consequent", "freq", F.array_remove("items", F.col("consequent")).alias("antecedent"))
    sides = found.select(F.col("items").alias("antecedent"), F.col("freq").alias("_left"))
    rules = whole.join(sides, "antecedent").withColumn("confidence", F.col("freq") / F.col("_left")).filter(F.col("confidence") >= min_confidence)
    rules = rules.join(single, "consequent").select(
        "antecedent", "consequent", (F.col("freq") / F.lit(n)).alias("support"), "confidence", (F.col("confidence") / F.col("_share")).alias("lift"))
    if min_len <= 1:
        empty = single.filter(F.col("_share") >= min_confidence).select(
            F.array().cast("array<string>").alias("antecedent"), "consequent", F.col("_share").alias("support"), F.col("_share").alias("confidence"),
            F.lit(1.0).alias("lift"))
        rules = rules.unionByName(empty)
    return rules.filter(F.size("antecedent") + 1 <= max_len)


def grouped_item_sets(df: DataFrame, group: str, basket: str, item: str, min_support: float, max_len: int = 10) -> DataFrame:
    """(group, items, freq, n): item sets that at least `min_support` of the group's n baskets hold, for every group.

    Level by level, with the threshold of the set's own group: two frequent sets that share all but their last item make a candidate, which is
    dropped if one of its subsets is not frequent; it occurs in those baskets in which both occur. Only occurrences of frequent sets go on
    to the next level, so what a small group needs does not lower the threshold of a large one.
    """
    pairs = df.select(F.col(group).cast("string").alias("g"), F.col(basket).alias("b"), F.col(item).cast("string").alias("i")).na.drop("any").distinct()
    pairs = stage(pairs)
    sizes = stage(pairs.groupBy("g").agg(F.count_distinct("b").alias("n")))
    sizes = sizes.withColumn("least", F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(min_support))))
    holds = lambda rows: rows.groupBy("g", "items").agg(F.count(F.lit(1)).alias("freq"))
    enough = lambda sets: stage(sets.join(small(sizes), "g").filter("freq >= least").drop("least"))
    seen = pairs.select("g", "b", F.array("i").alias("items"))
    found, size, every = enough(holds(seen)), 1, None
    while found.limit(1).count():
        every = found if every is None else every.unionByName(found)
        size += 1
        if size > max_len:
            break
        seen = stage(seen.join(small(found.select("g", "items")), ["g", "items"], "left_semi"))
        split = lambda rows: rows.withColumns({"head": F.slice("items", 1, size - 2), "last": F.element_at("items", -1)})
        left, right = split(seen), split(seen).select("g", "b", "head", F.col("last").alias("more"))
        grown = left.join(right, ["g", "b", "head"]).filter("last < more").select("g", "b", F.concat("items", F.array("more")).alias("items"))
        if size > 2:
            grown = grown.join(small(_candidates(split(found.select("g", "items")), size)), ["g", "items"], "left_semi")
        seen = stage(grown)
        found = enough(holds(seen))
    return sizes.select("g", F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("freq"), "n").limit(0) if every is None else every


def _candidates(sets: DataFrame, size: int) -> DataFrame:
    """(g, items): joins of two sets with the same head all of whose subsets are among the sets."""
    right = sets.select("g", "head", F.col("last").alias("more"))
    both = stage(sets.join(right, ["g", "head"]).filter("last < more").select("g", F.concat("items", F.array("more")).alias("items")))
    # Without the last or the last but one item it is one of the two sets themselves.
    without = F.transform(F.sequence(F.lit(0), F.lit(size - 3)), lambda at: F.filter("items", lambda _, i: i != at))
    missing = both.select("g", "items", F.explode(without).alias("part")).join(
        sets.select("g", F.col("items").alias("part")), ["g", "part"], "left_anti").select("g", "items").distinct()
    return both.join(missing, ["g", "items"], "left_anti")


def grouped_rules(df: DataFrame, group: str, basket: str, item: str, min_support: float, min_confidence: float,
                  max_len: int = 10) -> DataFrame:
    """Rules inside every group, with supports relative to the group's own baskets; a basket is one of the group that it is listed under."""
    found = stage(grouped_item_sets(df, group, basket, item, min_support, max_len))
    whole = found.filter(F.size("items") > 1).select("g", "n", "freq", "items", F.explode("items").alias("consequent"))
    whole = whole.select("g", "n", "freq", "consequent", F.array_remove("items", F.col("consequent")).alias("antecedent"))
    sides = found.select("g", F.col("items").alias("antecedent"), F.col("freq").alias("left"))
    single = found.filter(F.size("items") == 1).select("g", F.col("items")[0].alias("consequent"), F.col("freq").alias("right"))
    rules = whole.join(sides, ["g", "antecedent"]).withColumn("confidence", F.col("freq") / F.col("left")).filter(F.col("confidence") >= min_confidence)
    rules = rules.join(small(single), ["g", "consequent"])
    return rules.select(F.col("g").alias(group), "antecedent", "consequent", (F.col("freq") / F.col("n")).alias("support"), "confidence",
                        (F.col("confidence") / (F.col("right") / F.col("n"))).alias("lift"))


def nonredundant(rules: DataFrame) -> DataFrame:
    """Rules for which no proper subset of the left side predicts the same item at least as well.

    The empty left side is checked on the row itself (its confidence is confidence / lift); other subsets are
    listed from a bit mask and matched by an equi-join on (consequent, left side), so rules of a frequent
    consequent are never paired with one another.
    """
    keyed = stage(rules.withColumn("_key", F.concat_ws("\u0001", F.array_sort("antecedent"))))
    size = F.size("antecedent")
    masks = F.when(size >= 2, F.sequence(F.lit(1), (F.pow(F.lit(2), size) - 2).cast("int"))).otherwise(F.array().cast("array<int>"))
    subsets = keyed.select("consequent", "_key", F.col("confidence").alias("_conf"), "antecedent", F.explode(masks).alias("_m"))
    subset_key = F.concat_ws("\u0001", F.filter(F.array_sort("antecedent"), lambda x, i: F.getbit(F.col("_m"), i) == 1))
    subsets = subsets.select("consequent", F.col("_key").alias("_full"), "_conf", subset_key.alias("_key"))
    beaten = subsets.join(keyed.select("consequent", "_key", F.col("confidence").alias("_sub")), on=["consequent", "_key"]).filter(
        F.col("_sub") >= F.col("_conf")).select("consequent", F.col("_full").alias("_key")).distinct()
    survives = (size == 0) | (F.col("lift") > 1.0 + 1e-12)
    return keyed.filter(survives).join(beaten, on=["consequent", "_key"], how="left_anti").drop("_key").select(*rules.columns)


def label_rules(rules: DataFrame) -> DataFrame:
    """Rules as text, `{a,b} => {c}`, with their measures; order by lift where a listing is wanted."""
    lhs = F.concat(F.lit("{"), F.concat_ws(",", "antecedent"), F.lit("}"))
    return rules.select(F.concat(lhs, F.lit(" => {"), "consequent", F.lit("}")).alias("rule"), *MEASURES)


def top_rules(rules: DataFrame, n: int, by: str = "confidence") -> DataFrame:
    labelled = rules.withColumn("_lhs", F.concat_ws(",", "antecedent"))
    return labelled.orderBy(F.desc(by), F.desc("support"), "_lhs", "consequent").limit(n).drop("_lhs")


def rule_graph(rules: DataFrame) -> DataFrame:
    """Edge list item -> rule -> item of a rule set."""
    labelled = rules.withColumn("rule", F.concat(F.lit("{"), F.concat_ws(",", "antecedent"), F.lit("} => {"), "consequent", F.lit("}")))
    into = labelled.select(F.explode("antecedent").alias("source"), F.col("rule").alias("target"))
    out = labelled.select(F.col("rule").alias("source"), F.col("consequent").alias("target"))
    return into.unionByName(out)


def rule_lengths(rules: DataFrame) -> DataFrame:
    return rules.groupBy((F.size("antecedent") + 1).alias("length")).agg(F.count(F.lit(1)).alias("rules"))
