"""Mixing sources to target weights by hierarchical budgeting.

A tree of levels (domain, language, source) carries integer weights. A token budget flows from the root to the leaves: at every node the children
share it in proportion to their weights, no child gets more than its subtree holds (tokens x max_epochs), and what a child cannot
use goes to its siblings first; only a subtree that is used up whole passes the rest to the siblings of its ancestors. Shares are
whole tokens, rounded down. Each leaf then gives its quota as a token prefix of seeded epochs: whole epochs first, then the documents of the
next epoch in the order of md5(seed|epoch|doc_id), the last one cut.

Tokens are words `[^\\x20\\x09-\\x0D]+`. Defined results: texts without tokens are never chosen; a null level value is the branch
`(none)`; weights not named are `other` (1 by default), a weight of 0 leaves the branch out; an empty table gives an empty mix; rows that
repeat a doc_id count each; further columns stay as they are, whatever their names, but for the two that the mix adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import unused
from tallyloom.llm.grouping import small
from tallyloom.runtime import running_totals, stage

SPACE = r"[\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")).cast("long")


def _weight(level: str, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for value, weight in weights.items():
        out = F.when(F.col(level) == value, weight).otherwise(out)
    return out.cast("long")


def quotas(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Column, max_epochs: int, other: int = 1) -> DataFrame:
    """(levels..., tokens, quota) from leaves (levels..., tokens) and a budget in terms of `total`, the tokens of all leaves."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("total")).select(budget.cast("long").alias("quota"))
    above, path = total.first()["quota"], []
    node = None
    for level in levels:
        parent, path = list(path), [*path, level]
        caps = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("long").alias("cap")).withColumn("w", _weight(level, weights.get(level, {}), other))
        caps = caps.filter("w > 0")
        caps = caps.join(node.select(*parent, F.col("quota").alias("b")), parent) if parent else caps.withColumn("b", F.lit(above).cast("long"))
        family = Window.partitionBy(*parent)
        order = family.orderBy(F.col("cap") / F.col("w"), level)
        caps = caps.withColumns({
            "left": F.col("b") - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "rest": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)), "at": F.row_number().over(order)})
        wide = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(18,0)")
        caps = caps.withColumn("whole", wide("cap", "rest") <= wide("left", "w"))
        # The children before the first one that is not used up give all they have; it and the later ones share what is left.
        cut = F.min(F.when(~F.col("whole"), F.struct("at", "left", "rest"))).over(family)
        node = caps.withColumn("cut", cut).withColumn("quota", F.expr(
            "CASE WHEN cut IS NULL OR at < cut.at THEN cap ELSE (cast(cut.left AS decimal(19,0)) * cast(w AS decimal(18,0))) div cut.rest END"))
        node = node.select(*path, "quota")
    return node.join(leaves, levels)


def select(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget: Column, max_epochs: int = 2, seed: int = 1,
           other: int = 1) -> DataFrame:
    """(doc_id, levels..., n_tokens, epoch, take_tokens): which documents enter the mix, in which epoch and with how many leading tokens.

    `levels` names the tree from the top, each level by an expression over the documents.
    """
    names = list(levels)
    rows = stage(docs.select("doc_id", *[F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in levels.items()],
                             n_tokens(F.col("text")).alias("n_tokens")).filter("n_tokens > 0"))
    leaves = stage(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")))
    plan = quotas(leaves, names, weights, budget, max_epochs, other).filter("quota > 0")
    # A row per leaf: broadcast while small, so that a leaf with very many rows is not one task's; else the adaptive plan splits large leaves.
    plan = stage(plan.select(*names, F.expr("quota div tokens").alias("full"), F.expr("quota % tokens").alias("part"),
                             F.concat_ws("\x1f", *names).alias("leaf")))
    placed = rows.join(small(plan, 64 * len(names) + 96), names)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("full") + 1).cast("string"), F.col("doc_id").cast("string")))
    ordered = running_totals(placed.filter("part > 0").withColumn("key", key), ["leaf", "key", "doc_id", "n_tokens"], {"upto": "n_tokens"})
    ordered = stage(ordered)
    begins = ordered.groupBy("leaf").agg(F.min(F.col("upto") - F.col("n_tokens")).alias("begin"))
    rest = F.col("part") - (F.col("upto") - F.col("n_tokens") - F.col("begin"))
    last = ordered.join(small(stage(begins), 96), "leaf").filter(rest > 0).select(
        "doc_id", *names, "n_tokens", (F.col("full") + 1).cast("int").alias("epoch"), F.least("n_tokens", rest).alias("take_tokens"))
    whole = placed.filter("full > 0").select("doc_id", *names, "n_tokens", F.explode(F.expr("sequence(1, cast(full AS int))")).alias("epoch"),
                                             F.col("n_tokens").alias("take_tokens"))
    return whole.unionByName(last)


def mixed(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget: Column, max_epochs: int = 2, seed: int = 1) -> DataFrame:
    """The documents of the mix with their columns, `epoch` and `take_tokens` (a caller's columns of these two names are replaced); once per epoch."""
    taken = select(docs, levels, weights, budget, max_epochs, seed).groupBy("doc_id", "epoch").agg(F.max("take_tokens").alias("take_tokens"))
    key, epoch, take = (unused(docs, c) for c in ("_id", "_epoch", "_take"))
    taken = taken.select(F.col("doc_id").alias(key), F.col("epoch").alias(epoch), F.col("take_tokens").alias(take))
    out = docs.join(taken, docs["doc_id"].eqNullSafe(F.col(key))).drop(key, "epoch", "take_tokens")
    return out.withColumnsRenamed({epoch: "epoch", take: "take_tokens"})


# The tree that the registered query and the pipeline use.
def production_levels() -> dict[str, Column]:
    number = F.coalesce(F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "[0-9]+", 0).try_cast("int"), F.lit(99))
    domain = F.when(number < 5, "web").when(number < 10, "forum").when(number < 15, "reference").otherwise("other")
    return {"domain": domain, "language": F.col("lang"), "origin": F.col("source")}


PRODUCTION_WEIGHTS = {"domain": {"web": 4, "forum": 2, "reference": 3, "other": 1}, "language": {"en": 5, "de": 2, "fr": 2, "es": 1}}
PRODUCTION_EPOCHS = 2


def production_budget() -> Column:
    """Four fifths of all tokens."""
    return F.expr("total * 4 div 5")
