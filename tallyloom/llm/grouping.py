"""Union-find grouping of links between rows: trees inside tasks, star contraction between them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import hot_split_join, persisted, stage

# Bytes of a table that may be broadcast, estimated as rows times the width of a row.
BROADCAST_BYTES = 16_000_000
# Links that one task makes into trees.
FOREST_ROWS = 200_000


def small(df: DataFrame, row_bytes: int = 16) -> DataFrame:
    """Broadcast, if a count shows that its rows of about `row_bytes` stay within BROADCAST_BYTES; otherwise joined by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _forest(links: DataFrame) -> DataFrame:
    """The links of every Arrow batch, replaced by stars around the smallest id that they connect."""
    def run(batches):
        for batch in batches:
            above: dict[int, int] = {}

            def top(x):
                while (y := above.setdefault(x, x)) != x:
                    above[x] = x = above[y]
                return x

            for a, b in zip(batch["u"].tolist(), batch["v"].tolist()):
                a, b = top(a), top(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
            ends = [(x, y) for x in list(above) if (y := top(x)) != x]
            yield pd.DataFrame({"u": [x for x, _ in ends], "v": [y for _, y in ends]}, dtype="int64")

    return links.select("u", "v").mapInPandas(run, "u long, v long").distinct()


def _lowest(links: DataFrame) -> DataFrame:
    """(u, m, n): per node the smallest node among itself and the v it is linked to, and their number."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node that has a link (u, v): the smallest id that it is connected with.

    After trees inside tasks, rounds of two steps until nothing changes: first every node hands its larger neighbours to the smallest of
    its neighbourhood, then itself and its smaller ones. Joins split off nodes with very many links.
    """
    down = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    nodes = stage(links.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    now = stage(_forest(down))
    state = _state(now)
    while state[0]:
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        with persisted(_lowest(around)) as lowest:
            handed = hot_split_join(around, lowest, ["u"], "n").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            wide = stage(handed.distinct())
        with persisted(_lowest(wide)) as lowest:
            handed = hot_split_join(wide, lowest, ["u"], "n").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            # Each of the two steps at most doubles the links.
            now = stage(_forest(handed.unionByName(lowest.select("u", F.col("m").alias("v"))).coalesce(1 + 4 * state[0] // FOREST_ROWS)))
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
