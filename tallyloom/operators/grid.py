"""Density clustering of rows with few dimensions on a grid of cells whose diagonal is the radius.

Rows of one cell are neighbours of each other: a cell with enough rows needs no distances to know that all of them are core rows, and the core rows of a
cell are one cluster. So distances are taken only for rows of thin cells against the rows of the bounded number of cells around them, and
clusters are grown over cells instead of rows. Thin cells hold few rows by definition, which keeps the pairs that are compared linear
in the rows, however dense a cell is; its rows are dealt over many tasks.
"""

from __future__ import annotations

from itertools import product
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.graph import connected_components
from tallyloom.runtime import hot_split_join, stage

# Above this number of dimensions a cell has too many neighbours (5^4 offsets at 4).
MAX_DIMENSIONS = 4
# Cell numbers beyond this are not exact in doubles.
FARTHEST = 2.0 ** 50
# Rows of a cell that meet the rows around it in one task.
PART = 4096


def fits(columns: int, radii: list[float], farthest: float | None) -> bool:
    return 1 <= columns <= MAX_DIMENSIONS and min(radii) > 0 and farthest is not None and farthest * sqrt(columns) / min(radii) < FARTHEST


def _wide(df: DataFrame) -> DataFrame:
    """A side with rows for every radius or setting: its file is far smaller than its rows in memory, so it must not be broadcast by its size on disk."""
    return df.hint("merge")


def _offsets(d: int) -> list[tuple[int, ...]]:
    """Cells, relative to one, that come within the radius of it; the cell itself is the first."""
    reach = int(sqrt(d)) + 1
    near = [o for o in product(range(-reach, reach + 1), repeat=d) if sum(max(0, abs(x) - 1) ** 2 for x in o) <= d + 1e-6]
    return sorted(near, key=lambda o: (any(o), o))


def _around(cell: str, offsets: list[tuple[int, ...]]) -> Column:
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in o]) for o in offsets])
    return F.transform(steps, lambda o: F.zip_with(F.col(cell), o, lambda a, b: a + b))


def _distance(a: list[Column], b: list[Column]) -> Column:
    total = None
    for x, y in zip(a, b):
        total = (x - y) * (x - y) if total is None else total + (x - y) * (x - y)
    return F.sqrt(total)


def _to_box(x: list[Column], low: list[Column], high: list[Column]) -> Column:
    return _distance([F.greatest(lo - v, v - hi, F.lit(0.0)) for v, lo, hi in zip(x, low, high)], [F.lit(0.0)] * len(x))


def density_labels(vectors: DataFrame, d: int, settings: list[tuple[float, int]]) -> DataFrame:
    """(setting, node, component) of the core and border rows among the distinct vectors (rep, vec, n), for every (eps, min_samples)."""
    spark = vectors.sparkSession
    radii = sorted({e for e, _ in settings})
    xs = [f"x{j}" for j in range(d)]
    most = F.array(*[F.lit(max(m for e, m in settings if e == r)) for r in radii])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("e"), F.lit(float(r)).alias("eps")) for i, r in enumerate(radii)]))
    rows = vectors.select(F.col("rep").alias("key"), "n", *[F.col("vec")[j].alias(x) for j, x in enumerate(xs)], each.alias("r")).select("r.*", "key", "n", *xs)
    # A hair less than eps / sqrt(d), so that rounding cannot part the rows of a cell.
    side = F.col("eps") / sqrt(d) * (1 - 1e-9)
    rows = stage(rows.withColumn("cell", F.array(*[F.floor(F.col(x) / side).cast("double") for x in xs])))
    cells = stage(rows.groupBy("e", "cell").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows")))
    rows = hot_split_join(rows, cells, ["e", "cell"], "rows").withColumn("parts", F.ceil(F.col("rows") / PART).cast("int"))
    rows = stage(rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("rows"))
    offsets = _offsets(d)

    # Neighbours of the rows in thin cells; in the others every row has enough of them in the cell.
    thin = F.col("total") < F.element_at(most, F.col("e") + 1)
    parts = F.ceil(F.col("rows") / PART).cast("int").alias("parts")
    links = cells.filter(thin).select("e", "cell", F.explode(_around("cell", offsets)).alias("next"))
    links = stage(links.join(_wide(cells.select("e", F.col("cell").alias("next"), parts)), ["e", "next"]))
    asked = rows.filter(thin).drop("parts", "part").join(_wide(links), ["e", "cell"]).select("e", "eps", "key", *xs, "next", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    held = rows.select("e", F.col("cell").alias("next"), "part", F.col("n").alias("m"), *[F.col(x).alias(f"y{x}") for x in xs])
    apart = _distance([F.col(x) for x in xs], [F.col(f"y{x}") for x in xs])
    near = asked.join(_wide(held), ["e", "next", "part"]).filter(apart <= F.col("eps")).groupBy("e", "key").agg(F.sum("m").alias("near"))
    counted = stage(rows.join(_wide(near), ["e", "key"], "left").withColumn("near", F.when(thin, F.coalesce("near", F.lit(0))).otherwise(F.col("total"))).drop("total", "n"))

    # From here on everything carries the number of its setting, in the place of its radius.
    names = F.broadcast(spark.createDataFrame([(i, radii.index(e), m) for i, (e, m) in enumerate(settings)], "setting int, e int, least int"))
    told = counted.join(names, "e").withColumn("core", F.col("near") >= F.col("least"))
    core, rest = told.filter("core"), told.filter("NOT core")
    point = F.struct(*xs)
    groups = core.groupBy("setting", "cell").agg(
        F.min("key").alias("node"), F.first("eps").alias("eps"), F.count(F.lit(1)).alias("rows"), F.array(*[F.min(x) for x in xs]).alias("low"),
        F.array(*[F.max(x) for x in xs]).alias("high"), F.array(*[f(point, x) for x in xs for f in (F.min_by, F.max_by)]).alias("ends"))
    groups = stage(groups)
    to = groups.select("setting", F.col("cell").alias("next"), F.col("node").alias("v"), F.col("low").alias("vlow"), F.col("high").alias("vhigh"), F.col("ends").alias("vends"),
                       parts)
    halves = offsets[1:][: (len(offsets) - 1) // 2]
    pairs = groups.select("setting", "eps", "cell", F.col("node").alias("u"), "low", "high", "ends", F.explode(_around("cell", halves)).alias("next"))
    pairs = pairs.join(_wide(to), ["setting", "next"])
    gap = _distance([F.greatest(F.col("vlow")[j] - F.col("high")[j], F.col("low")[j] - F.col("vhigh")[j], F.lit(0.0)) for j in range(d)], [F.lit(0.0)] * d)
    # Two cells are linked if two of their outermost rows are neighbours; where not, and only between clusters so far, all rows are asked.
    close = F.exists("ends", lambda a: F.exists("vends", lambda b: _distance([a[x] for x in xs], [b[x] for x in xs]) <= F.col("eps")))
    pairs = stage(pairs.filter(gap <= F.col("eps")).withColumn("close", close).drop("ends", "vends"))
    sure = pairs.filter("close").select(F.col("setting").alias("scope"), "u", "v")
    found = stage(connected_components(sure))
    for end in ("u", "v"):
        named = found.select(F.col("scope").alias("setting"), F.col("node").alias(end), F.col("component").alias(f"{end}c"))
        pairs = pairs.join(_wide(named), ["setting", end], "left")
    open_pairs = stage(pairs.filter(~F.col("close") & (F.coalesce("uc", "u") != F.coalesce("vc", "v"))))
    if open_pairs.limit(1).count():
        mine = core.select("setting", "cell", *xs).join(_wide(open_pairs.drop("low", "high")), ["setting", "cell"])
        mine = mine.filter(_to_box([F.col(x) for x in xs], [F.col("vlow")[j] for j in range(d)], [F.col("vhigh")[j] for j in range(d)]) <= F.col("eps"))
        mine = mine.select("setting", "eps", "u", "v", "next", *xs, F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
        theirs = core.select("setting", F.col("cell").alias("next"), "part", *[F.col(x).alias(f"y{x}") for x in xs])
        more = mine.join(_wide(theirs), ["setting", "next", "part"]).filter(apart <= F.col("eps")).select(F.col("setting").alias("scope"), "u", "v").distinct()
        found = stage(connected_components(sure.unionByName(stage(more))))
    found = found.select(F.col("scope").alias("setting"), "node", "component")
    groups = stage(groups.join(_wide(found), ["setting", "node"], "left").withColumn("component", F.coalesce("component", "node")))
    inner = hot_split_join(core.select("setting", "cell", F.col("key").alias("node")), groups.select("setting", "cell", "component", "rows"), ["setting", "cell"], "rows")

    # Border rows: the smallest cluster with a core row around them.
    to = groups.select("setting", F.col("cell").alias("next"), "component", "low", "high", parts)
    edge = rest.select("setting", "cell").distinct().select("setting", "cell", F.explode(_around("cell", offsets)).alias("next")).join(_wide(to), ["setting", "next"])
    edge = rest.select("setting", "eps", "key", "cell", *xs).join(_wide(edge), ["setting", "cell"])
    edge = edge.filter(_to_box([F.col(x) for x in xs], [F.col("low")[j] for j in range(d)], [F.col("high")[j] for j in range(d)]) <= F.col("eps"))
    edge = edge.select("setting", "eps", "key", "component", "next", *xs, F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    theirs = core.select("setting", F.col("cell").alias("next"), "part", *[F.col(x).alias(f"y{x}") for x in xs])
    border = edge.join(_wide(theirs), ["setting", "next", "part"]).filter(apart <= F.col("eps")).groupBy("setting", F.col("key").alias("node")).agg(F.min("component").alias("component"))
    return inner.select("setting", "node", "component").unionByName(border)
