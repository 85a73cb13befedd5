"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

A document's set holds its distinct word shingles; two documents are linked when 100 * intersection >= similarity * union.

1. Documents with equal sets form a class, represented by its smallest id. Everything below is between representatives.
2. Signatures: each element walks its own random permutation of the M slots and offers rank + fraction to the slot it reaches; it stops
   once its rank exceeds the worst slot, so a large set needs a few steps per element. Bands of ROWS slots make the candidates.
   A pair of similarity 0.8 misses all 48 bands with probability 5e-9.
3. Each bucket is a star around its smallest id: one pair per representative is verified first. A few more rounds compare what is not yet
   in a bucket's most common component with other members of that component, again one pair per representative. Buckets that still hold
   more than one component then have every pair across components checked, so no link between different texts is lost, while groups of
   near copies, which the stars join, cost no pairs. That last check is done in blocks inside tasks and writes no
   pairs but links: signatures first (a pair may be 4.5 standard errors under the limit), then the full sets.
4. Components by local union-find inside tasks and star contraction between them.

Defined results: null, empty or blank texts have no shingles and link to nothing; rows without doc_id are returned unlinked with a
null component and are kept; rows that share a doc_id are one document; extra columns are ignored, or stay as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.blocks import blocks, mix, pairs_within, shingles
from tallyloom.llm.common import columns, unused
from tallyloom.llm.grouping import components, small
from tallyloom.runtime import stage

ROWS = 5
BANDS = 48
SLOTS = ROWS * BANDS
STAR_ROUNDS = 3
# Standard errors by which an estimate may be under the limit before a pair is ruled out (3e-6 of the pairs at the limit itself).
ERRORS = 4.5
# Members of a bucket that meet in one task; a larger bucket becomes several pairs of parts.
PART = 1_000
# Rows of the buckets that one call in a task handles together.
BIN = 4_000


def signatures(offsets: np.ndarray, items: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature of every set of a block, one row per set; rows of empty sets are infinite."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    out = np.full((n, m), np.inf)
    flat = out.reshape(-1)
    worst = np.full(n, m - 1)
    order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(items), 1))
    live = np.arange(len(items))
    for j in range(m):
        live = live[worst[owner[live]] >= j]
        if not len(live):
            break
        draw = mix(items[live] + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF))
        k = j + (mix(draw) % np.uint64(m - j)).astype(np.int64)
        slot = order[live, k]
        order[live, k] = order[live, j]
        rank = (draw >> np.uint64(11)) * (1.0 / (1 << 53)) + j
        np.minimum.at(flat, owner[live] * m + slot, rank)
        top = out.max(axis=1)
        worst = np.where(np.isinf(top), m - 1, top).astype(np.int64)
    return out


FEATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, slots binary"


def features(docs: DataFrame, width: int) -> DataFrame:
    """Per row: set size, a 128-bit name of the set, and its band keys."""
    def run(batches):
        for batch in batches:
            for first, held in blocks(batch["text"].tolist()):
                offsets, items = shingles(held, width)
                sig = np.ascontiguousarray(signatures(offsets, items)).view(np.uint64).reshape(len(held), BANDS, ROWS)
                size = np.diff(offsets)
                keys = np.zeros((len(held), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + mix(sig[:, :, r]))
                names = [np.concatenate(([np.uint64(0)], np.cumsum(mix(items ^ np.uint64(salt)), dtype=np.uint64))) for salt in (0, 0x5BD1E9955BD1E995)]
                names = [(x[offsets[1:]] - x[offsets[:-1]]).view(np.int64) for x in names]
                keys = keys.view(np.int64)
                low = (mix(sig.reshape(len(held), SLOTS)) & np.uint64(255)).astype(np.uint8)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[first:first + len(held)].to_numpy(), "n_shingles": size, "set_a": names[0], "set_b": names[1],
                    "bands": [keys[i] if size[i] else keys[i][:0] for i in range(len(held))], "slots": [r.tobytes() for r in low]})

    return columns(docs.filter(docs["doc_id"].isNotNull()), "doc_id", "text").mapInPandas(run, FEATURES)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, items): shingle sets of the listed documents, from their whole texts."""
    def run(batches):
        for batch in batches:
            for first, held in blocks(batch["text"].tolist()):
                offsets, items = shingles(held, width)
                items = items.view(np.int64)
                yield pd.DataFrame({"id": batch["doc_id"].iloc[first:first + len(held)].to_numpy(),
                                    "items": [items[a:b] for a, b in zip(offsets[:-1], offsets[1:])]})

    wanted = columns(docs, "doc_id", "text").join(small(ids), F.col("doc_id") == F.col("id"), "left_semi")
    return wanted.mapInPandas(run, "id long, items array<long>").dropDuplicates(["id"])


def verified(sets: DataFrame, pairs: DataFrame, similarity: int) -> DataFrame:
    """The pairs (u, v) of representatives whose full sets are similar enough. Few u for many v: only the sets of v are copied."""
    near = sets.select(F.col("id").alias("v"), F.col("items").alias("b")).join(small(pairs), "v")
    hubs = sets.join(small(pairs.select(F.col("u").alias("id")).distinct()), "id", "left_semi").select(F.col("id").alias("u"), F.col("items").alias("a"))
    both = near.join(hubs, "u").filter("100 * least(size(a), size(b)) >= %d * greatest(size(a), size(b))" % similarity)
    both = both.select("u", "v", F.size(F.array_intersect("a", "b")).alias("n"), F.size("a").alias("na"), F.size("b").alias("nb"))
    return both.filter(100 * F.col("n") >= similarity * (F.col("na") + F.col("nb") - F.col("n"))).select("u", "v")


def _placed(members: DataFrame, grouped: DataFrame) -> DataFrame:
    """(key, id, c): the members of every bucket with their component so far."""
    return members.join(grouped, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))


def _mixed(placed: DataFrame) -> DataFrame:
    """(key, id, c, main, n): members of the buckets that hold several components, with the bucket's most common one and its size."""
    per = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "c")).alias("m"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).filter("k > 1")
    return placed.join(per.select("key", F.col("m.c").alias("main"), "n"), "key")


def _across(split: DataFrame, homes: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """(u, c, home, vs): for u, those of part `home` of another component c that share a bucket with it and that sizes and signatures do not rule out.

    A pair that shares several buckets is written in the first of its bands only.
    """
    limit = similarity / 100
    least = int((limit - ERRORS * (limit * (1 - limit) / SLOTS) ** 0.5) * SLOTS)
    rows = split.join(sketches, "id").join(homes.select("id", "home"), "id").withColumn("parts", F.ceil(F.col("n") / PART).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    rows = rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "c", "home",
                       (F.col("c") == F.col("main")).alias("common"), "slots", "bands", "size")

    rows = stage(rows)
    bins = max(1, -(-rows.count() // BIN))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "p", "q"], kind="stable", ignore_index=True)
        key, p, q, ids, c, own, size, home, common = (part[x].to_numpy() for x in ("key", "p", "q", "id", "c", "own", "size", "home", "common"))
        slots = np.frombuffer(b"".join(part["slots"]), np.uint8).reshape(-1, SLOTS)
        bands = np.stack(part["bands"].to_numpy())
        group = np.cumsum(np.append(0, (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])))
        out = []
        for i, j in pairs_within(group, 50_000):
            some = (c[i] != c[j]) & ~(common[i] & common[j]) & ((p[i] == q[i]) | (own[i] != own[j]))
            some &= 100 * np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j])
            i, j = i[some], j[some]
            some = np.count_nonzero(slots[i] == slots[j], axis=1) >= least
            i, j = i[some], j[some]
            some = bands[i, (bands[i] == bands[j]).argmax(axis=1)] == key[i]
            i, j = i[some], j[some]
            # The one outside the common component asks, or the smaller of two such.
            swap = common[i] | (~common[j] & (ids[i] > ids[j]))
            out.append(np.stack((np.where(swap, j, i), np.where(swap, i, j)), axis=1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        u, to = pairs.T
        order = np.lexsort((home[to], c[to], ids[u]))
        u, to = u[order], to[order]
        cuts = np.flatnonzero((ids[u][1:] != ids[u][:-1]) | (c[to][1:] != c[to][:-1]) | (home[to][1:] != home[to][:-1])) + 1 if len(u) else []
        return pd.DataFrame([(ids[x[0]], c[y[0]], home[y[0]], ids[y]) for x, y in zip(np.split(u, cuts), np.split(to, cuts)) if len(y)],
                            columns=["u", "c", "home", "vs"])

    found = rows.groupBy(F.pmod(F.xxhash64("key", "p", "q"), F.lit(bins)).alias("bin")).applyInPandas(run, "u long, c long, home int, vs array<long>")
    return found.groupBy("u", "c", "home").agg(F.flatten(F.collect_list("vs")).alias("vs"))


def _verified_across(sets: DataFrame, work: DataFrame, homes: DataFrame, similarity: int) -> DataFrame:
    """The linked pairs (u, v) of the work list. Sets of a part of a component and of those that ask for it meet in one task; pairs are not written."""
    loads = work.groupBy("c", "home").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("turns"))
    ask = work.join(loads, ["c", "home"]).withColumn("turn", F.pmod(F.xxhash64("u"), F.col("turns")).cast("int"))
    ask = ask.join(sets.select(F.col("id").alias("u"), F.col("items").alias("mine")), "u").select("c", "home", "turn", "u", "vs", "mine")
    hold = homes.join(loads, ["c", "home"]).withColumn("turn", F.explode(F.expr("sequence(0, turns - 1)"))).join(sets.select("id", F.col("items").alias("theirs")), "id")
    hold = hold.select(*[F.col(x).alias(f"_{x}") for x in ("c", "home", "turn", "id", "theirs")])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        at = {x: i for i, x in enumerate(right["_id"].tolist())}
        items = [np.asarray(x) for x in right["_theirs"]]
        u, v = [], []
        for x, vs, mine in zip(left["u"], left["vs"], left["mine"]):
            mine = np.sort(mine)
            theirs = [items[at[y]] for y in vs]
            size = np.array([len(t) for t in theirs])
            flat = np.concatenate(theirs)
            hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            ok = 100 * both >= similarity * (size + len(mine) - both)
            u.append(np.full(ok.sum(), x))
            v.append(np.asarray(vs)[ok])
        return pd.DataFrame({"u": np.concatenate(u) if u else np.zeros(0, np.int64), "v": np.concatenate(v) if v else np.zeros(0, np.int64)})

    return ask.groupBy("c", "home", "turn").cogroup(hold.groupBy("_c", "_home", "_turn")).applyInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id (smallest id with the same set), component_id, kept."""
    found = stage(features(docs, width))
    ids = stage(found.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "bands", "slots", "n_shingles")).alias("r")).select(
        "set_a", "set_b", F.col("r.doc_id").alias("id"), F.col("r.bands").alias("bands"), F.col("r.slots").alias("slots"),
        F.col("r.n_shingles").alias("size")))
    rows = ids.select("id", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).filter("leader < last").select("key", "leader")
    members = stage(rows.join(small(stage(buckets)), "key").select("key", "leader", "id"))
    sets = stage(full_sets(docs, stage(members.select("id").distinct()), width))
    pairs = stage(members.filter("id <> leader").groupBy(F.col("id").alias("v")).agg(F.min("leader").alias("u")))
    members = members.select("key", "id")
    edges = stage(verified(sets, pairs, similarity))
    grouped = stage(components(edges))
    for turn in range(STAR_ROUNDS):
        split = stage(_mixed(stage(_placed(members, grouped))))
        salted = lambda c: F.xxhash64(F.lit(turn), c)
        pivots = split.filter("c = main").groupBy("key").agg(F.min(F.struct(salted("id"), "id")).alias("p")).select("key", F.col("p.id").alias("u"))
        pairs = stage(split.filter("c <> main").join(pivots, "key").groupBy(F.col("id").alias("v")).agg(
            F.min(F.struct(salted("u"), "u")).alias("p")).select("v", F.col("p.u").alias("u")))
        more = stage(verified(sets, pairs, similarity))
        gained = more.count()
        if not gained:
            break
        edges = edges.unionByName(more)
        grouped = stage(components(edges))
        if gained * 20 < pairs.count():
            break
    placed = stage(_placed(members, grouped))
    split = stage(_mixed(placed))
    homes = split.select("id", "c").distinct()
    sizes = homes.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    homes = stage(homes.join(sizes, "c").select("id", "c", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("home")))
    work = stage(_across(split, homes, ids.select("id", "slots", "bands", "size"), similarity))
    more = stage(_verified_across(sets, work, homes, similarity))
    if more.limit(1).count():
        grouped = stage(components(edges.unionByName(more)))
    classes = ids.join(grouped, "id", "left").select("set_a", "set_b", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component"))
    named = found.join(classes, ["set_a", "set_b"], "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component", "doc_id").alias("component_id"))
    nameless = docs.filter(docs["doc_id"].isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"),
                                                            F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("component_id"))
    return named.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """The input rows, all columns untouched, without documents whose group has a smaller id."""
    name = unused(docs, "_gone")
    gone = near_duplicates(docs, width, similarity).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(name), "left_anti")
