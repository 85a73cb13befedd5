"""Ranked lexical search by dual trees: every item is answered with its `k` highest-scoring documents, exactly.

Terms are the runs of ASCII letters and digits and of all characters from U+0080 on, A-Z lower-cased. N documents hold a term, L terms in all, n in
a document, df documents hold a given term, tf times in one. A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document's score for an
item sums w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the item's distinct terms, where m = 100 - B + ((B * n * N) div L), in whole
numbers. So a document is a vector of whole numbers over the items' terms, an item a set of coordinates, and the score their product.

1. One pass over the texts keeps, per document, its length and the counts of those of its terms that some item has.
2. Items form a tree (on the driver, a bounded block of items at a time): a node holds the coordinates of all its items. Inside every task the
   documents of a block form a tree, split by their products with the upper item nodes; a node holds the maximum of every coordinate. The product of two
   nodes bounds the score of every pair below them. Both trees are walked down together, a whole level at a time; a pair of nodes goes when its
   bound is below the weakest kth score of the node's items. Pairs of items and small groups of documents that remain are scored in full, the highest
   bounds first, which raises the kth scores for those to come.
3. The kth scores over a hashed share of the documents are lower bounds of the final ones, and start step 2 for all documents. Tasks return their best k of
   every item; the best k of those are the answer. Nothing depends on how rows are dealt out.

Scores stay below 2^53, or products are made with 64-bit integers, so that every sum is exact. Terms are known by 64-bit hashes.

Defined results: null and term-free texts have no terms and are never found; rows without doc_id count in N, L and df but are not returned; rows that
repeat a doc_id are documents of their own; rows of items that share an item_id are one item, items without id or terms give no rows; equal scores
go by ascending doc_id; scores of 0 are left out; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyloom.llm.blocks import blocks, words
from tallyloom.llm.common import columns, texts_of
from tallyloom.runtime import stage

K = 50
# Weight of a document's length, in per cent.
LENGTH_SHARE = 50
# Bytes of item texts whose terms are broadcast at once; more items are searched block by block.
ITEM_BYTES = 1_000_000
# Numbers in the matrix of a group of items and their terms; a task walks one group after the other.
GROUP_CELLS = 1_000_000
# Numbers in the matrix of a block of documents (8 bytes each), and its least number of rows.
CELLS = 4_000_000
LEAST_ROWS = 64
# Documents below the lowest nodes, and children of a node.
LEAF = 8
FAN = 4
# One document in so many is searched first, for lower bounds.
SEED_SHARE = 32
# Groups that the rows of an item are dealt to before the last merge.
MERGE = 32
COUNTS = "doc_id long, nameless boolean, n long, terms binary, tf binary"

_GAP = np.ones(256, bool)
_GAP[48:58] = False
_GAP[97:123] = False
_GAP[128:] = False


def item_terms(texts: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """(sorted term hashes, places in them of every text's distinct terms)."""
    sets = []
    for _, held in blocks(texts):
        doc, code = words(held, _GAP)
        ends = np.searchsorted(doc, np.arange(len(held) + 1))
        sets += [np.unique(code[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    return vocabulary, [np.searchsorted(vocabulary, s) for s in sets]


def counted(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per row: length in terms, and the number and count of each vocabulary term that it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    wide = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")

    def run(batches):
        vocabulary = shared.value
        size = max(len(vocabulary), 1)
        for batch in batches:
            for first, held in blocks(batch["text"].tolist()):
                doc, code = words(held, _GAP)
                n = np.bincount(doc, minlength=len(held))
                if len(vocabulary):
                    at = np.minimum(np.searchsorted(vocabulary, code), len(vocabulary) - 1)
                    hit = vocabulary[at] == code
                    cell, tf = np.unique(doc[hit] * size + at[hit], return_counts=True)
                else:
                    cell = tf = np.zeros(0, np.int64)
                cuts = np.searchsorted(cell, np.arange(len(held) + 1) * size)
                term, tf = (cell % size).astype(wide), tf.astype("<u4")
                some = slice(first, first + len(held))
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[some], "nameless": batch["nameless"].to_numpy()[some], "n": n,
                                    "terms": [term[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], "tf": [tf[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]})

    return texts_of(docs).mapInPandas(run, COUNTS)


def frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each vocabulary term."""
    wide = np.dtype("<u2" if terms <= 1 << 16 else "<u4")

    def run(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["terms"]), wide), minlength=terms)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"term": some, "df": total[some]})

    out = np.zeros(terms, np.int64)
    for r in found.select("terms").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def item_tree(sets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(order, levels) of items given as rows of 0 and 1: levels from the root down, each with the coordinates and the first item of its nodes.

    Items that share heavy terms stand together: a run is cut at the median between its heaviest item and the one least like it.
    """
    order, runs = np.arange(len(sets)), [(0, len(sets))]
    heavy = sets * np.sqrt(np.maximum(weight, 0).astype(float))
    heavy /= np.maximum(np.sqrt((heavy ** 2).sum(axis=1, keepdims=True)), 1e-9)
    while runs:
        a, b = runs.pop()
        if b - a <= 2:
            continue
        some = heavy[order[a:b]]
        one = some @ some[0]
        other = some @ some[int(one.argmin())]
        order[a:b] = order[a:b][np.argsort(other - one, kind="stable")]
        middle = (a + b) // 2
        runs += [(a, middle), (middle, b)]
    levels, first = [(sets[order], np.arange(len(sets)))], np.arange(len(sets))
    while len(first) > 1:
        at = np.arange(0, len(first), FAN)
        levels.append((np.maximum.reduceat(levels[-1][0], at, axis=0), at))
        first = first[at]
    return order, levels[::-1]


def document_tree(x: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(order, levels) of documents given as rows of coordinates: the maxima of the nodes of each level, from the root down, with their first child."""
    n = len(x)
    side = x @ upper.T
    order, runs = np.arange(n), [(0, n)]
    while runs:
        a, b = runs.pop()
        if b - a <= LEAF:
            continue
        some = side[order[a:b]]
        widest = int((some.max(axis=0) - some.min(axis=0)).argmax())
        order[a:b] = order[a:b][np.argsort(some[:, widest], kind="stable")]
        middle = a + max(LEAF, (b - a) // 2 // LEAF * LEAF)
        runs += [(a, middle), (middle, b)]
    at = np.arange(0, n, LEAF)
    levels = [(np.maximum.reduceat(x[order], at, axis=0), at)]
    while len(levels[-1][0]) > 1:
        at = np.arange(0, len(levels[-1][0]), FAN)
        levels.append((np.maximum.reduceat(levels[-1][0], at, axis=0), at))
    return order, levels[::-1]


def groups(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of items whose matrix of items and terms has at most about GROUP_CELLS numbers."""
    out, some, held = [], [], set()
    for i, s in enumerate(sets):
        held.update(s.tolist())
        some.append(i)
        if len(held) * len(some) >= GROUP_CELLS:
            out.append(np.array(some))
            some, held = [], set()
    return out + [np.array(some)] * bool(some)


class Search:
    """The best k documents of every item of a group so far, and the weakest of their scores."""

    def __init__(self, sets: list[np.ndarray], items: np.ndarray, weight: np.ndarray, weakest: np.ndarray, k: int):
        self.terms = np.unique(np.concatenate([sets[i] for i in items]))
        weight = weight[self.terms]
        table = np.zeros((len(items), len(self.terms)), np.int8)
        for i, item in enumerate(items):
            table[i, np.searchsorted(self.terms, sets[item])] = 1
        # Sums of doubles are exact while they stay below 2^53.
        top = int(weight.max(initial=0)) * 1_000_000 * len(self.terms)
        self.kind = np.float64 if top < 1 << 53 else np.int64
        order, levels = item_tree(table, weight)
        self.k, self.items = k, items[order]
        self.levels = [(u.astype(self.kind), at) for u, at in levels]
        self.weakest = np.maximum(weakest[self.items], 1).astype(self.kind)
        # The k best scores of every item; none yet is 0.
        self.best = np.zeros((len(items), k), self.kind)
        self.kept = [np.zeros((3, 0), np.int64)]
        # Pairs of an item and a document that were scored in full.
        self.scored = 0

    def add(self, ids: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        """Documents, and the weighted coordinates (row, term, value) that they have."""
        place = np.searchsorted(self.terms, term)
        hit = self.terms[np.minimum(place, len(self.terms) - 1)] == term if len(self.terms) else np.zeros(len(term), bool)
        hit &= value > 0
        some, at = np.unique(row[hit], return_inverse=True)
        if not len(some):
            return
        x = np.zeros((len(some), len(self.terms)), self.kind)
        x[at, place[hit]] = value[hit]
        ids = ids[some]
        items = self.levels[-1][0]
        upper = next((u for u, _ in self.levels if len(u) >= 8), items)
        order, nodes = document_tree(x, upper)
        alive, i, d = np.ones((1, 1), bool), 0, 0
        while True:
            u, m = self.levels[i][0], nodes[d][0]
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                return
            bound = np.zeros(alive.shape, self.kind)
            bound[np.ix_(rows, cols)] = u[rows] @ m[cols].T
            alive &= bound >= self._floor(i)[:, None]
            if i == len(self.levels) - 1 and d == len(nodes) - 1:
                break
            # The side with more levels to go moves first.
            if len(nodes) - d >= len(self.levels) - i:
                alive, d = np.repeat(alive, self._children(nodes, d), axis=1), d + 1
            else:
                alive, i = np.repeat(alive, self._children(self.levels, i), axis=0), i + 1
        begin = nodes[-1][1]
        end = np.append(begin[1:], len(order))
        for leaf in np.argsort(-np.where(alive, bound, 0).max(axis=0), kind="stable"):
            rows = np.flatnonzero(alive[:, leaf] & (bound[:, leaf] >= self.weakest))
            if len(rows):
                some = order[begin[leaf]:end[leaf]]
                self.scored += len(rows) * len(some)
                self._take(rows, ids[some], items[rows] @ x[some].T)
        self._settle()

    @staticmethod
    def _children(levels: list, i: int) -> np.ndarray:
        return np.diff(np.append(levels[i][1], len(levels[i + 1][0])))

    def _floor(self, i: int) -> np.ndarray:
        """The weakest kth score below every node of a level."""
        floor = self.weakest
        for j in range(len(self.levels) - 2, i - 1, -1):
            floor = np.minimum.reduceat(floor, self.levels[j][1])
        return floor

    def _take(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        best = np.concatenate((self.best[rows], score), axis=1)
        best = -np.partition(-best, self.k - 1, axis=1)[:, :self.k]
        self.best[rows] = best
        self.weakest[rows] = np.maximum(self.weakest[rows], best.min(axis=1))
        r, c = np.nonzero(score >= self.weakest[rows][:, None])
        self.kept.append(np.stack((rows[r], ids[c], score[r, c].astype(np.int64))))

    def _settle(self) -> None:
        """Keep no more than the best k of every item, ties by the smaller document."""
        item, doc, score = np.concatenate(self.kept, axis=1)
        order = np.lexsort((doc, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.kept = [np.stack((item, doc[order], score[order]))[:, place < self.k]]

    def found(self) -> pd.DataFrame:
        self._settle()
        item, doc, score = self.kept[0]
        return pd.DataFrame({"item": self.items[item].astype(np.int32), "doc_id": doc, "score": score})


def _best(found: DataFrame, sets: list[np.ndarray], weight: np.ndarray, weakest: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score, rank): the best k documents of every item among the rows (doc_id, m, terms, tf)."""
    shared = found.sparkSession.sparkContext.broadcast((sets, weight, weakest))
    wide = np.dtype("<u2" if len(weight) <= 1 << 16 else "<u4")

    def run(batches):
        sets, weight, weakest = shared.value
        searches = [Search(sets, some, weight, weakest, k) for some in groups(sets)]
        most = max(LEAST_ROWS, CELLS // max(max(len(s.terms) for s in searches), 1))
        for batch in batches:
            for at in range(0, len(batch), most):
                part = batch.iloc[at:at + most]
                ids, m = part["doc_id"].to_numpy(), part["m"].to_numpy()
                term = np.frombuffer(b"".join(part["terms"]), wide).astype(np.int64)
                tf = np.frombuffer(b"".join(part["tf"]), "<u4").astype(np.int64)
                row = np.repeat(np.arange(len(part)), [len(t) // wide.itemsize for t in part["terms"]])
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
                for search in searches:
                    search.add(ids, row, term, value)
        for search in searches:
            yield search.found()

    rows = found.mapInPandas(run, "item int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id")]
    near = Window.partitionBy("item", "group").orderBy(*order)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE))).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).select("item", "doc_id", "score", "rank")


def _block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item, doc_id, score, rank) for one block of item texts, by place in the list."""
    vocabulary, sets = item_terms(items)
    found = stage(counted(docs, vocabulary))
    total = found.agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("l"), F.sum((F.col("n") > 0).cast("long")).alias("n")).first()
    n_all, l_all = int(total["n"] or 0), int(total["l"] or 0)
    df = frequencies(found, len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * n_all + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    m = F.expr(f"{100 - LENGTH_SHARE} + (({LENGTH_SHARE} * n * {n_all}L) div {max(l_all, 1)}L)")
    rows = found.filter("NOT nameless AND octet_length(terms) > 0").select("doc_id", m.alias("m"), "terms", "tf")
    weakest = np.zeros(len(sets), np.int64)
    seeds = _best(rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SEED_SHARE)) == 0), sets, weight, weakest, k)
    for r in seeds.filter(F.col("rank") == k).collect():
        weakest[r["item"]] = r["score"]
    return _best(rows, sets, weight, weakest, k)


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    asked = columns(items, "item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // ITEM_BYTES))
    kind = StructType([StructField("item", IntegerType()), StructField("item_id", items.schema["item_id"].dataType)])
    out = None
    for part in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).groupBy("item_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text")).collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], kind)
        if rows:
            found = _block(docs, [r["text"] for r in rows], k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
            out = found if out is None else out.unionByName(found)
    if out is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out
