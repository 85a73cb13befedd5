"""Importance resampling towards a target distribution over hashed word runs, with bucket numbers from position-table CRCs.

Features are all runs of 1 to `orders` consecutive words joined by one space; a feature's bucket is the unsigned CRC-32 of its UTF-8 bytes
modulo `buckets`. CRC-32 is linear over XOR: a byte's share of the checksum depends on the byte and on its distance from the end only,
so the checksum of a span is the XOR of one table entry per byte (np.bitwise_xor.reduceat over all spans of a block at once) and of a constant
for the span's length. Spans longer than the table are cut into blocks of TABLE bytes; the register of the blocks so far moves over
the next block like four bytes that stand before it.

A bucket's gain is floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) where s of the S features of all documents, and t of
the T features of all target texts, fall into it. A document's weight is the sum of its features' gains; its score adds Gumbel noise from the
SHA-256 of `seed:doc_id`, so that taking the highest scores draws without replacement. Drawn are the best `share` per cent, rounded
down, of the documents with at least `least_words` words, by score, then doc_id.

Two passes over the texts, none of which shuffles more than one row per bucket and task; the ranking is a range sort of the scores.

Defined results: null and empty texts have no features, weight 0 and are not drawn; rows without doc_id count as documents, have no score and are
not drawn; rows that repeat a doc_id are documents of their own, and tie by n_features and weight; without target texts all gains follow from
t = T = 0; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.blocks import blocks
from tallyloom.llm.common import columns, texts_of
from tallyloom.runtime import global_row_number, stage

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 10
SEED = 2024
# Distances from the end that the table knows, and the size of the blocks of longer spans; at least 4, the bytes of a register.
TABLE = 64
_ALL = np.uint32(0xFFFFFFFF)

_GAP = np.ones(256, bool)
_GAP[48:58] = False
_GAP[97:123] = False
_GAP[128:] = False


def position_table(reach: int = TABLE) -> tuple[np.ndarray, np.ndarray]:
    """(table, constants): what a byte at a distance from the end adds to a CRC-32, and the CRC-32 of 0 to `reach` zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1)).astype(np.uint32)
    over = lambda x: (x >> np.uint32(8)) ^ step[x & np.uint32(255)]
    table, zeros = [step], [np.array(_ALL)]
    for _ in range(reach):
        table.append(over(table[-1]))
        zeros.append(over(zeros[-1]))
    return np.stack(table[:reach]), np.array([int(z) for z in zeros], np.uint32) ^ _ALL


_TABLE, _ZEROS = position_table()
_FLAT = _TABLE.reshape(-1)


def _shares(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XOR of the table entries of the bytes of every span; sizes are 1 to TABLE."""
    first = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(first, size)
    place = np.repeat(size - 1, size) - inside
    return np.bitwise_xor.reduceat(_FLAT[place * 256 + raw[np.repeat(start, size) + inside]], first)


def crc32(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of every span raw[start : start + size], of any size."""
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero((size > 0) & (size <= TABLE))
    if len(short):
        out[short] = _shares(raw, start[short], size[short]) ^ _ZEROS[size[short]]
    long = np.flatnonzero(size > TABLE)
    if not len(long):
        return out
    # The first block takes what is over, so that all further ones are full.
    turns = -(-size[long] // TABLE)
    lead = size[long] - (turns - 1) * TABLE
    state = _shares(raw, start[long], lead) ^ _ZEROS[lead] ^ _ALL
    full = turns - 1
    owner = np.repeat(np.arange(len(long)), full)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    share = _shares(raw, (start[long] + lead)[owner] + turn * TABLE, np.full(len(owner), TABLE))
    begin = np.cumsum(full) - full
    live = np.arange(len(long))
    for t in range(int(full.max())):
        live = live[full[live] > t]
        moved = share[begin[live] + t]
        for j in range(4):
            moved ^= _TABLE[TABLE - 1 - j][(state[live] >> np.uint32(8 * j)) & np.uint32(255)]
        state[live] = moved
    out[long] = state ^ _ALL
    return out


def features(held: list[bytes], orders: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature of a block of lower-cased texts, documents ascending within each order, and words per document."""
    raw = np.frombuffer(b" ".join(held) + b" ", np.uint8)
    gap = _GAP[raw]
    before = np.concatenate(([True], gap[:-1]))
    start, stop = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
    doc = np.searchsorted(np.cumsum([len(x) + 1 for x in held]), start, "right")
    words = np.bincount(doc, minlength=len(held))
    if orders == 1:
        return doc, crc32(raw, start, stop - start) % np.uint32(buckets), words
    # Words apart by exactly one space each, whatever stood between them.
    size = stop - start
    at = np.cumsum(size + 1) - size - 1
    tidy = np.full(int((size + 1).sum()), 32, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    tidy[np.repeat(at, size) + inside] = raw[np.repeat(start, size) + inside]
    docs, found = [], []
    for n in range(1, orders + 1):
        first = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:]) if len(doc) >= n else np.zeros(0, np.int64)
        last = first + n - 1
        docs.append(doc[first])
        found.append(crc32(tidy, at[first], at[last] + size[last] - at[first]) % np.uint32(buckets))
    return np.concatenate(docs), np.concatenate(found), words


def counts(texts: DataFrame, orders: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: one array of `buckets` numbers, summed over tasks by Spark."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, held in blocks(batch["text"].tolist()):
                total += np.bincount(features(held, orders, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    out = np.zeros(buckets, np.int64)
    for r in columns(texts, "text").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket, in thousandths of a nat, rounded down."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in thousandths from the hash of seed and id, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, orders: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for batch in batches:
            for first, held in blocks(batch["text"].tolist()):
                doc, bucket, words = features(held, orders, len(gain))
                weight = np.zeros(len(held), np.int64)
                np.add.at(weight, doc, gain[bucket])
                some = slice(first, first + len(held))
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[some], "nameless": batch["nameless"].to_numpy()[some], "n_words": words,
                                    "n_features": np.bincount(doc, minlength=len(held)), "weight": weight})

    found = texts_of(docs).mapInPandas(run, "doc_id long, nameless boolean, n_words long, n_features long, weight long")
    return found.select(F.expr("if(nameless, null, doc_id)").alias("doc_id"), "n_words", "n_features", "weight")


def resample(docs: DataFrame, target: DataFrame, orders: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: int = SHARE,
             seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, weight, score, rank (1, 2, ... of those drawn, else null)."""
    gain = gains(counts(docs, orders, buckets), counts(target, orders, buckets))
    scored = stage(weighed(docs, gain, orders).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))))
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    drawn = scored.filter(fit).count() * share // 100
    placed = global_row_number(scored.filter(fit), [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")], "place")
    names = [F.col(c) for c in ("doc_id", "n_words", "n_features", "weight", "score")]
    ranked = placed.select(*names, F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank"))
    return ranked.unionByName(scored.filter(~fit).select(*names, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents' rows, all columns as they came; a doc_id that several rows share is drawn with all of them."""
    ids = resample(docs, target, **options).filter("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(ids, "doc_id", "left_semi").select(*docs.columns)
