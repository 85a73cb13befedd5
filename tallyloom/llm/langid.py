"""Language identification by mixture inference.

Training counts hashed byte n-grams (orders 1 to 3) of every training text per language. A document's n-grams are seen as drawn from a mixture of
languages: expectation-maximisation finds the proportions, then the language set is chosen by penalised likelihood among the
leading 1, 2, ... languages. The answer is the language with the largest proportion in that set; ties go to the smaller name.

The model has BUCKETS numbers per language, whatever the corpus; texts are scored whole, in one pass without a shuffle.
Defined results: a null text or one without a letter is `und` with score 0, as is every text if nothing could be learned.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.blocks import blocks, mix
from tallyloom.llm.common import columns

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
ROUNDS = 12
# Log-likelihood that a further language must add, in units of log(number of n-grams) / 2: n-grams overlap, so plain BIC (1) adds too many.
PENALTY = 6.0

_LATIN = re.compile("[A-Za-z]")


def has_letter(text) -> bool:
    return bool(text) and bool(_LATIN.search(text) or any(c.isalpha() for c in text))


def grams(raw: bytes) -> np.ndarray:
    """Bucket of every n-gram of one text, white space and digits folded."""
    b = _FOLD[np.frombuffer(b" " + raw + b" ", np.uint8)].astype(np.uint64)
    out, code = [], np.zeros(len(b), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        code = (code[:len(b) - n + 1] << np.uint64(8)) | b[n - 1:]
        if n in ORDERS:
            out.append(mix(code + np.uint64(n << 40)) & np.uint64(BUCKETS - 1))
    return np.concatenate(out).astype(np.int64)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:65] = 32
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities) from the rows of (text, lang) with both given."""
    def run(batches):
        total: dict = {}
        for batch in batches:
            langs = batch["lang"].tolist()
            for first, held in blocks(batch["text"].tolist()):
                for i, raw in enumerate(held):
                    lang = langs[first + i]
                    if lang not in total:
                        total[lang] = np.zeros(BUCKETS, np.int64)
                    total[lang] += np.bincount(grams(raw), minlength=BUCKETS)
        for lang, counts in total.items():
            some = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": some, "n": counts[some]})

    known = columns(docs, "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    # BUCKETS rows per language at most.
    rows = known.mapInPandas(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    counts = np.full((len(names), BUCKETS), SMOOTHING)
    at = {x: i for i, x in enumerate(names)}
    np.add.at(counts, (rows["lang"].map(at).to_numpy(int), rows["bucket"].to_numpy(int)), rows["n"].to_numpy(float))
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).T.copy() if names else np.zeros((BUCKETS, 0))


def em(p: np.ndarray, c: np.ndarray, start: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) per document; rows of p are n-grams, `start` the first row of each document."""
    doc = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(p))))
    total = np.add.reduceat(c, start)
    for _ in range(rounds):
        w = p * share[doc]
        w *= (c / w.sum(axis=1))[:, None]
        share = np.add.reduceat(w, start, axis=0) / total[:, None]
    return share, np.add.reduceat(c * np.log((p * share[doc]).sum(axis=1)), start)


def proportions(held: list[bytes], logp: np.ndarray) -> np.ndarray:
    """Proportions of the chosen language set, one row per text."""
    idx, counts, start, at = [], [], [], 0
    for raw in held:
        seen = np.bincount(grams(raw), minlength=BUCKETS)
        some = np.flatnonzero(seen)
        idx.append(some)
        counts.append(seen[some])
        start.append(at)
        at += len(some)
    idx, c, start = np.concatenate(idx), np.concatenate(counts).astype(float), np.array(start)
    k = logp.shape[1]
    rows = logp[idx]
    # Only ratios of the likelihoods count; the largest of each row is put at 1.
    top = rows.max(axis=1)
    p = np.exp(rows - top[:, None])
    share, full = em(p, c, start, np.full((len(held), k), 1.0 / k), ROUNDS)
    fee = PENALTY * 0.5 * np.log(np.maximum(np.add.reduceat(c, start), 2))
    order = np.argsort(-share, axis=1, kind="stable")
    alone = np.add.reduceat(c[:, None] * (rows - top[:, None]), start, axis=0)
    first = np.argmax(alone, axis=1)
    best = alone[np.arange(len(held)), first]
    out = np.zeros_like(share)
    out[np.arange(len(held)), first] = 1.0
    ends = np.append(start, len(p))
    for size in range(2, k + 1):
        # No set can beat the full mixture, so only documents it helps by more than the fee are tried.
        todo = np.flatnonzero(full - (size - 1) * fee > best)
        if not len(todo):
            break
        pick = np.concatenate([np.arange(ends[d], ends[d + 1]) for d in todo])
        allowed = np.zeros((len(todo), k))
        np.put_along_axis(allowed, order[todo, :size], 1.0, axis=1)
        init = (share[todo] + 1e-3) * allowed
        part, value = em(p[pick], c[pick], np.append(0, np.cumsum((ends[1:] - ends[:-1])[todo])[:-1]), init / init.sum(axis=1, keepdims=True), ROUNDS)
        value -= (size - 1) * fee[todo]
        better = value > best[todo]
        best[todo[better]] = value[better]
        out[todo[better]] = part[better]
    return out


def predict(docs: DataFrame, names: list[str], logp: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score, languages): the chosen set is listed as `lang:share`, largest first."""
    model = docs.sparkSession.sparkContext.broadcast(logp.astype(np.float32))

    def run(batches):
        table = model.value.astype(np.float64)
        for batch in batches:
            texts = batch["text"].tolist()
            for first, held in blocks(texts):
                ids = batch["doc_id"].iloc[first:first + len(held)]
                lettered = np.array([has_letter(t) for t in texts[first:first + len(held)]], bool) & bool(names)
                pred, score, listed = ["und"] * len(held), np.zeros(len(held)), [""] * len(held)
                if lettered.any():
                    some = np.flatnonzero(lettered)
                    share = proportions([held[i] for i in some], table)
                    for i, row in zip(some, share):
                        top = int(np.argmax(row))
                        pred[i], score[i] = names[top], min(1.0, row[top])
                        listed[i] = ",".join(f"{names[j]}:{row[j]:.3f}" for j in np.argsort(-row, kind="stable") if row[j] > 0)
                yield pd.DataFrame({"doc_id": ids.to_numpy(), "lang_pred": pred, "score": score, "languages": listed})

    return columns(docs, "doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double, languages string")


def held_out(doc_id) -> F.Column:
    """One document in five by the CRC of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
