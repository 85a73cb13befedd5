"""Toxicity grades by cumulative-link ordinal regression on sparse features of a text.

P(grade <= k) = sigmoid(t_k - w.x) with one weight vector w for ordered thresholds t_0 < t_1 < t_2. x marks which words the whole text holds, which
stems (the first STEM bytes of longer words), and which stems make up at least certain shares (LEVELS) of its words; all of them hashed to 2^20 buckets.
Labels are 0/1, so grades are derived: 0 is not toxic; toxic documents are cut into thirds by how many markers they hold (features whose labelled
documents are toxic nine times in ten). A text's score is its expected grade. It is rejected when the probability of a grade above 0 passes a
limit that the fit takes from documents held out of it: the one with the best share of toxic documents caught, less CLEAN_WEIGHT times the share of
clean ones lost.

The model is fitted on at most about SAMPLE_ROWS labelled documents, chosen by the hash of their id. Spark counts their features and picks the FEATURES with the
largest chi-square; the driver gets those only. The likelihood is maximised to convergence by L-BFGS, with a ridge on the weights.

Defined results: null or wordless texts get the grade of an empty bag; contradictory labels of one document count as toxic; rows that repeat a doc_id
are fitted and judged each by its own text; labels without id or grade, or of unknown documents, are ignored; without labels of both kinds everything is
grade 0 with severity 0 and nothing is rejected; further columns stay as they are, whatever their names (`score` adds its three under names of the caller's choice).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.blocks import _BYTE, blocks, mix, powers
from tallyloom.llm.common import columns, unused
from tallyloom.runtime import stage

BUCKETS = 1 << 20
SAMPLE_ROWS = 20_000
FEATURES = 1_000
GRADES = 4
LEAST_DOCUMENTS = 3
STEM = 6
# Shares of a text's words from which on a stem counts once more.
LEVELS = (0.01, 0.02, 0.04)
RIDGE = 0.3
ROUNDS = 300
CLEAN_WEIGHT = 10

_MASK = np.uint64(BUCKETS - 1)
_GAP = np.ones(256, bool)
_GAP[48:58] = False
_GAP[97:123] = False
_GAP[128:] = False


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    # Probability of a grade above 0 from which on a text is rejected.
    limit: float


def bags(texts: list):
    """(first, offsets, buckets) per block: the distinct feature buckets of every text, in ascending order."""
    for first, held in blocks(texts):
        raw = np.frombuffer(b" ".join(held) + b" ", np.uint8)
        gap = _GAP[raw]
        before = np.concatenate(([True], gap[:-1]))
        start, stop = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
        doc = np.searchsorted(np.cumsum([len(x) + 1 for x in held]), start, "right")
        n_words = np.bincount(doc, minlength=len(held))
        up, down = powers(len(raw))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)))
        at = doc.astype(np.uint64) * np.uint64(BUCKETS)
        words = at + (mix((total[stop] - total[start]) * down[start]) & _MASK)
        long = stop - start > STEM
        begin = start[long]
        stems = at[long] + (mix((total[begin + STEM] - total[begin]) * down[begin] + np.uint64(1)) & _MASK)
        stems, count = np.unique(stems, return_counts=True)
        owner = stems // np.uint64(BUCKETS)
        share = count / np.maximum(n_words[owner.astype(np.int64)], 1)
        found = [words, stems]
        for level, least in enumerate(LEVELS, 1):
            some = (share >= least) & (count > 1)
            found.append(owner[some] * np.uint64(BUCKETS) + (mix((stems[some] & _MASK) + np.uint64(level << 32)) & _MASK))
        cells = np.unique(np.concatenate(found)).astype(np.int64)
        yield first, np.searchsorted(cells, np.arange(len(held) + 1) * BUCKETS), cells % BUCKETS


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, toxic, x) of the labelled documents that the model is fitted on, written once."""
    known = columns(labels, "doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("int(toxic > 0)")).alias("toxic"))
    known = stage(known)
    part = min(1.0, rows / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(part * 1_000_000)))

    def run(batches):
        for batch in batches:
            for first, cuts, found in bags(batch["text"].tolist()):
                some = slice(first, first + len(cuts) - 1)
                yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[some], "toxic": batch["toxic"].to_numpy()[some],
                                    "x": [found[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]})

    # Bounded by `rows`.
    taken = columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    return stage(taken.mapInPandas(run, "doc_id long, toxic int, x array<int>"))


def selected(rows: DataFrame, features: int = FEATURES) -> pd.DataFrame:
    """(bucket, seen, bad): the features with the largest chi-square, and how many of the documents, and of the toxic ones, hold them."""
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = whole["n"], whole["bad"] or 0
    if not 0 < bad < n:
        return pd.DataFrame({"bucket": [], "seen": [], "bad": []}).astype("int64")
    counts = rows.select("toxic", F.explode("x").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("seen"), F.sum("toxic").alias("bad"))
    expected = F.col("seen") * (bad / n)
    chi = F.pow(F.col("bad") - expected, 2) / (expected * (1 - bad / n) * F.greatest(1 - F.col("seen") / n, F.lit(1 / n)))
    best = counts.filter(F.col("seen") >= LEAST_DOCUMENTS).withColumn("chi", chi).orderBy(F.col("chi").desc(), "bucket").limit(features)
    return pd.DataFrame([(r["bucket"], r["seen"], r["bad"]) for r in best.collect()], columns=["bucket", "seen", "bad"]).astype("int64").sort_values("bucket", ignore_index=True)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    below = _sigmoid(thresholds[None, :] - score[:, None])
    edges = np.concatenate((np.zeros((len(score), 1)), below, np.ones((len(score), 1))), axis=1)
    return np.diff(edges, axis=1)


def thresholds_of(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logarithms of the gaps."""
    return free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))


def loss(theta: np.ndarray, owner: np.ndarray, feature: np.ndarray, y: np.ndarray, features: int, ridge: float) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of grades y with a ridge on the weights, and its gradient; theta holds the weights, then the free thresholds."""
    n, w, free = len(y), theta[:features], theta[features:]
    t, gaps = thresholds_of(free), np.exp(free[1:])
    score = np.bincount(owner, weights=w[feature], minlength=n)
    below = _sigmoid(t[None, :] - score[:, None])
    slope, row = below * (1 - below), np.arange(n)
    p = np.maximum(probabilities(score, t)[row, y], 1e-12)
    up = np.where(y < GRADES - 1, slope[row, np.minimum(y, GRADES - 2)], 0.0) / p
    low = np.where(y > 0, slope[row, np.maximum(y - 1, 0)], 0.0) / p
    g_t = np.array([low[y == k + 1].sum() - up[y == k].sum() for k in range(GRADES - 1)])
    g_free = np.append(g_t.sum(), [g_t[k:].sum() * gaps[k - 1] for k in range(1, GRADES - 1)])
    g_w = np.bincount(feature, weights=(up - low)[owner], minlength=features) + ridge * w
    # A faint pull keeps gaps finite where a grade is empty.
    return float(-np.log(p).sum() + ridge / 2 * (w @ w) + 1e-3 / 2 * (free @ free)), np.concatenate((g_w, g_free + 1e-3 * free))


def lowest(fun, x: np.ndarray, rounds: int = ROUNDS, memory: int = 10) -> np.ndarray:
    """Minimum of a smooth function (value, gradient) by L-BFGS with halved steps."""
    f, g = fun(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, kept = g.copy(), []
        for s, d in reversed(steps):
            kept.append((s @ q) / (s @ d))
            q -= kept[-1] * d
        q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(np.abs(g).sum(), 1.0)
        for (s, d), a in zip(steps, reversed(kept)):
            q += s * (a - (d @ q) / (s @ d))
        size = 1.0
        new, slope = fun(x - q), g @ q
        while new[0] > f - 1e-4 * size * slope and size > 1e-10:
            size /= 2
            new = fun(x - size * q)
        s, d = -size * q, new[1] - g
        x, before, (f, g) = x + s, f, new
        if s @ d > 1e-12:
            steps = [*steps, (s, d)][-memory:]
        if before - f < 1e-9 * max(abs(f), 1.0):
            break
    return x


def trained(owner: np.ndarray, feature: np.ndarray, y: np.ndarray, features: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the rows with grades y; (owner, feature) says which row has which feature."""
    rate = np.clip([(y <= k).mean() for k in range(GRADES - 1)], 1e-3, 1 - 1e-3)
    t = np.log(rate / (1 - rate))
    start = np.concatenate((np.zeros(features), [t[0]], np.log(np.maximum(np.diff(t), 1e-2))))
    theta = lowest(lambda x: loss(x, owner, feature, y, features, ridge), start)
    return theta[:features], thresholds_of(theta[features:])


def grades(markers: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for the others; toxic rows by thirds of their number of markers."""
    cuts = np.quantile(markers[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + (markers > cuts[0]).astype(int) + (markers > cuts[1]), 0)


def best_limit(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The limit on the chance of a grade above 0 with the most toxic rows at or above it, less CLEAN_WEIGHT times the clean ones, in shares."""
    order = np.argsort(-chance, kind="stable")
    c, t = chance[order], toxic[order]
    gain = np.cumsum(t) / max(t.sum(), 1) - CLEAN_WEIGHT * np.cumsum(1 - t) / max((1 - t).sum(), 1)
    last = np.append(c[1:] < c[:-1], True)
    at = int(np.where(last, gain, -np.inf).argmax())
    # Half way to the next row, so that the rows at the edge are not the edge.
    return float((c[at] + (c[at + 1] if at + 1 < len(c) else 0.0)) / 2)


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """The model of the sampled rows (doc_id, toxic, x); the driver holds the selected features of the sample."""
    best = selected(rows, features)
    spots, weights = best["bucket"].to_numpy(), np.zeros(BUCKETS)
    if not len(spots):
        return Model(weights, np.array([35.0, 36.0, 37.0]), 2.0)
    keep = F.array(*[F.lit(int(b)) for b in spots])
    got = rows.select("doc_id", "toxic", F.array_intersect("x", keep).alias("x")).collect()
    got.sort(key=lambda r: (r["doc_id"], len(r["x"]), r["x"]))
    toxic = np.array([r["toxic"] for r in got])
    owner = np.repeat(np.arange(len(got)), [len(r["x"]) for r in got])
    feature = np.searchsorted(spots, np.array([b for r in got for b in r["x"]], np.int64))
    marker = (best["bad"] >= 0.9 * best["seen"]).to_numpy()
    y = grades(np.bincount(owner, weights=marker[feature], minlength=len(got)), toxic)
    # Every half is judged by the model of the other one.
    chance, half = np.zeros(len(got)), np.arange(len(got)) % 2
    for side in (0, 1):
        mine = half[owner] != side
        if 0 < toxic[half != side].sum() < (half != side).sum():
            w, t = trained(owner[mine] // 2, feature[mine], y[half != side], len(spots), ridge)
            score = np.bincount(owner, weights=w[feature], minlength=len(got))
            chance[half == side] = 1 - _sigmoid(t[0] - score[half == side])
    w, t = trained(owner, feature, y, len(spots), ridge)
    weights[spots] = w
    return Model(weights, t, best_limit(chance, toxic) if chance.any() else 0.5)


NAMES = ("_severity", "_grade", "_rejected")


def score(docs: DataFrame, model: Model, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """All rows and columns, with the expected grade (0 to 3), the likeliest grade and whether the text is rejected, named by `names`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int, rejected boolean")
    def judged(texts: pd.Series) -> pd.DataFrame:
        weights, thresholds, limit = shared.value
        sums = [np.add.reduceat(np.append(weights[found], 0.0), cuts[:-1]) * (np.diff(cuts) > 0) for _, cuts, found in bags(texts.tolist())]
        p = probabilities(np.concatenate(sums) if sums else np.zeros(0), thresholds)
        expected = np.clip(p @ np.arange(GRADES), 0.0, GRADES - 1.0)
        return pd.DataFrame({"severity": np.where(p[:, 0] < 1 - 1e-12, expected, 0.0), "grade": p.argmax(axis=1).astype(np.int32), "rejected": 1 - p[:, 0] >= limit})

    # Only the text goes to Python and only the verdict comes back.
    verdict = judged(docs["text"])
    plain = [docs[f"`{c}`"] for c in docs.columns]
    return docs.select(*plain, verdict.alias(names[0] + names[1])).select(
        *[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{names[0] + names[1]}`.{c}").alias(n) for c, n in zip(("severity", "grade", "rejected"), names)])


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the model does not reject, with the columns they came with."""
    names = tuple(unused(docs, n) for n in NAMES)
    judged = score(docs, fit(sample(docs, labels)), names)
    return judged.filter(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])
