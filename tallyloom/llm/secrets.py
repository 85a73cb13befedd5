"""Secret scan: fixed forms plus two character Markov models compared by log-likelihood ratio; DataFrame operations only.

One model has the transitions of random strings (values caught by the fixed forms), the other those of ordinary identifiers
(the distinct tokens of documents in which no form was caught). Both are counted with Spark over a bounded hash sample of documents
and smoothed, so an empty sample gives two uniform models that catch nothing. Every whole text is then scanned in one narrow pass.

Offsets count code points, ends are exclusive. Defined results: null text is empty and has no spans; repeated rows give
repeated results; only doc_id and text are read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import columns, sha256_of

# (kind, pattern, group whose length counts, least length); failing matches still consume their text.
FORMS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of 16 or more are exactly the runs that pass, since a match is a maximal run.
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
WIDTH = len(SYMBOLS) + 1
# Documents that the two models are counted on, at most about this many; chosen by the hash of their id.
SAMPLE_DOCS = 20_000
SMOOTHING = 0.5
# Pseudo-counts per transition of the random model: without evidence, random strings are uniform.
RANDOM_PRIOR = 4.0
# Nats per transition by which the random model must be ahead.
MARGIN = 0.8

SPAN = "array<struct<s:int,e:int,kind:int,value:string>>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one pattern with positions: the pieces between matches tell how far each one is into the text."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["m"])
        one = F.array(F.struct(s.alias("s"), e.alias("e"), F.lit(kind).alias("kind"), x["g"].alias("value"))).cast(SPAN)
        kept = F.when(F.length(x["g"]) >= least, F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(e.alias("at"), kept.alias("out")))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step)["out"]).otherwise(F.array().cast(SPAN))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, b0, b1, b2): spans of the fixed forms, one array per kind."""
    text = columns(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return text.select("doc_id", "text", *[_spans(F.col("text"), k, pattern, group, least).alias(f"b{k}")
                                           for k, (_, pattern, group, least) in enumerate(FORMS)])


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratio (random against ordinary) of every transition, as a WIDTH x WIDTH table in row order."""
    total = max(docs.count(), 1)
    cut = min(1.0, sample_docs / total)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(cut * 1_000_000)))
    marked = base_spans(sample)
    caught = F.concat("b0", "b1", "b2")
    # Two kinds of labelled strings from one scan.
    labelled = marked.select(F.explode(F.when(F.size(caught) > 0, F.transform(
        caught, lambda x: F.struct(F.lit(1).alias("random"), x["value"].alias("v")))).otherwise(F.transform(
            F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))),
            lambda v: F.struct(F.lit(0).alias("random"), v.alias("v"))))).alias("x")).select("x.*").distinct()
    pairs = labelled.select("random", F.explode(F.expr("transform(sequence(1, length(v) - 1), i -> substring(v, i, 2))")).alias("p"))
    # At most WIDTH * WIDTH * 2 rows.
    counts = {(r["random"], r["p"]): r["n"] for r in pairs.groupBy("random", "p").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = [0.0] * (WIDTH * WIDTH)
    for a, x in enumerate(SYMBOLS, 1):
        rows = [[counts.get((side, x + y), 0) + prior for y in SYMBOLS] for side, prior in ((1, RANDOM_PRIOR), (0, SMOOTHING))]
        for b in range(1, WIDTH):
            table[a * WIDTH + b] = math.log(rows[0][b - 1] / sum(rows[0])) - math.log(rows[1][b - 1] / sum(rows[1]))
    return table


def find(docs: DataFrame, model: list[float], margin: float = MARGIN) -> DataFrame:
    """Per row: counts and digest of the fixed forms, and all spans as `kind:start:end`, those of the models named `markov`.

    The models judge runs of 20 or more symbols that no fixed form overlaps.
    """
    marked = base_spans(docs)
    tokens = _spans(F.col("text"), len(FORMS), TOKEN, 0, 20)
    marked = marked.withColumn("tokens", tokens).withColumn("base", F.concat(*[f"b{k}" for k in range(len(FORMS))]))
    llr = f"split('{','.join(f'{x:.6g}' for x in model)}', ',')"
    # One walk over the symbols of a token, with the one before in hand: linear in its length.
    codes = f"transform(filter(split(t.value, ''), x -> x <> ''), x -> position(x, '{SYMBOLS}'))"
    step = f"if(a.p = 0, 0D, element_at(cast({llr} AS array<double>), a.p * {WIDTH} + x + 1))"
    score = f"aggregate({codes}, struct(0 AS p, 0D AS s), (a, x) -> struct(x AS p, a.s + {step} AS s), a -> a.s) / (length(t.value) - 1)"
    added = F.expr(f"filter(tokens, t -> NOT exists(base, x -> x.s < t.e AND t.s < x.e) AND {score} >= {margin})")
    order = "(x, y) -> CASE WHEN x.s < y.s THEN -1 WHEN x.s > y.s THEN 1 WHEN x.kind < y.kind THEN -1 WHEN x.kind > y.kind THEN 1 ELSE 0 END"
    names = "array(" + ", ".join(f"'{k}'" for k, *_ in FORMS) + ", 'markov')"
    listed = lambda a: F.expr(f"transform(array_sort({a}, {order}), x -> concat_ws(':', {names}[x.kind], x.s, x.e))")
    marked = marked.withColumn("added", added)
    return marked.select(
        "doc_id", *[F.size(f"b{k}").cast("long").alias(f"n_{name}") for k, (name, *_) in enumerate(FORMS)],
        sha256_of(listed("base")).alias("base_sha256"), F.concat_ws(",", listed("concat(base, added)")).alias("spans"))
