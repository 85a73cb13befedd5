"""The pipeline against a plain version of its five stages."""

import hashlib
import os
import re
from collections import defaultdict

import duckdb
import numpy as np
import plain

import corpus_pipeline
from tallyloom.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"


def plain_rejects(text, model):
    (_, _, found), = toxicity.bags([text])
    return 1 - 1 / (1 + np.exp(-(model.thresholds[0] - sum(model.weights[b] for b in found)))) >= model.limit


def plain_mix(rows):
    """(doc_id, epoch, take_tokens) from (doc_id, text, lang, source)."""
    leaves, size = defaultdict(list), {}
    for d, t, lang, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        k = int(re.search("[0-9]+", source)[0])
        domain = "web" if k < 5 else "forum" if k < 10 else "reference" if k < 15 else "other"
        if n:
            leaves[domain, lang, source].append(d)
            size[d] = n
    tokens = {leaf: sum(size[d] for d in ids) for leaf, ids in leaves.items()}
    weight = lambda level, name: mixing.PRODUCTION_WEIGHTS.get(level, {}).get(name, 1)
    quota = {(): sum(tokens.values()) * 4 // 5}
    for depth, level in enumerate(("domain", "language", "origin"), 1):
        below = defaultdict(dict)
        for leaf, n in tokens.items():
            below[leaf[:depth - 1]][leaf[depth - 1]] = below[leaf[:depth - 1]].get(leaf[depth - 1], 0) + n * mixing.PRODUCTION_EPOCHS
        quota = {(*up, c): q for up, caps in below.items() for c, q in plain.budget(caps, {c: weight(level, c) for c in caps}, quota[up]).items()}
    out = set()
    for leaf, ids in leaves.items():
        full, part = divmod(quota[leaf], tokens[leaf])
        out |= {(d, e, size[d]) for d in ids for e in range(1, full + 1)}
        for d in sorted(ids, key=lambda d: (hashlib.md5(f"1|{full + 1}|{d}".encode()).hexdigest(), d)):
            if part > 0:
                out.add((d, full + 1, min(part, size[d])))
                part -= size[d]
    return out


def test_pipeline_against_plain(spark):
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text, lang, source FROM '{FOLDER}/documents.parquet'").fetchall()
    bench = con.execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    model = toxicity.fit(toxicity.sample(read("documents"), read("labels")))
    rows = [r for r in rows if not plain_rejects(r[1], model)]
    gone = plain.repeated_lines([r[:2] for r in rows])
    lines = [(r[0], [x for i, x in enumerate(r[1].split("\n")) if i not in gone.get(r[0], ())], r[2], r[3]) for r in rows]
    rows = [(d, "\n".join(x), lang, source) for d, x, lang, source in lines if x]
    named = plain.near_groups([r[:2] for r in rows], 5)
    rows = [r for r in rows if named[r[0]] == r[0]]
    hits = plain.contaminated([r[:2] for r in rows], bench)
    rows = [r for r in rows if not (hits[r[0]][1] and 20 * hits[r[0]][1] >= hits[r[0]][0])]
    want = plain_mix(rows)
    texts = {r[0]: r[1] for r in rows}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r["doc_id"], r["epoch"], r["take_tokens"]) for r in got} == want and len(got) == len(want)
    assert all(r["text"] == texts[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in got)


def test_stages_with_clashing_columns(spark, documents, edge_rows):
    """Further columns, whatever their names, neither break a stage nor change what it keeps."""
    for _, stage in corpus_pipeline.STAGES:
        clean, clash = (stage(spark, documents(edge_rows, clash=c), FOLDER) for c in (False, True))
        assert clash.columns == clean.columns
        assert sorted(map(str, clash.collect())) == sorted(map(str, clean.collect()))


def test_stages_keep_the_columns_and_survive_edges(spark, documents, edge_rows):
    docs = documents(edge_rows)
    before = docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() <= before
        assert i == 4 or len(docs.columns) == 5
        empty = stage(spark, documents([(1, "a")]).limit(0), FOLDER)
        assert empty.count() == 0
    assert os.path.exists(FOLDER)
