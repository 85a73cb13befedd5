"""Ranked search, importance resampling and the Jaccard join against plain versions, with awkward inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import plain
import pytest
from test_edges import words

from tallyloom.llm import grouping, jaccard, ranked, resample


# Ranked search

def plain_rank(rows, items, k=50):
    """item -> [(doc_id, score)] by the formula, one pair after the other."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", plain.ascii_lower(t))
    docs = [(d, Counter(terms(t))) for d, t in rows]
    n_all, l_all = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in items:
        if item is not None and text is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, some in asked.items():
        scores = []
        for d, c in docs:
            m = 50 + 50 * sum(c.values()) * n_all // max(l_all, 1)
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in some if c[t])
            if score > 0 and d is not None:
                scores.append((-score, d))
        out[item] = [(d, -s) for s, d in sorted(scores)[:k]]
    return {i: x for i, x in out.items() if x}


def search_rows():
    rng = np.random.default_rng(12)
    pool = [words(9000 + i, 1) for i in range(150)]
    text = lambda n: " ".join(rng.choice(pool, n, p=(w := 1 / np.arange(1, 151)) / w.sum()))
    rows = [(i, text(int(rng.integers(1, 60)))) for i in range(400)]
    rows += [(1000 + i, "Tie TIE, of copies") for i in range(70)] + [(2000, None), (2001, ""), (2002, "-- .."), (2003, pool[3] * 3000), (2004, f"{pool[0]} " * 3000), (None, text(30)), (5, text(20)), (7, rows[7][1])]
    items = [(i, text(int(rng.integers(1, 25)))) for i in range(40)] + [(50, "tie of"), (51, None), (52, " , "), (None, "tie"), (53, "unheardof"), (54, pool[1]), (54, pool[2].upper())]
    return rows, items


@pytest.mark.parametrize("small", [False, True])
def test_ranked_against_plain(spark, documents, monkeypatch, small):
    if small:
        # Many blocks of documents, groups of items and blocks of items.
        monkeypatch.setattr(ranked, "CELLS", 100)
        monkeypatch.setattr(ranked, "GROUP_CELLS", 300)
        monkeypatch.setattr(ranked, "ITEM_BYTES", 1_500)
        monkeypatch.setattr(ranked, "SEED_SHARE", 2)
    rows, items = search_rows()
    bench = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, rank int, doc_id int")
    for k in (50, 3):
        got = {}
        for r in ranked.rank(documents(rows, clash=True), bench, k).orderBy("item_id", "rank").collect():
            got.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
            assert r["rank"] == len(got[r["item_id"]])
        assert got == plain_rank(rows, items, k)
    assert [d for d, _ in got[50]] == [1000, 1001, 1002]


def test_ranked_empty(spark, documents):
    rows, items = search_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for docs, asked in ((documents(rows).limit(0), bench), (documents(rows), bench.limit(0)), (documents([(1, None), (None, "tie of")]), bench)):
        found = ranked.rank(docs, asked)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    names = spark.createDataFrame([("a", "tie"), ("b", "of")], "item_id string, text string")
    assert {r["item_id"] for r in ranked.rank(documents(rows), names, 1).collect()} == {"a", "b"}


def test_bounds_prune_exactly():
    """Whole batches go unscored, and what is left is what a full product finds, in doubles and in whole numbers."""
    rng = np.random.default_rng(13)
    terms, n, items, k = 300, 3000, 64, 5
    # Documents and items of eight subjects.
    sets = [np.unique(np.concatenate((rng.choice(30, 8) + 30 * (i % 8), rng.choice(60, 2) + 240))) for i in range(items)]
    weight = np.where(np.arange(terms) < 240, 9_000, 500)
    rows, cols = [], []
    for d in range(n):
        some = np.unique(np.concatenate((rng.choice(30, rng.integers(1, 10)) + 30 * (d % 8), rng.choice(60, 5) + 240)))
        rows.append(np.full(len(some), d))
        cols.append(some)
    row, col = np.concatenate(rows), np.concatenate(cols)
    value = weight[col] * rng.integers(1, 1_000_000, len(col))
    full = np.zeros((n, terms), np.int64)
    full[row, col] = value
    for big in (0, 1 << 40):
        search = ranked.Search(sets, np.arange(items), weight + big, np.zeros(items, np.int64), k)
        assert search.kind is (np.int64 if big else np.float64)
        for a in range(0, n, 500):
            here = (row >= a) & (row < a + 500)
            search.add(np.arange(a, a + 500), row[here] - a, col[here], value[here])
        found = search.found()
        for i, s in enumerate(sets):
            scores = full[:, s].sum(axis=1)
            want = sorted(zip(-scores, range(n)))[:k]
            mine = found[found["item"] == i]
            assert list(zip(-mine["score"], mine["doc_id"])) == want
        assert search.scored < 0.35 * items * n


# Importance resampling

def test_position_table_crc():
    rng = np.random.default_rng(14)
    raw = rng.integers(0, 256, 20_000, dtype=np.uint8)
    start = rng.integers(0, 9_000, 400)
    size = np.concatenate((np.arange(200), rng.integers(0, 11_000, 200)))
    assert resample.crc32(raw, start, size).tolist() == [zlib.crc32(raw[a:a + n].tobytes()) for a, n in zip(start, size)]
    table, zeros = resample.position_table(9)
    assert zeros.tolist() == [zlib.crc32(bytes(n)) for n in range(10)] and table.shape == (9, 256)


def plain_draw(rows, target, orders, buckets, least, share, seed):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain.ascii_lower(t))
    runs = lambda w: [" ".join(w[i:i + n]) for n in range(1, orders + 1) for i in range(len(w) - n + 1)]
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(at(f) for x in texts for f in runs(split(x))) for texts in ([x for _, x in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for d, x in rows:
        w = split(x)
        weight = sum(gain[at(f)] for f in runs(w))
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(runs(w)), weight, score, None, len(w)])
    fit = [r for r in out if r[0] is not None and r[5] >= least]
    for i, r in enumerate(sorted(fit, key=lambda r: (-r[3], r[0], r[1], r[2]))[:len(fit) * share // 100], 1):
        r[4] = i
    return sorted(map(str, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_resample_against_plain(spark, documents, edge_rows, orders):
    rng = np.random.default_rng(15)
    pool = [words(7000 + i, 1) for i in range(60)] + ["ñandú", "x" * 70, "y" * 200]
    rows = [(i, " ".join(rng.choice(pool, rng.integers(1, 50)))) for i in range(150)] + [(300 + i, rows_of_copies) for i, rows_of_copies in enumerate(["Same, same"] * 20)] + edge_rows
    target = [(0, " ".join(pool[:12]) * 3), (1, None), (2, ""), (3, "ÑANDÚ ñandú")]
    bench = spark.createDataFrame([(*x, 3) for x in target], "item_id long, text string, weight int")
    got = resample.resample(documents(rows, clash=True), bench, orders, 500, 5, 30, 7).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(str, map(tuple, got))) == plain_draw(rows, [t for _, t in target], orders, 500, 5, 30, 7)
    assert sum(r["rank"] is not None for r in got) > 20


def test_resample_edges(spark, documents, edge_rows):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    df = documents(edge_rows, clash=True)
    assert resample.resample(df.limit(0), bench).count() == 0
    assert {r["weight"] for r in resample.resample(documents([(1, None), (2, " ")]), bench.limit(0)).collect()} == {0}
    drawn = resample.drawn_documents(df, bench, least_words=1, share=100)
    assert drawn.columns == df.columns and {r["doc_id"] for r in drawn.collect()} == {4, 5, 6, 7, 8, 9}


# Jaccard join

def test_components_against_plain(spark):
    rng = np.random.default_rng(16)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(150)] + [(5000, 5001 + i) for i in range(400)]
    df = spark.createDataFrame([links[i] for i in rng.permutation(len(links))], "u long, v long").repartition(9)
    got = {r["id"]: r["component"] for r in grouping.components(df).collect()}
    assert got == plain.groups({x for e in links for x in e}, links)
    assert grouping.components(df.limit(0)).count() == 0


def family_rows():
    rng = np.random.default_rng(17)
    base = [words(800 + i, n).split() for i, n in enumerate((8, 12, 20, 60, 150))]
    rows = []
    for i in range(160):
        text = list(base[i % 5])
        for _ in range(rng.integers(0, 4)):
            text[rng.integers(0, len(text))] = words(5000 + i, 1)
        rows.append((i, " ".join(text[:len(text) - int(rng.integers(0, 3))])))
    rows += [(400 + i, words(6000 + i, int(rng.integers(3, 14)))) for i in range(120)] + [(600 + i, "Copied Words here and there again") for i in range(40)]
    return rows + [(700, None), (701, ""), (702, "a b"), (703, "A  b"), (704, "a b c d e"), (705, "a b c d e")]


@pytest.mark.parametrize("cost, part", [(200_000, 1_000), (0, 4)])
def test_jaccard_against_plain(spark, documents, monkeypatch, cost, part):
    """With a cost of 0 every bucket across components is dropped or compared in blocks."""
    monkeypatch.setattr(jaccard, "COST", cost)
    monkeypatch.setattr(jaccard, "PART", part)
    seen = []
    watched = jaccard.neighbourhoods

    def watch(*args):
        seen.append(watched(*args))
        return seen[-1]

    monkeypatch.setattr(jaccard, "neighbourhoods", watch)
    rows = family_rows()
    for similarity in (85, 60) if cost else (85,):
        want = plain.near_groups(rows, 4, similarity)
        got = {r["doc_id"]: r for r in jaccard.jaccard_groups(documents(rows, clash=True), 4, similarity).collect()}
        assert {d: r["component_id"] for d, r in got.items()} == want and len(set(want.values())) < len(want)
        assert all(r["n_shingles"] == len(plain.shingles(dict(rows)[d], 4)) for d, r in got.items())
        assert {r["class_id"] for d, r in got.items() if 600 <= d < 640} == {600}
    if not cost:
        (dropped, index), = seen
        assert dropped.count() > 0 and index.filter("role = 1").count() > 0 and index.filter("role = 2").count() > 0


def test_buckets_with_the_same_members_meet_once(spark, documents, monkeypatch):
    met, across = [], jaccard.across
    monkeypatch.setattr(jaccard, "across", lambda rows, costs, *more: met.append((rows.collect(), costs.collect())) or across(rows, costs, *more))
    # Pairs that share three quarters of their words in a row: many segments in common, but no link; and one document that comes twice.
    rows = []
    for k in range(30):
        held = [f"w{k}x{i}" for i in range(60)]
        rows += [(2 * k, " ".join(held)), (2 * k + 1, " ".join(held[:50] + [f"v{k}x{i}" for i in range(10)]))]
    rows.append(rows[0])
    got = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert len(got) == 61 and all(r["component_id"] == r["doc_id"] for r in got)
    (members, costs), = met
    held = {}
    for r in members:
        held.setdefault(r["key"], []).append((r["id"], r["role"]))
    sets = [tuple(sorted(x)) for x in held.values()]
    assert len(sets) > 20 and len(set(sets)) == len(sets) == len(costs)


def test_one_deletion_finds_what_dropped_keys_hid(spark, monkeypatch):
    """Pairs that agree in dropped segments only: random sets that differ by as much as their scheme allows."""
    monkeypatch.setattr(jaccard, "COST", 0)
    rng = np.random.default_rng(18)
    edges = jaccard.band_edges(85)
    offsets, items, rows = [0], [], []
    for i in range(300):
        mine = rng.integers(1, 1 << 62, int(rng.integers(14, 40)), dtype=np.uint64)
        other = mine.copy()
        other[:1 + i % 2] = rng.integers(1, 1 << 62, 1 + i % 2, dtype=np.uint64)
        rows += [np.unique(mine), np.unique(other[:len(other) - i % 2])]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    keys = [[] for _ in rows]
    for some, band, count, first, key, *_ in jaccard.schemes(offsets, np.concatenate(rows), 85):
        assert (count == jaccard.segments_in(edges, band, 85)).all()
        for d, a, b in zip(some, first, first + count):
            keys[d] += key[a:b].view(np.int64).tolist()
    linked = 0
    for i in range(0, len(rows), 2):
        both = len(np.intersect1d(rows[i], rows[i + 1]))
        if 100 * both >= 85 * (len(rows[i]) + len(rows[i + 1]) - both):
            linked += 1
            assert set(keys[i]) & set(keys[i + 1])
    assert linked > 150
    sets = spark.createDataFrame([(i, r.view(np.int64).tolist(), len(r)) for i, r in enumerate(rows)], "id long, items array<long>, size long")
    members = spark.createDataFrame([(k, i, 0) for i, ks in enumerate(keys) for k in set(ks)], "key long, id long, role int")
    shared = members.groupBy("key").count().filter("count > 1").select("key")
    dropped, index = jaccard.neighbourhoods(shared, members, lambda ids: sets.join(ids, "id", "left_semi"), 85)
    gone = {r["key"] for r in dropped.collect()}
    held = {}
    for r in index.collect():
        held.setdefault(r["id"], {1: set(), 2: set()})[r["role"]].add(r["key"])
    missed = 0
    for i in range(0, len(rows), 2):
        both = len(np.intersect1d(rows[i], rows[i + 1]))
        if 100 * both >= 85 * (len(rows[i]) + len(rows[i + 1]) - both) and not (set(keys[i]) & set(keys[i + 1])) - gone:
            a, b = held[i], held[i + 1]
            assert a[1] & b[2] or a[2] & b[1]
            missed += 1
    assert gone and missed >= 5


def test_bitmaps_rule_out_exactly():
    rng = np.random.default_rng(19)
    rows = []
    for n in (1, 2, 5, 31, 32, 33, 100, 128, 129, 700):
        for _ in range(12):
            mine = rng.integers(1, 1 << 62, n, dtype=np.uint64)
            rows.append(np.unique(mine))
            other = np.concatenate((mine[int(n * rng.random() * 0.3):], rng.integers(1, 1 << 62, int(n * rng.random() * 0.3), dtype=np.uint64)))
            rows.append(np.unique(other))
    bits = jaccard.bitmaps(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows))
    i, j = np.triu_indices(len(rows), 1)
    size = np.array([len(r) for r in rows])
    may = jaccard.may_link(bits, size, i, j, 85)
    both = np.array([len(np.intersect1d(rows[a], rows[b])) for a, b in zip(i, j)])
    linked = 100 * both >= 85 * (size[i] + size[j] - both)
    assert linked.any() and not (linked & ~may).any() and may.sum() < 2 * linked.sum()


def test_jaccard_edges(spark, documents, edge_rows):
    df = documents([*edge_rows, (20, words(1, 30)), (20, words(2, 30)), (21, words(1, 30)), (22, words(2, 30))], clash=True)
    got = jaccard.jaccard_groups(df).collect()
    assert len(got) == len(edge_rows) + 4 and {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (1, 2, 3, 4, 6, 8)} == {1: 1, 2: 2, 3: 3, 4: 4, 6: 6, 8: 4}
    # One document of two texts goes by one of them.
    named = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (20, 21, 22)}
    assert named[20] == 20 and sorted((named[21], named[22])) in ([20, 21], [20, 22])
    assert jaccard.jaccard_groups(df.limit(0)).count() == 0
