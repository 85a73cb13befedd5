"""Line dedup by a segment-partition edit join.

Every line that holds a code point is compared. Equal lines are one line, known by a 128-bit hash. Different lines are linked within a number of edits
(insert, delete or replace a code point) that grows with the length of the shorter one: the parameter `tolerance` lists from which length on how
many are allowed, by default none below 32 code points, one from there and two from 48, since few edits turn one short line into
another. Of every connected group only the first occurrence (smallest doc_id, then line number) stays.

A line of length l with tolerance t is cut into t + 1 segments; a line at least as long and within t edits contains one of them unchanged. The probes of
a line of length L are the substrings that can be that segment for partner lengths L, L - 1, ..., each with the partner's tolerance, narrowed
from both sides by the edits that are left (the multi-match-aware selection). Keys hash (length, segment number, substring). Each key's bucket is a star around its smallest
indexed line: one pair per line is verified first, then, in buckets that still hold several components, the pairs across them, in blocks inside
tasks that write links only. Verification is banded bit-parallel edit distance on the whole lines, many pairs at a time.

Defined results: null text has no lines; empty text has one empty line; empty lines, which only set others apart, stay; rows without doc_id
keep all lines; rows that repeat a doc_id are the same document, and keep the same lines; a document whose every line goes is dropped by
`drop_repeated_lines`; further columns stay as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.blocks import blocks, mix, pairs_within, powers
from tallyloom.llm.common import columns, unused
from tallyloom.llm.grouping import components, small
from tallyloom.runtime import stage

# (least length of the shorter line, edits), ascending; no edits below the first.
TOLERANCE = ((32, 1), (48, 2))
# Members of a bucket that meet in one task; a larger bucket becomes several pairs of parts.
PART = 1_000
# Rows of the buckets that one call in a task handles together.
BIN = 4_000


def edits_allowed(length: np.ndarray, tolerance=TOLERANCE) -> np.ndarray:
    """Edits that a pair may have whose shorter line has the given length."""
    return np.array([0, *(t for _, t in tolerance)])[np.searchsorted([least for least, _ in tolerance], length, "right")]


def segments(length: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, size) of the tau + 1 segments of lines of the given lengths; the later ones are the longer ones."""
    base, longer = np.divmod(length, tau + 1)
    out, at = [], np.zeros_like(length)
    for i in range(tau + 1):
        size = base + (i >= tau + 1 - longer)
        out.append((at, size))
        at = at + size
    return out


def line_keys(codes: np.ndarray, start: np.ndarray, length: np.ndarray, tolerance=TOLERANCE):
    """(names a, names b, indexed keys, probe keys) of lines given by their place in an array of code points; keys are lists by line.

    Probes that would repeat an indexed key of the same line are left out: an indexed key probes as well.
    """
    up, down = powers(len(codes))

    def prefix(salt):
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64) + np.uint64(salt)) * up[:len(codes)], dtype=np.uint64)))

    total, other = prefix(1), prefix(1 << 40)

    def piece(sums, at, size):
        return mix((sums[at + size] - sums[at]) * down[at])

    a, b = piece(total, start, length), piece(other, start, length)
    indexed, probes = [], []
    for tau in sorted({t for _, t in tolerance if t}):
        for delta in range(tau + 1):
            # Lines with a partner of this tolerance that is shorter by delta.
            line = np.flatnonzero((length > delta) & (edits_allowed(length - delta, tolerance) == tau))
            own, partner, origin = length[line], length[line] - delta, start[line]
            for i, (begin, size) in enumerate(segments(partner, tau)):
                salt = mix(partner.astype(np.uint64) * np.uint64(64) + np.uint64(i))
                for shift in range(max(-i, delta - (tau - i)), min(i, delta + (tau - i)) + 1):
                    at = begin + shift
                    fits = np.flatnonzero((at >= 0) & (at + size <= own))
                    key = mix(piece(total, origin[fits] + at[fits], size[fits]) ^ salt[fits])
                    (indexed if delta == 0 and shift == 0 else probes).append((line[fits], key))
    return a, b, _by_line(indexed, len(length)), _by_line(probes, len(length))


LINES = "doc_id long, line_no int, n_lines int, a long, b long, indexed array<long>, probes array<long>"


def _by_line(found: list[tuple[np.ndarray, np.ndarray]], lines: int) -> list[np.ndarray]:
    """Lists of the keys of every line, from pairs of arrays (line, key)."""
    line, key = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    key = key[np.argsort(line, kind="stable")].view(np.int64)
    cuts = np.cumsum(np.bincount(line, minlength=lines))
    return [key[x:y] for x, y in zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist())]


def lines(docs: DataFrame, tolerance=TOLERANCE) -> DataFrame:
    """Every compared line with its name and, where it has a tolerance, its keys; and one row with null line_no per document."""
    def run(batches):
        for batch in batches:
            texts = batch["text"].tolist()
            for first, held in blocks(texts):
                part = texts[first:first + len(held)]
                ids = batch["doc_id"].iloc[first:first + len(held)].to_numpy()
                codes = np.frombuffer("".join(f"{t or ''}\n" for t in part).encode("utf-32-le", "surrogatepass"), np.uint32)
                breaks = np.flatnonzero(codes == 10)
                start = np.concatenate(([0], breaks[:-1] + 1))
                length = breaks - start
                ends = np.cumsum([len(t or "") + 1 for t in part])
                doc = np.searchsorted(ends, start, "right")
                count = np.bincount(doc, minlength=len(part))
                number = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
                keep = length > 0
                doc, number, start, length = doc[keep], number[keep], start[keep], length[keep]
                null = np.array([t is None for t in part], bool)
                yield pd.DataFrame({"doc_id": ids, "line_no": pd.array([None] * len(part), "Int32"), "n_lines": np.where(null, 0, count).astype(np.int32),
                                    "a": 0, "b": 0, "indexed": None, "probes": None})
                if len(start):
                    a, b, indexed, probes = line_keys(codes, start, length, tolerance)
                    named = pd.DataFrame({"doc_id": ids[doc], "line_no": number.astype(np.int32), "n_lines": 0, "a": a.view(np.int64), "b": b.view(np.int64)})
                    near = edits_allowed(length, tolerance) > 0
                    if near.any():
                        some = np.flatnonzero(near)
                        yield named[near].assign(indexed=[indexed[i] for i in some], probes=[probes[i] for i in some])
                    if not near.all():
                        yield named[~near].assign(indexed=None, probes=None)

    return columns(docs.filter(docs["doc_id"].isNotNull()), "doc_id", "text").mapInPandas(run, LINES)


def within(left: list[str], right: list[str], allowed) -> np.ndarray:
    """Whether each pair is within its allowed edits (a number or one per pair): a band of diagonals per column, one machine word per pair."""
    n = len(left)
    if not n:
        return np.zeros(0, bool)
    allowed = np.broadcast_to(np.asarray(allowed, np.int64), n)
    tau = int(allowed.max(initial=0))
    la, lb = (np.array([len(x) for x in side], np.int64) for side in (left, right))
    width = max(la.max(initial=0), lb.max(initial=0)) + 2 * tau + 2
    a = np.zeros((n, width + 2 * tau + 2), np.uint32)
    b = np.full((n, width), 0xFFFFFFFF, np.uint32)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, tau:tau + len(x)] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) + 1
        b[i, :len(y)] = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    band = 2 * tau + 1
    full = np.uint64((1 << band) - 1)
    one = np.uint64(1)
    # reach[e] holds, as bits, the diagonals of the column that are reached with e edits.
    reach = []
    for e in range(tau + 1):
        bits = 0
        for d in range(band):
            if 0 <= d - tau <= e:
                bits |= 1 << d
        reach.append(np.full(n, bits, np.uint64))
    done = np.zeros(n, bool)

    def finish(column):
        at = np.flatnonzero((lb == column) & (np.abs(la - lb) <= allowed))
        if len(at):
            bit = one << (la[at] - lb[at] + tau).astype(np.uint64)
            done[at] = (np.stack(reach)[allowed[at], at] & bit) != 0

    finish(0)
    for j in range(int(lb.max(initial=0))):
        # Bit d of the column j + 1 is row i = j + 1 + d - tau; its last character is a[i - 1], kept tau places to the right.
        same = np.zeros(n, np.uint64)
        for d in range(band):
            same |= (a[:, j + d] == b[:, j]).astype(np.uint64) << np.uint64(d)
        inside = np.zeros(n, np.uint64)
        for d in range(band):
            if j + 1 + d - tau >= 0:
                inside |= one << np.uint64(d)
        fresh = []
        for e in range(tau + 1):
            now = reach[e] & same
            if e:
                now |= reach[e - 1]                      # replace
                now |= (reach[e - 1] >> one)             # a character of b only
                now |= (fresh[e - 1] << one) & full      # a character of a only
                now |= fresh[e - 1]
            fresh.append(now & inside)
        reach = fresh
        finish(j + 1)
    return done


def _pair_edits(left: list[str], right: list[str], tolerance) -> np.ndarray:
    return edits_allowed(np.array([min(len(x), len(y)) for x, y in zip(left, right)], np.int64), tolerance)


def verified(pairs: DataFrame, texts: DataFrame, tolerance=TOLERANCE) -> DataFrame:
    """The pairs (u, v) of line names whose texts are within the edits that their length allows."""
    def run(batches):
        for batch in batches:
            # Pairs of like length together: a group costs its longest line.
            batch = batch.iloc[np.argsort(batch["y"].str.len().to_numpy(), kind="stable")].reset_index(drop=True)
            at = 0
            while at < len(batch):
                step = max(1, min(512, 4_000_000 // (8 * (len(batch["y"].iloc[min(at + 511, len(batch) - 1)]) + 64))))
                part = batch.iloc[at:at + step]
                left, right = part["x"].tolist(), part["y"].tolist()
                ok = within(left, right, _pair_edits(left, right, tolerance))
                yield part.loc[ok, ["u", "v"]]
                at += step

    x = texts.select(F.col("id").alias("u"), F.col("line").alias("x"))
    y = texts.select(F.col("id").alias("v"), F.col("line").alias("y"))
    near = pairs.join(x, "u").join(y, "v").filter(F.abs(F.length("x") - F.length("y")) <= max(t for _, t in tolerance))
    return near.select("u", "v", "x", "y").mapInPandas(run, "u long, v long")


def linked_across(split: DataFrame, texts: DataFrame, tolerance=TOLERANCE) -> DataFrame:
    """The links (u, v) between different components of one bucket; character counts rule out most pairs before the edit distance.

    Buckets, or pairs of parts of large ones, are dealt out to bins of about BIN rows, so that a task call handles many small ones.
    """
    sizes = split.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    rows = split.join(sizes, "key").join(texts, "id").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    rows = stage(rows.select("key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "id", "c", "own", "line"))
    bins = max(1, -(-rows.count() // BIN))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        key, p, q, mine, ids, c, own = (part[x].to_numpy() for x in ("key", "p", "q", "mine", "id", "c", "own"))
        order = np.lexsort((q, p, key))
        lines = part["line"].tolist()
        counts = np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) & 127, minlength=128) for x in lines]).astype(np.int32)
        allowed = edits_allowed(counts.sum(axis=1), tolerance)
        k, a, b = key[order], p[order], q[order]
        group = np.cumsum(np.append(0, (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        found = []
        for i, j in pairs_within(group):
            i, j = order[i], order[j]
            # A pair needs an indexed line; two parts of a bucket meet in their own pair of parts only.
            some = (c[i] != c[j]) & (own[i] | own[j]) & ((p[i] == q[i]) | (mine[i] != mine[j]))
            i, j = i[some], j[some]
            some = np.abs(counts[i] - counts[j]).sum(axis=1) <= 2 * np.minimum(allowed[i], allowed[j])
            found += list(zip(i[some].tolist(), j[some].tolist()))
        found.sort(key=lambda x: len(lines[x[0]]))
        u, v = [], []
        for at in range(0, len(found), 512):
            some = found[at:at + 512]
            ok = within([lines[i] for i, _ in some], [lines[j] for _, j in some], [min(allowed[i], allowed[j]) for i, j in some])
            u += [ids[i] for (i, _), good in zip(some, ok) if good]
            v += [ids[j] for (_, j), good in zip(some, ok) if good]
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    return rows.groupBy(F.pmod(F.xxhash64("key", "p", "q"), F.lit(bins)).alias("bin")).applyInPandas(run, "u long, v long").distinct()


def texts_of(docs: DataFrame, unique: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the named lines, taken from their first documents."""
    wanted = unique.join(small(ids), "id", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "id")).alias("at"))
    wanted = stage(wanted).select(F.col("doc_id").alias("_id"), "at")
    per_row = wanted.agg(F.avg(F.size("at"))).first()[0] or 0
    text = columns(docs, "doc_id", "text").join(small(wanted, 32 + int(16 * per_row)), F.col("doc_id") == F.col("_id"))
    cut = text.select(F.split("text", "\n", -1).alias("lines"), F.explode("at").alias("x"))
    return cut.select(F.col("x.id").alias("id"), F.expr("lines[x.line_no]").alias("line")).dropDuplicates(["id"])


def removed_lines(docs: DataFrame, tolerance=TOLERANCE) -> DataFrame:
    """(doc_id, n_lines, removed): per document the numbers (from 0) of the lines that repeat an earlier one."""
    every = stage(lines(docs, tolerance))
    compared = every.filter("line_no IS NOT NULL")
    unique = stage(compared.groupBy("a", "b").agg(F.min(F.struct("doc_id", "line_no")).alias("r"), F.count(F.lit(1)).alias("n")).select(
        F.col("a").alias("id"), "b", "n", "r.*"))
    keyed = compared.select(F.col("a").alias("id"), F.explode(F.concat(
        F.transform("indexed", lambda k: F.struct(k.alias("key"), F.lit(True).alias("own"))),
        F.transform("probes", lambda k: F.struct(k.alias("key"), F.lit(False).alias("own"))))).alias("k")).select("id", "k.key", "k.own")
    # Copies of a line give equal rows, which the partial aggregate folds.
    buckets = keyed.groupBy("key").agg(F.min(F.when(F.col("own"), F.col("id"))).alias("leader"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    buckets = stage(buckets.filter("lo < hi AND leader IS NOT NULL").select("key", "leader"))
    members = stage(keyed.join(small(buckets), "key").groupBy("key", "id").agg(F.max("own").alias("own"), F.min("leader").alias("leader")))
    stars = stage(members.filter("id <> leader").groupBy(F.col("id").alias("v")).agg(F.min("leader").alias("u")).select("u", "v"))
    texts = stage(texts_of(docs, unique, stage(members.select("id").distinct())))
    edges = stage(verified(stars, texts, tolerance))
    grouped = stage(components(edges))
    placed = stage(members.join(grouped, "id", "left").select("key", "own", "id", F.coalesce("component", "id").alias("c")))
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    more = stage(linked_across(placed.join(mixed, "key"), texts, tolerance))
    if more.limit(1).count():
        edges = edges.unionByName(more)
        grouped = stage(components(edges))
    # Per line that is repeated or linked: the first occurrence of its group.
    named = unique.join(grouped, "id", "left").filter("n > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "id"))
    firsts = named.groupBy("component").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    named = stage(named.join(firsts, "component").select(F.col("id").alias("a"), "b", "first"))
    gone = compared.join(small(named, 56), ["a", "b"]).filter(F.struct("doc_id", "line_no") != F.col("first"))
    gone = gone.select("doc_id", F.lit(0).alias("n_lines"), "line_no")
    counts = every.filter("line_no IS NULL").select("doc_id", "n_lines", "line_no")
    return counts.unionByName(gone).groupBy("doc_id").agg(F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set("line_no")).alias("removed"))


def drop_repeated_lines(docs: DataFrame, tolerance=TOLERANCE) -> DataFrame:
    """The input rows without repeated lines in `text`; documents that lose every line are dropped, other columns stay."""
    key, gone, kept = (unused(docs, n) for n in ("_id", "_gone", "_kept"))
    lost = removed_lines(docs, tolerance).filter("size(removed) > 0").select(F.col("doc_id").alias(key), F.col("removed").alias(gone))
    joined = docs.join(lost, docs["doc_id"] == F.col(key), "left")
    left = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(gone, i))
    out = joined.withColumn(kept, F.when(F.col(gone).isNotNull(), left)).filter(F.col(kept).isNull() | (F.size(kept) > 0))
    return out.withColumn("text", F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).drop(key, gone, kept)
