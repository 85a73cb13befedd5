"""URL filter: host and path rules, and a sorted array of 64-bit xxhash digests that is memory-mapped and probed by binary search.

A listing is a set of strings, each a host (it covers its subdomains) or `host/path` (that page alone). Spark sorts the listing by digest and
writes it in shards of at most SHARD_ENTRIES, which every executor receives as files: digests, offsets, and the strings. A
task maps the files, looks a batch of candidate strings up with one vectorised binary search, and confirms every hit against
the stored string, so colliding digests cannot block a page. Mapped files are shared by the workers of a machine, and pages of the map that
are not probed stay on disk. Pages pass in one narrow scan of page_id and url; nothing is shuffled.

Rules come first: the longest fitting rule decides; where none fits, the listing does. Defined results: a null url, or one without `://`, has an
empty host and path, fits no rule and is allowed; an empty listing allows everything; rows that repeat a page_id are judged alike.
"""

from __future__ import annotations

import os
import struct
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import columns, lower_ascii

# (verdict, host, path prefix); fixed values of the contract.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
SHARD_ENTRIES = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest is asked first, so it is put on last.
    for what, at, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        name, verdict = F.when(fits, at + prefix).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def digests(strings: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s.encode()) for s in strings), np.uint64, len(strings))


def write_shard(folder: str, entries: list[str], hashed=digests) -> str:
    """One file: count, sorted digests, offsets of the strings, and the strings."""
    keys = hashed(entries)
    order = np.argsort(keys, kind="stable")
    raw = [entries[i].encode() for i in order]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64))).astype(np.int64)
    path = os.path.join(folder, f"urls-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        f.write(struct.pack("<q", len(raw)))
        f.write(keys[order].tobytes())
        f.write(offsets.tobytes())
        f.write(b"".join(raw))
    return path


class Shard:
    """A mapped file of a listing."""

    def __init__(self, path: str, hashed=digests):
        n = int(np.fromfile(path, np.int64, 1)[0])
        self.hashed = hashed
        self.keys = np.memmap(path, np.uint64, "r", 8, (n,)) if n else np.zeros(0, np.uint64)
        self.offsets = np.memmap(path, np.int64, "r", 8 + 8 * n, (n + 1,))
        self.text = np.memmap(path, np.uint8, "r", 16 + 16 * n) if n and self.offsets[-1] else np.zeros(0, np.uint8)

    def contains(self, strings: list[str], keys: np.ndarray | None = None) -> np.ndarray:
        """Whether each string is stored; every equal digest is confirmed, collisions included."""
        keys = self.hashed(strings) if keys is None else keys
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        out = np.zeros(len(strings), bool)
        for i in np.flatnonzero(high > low):
            raw = strings[i].encode()
            out[i] = any(self.text[self.offsets[k]:self.offsets[k + 1]].tobytes() == raw for k in range(low[i], high[i]))
        return out


def distribute(listing: DataFrame) -> list[str]:
    """Names of the shard files that every executor now has. The listing passes the driver a shard at a time, from the store to a file."""
    spark = listing.sparkSession
    entries = listing.toDF("entry").filter("entry IS NOT NULL AND entry <> ''").distinct()
    # Served from here to the executors for as long as the session lasts, and deleted with it.
    folder = os.path.join(SparkFiles.getRootDirectory(), "listings")
    os.makedirs(folder, exist_ok=True)
    names, held = [], []

    def put():
        path = write_shard(folder, held)
        spark.sparkContext.addFile(path)
        names.append(os.path.basename(path))

    for row in entries.toLocalIterator():
        held.append(row["entry"])
        if len(held) >= SHARD_ENTRIES:
            put()
            held = []
    if held:
        put()
    return names


def candidates(host: str, path: str) -> list[str]:
    """What a listing may hold for a page: its host, the parent domains, and the page itself."""
    parts = host.split(".")
    out = [".".join(parts[i:]) for i in range(len(parts))] if host else []
    return [*out, host + path] if host and path else out


def judge(pages: DataFrame, listing: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    names = distribute(listing)
    host, path = host_and_path(F.col("url"))
    split = columns(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("verdict"))

    def run(batches):
        shards = [Shard(SparkFiles.get(n)) for n in names]
        for batch in batches:
            open_rows = np.flatnonzero(batch["verdict"].isna().to_numpy())
            asked, row = [], []
            for i in open_rows:
                some = candidates(batch["host"].iat[i], batch["path"].iat[i])
                asked += some
                row += [i] * len(some)
            # Hosts repeat: each string is looked up once a batch.
            distinct, back = np.unique(np.array(asked, object), return_inverse=True) if asked else (np.array([], object), np.array([], int))
            keys = digests(list(distinct))
            hit = np.zeros(len(distinct), bool)
            for shard in shards:
                hit |= shard.contains(list(distinct), keys)
            verdict = batch["verdict"].to_numpy(object).copy()
            verdict[open_rows] = "allow"
            verdict[np.array(row, int)[hit[back]] if len(row) else []] = "block"
            yield batch.assign(verdict=verdict)

    return ruled.mapInPandas(run, "page_id long, host string, path string, rule string, verdict string")


# Words that make a label of a host suspect; fixed values.
SUSPECT = ("ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "warez", "xxx")


def suspect_hosts(pages: DataFrame) -> DataFrame:
    """A listing from the table itself: distinct hosts from their first label with a suspect word on (words are joined by dashes)."""
    host = host_and_path(F.col("url"))[0]
    cut = F.regexp_extract(host, r"(?:^|\.)((?:[^.]*-)?(?:" + "|".join(SUSPECT) + r")(?:-[^.]*)?(?:\..*)?)$", 1)
    return columns(pages, "url").select(cut.alias("entry")).filter("entry <> ''").distinct()
