"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def groups(nodes, links):
    """Smallest member reachable from every node."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width, 0) + 1)} if words else set()


def near_groups(rows, width, similarity=80):
    sets = {d: shingles(t, width) for d, t in rows}
    ids = sorted(d for d in sets if sets[d])
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return groups(list(sets), links)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def tolerance(length):
    """Edits allowed to a pair of lines by the length of the shorter one."""
    return 2 if length >= 48 else 1 if length >= 32 else 0


def repeated_lines(rows):
    """doc_id -> numbers of the lines that go: equal lines of any length but 0, and near ones by their tolerance."""
    seen = defaultdict(list)
    for d, t in rows:
        for i, line in enumerate(t.split("\n") if t is not None else []):
            if line and d is not None:
                seen[line].append((d, i))
    lines = sorted(seen, key=len)
    links = []
    for i, a in enumerate(lines):
        tau = tolerance(len(a))
        for b in lines[i + 1:] if tau else ():
            if len(b) - len(a) > tau:
                break
            if sum(abs(a.count(x) - b.count(x)) for x in set(a + b)) <= 2 * tau and edits(a, b) <= tau:
                links.append((a, b))
    gone = defaultdict(set)
    for members in _members(groups(lines, links)).values():
        places = sorted(p for line in members for p in seen[line])
        for d, i in places:
            if (d, i) != places[0]:
                gone[d].add(i)
    return gone


def _members(named):
    out = defaultdict(list)
    for x, r in named.items():
        out[r].append(x)
    return out


def cut_strings(rows, length=50):
    """doc_id -> (bytes, removed, spans, digest)."""
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first.setdefault(b[i:i + length], d) < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def contaminated(rows, items, n=13):
    """doc_id -> (words, hit words, items)."""
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    sizes = {len(k) for k in windows}
    out = {}
    for d, t in rows:
        w, hit, found = bench_words(t), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                k = tuple(w[i:i + size])
                if k in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[k]
        out[d] = (len(w), len(hit), found)
    return out


FORMS = [
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def secret_spans(text):
    out = []
    for k, (name, pattern, group, least) in enumerate(FORMS):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(out)]


def budget(tree_caps, weights, total):
    """Shares of children (name -> cap) in whole tokens, those used up whole taken out first."""
    quota, left, open_ = {}, total, sorted(tree_caps, key=lambda c: (tree_caps[c] / weights[c], c))
    while open_:
        rest = sum(weights[c] for c in open_)
        c = open_[0]
        if tree_caps[c] * rest <= left * weights[c]:
            quota[c] = tree_caps[c]
            left -= tree_caps[c]
            open_ = open_[1:]
        else:
            return quota | {c: left * weights[c] // rest for c in open_}
    return quota
