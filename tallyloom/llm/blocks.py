"""Word and shingle hashes of whole texts, a block of documents at a time, as NumPy arrays inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 250_000
# Powers of the hash base that a worker keeps; longer blocks compute their own.
KEPT_POWERS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(texts: list, lower: bool = True, most: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts as UTF-8, lower-cased (A-Z) unless told otherwise, with the number of the first one; null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        raw = raw.lower() if lower else raw
        if held and size + len(raw) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_GROWN: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _GROWN or len(_GROWN["up"]) <= n:
        if n > KEPT_POWERS:
            return _powers(_BASE, n), _powers(_INVERSE, n)
        _GROWN.update(up=_powers(_BASE, KEPT_POWERS), down=_powers(_INVERSE, KEPT_POWERS))
    return _GROWN["up"], _GROWN["down"]


def words(held: list[bytes], space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word of the block, in order; words are maximal runs of bytes outside `space`."""
    raw = np.frombuffer(b" ".join(held) + b" ", np.uint8)
    gap = space[raw]
    if not space[32]:
        raise ValueError("a space must separate words")
    before = np.concatenate(([True], gap[:-1]))
    start = np.flatnonzero(before & ~gap)
    stop = np.flatnonzero(gap & ~before)
    up, down = powers(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)))
    code = mix((total[stop] - total[start]) * down[start])
    ends = np.cumsum([len(x) + 1 for x in held])
    return np.searchsorted(ends, start, "right"), code


def shingles(held: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): each document's distinct shingle hashes in ascending order; a shorter document is one shingle."""
    doc, code = words(held)
    counts = np.bincount(doc, minlength=len(held)) if len(doc) else np.zeros(len(held), np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    n = len(code)
    full = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        full += code[j:n - width + 1 + j] * _PLACE[j] if n >= width else full
    full = mix(full + np.uint64(width))
    sets = []
    for d in range(len(held)):
        a, b = first[d], first[d + 1]
        if b - a >= width:
            sets.append(np.unique(full[a:b - width + 1]))
        elif b > a:
            sets.append(mix(np.array([(code[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(([0], np.cumsum([len(s) for s in sets]))), np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def pairs_within(group: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j), i < j, of rows with the same value of `group`, whose equal values stand together; in portions of about `most`."""
    n = len(group)
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, n)
    end = np.repeat(ends, np.diff(np.append(0, ends)))
    alive, step, held, size = np.arange(n), 1, [], 0
    while len(alive := alive[alive + step < end[alive]]):
        held.append((alive, alive + step))
        size += len(alive)
        if size >= most:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
        step += 1
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))
