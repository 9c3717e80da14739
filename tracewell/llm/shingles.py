"""Sets of word shingles as 64-bit hashes, for many texts at once.

Bytes are hashed by a polynomial whose prefix sums give the hash of any word without a loop; words are mixed, and k of
them in a row make a shingle.
"""

from __future__ import annotations

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 512 << 10  # bytes that are hashed at once

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, "u8") * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62, dtype="i8")) | 1
_PLACE = [int(x) | 1 for x in _rng.integers(1 << 40, 1 << 62, 64, "i8")]
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, CHUNK + (1 << 16))
        _powers[:] = [_geometric(x, size) for x in (_BASE, inverse)]
    return _powers[0], _powers[1]


def _geometric(x: int, n: int) -> np.ndarray:
    out = np.full(n, x % (1 << 64), "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of bytes that begin and end anywhere between words."""
    b = np.frombuffer(raw, "u1")
    edge = np.diff(np.concatenate([[True], SPACE[b], [True]]).view("i1"))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _tables(len(b) + 1)
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_BYTE[b] * up[: len(b)], dtype="u8")])
    return mixed((sums[end] - sums[start]) * down[start]), start


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; cut into chunks between words."""
    hashes, starts, at = [np.zeros(0, "u8")], [np.zeros(0, "i8")], 0
    while at < len(raw):
        stop = min(len(raw), at + CHUNK)
        while stop < len(raw) and not SPACE[raw[stop]]:
            stop += 1
        h, s = _words(raw[at:stop])
        hashes.append(h)
        starts.append(s + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """For each text its sorted distinct shingles of k words; with fewer words, the whole sequence as one."""
    raws = [(t or "").encode().translate(LOWER) for t in texts]
    bounds = np.cumsum([0, *(len(r) + 1 for r in raws)])
    h, start = words(b" ".join(raws))
    first = np.searchsorted(start, bounds)
    n = max(0, len(h) - k + 1)
    made = np.zeros(n, "u8")
    for j in range(k):
        made += h[j : n + j] * np.uint64(_PLACE[j])
    made = mixed(made)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(made[a : b - k + 1]))
        elif b > a:
            few = sum(int(x) * p for x, p in zip(h[a:b], _PLACE, strict=False)) + int(b - a) * _PLACE[-1]
            out.append(mixed(np.array([few % (1 << 64)], "u8")))
        else:
            out.append(np.zeros(0, "u8"))
    return out
