"""Word shingles of many texts as 64-bit hashes, by array operations."""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
#: White space of the contract: space, and tab to carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x + np.uint64((_ODD * (2 * seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_POWERS[0]) < n:
        for i, b in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            row = np.full(1 << n.bit_length(), b, np.uint64)
            row[0] = 1
            _POWERS[i] = np.cumprod(row)
    return _POWERS


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles (of all its words, with fewer than k)."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return []
    ends = np.cumsum([len(r) for r in raw])
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    power, inverse = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    terms = _VALUES[data]
    terms *= power[: len(data)]
    np.cumsum(terms, out=total[1:])
    del terms
    words = mixed((total[end] - total[begin]) * inverse[begin])
    upto = np.searchsorted(begin, ends)
    run = words[: max(0, len(words) - k + 1)].copy()
    for j in range(1, k):
        run = mixed(run, 1) + words[j : j + len(run)]
    run = mixed(run, 2)
    out, start = [], 0
    for stop in upto.tolist():
        n = stop - start
        if n >= k:
            out.append(np.unique(run[start : stop - k + 1]))
        elif n:
            h = np.uint64(n)
            for w in words[start:stop]:
                h = mixed(np.array([h]), 3)[0] ^ w
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        start = stop
    return out


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    with np.errstate(over="ignore"):
        n = np.uint64(len(hashes))
        pair = mixed(np.array([mixed(hashes, 5).sum(dtype=np.uint64) + n, mixed(hashes, 6).sum(dtype=np.uint64) ^ n], np.uint64), 4)
    return tuple(pair.view(np.int64).tolist())
