"""Word shingles of whole texts as numpy arrays, for use inside tasks."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i mod 2^64 for i < n, grown as needed."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str | None) -> bytes:
    """Words with A-Z in lower case, one space between them (bytes.lower and
    bytes.split know ASCII only: space and 0x09-0x0D)."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split()) if text else b""


def shingle_hashes(body: bytes, size: int) -> np.ndarray:
    """64-bit hashes of a normalised text's distinct shingles, sorted: all runs of
    ``size`` words; with fewer words the whole sequence; without words none."""
    if not body:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(body, dtype=np.uint8)
    p, inverse = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
    gap = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate(([0], gap + 1)), np.concatenate((gap, [len(raw)]))
    k = min(size, len(starts))
    a, b = starts[:len(starts) - k + 1], ends[k - 1:]
    return np.unique(mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64)))
