"""Hashes of words, shingles and word windows of many texts at once, the same on every machine."""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
#: One random number per byte value, and odd multipliers.
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
ODD = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS = np.cumprod(np.full(4096, BASE))


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.full(max(n, 2 * len(_POWERS)), BASE))
    return _POWERS


def words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (between bytes 9 to 13 and 32) of all texts, and where each text's begin (one more entry than texts).

    lower: A-Z count as a-z.
    """
    split = [(t.lower() if lower else t).split() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in split], dtype=np.int64)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    flat = [w for s in split for w in s]
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    raw = np.frombuffer(b"".join(flat), np.uint8)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat(BYTE[raw] * powers(int(sizes.max()))[place], starts) + sizes.astype(np.uint64)), offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``k``-word shingles; of a text of fewer words (not none), one of all."""
    n = len(hashes)
    m = max(0, n - k + 1)
    grams = np.zeros(m, np.uint64)
    for i in range(k):
        grams += mix(hashes[i : m + i] + ODD[7]) * ODD[i]
    grams = mix(grams)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for i in range(a, b):
                whole = mix(whole * ODD[6] + hashes[i : i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def doubled(hashes: np.ndarray, top: int) -> dict[int, np.ndarray]:
    """Hashes of the windows of 1, 2, 4, ... up to ``top`` consecutive words, by window size; index: first word."""
    out, k = {1: hashes}, 1
    while 2 * k <= top:
        h = out[k]
        out[2 * k] = mix(h[: len(h) - k] * ODD[0] + h[k:] * ODD[1] + U(k)) if len(h) > k else np.zeros(0, np.uint64)
        k *= 2
    return out


def windows(levels: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words from those of the powers of two in it."""
    n = len(levels[1]) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at = np.full(n, U(size)), 0
    for k in sorted(levels, reverse=True):
        if size - at >= k:
            out = mix(out * ODD[2] + levels[k][at : at + n] * ODD[3])
            at += k
    return out
