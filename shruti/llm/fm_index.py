"""An FM-index over a sequence of numbers: suffix order, wavelet matrix of packed bits, backward search of many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (numbers from 0) in order, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        if k < n:
            after[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if n else 0
        rank = new
        if not n or rank[order[-1]] == n - 1:
            return order
        k *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, by levels of packed bits."""

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        values = values.astype(np.int64)
        for bit in range(max(1, (n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit) & 1
            packed = np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()
            blocks = np.frombuffer(packed.ljust((len(packed) + 15) // 8 * 8, b"\0"), "<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)])[:-1].astype(np.uint32)
            zeros = len(values) - int(ones.sum())
            self.levels.append((bit, blocks, before, zeros))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the prefixes that end before ``at`` end among the symbols on the last level."""
        at = at.astype(np.int64)
        for bit, blocks, before, zeros in self.levels:
            block = at >> 6
            ones = before[block] + np.bitwise_count(blocks[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbols >> bit) & 1 == 1, zeros + ones.astype(np.int64), at - ones)
        return at


class FMIndex:
    """text: numbers from 0 to ``n_symbols`` - 1."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        self.order = suffix_order(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        last = text[self.order - 1]  # before the first suffix comes the last symbol
        self.bwt = WaveletMatrix(last, n_symbols)
        symbols = np.arange(n_symbols)
        self.shift = self.first[:-1] - self.bwt.descend(symbols, np.zeros(n_symbols, np.int64))

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        both = self.bwt.descend(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        shift = self.shift[symbols]
        return both[: len(symbols)] + shift, both[len(symbols) :] + shift

    def statistics(self, text: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a streamed text that is part of the indexed one.

        Of each place in ``ends`` (exclusive): how many words before it, up to
        ``limit``, are found in the index more than once, that is elsewhere too,
        and the interval of the suffixes that begin with them. All places search
        backward together; one ends where it is left alone or has ``limit`` words.
        """
        lengths = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.order), np.int64)
        alive, lo, hi = np.arange(len(ends)), low, high
        for step in range(1, limit + 1):
            symbols = text[ends[alive] - step]
            # the interval of one symbol is known without the wavelet matrix
            lo, hi = self.extend(symbols, lo, hi) if step > 1 else (self.first[symbols], self.first[symbols + 1])
            more = hi - lo > 1
            alive, lo, hi = alive[more], lo[more], hi[more]
            if not len(alive):
                break
            lengths[alive], low[alive], high[alive] = step, lo, hi
        return lengths, low, high
