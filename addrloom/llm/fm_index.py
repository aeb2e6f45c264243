"""A compressed full-text index in numpy: truncated suffix order, Burrows-Wheeler text, wavelet matrix."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words with a running count per word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """How often a symbol occurs in front of a place, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for bit in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(np.uint8)
            zeros = int(len(ones) - ones.sum())
            self.levels.append((bit, BitVector(ones), zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Place of ``i`` among the symbols equal to ``symbol``, counted within the last level."""
        for bit, vector, zeros in self.levels:
            ones = vector.rank(i)
            i = np.where((symbol >> bit) & 1, zeros + ones, i - ones)
        return i


class FmIndex:
    """Backward search over pieces of text; suffixes are told apart by their first ``depth`` symbols."""

    def __init__(self, pieces: np.ndarray, sizes: np.ndarray, depth: int):
        """``pieces``: the symbols of all pieces end to end, ``sizes`` their lengths."""
        self.alphabet, ranks = np.unique(pieces, return_inverse=True)
        n = len(pieces) + len(sizes)
        # Symbol 0 closes each piece.
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        text[inside] = ranks + 1
        self.piece = np.repeat(np.arange(len(sizes)), sizes + 1)
        rank, span = text, 1
        while span < depth:
            ahead = np.zeros(n, dtype=np.int64)
            ahead[: n - span] = rank[span:]
            pair = rank * (int(rank.max()) + 1) + ahead
            rank = np.unique(pair, return_inverse=True)[1]
            span *= 2
        self.order = np.argsort(rank, kind="stable")
        self.text = text
        before = text[self.order - 1]
        self.sigma = len(self.alphabet) + 1
        self.wavelet = WaveletMatrix(before, self.sigma)
        counts = np.bincount(text, minlength=self.sigma)
        self.first = np.cumsum(counts) - counts
        # Where each symbol's block begins in the last level of the wavelet matrix.
        self.base = self.wavelet.descend(np.arange(self.sigma), np.zeros(self.sigma, dtype=np.int64))

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with ``symbol`` put in front."""
        shift = self.first[symbol] - self.base[symbol]
        return (
            shift + self.wavelet.descend(symbol, low),
            shift + self.wavelet.descend(symbol, high),
        )

    def matches(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts of ``length`` symbols ending before each place of ``ends`` in the index's own text.

        Gives the interval of suffixes that begin with the longest part of them, read from its end, that
        occurs more than once, and that part's length: the matching statistics up to ``length``.
        """
        low = np.zeros(len(ends), dtype=np.int64)
        high = np.full(len(ends), len(self.text), dtype=np.int64)
        size = np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        for step in range(1, length + 1):
            symbol = self.text[ends[live] - step]
            new_low, new_high = self.extend(low[live], high[live], symbol)
            more = new_high - new_low > 1
            live = live[more]
            low[live], high[live], size[live] = new_low[more], new_high[more], step
            if len(live) == 0:
                break
        return low, high, size
