"""A compressed FM-index over integer sequences: wavelet matrices in packed bits, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


#: The bits below each place of a word.
_BELOW = np.array([(1 << i) - 1 for i in range(64)], np.uint64)


class Bits:
    """A bit vector with constant-time rank: packed words and a count before each."""

    __slots__ = ("before", "words")

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))[:-1].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & _BELOW[i & 63])


class WaveletMatrix:
    """A sequence of numbers below 2**levels, a bit vector for each level."""

    def __init__(self, values: np.ndarray, levels: int):
        self.bits, self.zeros, self.shifts = [], [], range(levels - 1, -1, -1)
        for shift in self.shifts:
            one = (values >> shift & 1).astype(np.uint8)
            self.bits.append(Bits(one))
            self.zeros.append(len(one) - int(one.sum()))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def walk(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the position is sent on the way of ``value``: differences count occurrences."""
        for shift, bits, zeros in zip(self.shifts, self.bits, self.zeros, strict=True):
            ones = bits.rank(i)
            i = np.where(value >> shift & 1, zeros + ones, i - ones)
        return i

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest number in each range low .. high, none of them empty."""
        out = np.zeros(len(low), np.int64)
        for shift, bits, zeros in zip(self.shifts, self.bits, self.zeros, strict=True):
            a, b = bits.rank(low), bits.rank(high)
            right = (high - b) == (low - a)  # no zero in the range
            low, high = np.where(right, zeros + a, low - a), np.where(right, zeros + b, high - b)
            out |= right.astype(np.int64) << shift
        return out


class FMIndex:
    """Index of documents, sequences of symbols 1 .. sigma, for patterns of at most ``depth`` symbols.

    ``text`` has a 0 after each document. Suffixes are sorted by their first ``depth`` symbols or
    more (prefix doubling), which is all that such patterns tell apart. What stays is the
    Burrows-Wheeler transform and the document of each row, both as wavelet matrices, and the
    symbols' counts; no suffix array.
    """

    def __init__(self, text: np.ndarray, document: np.ndarray, depth: int):
        # symbol 0 is the end of the text; the empty suffix, which starts there, has a row too
        text = np.append(text.astype(np.int64) + 1, 0)
        n, sigma = len(text), int(text.max()) + 1
        # as many symbols at once as fit into a number, then twice as many in each round
        bits = int(sigma + 1).bit_length()
        together = max(1, min(depth, 62 // bits))
        rank, known = np.zeros(n, np.int64), together
        for i in range(together):
            rank[: n - i] |= (text[i:] + 1) << bits * (together - 1 - i)
        rank = np.unique(rank, return_inverse=True)[1] + 1
        while known < depth:
            follow = np.zeros(n, np.int64)
            follow[: max(0, n - known)] = rank[known:]
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + follow, return_inverse=True)[1] + 1
            known *= 2
        suffixes = np.argsort(rank, kind="stable")
        self.n, self.sigma = n, sigma
        # the row of the suffix that starts at 0 has no symbol before it: one that no pattern holds
        last = np.where(suffixes > 0, text[suffixes - 1], sigma)
        self.count = np.append(0, np.cumsum(np.bincount(text, minlength=sigma)))
        self.transform = WaveletMatrix(last, max(1, int(sigma).bit_length()))
        documents = np.append(document, 0)[suffixes]
        self.documents = WaveletMatrix(documents, max(1, int(documents.max(initial=0)).bit_length()))
        self.first = self.transform.walk(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them."""
        symbol = symbol + 1
        both = self.transform.walk(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.count[symbol] - self.first[symbol]
        return base + both[: len(symbol)], base + both[len(symbol) :]

    def statistics(self, stream: np.ndarray, ends: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a stream of symbols, held at ``threshold``, at each position in ``ends``.

        The statistic is the length of the longest piece that ends just before the position and that the
        index holds twice at least (once is the streamed document itself), found by backward search, a symbol
        more in each step. Also the interval of rows of each piece that reaches the threshold.
        """
        reached = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for step in range(1, threshold + 1):
            symbol = stream[ends[live] - step]
            low, high = self.extend(symbol, low, high) if step > 1 else (self.count[symbol + 1], self.count[symbol + 2])
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            reached[live] = step
        return reached, low, high
