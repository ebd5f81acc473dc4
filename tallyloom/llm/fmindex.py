"""A compressed full-text index over word sequences: suffix array, Burrows-Wheeler transform, wavelet matrix.

The sequences of a shard are searched all at once: a backward step takes a vector
of intervals one word to the left, with two rank queries per bit of the alphabet.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank queries over a sequence of symbols below ``1 << bits``."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            ones = (now >> level) & 1
            self.levels.append(BitVector(ones.astype(np.uint8)))
            self.zeros.append(int(len(now) - ones.sum()))
            now = np.concatenate([now[ones == 0], now[ones == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` comes out among the entries of ``symbol``, in the order of the last level."""
        for k, (vector, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = vector.ones(at)
            at = np.where((symbol >> (self.bits - 1 - k)) & 1 == 1, zeros + ones, at - ones)
        return at


def suffix_array(symbols: np.ndarray, enough: int | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Order of all suffixes, and for each power of two below the last the rank of each suffix by that many symbols.

    Prefix doubling; it ends when all suffixes differ, so unique separators keep it as short as the sequences, or when
    they are in order by their first ``enough`` symbols. Suffixes with a common start of any length up to that lie
    together either way, which is all that a backward search for patterns of that length asks for.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    ranks, width = {1: rank}, 1
    while True:
        key = rank * (n + 1)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key)
        steps = np.empty(n, dtype=np.int64)
        steps[0] = 0
        ordered = key[order]
        np.cumsum(ordered[1:] != ordered[:-1], out=steps[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        width *= 2
        ranks[width] = rank
        if steps[-1] == n - 1 or enough is not None and width >= enough:
            return order, ranks


class FMIndex:
    """An index of word sequences, each with a weight (how many documents hold it)."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, weights: np.ndarray, longest: int | None = None):
        """``words``: the sequences one behind the other, as numbers from 0. A separator of its own ends each.

        ``longest``: the most words of a pattern that is searched for; any, if not given.
        """
        self.sizes = sizes.astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]]).astype(np.int64)
        m = len(self.sizes)
        self.text = np.empty(len(words) + m, dtype=np.int64)
        ends = self.begins + self.sizes
        inside = np.ones(len(self.text), dtype=bool)
        inside[ends] = False
        self.text[inside] = words + m
        self.text[ends] = np.arange(m)
        self.order, self.ranks = suffix_array(self.text, longest)
        n = len(self.text)
        # Separators are all 0 in the transform, they are never searched for.
        self.symbols = np.maximum(self.text - (m - 1), 0)
        transform = self.symbols[self.order - 1]
        bits = max(1, int(self.symbols.max()).bit_length())
        self.wavelet = WaveletMatrix(transform, bits)
        # Suffixes that begin with a smaller symbol come first, and the last level lists entries by symbol reversed in
        # bits; so a symbol's first entry there is taken off and its first suffix added.
        counts = np.bincount(self.symbols, minlength=1 << bits if bits < 22 else int(self.symbols.max()) + 1)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(m), self.sizes + 1)
        self.weight_before = np.concatenate([[0], np.cumsum(weights[owner[self.order]])])
        self.n = n

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``symbol`` followed by what the intervals ``[low, high)`` stand for."""
        first = self.wavelet.descend(symbol, np.zeros_like(low))
        base = self.smaller[symbol] - first
        return self.wavelet.descend(symbol, low) + base, self.wavelet.descend(symbol, high) + base

    def same_start(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place in suffix order, the interval of suffixes that share its first ``width`` symbols."""
        power = 1 << (width.bit_length() - 1)
        if power not in self.ranks:
            # All suffixes differ before that many symbols.
            places = np.arange(self.n)
            return places, places + 1
        one = self.ranks[power][self.order]
        shifted = np.minimum(self.order + width - power, self.n - 1)
        two = self.ranks[power][shifted]
        new = np.concatenate([[True], (np.diff(one) != 0) | (np.diff(two) != 0)])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        return starts[group], np.concatenate([starts[1:], [self.n]])[group]

    def occurrences(self, width: int) -> list[np.ndarray]:
        """Matching statistics of the indexed sequences at one width: the weight of each window's occurrences.

        All sequences are streamed at once from their ends. A match grows by backward steps until it is ``width``
        words long; then it is cut by one word on the right - its interval widens to the suffixes that share the
        rest - before it grows again on the left. So a word costs one step, however many windows it lies in.
        """
        wider_low, wider_high = self.same_start(width - 1)
        m = len(self.sizes)
        windows = np.maximum(0, self.sizes - width + 1)
        ends = np.cumsum(windows)
        found = np.zeros(int(ends[-1]) if m else 0, dtype=np.int64)
        low, high = np.zeros(m, dtype=np.int64), np.full(m, self.n, dtype=np.int64)
        by_size = np.argsort(-self.sizes, kind="stable")
        for done in range(int(self.sizes.max(initial=0))):
            who = by_size[:np.searchsorted(-self.sizes[by_size], -done, side="left")]
            at = self.sizes[who] - 1 - done
            lo, hi = low[who], high[who]
            if done >= width:
                lo, hi = wider_low[lo], wider_high[lo]
            lo, hi = self.step(self.symbols[self.begins[who] + at], lo, hi)
            low[who], high[who] = lo, hi
            if done >= width - 1:
                found[ends[who] - windows[who] + at] = self.weight_before[hi] - self.weight_before[lo]
        return np.split(found, ends[:-1]) if m else []
