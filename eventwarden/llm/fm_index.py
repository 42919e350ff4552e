"""An FM-index over a shard's word sequences, in numpy: wavelet matrix, backward search.

Queries run side by side as arrays: one step of the search extends all of them by a word.
"""

from __future__ import annotations

import numpy as np


def prefix_classes(text: np.ndarray, depth: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by their first ``depth`` words, and the rank of each by half as many.

    Prefix doubling; ``depth`` is a power of two.
    """
    n = len(text)
    rank, size = text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max(initial=0)) + 2)
        key[:max(n - size, 0)] += rank[size:] + 1
        order = np.argsort(key, kind="stable")
        if size * 2 >= depth:
            return order, rank
        ordered = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        rank, size = fresh, size * 2


class Bits:
    """A bit sequence with the number of ones before any place: packed words and their sums."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.sums = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int64)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[word] + np.bitwise_count(self.words[word] & low)


class FmIndex:
    """Index of ``text``: word numbers from 1, 0 between sequences and at the end.

    Finds patterns of up to ``window`` words (33 to 64): suffixes are ordered by their first 64
    words, which orders all that such a pattern can tell apart.
    """

    def __init__(self, text: np.ndarray, window: int):
        self.size, self.window = len(text), window
        self.order, half = prefix_classes(text)
        half = np.concatenate([half, np.full(64, -1)])
        bwt = text[self.order - 1]
        counts = np.bincount(text)
        self.before = np.cumsum(counts) - counts
        self.levels: list[tuple[int, Bits]] = []
        symbols, row = np.arange(len(counts)), bwt
        start = np.zeros(len(counts), np.int64)
        for bit in reversed(range(max(1, int(len(counts) - 1).bit_length()))):
            level = Bits((row >> bit & 1).astype(np.uint8))
            self.levels.append((bit, level))
            ones = level.ones(start)
            start = np.where(symbols >> bit & 1, level.zeros + ones, start - ones)
            one = (row >> bit & 1).astype(bool)
            row = np.concatenate([row[~one], row[one]])
        self.base = self.before - start  # from a place in the last level to one in the order
        self.shorter = self._groups(half, window - 1)
        self.whole = self._groups(half, window)

    def _groups(self, half: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the order its group of suffixes with the same first ``depth`` words, and the groups' starts."""
        a, b = self.order[1:], self.order[:-1]
        same = (half[a] == half[b]) & (half[a + depth - 32] == half[b + depth - 32])
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        return np.cumsum(np.concatenate([[0], ~same])), np.append(starts, self.size)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` put in front."""
        at, twice = np.concatenate([low, high]), np.concatenate([symbol, symbol])
        for bit, level in self.levels:
            ones = level.ones(at)
            at = np.where(twice >> bit & 1, level.zeros + ones, at - ones)
        at += self.base[twice]
        return at[:len(low)], at[len(low):]

    def match(self, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Streams ``text`` from each ``last`` window back to each ``first``: the group of every window found.

        Returns an array by place in ``text``: a number in ``self.whole``'s groups where a window
        begins that was searched, -1 elsewhere.  Matching statistics are kept at the window's
        length: a match that is as long first drops its last word, which widens its interval to
        the group of suffixes with the shorter beginning, and then takes the next word in front.
        """
        found = np.full(len(text), -1, np.int64)
        steps = last - first + self.window
        order = np.argsort(-steps, kind="stable")
        steps, end = steps[order], (last + self.window)[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.size, np.int64)
        group, starts = self.shorter
        for step in range(int(steps.max(initial=0))):
            active = int(np.searchsorted(-steps, -step, side="left"))
            low, high, at = low[:active], high[:active], end[:active] - 1 - step
            if step >= self.window:
                g = group[low]
                low, high = starts[g], starts[g + 1]
            low, high = self.extend(text[at], low, high)
            if not (low < high).all():
                raise RuntimeError("a streamed window is missing in its own shard's index")
            if step >= self.window - 1:
                found[at] = self.whole[0][low]
        return found
