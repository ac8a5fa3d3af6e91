"""FM-index over one shard of word ids: suffix sorting, wavelet ranks, backward search and locate."""

from __future__ import annotations

import numpy as np

END, BREAK, FIRST_WORD = 0, 1, 2


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Order of the suffixes of ``text``, whose last symbol must occur nowhere else.

    The first sort looks at as many symbols as fit in 62 bits; later rounds double the length
    and sort only suffixes that are still tied, so repeated passages cost a logarithm.
    """
    n = len(text)
    length = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(length):
        key <<= bits
        key[:n - k] |= text[k:] if k < n else 0
    order = np.argsort(key)
    ordered = key[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    slot = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = slot, -1
    while True:
        tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(tied):
            return order
        suffix = order[tied]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + length, n)] + 1
        by = np.argsort(key)
        order[tied], key = suffix[by], key[by]
        head[tied[1:]] |= key[1:] != key[:-1]
        slot = np.maximum.accumulate(np.where(head[tied], tied, 0))
        rank[order[tied]] = slot
        length *= 2


class FMIndex:
    """Index of a text of word ids (``FIRST_WORD`` and above, ``BREAK`` between runs, ``END`` once at the end)."""

    def __init__(self, text: np.ndarray, sample: int = 16):
        n = len(text)
        self.bits = max(1, int(text.max()).bit_length())
        order = suffix_order(text, self.bits)
        symbols = text[order - 1]
        counts = np.bincount(text, minlength=(1 << self.bits) + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        # Wavelet matrix: zeros before every place, level by level from the highest bit.
        self.levels = []
        for level in reversed(range(self.bits)):
            bit = (symbols >> level) & 1
            zeros = np.zeros(n + 1, np.int32)
            np.cumsum(1 - bit, out=zeros[1:])
            self.levels.append((level, zeros, int(zeros[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(1 << self.bits)
        self.base = self._descend(every, np.zeros(len(every), np.int64))
        marked = order % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]
        self.size = n

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, zeros, total in self.levels:
            low = zeros[place]
            place = np.where((symbol >> level) & 1, total + place - low, low)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place of the transformed text."""
        return self._descend(symbol, place) - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of many phrases, one per row, ends aligned right and filled up with -1 on the left.

        Gives the rows that occur and the bounds of their suffixes.
        """
        rows = np.arange(len(phrases))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), self.size, np.int64)
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[rows, column]
            step = symbol >= 0
            known = symbol < 1 << self.bits
            safe = np.where(step & known, symbol, 0)
            low = np.where(step, self.before[safe] + self.rank(safe, low), low)
            high = np.where(step, self.before[safe] + self.rank(safe, high), high)
            alive = (high > low) & (known | ~step)
            rows, low, high = rows[alive], low[alive], high[alive]
        return rows, low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions of the suffixes in every interval, with the interval's place in the input.

        Each suffix steps back through the text until it meets a sampled position.
        """
        count = high - low
        which = np.repeat(np.arange(len(low)), count)
        row = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        found = np.zeros(len(row), np.int64)
        open_ = np.arange(len(row))
        steps = 0
        while len(open_):
            at = row[open_]
            hit = self.marks[at + 1] > self.marks[at]
            found[open_[hit]] = self.sampled[self.marks[at[hit]]] + steps
            open_, place = open_[~hit], at[~hit]
            symbol = np.zeros(len(place), np.int64)
            for level, zeros, total in self.levels:
                lower = zeros[place]
                one = zeros[place + 1] == lower
                symbol |= one.astype(np.int64) << level
                place = np.where(one, total + place - lower, lower)
            row[open_] = self.before[symbol] + place - self.base[symbol]
            steps += 1
        return found, which
