"""An FM-index over the words of one shard of training texts.

The text is a sequence of small integers.  Its suffix order gives the Burrows-Wheeler
sequence, held as a wavelet matrix; backward search through the matrix's ranks finds the
range of suffixes that start with a phrase, and suffix positions sampled at every
``SAMPLE``-th place of the text turn a range into places.  All searches of a shard run
at once as vector operations.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of text in order; a suffix sorts before its extensions.

    Prefix doubling: ranks by 2k symbols from pairs of ranks by k; only suffixes whose
    rank is shared are sorted again.
    """
    n = len(text)
    width = max(1, int(text.max(initial=0)).bit_length())
    step = min(max(1, 62 // (width + 1)), 16)
    padded = np.concatenate((text.astype(np.int64) + 1, np.zeros(step, np.int64)))
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = (key << (width + 1)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    apart = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    first = np.maximum.accumulate(np.where(apart, np.arange(n), 0))
    rank[order] = first
    open_ = np.flatnonzero(~apart | ~np.append(apart[1:], True)) if n else np.array([], np.int64)
    while len(open_):
        at = order[open_]
        after = at + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        head = rank[at]
        by = np.lexsort((second, head))
        at, head, second = at[by], head[by], second[by]
        order[open_] = at
        apart = np.concatenate(([True], (head[1:] != head[:-1]) | (second[1:] != second[:-1])))
        first = np.maximum.accumulate(np.where(apart, open_, 0))
        rank[at] = first
        keep = ~apart | ~np.append(apart[1:], True)
        open_ = open_[keep]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks over a sequence of integers below 2 ** width."""

    def __init__(self, values: np.ndarray, width: int) -> None:
        self.n, self.width = len(values), width
        self.bits, self.counts, self.zeros = [], [], []
        now = values
        for level in range(width - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            packed = np.packbits(np.append(bit, np.zeros(64 + -len(bit) % 64, bool)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1])
            self.zeros.append(len(bit) - int(bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a level."""
        word, left = at >> 6, (at & 63).astype(np.uint64)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & ((np.uint64(1) << left) - np.uint64(1)))

    def ranks(self, symbol: np.ndarray, *at: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands before each place, for one or more arrays of places."""
        start = np.zeros(len(symbol), np.int64)
        places = list(at)
        for level in range(self.width):
            one = ((symbol >> (self.width - 1 - level)) & 1).astype(bool)
            moved = []
            for p in (start, *places):
                ones = self._ones(level, p)
                moved.append(np.where(one, self.zeros[level] + ones, p - ones))
            start, *places = moved
        return [p - start for p in places]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and how often each stands before its place."""
        symbol, start, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at
        for level in range(self.width):
            ones = self._ones(level, place)
            after = self._ones(level, place + 1)
            one = after > ones
            before = self._ones(level, start)
            symbol = (symbol << 1) | one
            start = np.where(one, self.zeros[level] + before, start - before)
            place = np.where(one, self.zeros[level] + ones, place - ones)
        return symbol, place - start


class FmIndex:
    """Counts and places of phrases in a sequence of integers >= 1."""

    def __init__(self, text: np.ndarray) -> None:
        ended = np.append(text.astype(np.int64), 0)
        order = suffix_order(ended)
        self.n = len(ended)
        width = max(1, int(ended.max()).bit_length())
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(ended, minlength=1 << width))))
        self.bwt = WaveletMatrix(ended[order - 1], width)
        marked = order % SAMPLE == 0
        self.marks = WaveletMatrix(marked.astype(np.int64), 1)
        self.sampled = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases, all of one length, a row each."""
        n, k = phrases.shape
        return self.search_at(phrases.ravel(), np.arange(n) * k, k)

    def search_at(self, sequence: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases of one length that begin at places of a sequence."""
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), self.n)
        live = np.arange(len(starts))
        top = len(self.starts) - 1
        for step in range(length - 1, -1, -1):
            symbol = sequence[starts[live] + step].astype(np.int64)
            known = symbol < top
            hi[live[~known]] = lo[live[~known]]
            live, symbol = live[known], symbol[known]
            a, b = self.bwt.ranks(symbol, lo[live], hi[live])
            lo[live], hi[live] = self.starts[symbol] + a, self.starts[symbol] + b
            live = live[hi[live] > lo[live]]
            if not len(live):
                break
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes: steps back to the nearest sampled suffix."""
        out, steps = np.empty(len(rows), np.int64), 0
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            ones = self.marks._ones(0, at)
            here = self.marks._ones(0, at + 1) > ones
            out[live[here]] = self.sampled[ones[here]] + steps
            live, at = live[~here], at[~here]
            symbol, before = self.bwt.access(at)
            at = self.starts[symbol] + before
            steps += 1
        return out
