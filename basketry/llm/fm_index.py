"""FM-index over word sequences: backward search on a wavelet matrix, in numpy.

The text is the sequences one after another, each followed by a separator.
Suffixes are sorted up to ``depth`` words, which is enough for patterns of up to
``depth`` words.  The Burrows-Wheeler transform is kept as bit planes (one for
each bit of a word's number) with a running count every 64 bits; nothing else
of the text is needed for a search.  Searches of many patterns advance together,
one word at a time.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` symbols or more, by doubling."""
    n = len(text)
    rank = text.astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank, width = new, 2 * width
        if width >= depth or rank[order[-1]] == n - 1:
            return order


class BitPlane:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, place: np.ndarray) -> np.ndarray:
        block = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Index of sequences of symbols (each at least 1) with a weight for each sequence."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, depth: int):
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.text = np.zeros(int(self.starts[-1]), np.int64)
        for start, sequence in zip(self.starts, sequences):
            self.text[start : start + len(sequence)] = sequence
        self.size = len(self.text)
        order = suffix_order(self.text, depth)
        owner = np.repeat(np.arange(len(sequences)), lengths + 1)
        self.weight_before = np.concatenate([[0], np.cumsum(np.asarray(weights, np.int64)[owner[order]])])
        bwt = self.text[order - 1]
        symbols = int(self.text.max(initial=0)) + 1
        counts = np.bincount(self.text, minlength=symbols)
        first = np.concatenate([[0], np.cumsum(counts)])[:symbols]
        self.planes: list[tuple[int, BitPlane]] = []
        base = np.arange(symbols)  # where each symbol's run begins below the last plane
        place = np.zeros(symbols, np.int64)
        for bit in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bits = (bwt >> bit & 1).astype(np.uint8)
            plane = BitPlane(bits)
            self.planes.append((bit, plane))
            ones = plane.ones(place)
            place = np.where(base >> bit & 1, plane.zeros + ones, place - ones)
            bwt = np.concatenate([bwt[bits == 0], bwt[bits == 1]])
        self.shift = first - place
        self.symbols = symbols

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that start with ``symbol`` and go on like the rows low..high."""
        place = np.concatenate([low, high])
        both = np.concatenate([symbol, symbol])
        for bit, plane in self.planes:
            ones = plane.ones(place)
            place = np.where(both >> bit & 1, plane.zeros + ones, place - ones)
        place = place + self.shift[both]
        return place[: len(low)], place[len(low) :]

    def reach(self, text: np.ndarray, ends: np.ndarray, stops: np.ndarray, least: int) -> np.ndarray:
        """Matching statistics: smallest j >= stop such that text[j..end] has weight ``least`` or more in the index.

        end + 1 if not even the last symbol has.  Symbols that the index does not
        know (0 or beyond its own) end a match.
        """
        found = ends + 1
        active = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        at = ends.copy()
        while len(active):
            symbol = text[at[active]]
            known = (symbol > 0) & (symbol < self.symbols)
            active, symbol = active[known], symbol[known]
            a, b = self.step(low[active], high[active], symbol)
            enough = self.weight_before[b] - self.weight_before[a] >= least
            active = active[enough]
            low[active], high[active] = a[enough], b[enough]
            found[active] = at[active]
            at[active] -= 1
            active = active[at[active] >= stops[active]]
        return found


def repeated_starts(
    index: FMIndex, text: np.ndarray, first: np.ndarray, last: np.ndarray, window: int, least: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of window starts in ``text`` whose windows have weight ``least`` or more in the index.

    Query q asks for the starts first[q] .. last[q]; the result holds arrays
    (query, first start, last start).  Each round asks for the matching statistics
    at the end of the last window (all starts from there on are found, the one
    before is open) and at the end of the first one (a miss at j settles all
    starts up to j).
    """
    a, b = first.astype(np.int64).copy(), last.astype(np.int64).copy()
    out = []
    open_queries = np.flatnonzero(a <= b)
    while len(open_queries):
        q = open_queries
        j = index.reach(text, b[q] + window - 1, a[q], least)
        hit = j <= b[q]
        out.append((q[hit], j[hit], b[q][hit]))
        b[q] = np.where(hit, j, b[q]) - 1
        q = q[a[q] <= b[q]]
        if len(q):
            j = index.reach(text, a[q] + window - 1, a[q], least)
            hit = j <= a[q]
            out.append((q[hit], a[q][hit], a[q][hit]))
            a[q] = np.where(hit, a[q] + 1, j)
        open_queries = q[a[q] <= b[q]]
    return out
