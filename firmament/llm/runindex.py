"""Run-length index of short texts: a Burrows-Wheeler transform kept as runs, with the least origin of sorted intervals.

The index holds segments one after the other, each closed by a terminator of its own; terminators
are smaller than any byte and ordered like their segments.  A row of the transform is a suffix.
Runs carry their first row, their byte and where the step to the suffix one byte longer (LF)
begins, so a step is a look-up among the runs.  Suffixes that agree in their first ``length``
bytes are consecutive rows; for each such interval the smallest origin is sampled.

``earlier_matches`` streams the segments backwards through the index, all in step, and marks the
places whose next ``length`` bytes also start at an earlier origin.  The steps find the row of a place;
the interval of the row decides.  Samples at run ends are not read, and there are no matching statistics.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    def __init__(self, segments: np.ndarray, sizes: np.ndarray, origins: np.ndarray, length: int):
        """``segments``: bytes of all segments; ``origins``: rank of every byte's place in the corpus."""
        count, total = len(sizes), len(segments) + len(sizes)
        self.length, self.sizes = length, sizes
        close = np.cumsum(sizes + 1) - 1  # place of the terminators
        body = np.ones(total, bool)
        body[close] = False
        text = np.zeros(total, np.int64)
        text[body] = segments.astype(np.int64) + 1
        left = np.repeat(close, sizes + 1) - np.arange(total)  # bytes before the terminator
        origin = np.full(total, np.iinfo(np.int64).max)
        origin[body] = origins
        rows, classes = self._sort(text, left, length)
        before = text[rows - 1]
        before[rows == 0] = 0
        before[left[rows - 1] == 0] = 0  # the byte before a segment is a terminator
        change = np.concatenate([[True], before[1:] != before[:-1]])
        self.starts = np.flatnonzero(change)
        self.heads = before[self.starts]
        run = np.diff(np.append(self.starts, total))
        order = np.argsort(self.heads, kind="stable")
        self.steps = np.empty(len(run), np.int64)
        self.steps[order] = np.cumsum(run[order]) - run[order]  # rows by first byte are rows by (head, run)
        self.samples = origin[rows[np.append(self.starts[1:] - 1, total - 1)]]  # origins at run ends
        full = left[rows] >= length
        split = np.ones(total, bool)
        split[1:] = (classes[rows[1:]] != classes[rows[:-1]]) | ~full[1:] | ~full[:-1]
        self.intervals = np.flatnonzero(split)
        self.earliest = np.minimum.reduceat(origin[rows], self.intervals)
        self.first = np.arange(count)  # terminators are the smallest symbols, in order

    @staticmethod
    def _sort(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in suffix order and, for every place, the class of its first ``length`` bytes.

        Ranks by a few symbols are doubled in width until they reach past every terminator;
        equal suffixes then stand in the order of their segments.
        """
        total = len(text)
        used = np.zeros(258, np.int64)
        used[np.unique(text)] = 1
        dense = np.cumsum(used) - used[0]  # the terminator is 0
        bits = int(dense[-1]).bit_length() or 1
        width, classes = max(1, min(length, (63 - total.bit_length()) // bits)), None
        key = np.zeros(total, np.int64)
        symbols = dense[text]
        for j in range(width):
            key <<= bits
            reach = max(0, total - j)
            key[:reach] |= np.where(left[:reach] >= j, symbols[j:], 0)
        rank, rows = _ranks(key)
        while True:
            if classes is None and 2 * width >= length:
                classes = _pair(rank, left, length - width)
            if width > int(left.max()):
                return rows, rank if classes is None else classes
            rank, rows = _ranks(_pair(rank, left, width))
            width *= 2

    def step(self, row: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one byte longer."""
        run = np.searchsorted(self.starts, row, side="right") - 1
        return self.steps[run] + row - self.starts[run]

    def earlier_matches(self, origins: np.ndarray) -> np.ndarray:
        """For every byte of the segments: do the next ``length`` bytes also start at a smaller origin?"""
        found = np.zeros(len(origins), bool)
        ends = np.cumsum(self.sizes)
        order = np.argsort(-self.sizes, kind="stable")
        sizes, row = self.sizes[order], self.first[order]
        end = ends[order]
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            going = int(np.searchsorted(-sizes, -back, side="right"))
            row = self.step(row[:going])
            if back < self.length:
                continue
            place = end[:going] - back
            interval = np.searchsorted(self.intervals, row, side="right") - 1
            found[place] = self.earliest[interval] < origins[place]
        return found


def _pair(rank: np.ndarray, left: np.ndarray, ahead: int) -> np.ndarray:
    """Rank of a place joined with the rank ``ahead`` places on, 0 beyond the terminator."""
    total = len(rank)
    reach = max(0, total - ahead)
    out = (rank + 1) * (total + 1)
    out[:reach] += np.where(left[:reach] >= ahead, rank[ahead:] + 1, 0)
    return out


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the keys and the places in their order, equal keys by place."""
    bits = len(key).bit_length()
    rank = np.empty(len(key), np.int64)
    if int(key.max(initial=0)).bit_length() + bits <= 63:  # values sort faster than places
        ordered = np.sort((key << bits) | np.arange(len(key)))
        rows = ordered & ((1 << bits) - 1)
        ordered >>= bits
    else:
        rows = np.argsort(key, kind="stable")
        ordered = key[rows]
    rank[rows] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return rank, rows
