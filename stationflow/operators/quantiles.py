"""Quantile summaries of many columns, gathered while their rows pass by.

The same summaries as ``percentile_approx`` keeps at an accuracy of 1000 (Greenwald
and Khanna), on whole arrays: its values are taken in by 50000, in their order, and
summaries of partitions are merged in the order of the partitions. So a table that is
being written needs no pass of its own for the cut points of its columns.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The error of a rank, as a share of the rows.
ERROR = 1 / 1000
# Values that are sorted at once.
HEAD = 50000


class Summary(NamedTuple):
    """Some of the values in order; ``g`` is how many a value stands for, ``delta`` how far its rank may be off."""

    count: int
    value: np.ndarray
    g: np.ndarray
    delta: np.ndarray

    @classmethod
    def empty(cls) -> Summary:
        return cls(0, np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))

    @classmethod
    def read(cls, raw: bytes) -> Summary:
        n = (len(raw) - 8) // 24
        whole = np.frombuffer(raw, np.int64)
        return cls(int(whole[0]), np.frombuffer(raw, float, n, 8), whole[1 + n : 1 + 2 * n], whole[1 + 2 * n :])

    def written(self) -> bytes:
        return np.int64(self.count).tobytes() + self.value.tobytes() + self.g.tobytes() + self.delta.tobytes()

    def add(self, values: np.ndarray) -> Summary:
        """With more values, ``HEAD`` at most."""
        if not len(values):
            return self
        new = np.sort(values)
        delta = np.floor(2 * ERROR * (self.count + np.arange(1, len(new) + 1))).astype(np.int64)
        old = np.zeros(len(self.value) + len(new), bool)
        old[np.arange(len(self.value)) + np.searchsorted(new, self.value, "left")] = True
        # The ends are known for sure.
        if not old[0]:
            delta[0] = 0
        if not old[-1]:
            delta[-1] = 0
        out = Summary(self.count + len(new), np.empty(len(old)), np.ones(len(old), np.int64), np.empty(len(old), np.int64))
        out.value[old], out.value[~old] = self.value, new
        out.g[old] = self.g
        out.delta[old], out.delta[~old] = self.delta, delta
        return out.compressed()

    def compressed(self) -> Summary:
        """Neighbours as one, as far as the error allows, from the largest down; the least value stays."""
        n = len(self.value)
        if n < 2:
            return self
        until = self.g.cumsum()
        # For each value the nearest one below that it cannot stand for.
        least = np.searchsorted(until.astype(float), until + self.delta - 2 * ERROR * self.count, "right")
        below = memoryview(np.minimum(least, np.arange(n) - 1))
        heads, at = [], n - 1
        while at >= 1:
            heads.append(at)
            at = below[at]
        heads = np.array([0, *reversed(heads)])
        return Summary(self.count, self.value[heads], np.diff(until[heads], prepend=0), self.delta[heads])

    def merge(self, other: Summary) -> Summary:
        if not other.count or not self.count:
            return self if self.count else other
        mine = np.searchsorted(other.value, self.value, "right")
        theirs = np.searchsorted(self.value, other.value, "left")
        n = len(self.value) + len(other.value)
        out = Summary(self.count + other.count, np.empty(n), np.empty(n, np.int64), np.empty(n, np.int64))
        for one, before, two in ((self, mine, other), (other, theirs, self)):
            at = np.arange(len(before)) + before
            off = np.where((before > 0) & (before < len(two.value)), int(2 * ERROR * two.count), 0)
            out.value[at], out.g[at], out.delta[at] = one.value, one.g, one.delta + off
        return out.compressed()

    def quantiles(self, shares: Sequence[float]) -> list[float]:
        """The values at the given shares of the rows, in rising order."""
        if not self.count:
            return []
        off, ranks = float((self.g + self.delta).max()) / 2, self.g.cumsum().tolist()
        value, delta, out, at = self.value.tolist(), self.delta.tolist(), [], 0
        for share in shares:
            if share <= ERROR or len(value) == 1:
                out.append(value[0])
            elif share >= 1 - ERROR:
                out.append(value[-1])
            else:
                rank = int(np.ceil(share * self.count))
                while at < len(value) - 1 and not ranks[at] + delta[at] - off <= rank <= ranks[at] + off:
                    at += 1
                out.append(value[at])
        return out


class Learner:
    """Summaries of columns whose values come in batches."""

    def __init__(self, columns: int):
        self.summaries, self.head, self.size = [Summary.empty() for _ in range(columns)], np.empty((columns, HEAD)), 0

    def add(self, columns: Sequence[np.ndarray]) -> None:
        n = len(columns[0]) if len(columns) else 0
        first = 0
        while first < n:
            more = min(HEAD - self.size, n - first)
            for own, column in zip(self.head, columns, strict=True):
                own[self.size : self.size + more] = column[first : first + more]
            first, self.size = first + more, self.size + more
            if self.size == HEAD:
                self.close()

    def close(self) -> list[Summary]:
        """The summaries of all values so far."""
        self.summaries = [s.add(own[: self.size]) for s, own in zip(self.summaries, self.head, strict=True)]
        self.size = 0
        return self.summaries
