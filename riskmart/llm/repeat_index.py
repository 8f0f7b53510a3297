"""Run-length index of a shard: Burrows-Wheeler runs, suffixes sampled at their ends, and matching statistics.

The suffixes of the texts are sorted; the symbol before each, in that order, is the Burrows-Wheeler transform.
Texts that repeat give few, long runs of it. Where a suffix and its neighbour are preceded by the same symbol,
so are the suffixes one place earlier neighbours, with a match one longer. So the match lengths need to be
known only where a run begins (against the suffix before) and where one ends (against the suffix after): from
each such sample on, the matching statistic falls by one with every byte until the next sample.
"""

from __future__ import annotations

import numpy as np

WAYS = 3  # ranks put together in one step of the sort
RANK_BITS = 21


class RunLengthIndex:
    """Index of ``raw``, the texts one after the other, each followed by one byte that stands for its end.

    ``ends`` are the places of these bytes. Ends differ from all bytes and from each other, earlier ones
    being smaller, so no match crosses one. At most 2 ** 21 - 2 bytes.
    """

    def __init__(self, raw: np.ndarray, ends: np.ndarray):
        self.n = len(raw)
        if self.n > (1 << RANK_BITS) - 2:
            raise ValueError("too many bytes for one index")
        self.end_of = ends[np.searchsorted(ends, np.arange(self.n))] if self.n else ends
        self.symbols = raw.astype(np.int64) + 1
        self.symbols[ends] = 0
        self._sort()
        before = np.concatenate((self.symbols[-1:], self.symbols))[self.order]
        # A text's first suffix has an end before it, which differs from every other.
        change = np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0)) if self.n else np.zeros(0, bool)
        self.heads = np.flatnonzero(change)  # rows where a run begins
        self.tails = np.append(self.heads[1:], self.n) - 1 if self.n else self.heads

    def _sort(self) -> None:
        """Suffix order by ranks of ever longer prefixes; ``levels`` keeps (length, rank of that many bytes)."""
        # Eight bytes fit a key without their ends, 7 * 9 bits with them.
        n, length = self.n, 7
        padded = np.concatenate((self.symbols, np.zeros(length, np.int64)))
        key = np.zeros(n, np.int64)
        alive = np.ones(n, bool)  # the text has not ended yet
        for k in range(length):
            key = (key << 9) | np.where(alive, padded[k : k + n], 0)
            alive &= padded[k : k + n] != 0
        self.levels: list[tuple[int, np.ndarray]] = []
        place = np.arange(n)
        longest = int((self.end_of - place).max()) + 1 if n else 0
        while True:
            order = np.argsort(key, kind="stable")
            sorted_keys = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(1, sorted_keys[1:] != sorted_keys[:-1])) if n else 0
            self.levels.append((length, rank))
            if length >= longest:
                break
            key = rank
            for k in range(1, WAYS):
                at = place + k * length
                inside = at <= self.end_of
                key = (key << RANK_BITS) | np.where(inside, rank[np.minimum(at, n - 1)], 0)
            length *= WAYS
        self.order = order  # equal to their ends: the earlier text first, as the sort is stable

    def common(self, a: np.ndarray, b: np.ndarray, least: int = 0) -> np.ndarray:
        """Match lengths of suffixes at a and b, from the longest prefixes down; 0 where they match in fewer than ``least`` bytes."""
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        room = np.minimum(self.end_of[a] - a, self.end_of[b] - b)
        chosen = np.flatnonzero(room >= least)
        for length, rank in reversed(self.levels):
            if length <= least:  # one look tells most pairs apart
                chosen = chosen[rank[a[chosen]] == rank[b[chosen]]]
                break
        x, y, room = a[chosen], b[chosen], room[chosen]
        same = np.zeros(len(x), np.int64)
        for length, rank in reversed(self.levels):
            for _ in range(WAYS if length < self.levels[-1][0] else 1):
                ok = same + length <= room
                p, q = np.where(ok, x + same, 0), np.where(ok, y + same, 0)
                same += np.where(ok & (rank[p] == rank[q]), length, 0)
        for _ in range(self.levels[0][0] if self.levels else 0):
            p, q = x + same, y + same
            same += (same < room) & (self.symbols[p] == self.symbols[q])
        out = np.zeros(len(a), np.int64)
        out[chosen] = np.where(same >= least, same, 0)
        return out

    def samples(self, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places of the sampled suffixes, and the length each shares with the neighbour outside its run, if ``least`` or more."""
        heads, tails = self.heads[self.heads > 0], self.tails[self.tails < self.n - 1]
        at = np.concatenate((self.order[heads], self.order[tails]))
        other = np.concatenate((self.order[heads - 1], self.order[tails + 1]))
        length = self.common(at, other, least)
        keep = length > 0
        return at[keep], length[keep]

    def statistics(self) -> np.ndarray:
        """For every place the length of the longest match that starts there and somewhere else."""
        at, length = self.samples()
        reach = np.zeros(self.n, np.int64)
        np.maximum.at(reach, at, at + length)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0) if self.n else reach

    def repeated(self, window: int) -> np.ndarray:
        """Which bytes a string of ``window`` bytes covers that starts somewhere else too."""
        at, length = self.samples(window)
        edges = np.zeros(self.n + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        return np.cumsum(edges[:-1]) > 0
