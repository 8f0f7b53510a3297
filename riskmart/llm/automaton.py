"""Suffix automaton of many word sequences, with the smallest document number behind each state."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """All runs of words of the sequences added. ``first[state]`` is set by ``finish``."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first: list[float] = [float("inf")]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.first.append(float("inf"))
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of p's longest run followed by w, cut out of q where q also holds longer runs."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: Sequence[int], number: int) -> None:
        """Add one sequence of document ``number``."""
        follow, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for w in words:
            q = follow[last].get(w)
            if q is not None:
                last = self._split(last, q, w)
            else:
                new, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and w not in follow[p]:
                    follow[p][w] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, follow[p][w], w)
                last = new
            if number < first[last]:
                first[last] = number

    def finish(self) -> None:
        """Hand the smallest numbers down the links: a state's runs end wherever those of the states above it do."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.first[state] < self.first[up]:
                self.first[up] = self.first[state]

    def firsts(self, words: Sequence[int], window: int) -> list[float]:
        """For each run of ``window`` words: the smallest number of a sequence that holds it, or infinity.

        The walk keeps the longest match that ends at each word (its matching statistic), cut to ``window``.
        """
        follow, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        out = []
        for i, w in enumerate(words):
            while state and w not in follow[state]:
                state = link[state]
                matched = length[state]
            if w in follow[state]:
                state = follow[state][w]
                matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                matched = min(matched, length[state])
            if i >= window - 1:
                out.append(first[state] if matched >= window else float("inf"))
        return out
