"""Periodic runs of words: a suffix automaton whose link tree is accessed as a link-cut tree.

The link tree of a suffix automaton holds, above the state of each prefix, all suffixes of that prefix.
The tree is kept as preferred paths (splay trees), and all states of a path share the place where their
words were last seen to end. A word that is appended accesses the path from its prefix's state to the root:
each segment met there ended last at some earlier place, and its longest words have the length of its lowest
state. Where the distance between the two ends is at most that length, the words between them stand twice in
a row: a square. Then the whole path takes the new end as its colour. Squares are extended to maximal runs.

A stretch that repeats itself at least four times leaves marks that are cheap to see: after its first period
every run of a few words was met before, at a distance of at most the period. Only stretches with such marks
for long enough (a necessary condition, taken from hashes of whole batches) go through the automaton, in
overlapping blocks of four times the longest period they can hold; no run is missed, and what one automaton
holds grows with the period and not with the text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskmart.llm.automaton import SuffixAutomaton
from riskmart.llm.tables import only
from riskmart.llm.textbytes import flat, slices, span_hash, word_hash, words

LEAST_WORDS, LEAST_EXPONENT = 6, 4
BLOCK_WORDS = 4096  # least length of a block; longer periods take longer blocks
NEAR = 8  # periods up to this are looked for word by word, longer ones by runs of as many words

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class LinkCut:
    """Preferred paths of a rooted forest (``up``: parent of each node, 0 for none), each with a colour."""

    def __init__(self, up: Sequence[int]):
        self.up = list(up)  # parent in the splay tree, or where the path hangs
        self.left = [0] * len(self.up)
        self.right = [0] * len(self.up)
        self.colour = [-1] * len(self.up)  # holds at the root of a splay tree, for all of its path

    def _turn(self, x: int, p: int) -> None:
        """Lift x above its splay parent p."""
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        self.colour[x] = self.colour[p]
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> None:
        """Make x the root of its splay tree; the colour moves along."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                straight = (left[p] == x) == (left[g] == p)
                self._turn(p if straight else x, g if straight else p)
            self._turn(x, up[x])

    def access(self, x: int, colour: int) -> Iterator[tuple[int, int]]:
        """(lowest node, colour) of each segment between x and its root, lowest first; then all take ``colour``."""
        up, right, colours = self.up, self.right, self.colour
        below = 0
        while x:
            self._splay(x)
            met = colours[x]
            yield x, met
            if right[x]:
                colours[right[x]] = met
            right[x] = below
            below, x = x, up[x]
        colours[below] = colour


def squares(ids: Sequence[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of squares: for each run that repeats its primitive period twice, one at every end from there on."""
    automaton = SuffixAutomaton()
    automaton.add(ids, 0)
    follow, length = automaton.next, automaton.length
    tree = LinkCut([0, *automaton.link[1:]])
    state = 0
    for i, w in enumerate(ids):
        state = follow[state][w]
        for low, last in tree.access(state, i):
            if 0 <= last and i - last <= length[low]:
                yield i, i - last


def _primitive(ids: Sequence[int], start: int, period: int) -> bool:
    """No shorter period: ``ids`` has period ``period`` for at least two periods from ``start`` on."""
    rest, p = period, 2
    while rest > 1:
        if rest % p == 0:
            step = period // p
            if ids[start : start + period] == ids[start + step : start + step + period]:
                return False
            while rest % p == 0:
                rest //= p
        p = p + 1 if p * p <= rest else rest
    return True


def runs(ids: list[int], regions: Sequence[tuple[int, int, int]], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of maximal runs, by start and period, with squares in ``regions``.

    A region (first word, word after the last, longest period asked for) is searched in blocks.
    """
    n, found = len(ids), {}
    for low, high, longest in regions:
        block = max(BLOCK_WORDS, 4 * longest)
        for at in range(low, max(low + 1, high - 2 * longest), block - 2 * longest):
            done: dict[int, int] = {}
            for i, q in squares(ids[at : min(at + block, high)]):
                i += at
                if i < done.get(q, 0):
                    continue
                a, b = i - 2 * q + 1, i + 1
                while a and ids[a - 1] == ids[a - 1 + q]:
                    a -= 1
                while b < n and ids[b] == ids[b - q]:
                    b += 1
                done[q] = b
                if b - a >= max(least, exponent * q) and (a, q) not in found and _primitive(ids, a, q):
                    found[a, q] = b - a
    return [(a, length, q) for (a, q), length in sorted(found.items())]


def _stretches(at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of stretches of consecutive numbers in ``at`` with ``least`` or more."""
    if not len(at):
        return at, at
    heads = np.flatnonzero(np.append(True, np.diff(at) != 1))
    sizes = np.diff(np.append(heads, len(at)))
    long = sizes >= least
    return at[heads[long]], sizes[long]


def _before(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose value stood earlier, and the distance; values that share their upper bits may count as equal."""
    bits = np.uint64(max(len(hashes) - 1, 1).bit_length())
    place = (np.uint64(1) << bits) - np.uint64(1)
    both = np.sort((hashes & ~place) | np.arange(len(hashes), dtype=np.uint64))
    same = np.flatnonzero((both[1:] ^ both[:-1]) <= place)
    at = (both[same + 1] & place).astype(np.int64)
    gap = at - (both[same] & place).astype(np.int64)
    order = np.argsort(at)
    return at[order], gap[order]


def candidates(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int, int]]:
    """(document, first word, word after the last, longest period) of all stretches that can hold a run.

    A run of period q has max(least, exponent * q) words, of which all but the first q equal the word q before.
    For longer periods: runs of NEAR words that lie in it, but not in its first period, stood at most q
    words before. Both allow for more stretches than there are, never for fewer.
    """
    n = len(hashes)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out: list[tuple[np.ndarray, ...]] = []
    for q in range(1, min(NEAR, n - 1) + 1):
        same = np.flatnonzero((hashes[q:] == hashes[:-q]) & (doc[q:] == doc[:-q])) + q
        first, size = _stretches(same, max(least, exponent * q) - q)
        # Stretches of two documents can touch: cut where the document changes.
        out.append((first - q, first + size, np.full(len(first), q)))
    if n >= NEAR:
        # At i: the NEAR words from i on, in one document.
        i = np.arange(n - NEAR + 1)
        i = i[doc[i] == doc[i + NEAR - 1]]
        grams = span_hash(hashes, i, i + NEAR) + doc[i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at, gap = _before(grams)
        # Of a run with period q this many places or more follow each other with gaps up to q.
        spare = NEAR - 1
        shortest = (exponent - 1) * (NEAR + 1) - spare
        own = i[at]
        while True:
            first, size = _stretches(own, shortest)
            most = (size + spare) // (exponent - 1)
            inside = np.searchsorted(first, own, side="right") - 1
            ok = np.zeros(len(own), bool)
            if len(first):
                ok = (inside >= 0) & (own < first[inside] + size[inside])
                ok[ok] = gap[ok] <= most[inside[ok]]
            if ok.all():
                break
            own, gap = own[ok], gap[ok]
        out.append((first - most, first + size + spare, most))
    a, b, q = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    found = []
    for x, y, p in sorted(zip(a.tolist(), b.tolist(), q.tolist(), strict=True)):
        # A stretch belongs to the documents of its own words; the first ones may reach into the one before.
        d0, d1 = int(doc[min(x + p, n - 1)]), int(doc[y - 1])
        for d in range(d0, d1 + 1):
            low, high = max(x, int(bounds[d])), min(y, int(bounds[d + 1]))
            if high - low < least:
                continue
            low, high = low - int(bounds[d]), high - int(bounds[d])
            if found and found[-1][0] == d and low <= found[-1][2]:
                _, was, end, longest = found.pop()
                found.append((d, was, max(end, high), max(longest, p)))
            else:
                found.append((d, low, high, p))
    return found


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Per document row: doc_id, n_words, runs by start and period, and the words left when runs collapse.

    A run is a stretch of words with smallest period q and at least max(least, exponent * q) words that no
    neighbouring word extends; after its first q words its words go. Each row is taken by itself: null and
    repeated doc_ids are kept as they are. Null, empty and blank texts have no words, no runs and an empty
    rest. Order and repeats of rows do not matter, an empty table gives no rows, other columns take no part.
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    entry = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(entry)), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat(batch.column("text"))
            starts, ends, bounds = words(raw, offsets)
            regions: dict[int, list[tuple[int, int, int]]] = {}
            for d, *region in candidates(word_hash(raw, starts, ends), bounds, least, exponent):
                regions.setdefault(d, []).append(tuple(region))
            data = raw.tobytes()
            every, left = [], []
            for d in range(batch.num_rows):
                own = data[offsets[d] : offsets[d + 1]].split()
                found = []
                if d in regions:
                    names: dict[bytes, int] = {}
                    found = runs([names.setdefault(w, len(names)) for w in own], regions[d], least, exponent)
                if found:
                    keep = np.ones(len(own), bool)
                    for start, length, period in found:
                        keep[start + period : start + length] = False
                    own = list(itertools.compress(own, keep.tolist()))
                every.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                left.append(b" ".join(own))
            texts = pa.array(left, pa.binary()).cast(pa.string())
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(every, schema.field("runs").type), texts]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return only(docs, doc_id="long", text="string").mapInArrow(run, RUNS)
