"""Benchmark decontamination by SimHash of item-sized windows.

Items and documents are compared as runs of words (letters and digits, small ASCII letters). For an
item of n words every window of n words of a document that shares a five-word shingle with it gets
a 64-bit SimHash, rolled along the text. Eight tables index the item fingerprints by one byte each.
Fingerprints that differ in at most RADIUS bits have a byte that differs in at most as many bits as
REACH says for it, so looking up all such bytes finds every one of them. The bit distance, and then the
weighted Jaccard similarity of the shingles (each counted as often as it occurs), decide.
"""

from __future__ import annotations

import functools
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import flat, mix, slices, span_hash, word_hash, words

SHINGLE, SIMILARITY = 5, 0.8
RADIUS = 20  # of 64 bits: at similarity 0.8 about ten differ, with a standard deviation of three
PASS_ITEMS, PASS_CHARS = 20_000, 16 << 20  # benchmark items searched in one pass over the documents
WINDOWS, PROBES = 2048, 1 << 18  # windows looked up together, and entries of a table they meet at a time
_FILTER_BITS = 22

_FOLD = np.zeros(256, np.uint8)  # word bytes in small letters; 0x20 for all others
_FOLD[:] = 0x20
for _c in (*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)):
    _FOLD[_c] = _c
for _c in range(65, 91):
    _FOLD[_c] = _c + 32


def shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the n + 1 places where each text's words begin."""
    raw, offsets = flat(texts)
    raw = _FOLD[raw]
    starts, ends, bounds = words(raw, offsets)
    return word_hash(raw, starts, ends), bounds


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place; none where fewer are left in the array."""
    at = np.arange(max(len(hashes) - n + 1, 0))
    return span_hash(hashes, at, at + n)


def bits(shingles: np.ndarray) -> np.ndarray:
    return np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def window_prints(shingles: np.ndarray, m: int) -> np.ndarray:
    """SimHash of each m consecutive shingles: a bit is set where more than half of them have it."""
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits(shingles), axis=0, out=sums[1:])
    return np.packbits(2 * (sums[m:] - sums[:-m]) > m, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = np.minimum(nx[i], ny[j]).sum()
    return float(common / (len(a) + len(b) - common))


#: Bits that may differ in each byte. If all eight differed in more, RADIUS + 1 bits would differ at least.
REACH = [RADIUS // 8 - (block > RADIUS % 8) for block in range(8)]
_APART = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))


class Tables:
    """Fingerprints by the value of each of their bytes."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        own = prints.view(np.uint8).reshape(-1, 8)
        self.order = [np.argsort(own[:, block], kind="stable") for block in range(8)]
        self.first = [np.append(0, np.cumsum(np.bincount(own[:, block], minlength=256))) for block in range(8)]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of a print, place of a fingerprint, bits that differ) of all pairs within RADIUS, in order."""
        theirs = prints.view(np.uint8).reshape(-1, 8)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for block in range(8):
            probed, value = np.nonzero(_APART[theirs[:, block]] <= REACH[block])
            low, high = self.first[block][value], self.first[block][value + 1]
            ends = np.cumsum(high - low)
            at = 0
            while at < len(ends):
                done = ends[at - 1] if at else 0
                to = max(int(np.searchsorted(ends, done + PROBES, side="right")), at + 1)
                sizes = (high - low)[at:to]
                entry = np.arange(ends[to - 1] - done) + np.repeat(low[at:to] - (ends[at:to] - sizes - done), sizes)
                print_, item = np.repeat(probed[at:to], sizes), self.order[block][entry]
                differ = prints[print_] ^ self.prints[item]
                bits_ = np.bitwise_count(differ)
                close = np.flatnonzero(bits_ <= RADIUS)
                # A pair found in several tables counts in the first of them.
                for earlier in range(block):
                    byte = (differ[close] >> np.uint64(8 * earlier)) & np.uint64(255)
                    close = close[np.bitwise_count(byte) > REACH[earlier]]
                found.append((print_[close], item[close], bits_[close]))
                at = to
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        print_, item, bits_ = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((item, print_))
        return print_[order], item[order], bits_[order]


class Items:
    """Benchmark items of one pass, indexed by shingle, and by size and fingerprint byte."""

    def __init__(self, ids: list[int], texts: list[str]):
        hashes, bounds = shingled(pa.array(texts, pa.string()))
        self.ids, self.sizes = np.array(ids, np.int64), np.diff(bounds)
        self.shingles = [runs(hashes[a:b], min(SHINGLE, max(b - a, 1))) for a, b in itertools.pairwise(bounds.tolist())]
        self.by_size: dict[int, np.ndarray] = {int(n): np.flatnonzero(self.sizes == n) for n in np.unique(self.sizes) if n}
        self.prints = np.array([window_prints(s, len(s))[0] if len(s) else 0 for s in self.shingles], np.uint64)
        self.tables = {n: Tables(self.prints[own]) for n, own in self.by_size.items()}
        # Short items are one shingle of their own length.
        self.lengths = sorted({min(SHINGLE, n) for n in self.by_size})
        self.where: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in self.lengths:
            own = [i for i, size in enumerate(self.sizes.tolist()) if size and min(SHINGLE, size) == n]
            pairs = [(h, i) for i in own for h in set(self.shingles[i].tolist())]
            pairs.sort()
            keys = np.array([h for h, _ in pairs], np.uint64)
            known, first = np.unique(keys, return_index=True)
            rough = np.zeros(1 << _FILTER_BITS, bool)
            rough[known >> np.uint64(64 - _FILTER_BITS)] = True
            self.where[n] = known, np.append(first, len(keys)), np.array([i for _, i in pairs], np.int64), rough

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, item) wherever a shingle of an item stands."""
        for n in self.lengths:
            known, first, items, rough = self.where[n]
            found = runs(hashes, n)
            maybe = np.flatnonzero(rough[found >> np.uint64(64 - _FILTER_BITS)])
            at = np.minimum(np.searchsorted(known, found[maybe]), len(known) - 1)
            good = known[at] == found[maybe]
            for place, k in zip(maybe[good].tolist(), at[good].tolist(), strict=True):
                for item in items[first[k] : first[k + 1]].tolist():
                    yield place, item

    def candidates(self, size: int, prints: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, bits that differ) for all items of this size within RADIUS."""
        for a in range(0, len(prints), WINDOWS):
            window, item, distance = self.tables[size].within(prints[a : a + WINDOWS])
            yield from zip((window + a).tolist(), self.by_size[size][item].tolist(), distance.tolist(), strict=True)

    def match(self, hashes: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, start, bits) of each item that some window of these words resembles."""
        places: dict[int, list[int]] = {}
        for place, item in self.hits(hashes):
            places.setdefault(int(self.sizes[item]), []).append(place)
        best: dict[int, tuple[float, int, int]] = {}
        for size, found in places.items():
            n = min(SHINGLE, size)
            m = size - n + 1
            last = max(len(hashes) - size, 0)
            # Stretches of window starts that hold a hit; each is rolled along once.
            starts = np.unique(np.clip(np.array(found), 0, None))
            lows, highs = np.minimum(np.maximum(starts - m + 1, 0), last), np.minimum(starts, last)
            new = np.append(True, lows[1:] > np.maximum.accumulate(highs)[:-1] + 1)
            heads = np.flatnonzero(new)
            for a, b in zip(lows[heads].tolist(), np.maximum.reduceat(highs, heads).tolist(), strict=True):
                shingles = runs(hashes[a : b + size], n)
                width = min(m, len(shingles))
                for window, item, distance in self.candidates(size, window_prints(shingles, width)):
                    alike = similarity(shingles[window : window + width], self.shingles[item])
                    if alike >= SIMILARITY and (item not in best or alike > best[item][0]):
                        best[item] = alike, a + window, distance
        return best


LEAKS = "doc_id long, item_id long, start long, n_words long, distance int, similarity double"
_kept: dict[str, Items] = {}


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item that one of its windows resembles: the best window.

    ``start`` counts words. Ties go to the first window. A document shorter than an item is one
    window. Items without words, number or text match nothing; items of fewer than five words match
    where all their words stand. Items that repeat give a row each, documents that repeat too. Other columns take no part.

    The items are broadcast in passes of bounded size: a larger benchmark takes more passes, over all
    documents each. Passes run one after the other, so the driver holds the items of one; what they find is written.
    """
    items = only(benchmark, item_id="long", text="string").where("text is not null and item_id is not null")
    items = items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    passes = max(1, -(-n // PASS_ITEMS), -(-chars // PASS_CHARS))
    plain = only(docs, doc_id="long", text="string")
    if passes == 1:
        return _pass(plain, items.orderBy("item_id", "text").collect())[0]
    scratch = Scratch(docs.sparkSession, "items")
    parted = items.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    parted.repartition("pass").write.partitionBy("pass").parquet(f"{scratch.base}/parts")
    parted = docs.sparkSession.read.schema(parted.schema).parquet(f"{scratch.base}/parts")
    found = []
    for k in range(passes):
        one, shared = _pass(plain, parted.where(F.col("pass") == k).orderBy("item_id", "text").collect())
        found.append(scratch.save(one, f"found{k}"))
        shared.destroy()
    return functools.reduce(DataFrame.unionByName, found)


def _pass(docs: DataFrame, items: list) -> tuple[DataFrame, Broadcast]:
    """The leaks of some items (item_id, text, copies), and the broadcast that holds them."""
    each = f"{LEAKS}, copies long"
    schema, key = arrow(each), uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(([r["item_id"] for r in items], [r["text"] for r in items]))
    copies = np.array([r["copies"] for r in items], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _kept:
            _kept.clear()
            _kept[key] = Items(*shared.value)
        known = _kept[key]
        if not known.lengths:
            return
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            hashes, bounds = shingled(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            # One look at the whole slice tells which documents hold any shingle of an item.
            held = np.array(sorted({place for place, _ in known.hits(hashes)}), np.int64)
            columns: list[list] = [[] for _ in schema]
            for i in np.unique(np.searchsorted(bounds, held, side="right") - 1).tolist():
                for item, (alike, start, distance) in sorted(known.match(hashes[bounds[i] : bounds[i + 1]]).items()):
                    row = (doc_ids[i], int(known.ids[item]), start, int(known.sizes[item]), distance, alike, int(copies[item]))
                    for column, x in zip(columns, row, strict=True):
                        column.append(x)
            yield rows(schema, *columns)

    found = docs.mapInArrow(run, each)
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies"), shared


def keep_unleaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found; all columns are kept, and rows with a null doc_id stay."""
    found = leaks(docs, benchmark).select("doc_id").distinct()
    found = Scratch(docs.sparkSession, "leaks").save(found, "found")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
