"""Near-duplicate documents by 64-bit SimHash and Golay-code fuzzy hashing.

A fingerprint is cut into three segments of 22, 21 and 21 bits. Two fingerprints that differ in at
most two bits agree in one whole segment, and in the next segment they differ in two bits at most.
The perfect (23, 12) Golay code turns that next segment into a few 12-bit codeword numbers: all
codewords within four bits, which is one, or six where the nearest is three bits away. Two words
that differ in at most two bits always share one of these. (Their midpoint lies within three bits
of some codeword, which is then within four bits of both.) Whole segment and codeword number
together make the join keys, about sixteen a fingerprint, of some 34 bits each; the bit distance
then decides.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.graph import components
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import flat, slices

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
GENERATOR = 0xAE3  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
PAIRED_KEY_ROWS = 48  # a key with more fingerprints is linked through shared neighbours instead


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one text: bit set where more than half the shingle hashes have it; no words: 0."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    ends = [*np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist(), len(joined)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = max(len(ends) - shingle, 0)
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[min(shingle - 1, len(ends) - 1) :], strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, last + 1, 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null text counts as empty."""
    schema = arrow("doc_id long, fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat(batch.column("text"))
            data = raw.tobytes()
            found = [fingerprint(data[a:b], shingle) for a, b in itertools.pairwise(offsets.tolist())]
            yield rows(schema, batch.column("doc_id"), _signed(found))

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each 12-bit half, as two tables."""

    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GENERATOR << (bit - 11)
        return x

    return (
        np.array([remainder(x) for x in range(1 << 12)], np.int64),
        np.array([remainder(x << 12) for x in range(1 << 11)], np.int64),
    )


def _errors() -> np.ndarray:
    """For each syndrome, the error patterns of at most four bits, -1 where there are fewer than six."""
    low, high = _syndromes()
    table = np.full((1 << 11, 6), -1, np.int64)
    used = np.zeros(1 << 11, int)
    for weight in range(5):
        for bits in itertools.combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            syndrome = low[pattern & 0xFFF] ^ high[pattern >> 12]
            table[syndrome, used[syndrome]] = pattern
            used[syndrome] += 1
    return table


_TABLES: list[np.ndarray] = []


def codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6) numbers of the Golay codewords within four bits of each 23-bit word; -1: none."""
    if not _TABLES:
        _TABLES.extend([*_syndromes(), _errors()])
    low, high, errors = _TABLES
    patterns = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> 11)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs: whole segment i and each codeword number of segment i + 1."""
    x = fps.view(np.uint64)
    parts = [((x >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    at, keys = [], []
    for i in range(3):
        numbers = codewords(parts[(i + 1) % 3])
        row, col = np.nonzero(numbers >= 0)
        at.append(row)
        keys.append((i << 40) | (parts[i][row] << 12) | numbers[row, col])
    return np.concatenate(at), np.concatenate(keys)


def _keyed(distinct: DataFrame) -> DataFrame:
    schema = arrow("key long, fp long, first_id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, first = batch.column("fp").to_numpy(), batch.column("first_id").to_numpy()
            for a in range(0, len(fps), 50_000):
                row, keys = golay_keys(fps[a : a + 50_000])
                yield rows(schema, keys, fps[a + row], first[a + row])

    return distinct.select("fp", "first_id").mapInArrow(run, "key long, fp long, first_id long")


def links(distinct: DataFrame, scratch: Scratch, max_bits: int = 2) -> DataFrame:
    """(a, b) first ids of fingerprints that link; enough links to connect what the bit distance connects.

    Keys with few fingerprints are joined to themselves and checked. A key with many (a large group
    of near copies) would give pairs that grow with its square. Its fingerprints are linked through
    the 65 words within one bit of each: two of them differ in at most two bits just if they share
    such a word. Each word then links its fingerprints to the smallest, so the links stay linear.
    """
    if max_bits != 2:
        raise ValueError("the codeword radius is made for two bits")
    keyed = scratch.save(_keyed(distinct), "keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = scratch.save(sizes, "sizes")
    shared = scratch.save(keyed.join(sizes, "key"), "shared")
    few = shared.where(F.col("n") <= PAIRED_KEY_ROWS)
    pairs = (
        few.alias("x")
        .join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & F.expr("x.fp < y.fp and bit_count(x.fp ^ y.fp) <= 2"))
        .select(F.least("x.first_id", "y.first_id").alias("a"), F.greatest("x.first_id", "y.first_id").alias("b"))
    )
    many = shared.where(F.col("n") > PAIRED_KEY_ROWS).select("fp", "first_id").distinct()
    near = F.expr("concat(array(fp), transform(sequence(0, 63), b -> fp ^ shiftleft(1L, b)))")
    hubs = many.select(F.explode(near).alias("hub"), "first_id")
    least = F.min("first_id").over(Window.partitionBy("hub"))  # a hub has 65 fingerprints at most
    starred = hubs.select(least.alias("a"), F.col("first_id").alias("b")).where("a < b")
    out = scratch.save(pairs.unionByName(starred).distinct(), "pairs")
    scratch.drop(keyed, sizes, shared)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fp, component_id.

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` differing bits.
    Null and empty texts have fingerprint 0 and link like others; rows that repeat a doc_id with
    other text each keep their row. Rows with a null doc_id link nothing; they get the class of their
    fingerprint, or null if no numbered row has it. An empty table gives no rows; other columns take no part.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.save(fingerprints(docs, shingle), "prints")
    distinct = scratch.save(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = components(links(distinct, scratch, max_bits), scratch)
    classes = distinct.join(found, F.col("first_id") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "first_id").alias("component_id")
    )
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without those that have a smaller near duplicate; all columns are kept.

    Documents with an empty or null text are near duplicates of each other like any others.
    """
    found = near_duplicates(docs, shingle, max_bits)
    rest = found.where("doc_id <> component_id").select("doc_id").distinct()
    rest = Scratch(docs.sparkSession, "simhash").save(rest, "rest")
    return docs.join(rest, "doc_id", "left_anti").select(docs.columns)
