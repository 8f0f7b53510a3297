"""Near-duplicate lines by a segment-partition edit join.

A line is cut into ``edits`` + 1 segments. A line within that many edits of it holds one of the segments
unchanged, and not far from its place: for each segment and each length the other line may have, only a
few starting places can matter. So each line enters an index with its segments, by length and
segment number, and probes the index of its own and the next shorter lengths with the substrings at
those places. Both are rows of one table that is shuffled once and joined to itself. Pairs that meet
are compared first by parity sketches of their letters and letter pairs, of which an edit changes few
bits, and then by a banded bit-parallel edit distance.

Very many lines may share a segment and be near each other (numbered lines). They are linked first through
what is left of them without one character: lines that share such a rest are within two edits, and each
rest links its lines to one of them only. The join then leaves out segments whose lines are linked
already, and pairs of linked lines under the others.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.graph import components
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import mix, powers, slices

EDITS, MIN_CHARS = 2, 20  # shorter lines go only where they are equal
HEAVY_LINES = 200  # lines under one key of the index from which they are linked before the join
BROADCAST_LINES = 100_000  # lines whose text is wanted, up to which they are broadcast to the documents


def within(a: str, b: str, edits: int) -> bool:
    """Whether ``edits`` insertions, deletions and substitutions turn a into b.

    Bit j of row d says that a[:j] becomes what was read of b by at most d edits; only the band of
    2 * edits + 1 diagonals is kept.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[head:], b[head:]
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    places: dict[str, int] = {}
    for j, c in enumerate(a):
        places[c] = places.get(c, 0) | 2 << j
    state = [(2 << d) - 1 for d in range(edits + 1)]
    band = (2 << 2 * edits) - 1
    for i, c in enumerate(b, 1):
        mask = band << (i - edits) if i >= edits else band >> (edits - i)
        same, before = places.get(c, 0), state
        state = [(before[0] << 1) & same & mask]
        for d in range(1, edits + 1):
            kept = (before[d] << 1) & same
            state.append((kept | before[d - 1] | before[d - 1] << 1 | state[d - 1] << 1) & mask)
        if not state[edits]:
            return False
    return bool(state[edits] >> len(a) & 1)


def lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, and text, number, start and end of each line without white space at its ends."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    if not texts:
        return points, *(np.zeros(0, np.int64) for _ in range(4))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes + 1) - sizes - 1
    breaks = np.flatnonzero(points == 10)
    a, b = np.append(0, breaks + 1), np.append(breaks, len(points))
    text = np.searchsorted(first, a, side="right") - 1
    number = np.arange(len(a)) - np.searchsorted(a, first)[text]
    blank = np.flatnonzero(~((points == 32) | ((points >= 9) & (points <= 13))))
    i, j = np.searchsorted(blank, a), np.searchsorted(blank, b) - 1
    some = j >= i
    start, end = a.copy(), a.copy()
    start[some], end[some] = blank[i[some]], blank[j[some]] + 1
    return points, text, number, start, end


#: For each code point: its value in hashes, and its bit among the letter parities.
_VALUES = mix(np.arange(1, 0x110001, dtype=np.uint64))
_LETTERS = np.uint64(1) << (mix(np.arange(77, 0x110000 + 77, dtype=np.uint64)) >> np.uint64(59))


class Spans:
    """Hashes of any stretches of the texts."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[points] * powers(n), out=self.sums[1:])
        self.inverse = powers(n + 1, pow(int(powers(2)[1]), -1, 1 << 64))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def lines(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.hash(start, end) + (end - start).astype(np.uint64)).view(np.int64)


OCCURRENCES = "doc_id long, tid long, number int, line long"


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    schema = arrow(OCCURRENCES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            points, text, number, start, end = lines([x or "" for x in batch.column("text").to_pylist()])
            long = np.flatnonzero(end - start >= min_chars)
            at = pa.array(text[long])
            ids = [batch.column(c).take(at) for c in ("doc_id", "tid")]
            yield rows(schema, *ids, number[long], Spans(points).lines(start[long], end[long]))

    return docs.mapInArrow(run, OCCURRENCES)


def places(edits: int) -> list[tuple[int, int, int]]:
    """How much shorter the other line is, its segment, and how far from its place there the segment is sought."""
    return [
        (shorter, i, shift)
        for shorter in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)
    ]


def segments(n: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """First place (from 0) and length of segment i of lines of length n; the last ones are longer by one."""
    parts = edits + 1
    short, longer = n // parts, n % parts
    before = np.maximum(i - (parts - longer), 0)
    return i * short + before, short + (i >= parts - longer)


def keys(spans: Spans, start: np.ndarray, end: np.ndarray, edits: int) -> list[pa.Array]:
    """For each of the places that may hold a segment of a line as long or shorter, the key of each line there.

    Those that are the line's own segments make its index, and probe lines of the same length too.
    """
    size = end - start
    found = []
    for shorter, i, shift in places(edits):
        n = size - shorter
        place, length = segments(n, i, edits)
        a = place + shift
        fits = (n > edits) & (a >= 0) & (a + length <= size)
        a, length = start[fits] + a[fits], length[fits]
        label = (n[fits].astype(np.uint64) << np.uint64(3)) + np.uint64(i)
        key = np.zeros(len(size), np.int64)
        key[fits] = mix(spans.hash(a, a + length) + mix(label + np.uint64(1))).view(np.int64)
        found.append(pa.array(key, mask=~fits))
    return found


def sketches(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 parities of the letters of each line, then 32 of its pairs of neighbouring letters.

    An edit changes at most two of the former and four of the latter.
    """
    letter, value = _LETTERS[points], _VALUES[points]
    both = (value[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ value[1:]
    pair = np.uint64(1) << (((both * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(59)) + np.uint64(32))
    letters, pairs = np.zeros(len(points) + 1, np.uint64), np.zeros(len(points) + 1, np.uint64)
    np.bitwise_xor.accumulate(letter, out=letters[1:])
    np.bitwise_xor.accumulate(pair, out=pairs[1 : max(len(points), 1)])
    last = np.maximum(end - 1, start)  # pairs[i] covers the pairs that begin before i
    return (letters[end] ^ letters[start] ^ pairs[last] ^ pairs[start]).view(np.int64)


def _names(edits: int) -> list[str]:
    return [f"k{i}" for i in range(len(places(edits)))]


def _once(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """line, sketch and a column per key: each distinct line once, however many documents hold it."""
    names = _names(edits)
    lines_schema = ", ".join(["line long, sketch long", *(f"{k} long" for k in names)])
    schema = arrow(lines_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            points, _, _, start, end = lines([x or "" for x in batch.column("text").to_pylist()])
            long = np.flatnonzero(end - start >= min_chars)
            spans = Spans(points)
            line, once = np.unique(spans.lines(start[long], end[long]), return_index=True)
            start, end = start[long][once], end[long][once]
            yield rows(schema, line, sketches(points, start, end), *keys(spans, start, end, edits))

    return docs.mapInArrow(run, lines_schema).dropDuplicates(["line"])


def _keyed(once: DataFrame, edits: int, *columns: str) -> DataFrame:
    """key, line, the named columns, probe: each line under each of its keys; probe is 0 in the index."""
    each = [
        F.struct(F.col(k).alias("key"), F.lit(int(shorter > 0 or shift != 0)).alias("probe"))
        for k, (shorter, _, shift) in zip(_names(edits), places(edits), strict=True)
    ]
    named = ["line", *columns]
    return once.select(*named, F.inline(F.array(*each))).where("key is not null").select("key", *named, "probe")


def _with_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that hold the lines wanted (line, doc_id, tid, number), these in the array w."""
    each = wanted.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("number", "line")).alias("w"))
    if wanted.count() <= BROADCAST_LINES:
        each = F.broadcast(each)
    return docs.join(each, ["doc_id", "tid"])


def _rests(docs: DataFrame, wanted: DataFrame, edits: int) -> DataFrame:
    """(rest, line): hashes of the lines wanted, and of each without one of its characters.

    Two lines that share one are within two edits. If only one edit is allowed, the place of the missing
    character is part of the hash, and lines that share one differ in that character alone.
    """
    schema = arrow("rest long, line long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            points, text, number, start, end = lines([x or "" for x in batch.column("text").to_pylist()])
            spans = Spans(points)
            w = batch.column("w")
            of = np.repeat(np.arange(len(w)), pa.compute.list_value_length(w).to_numpy())
            at = np.searchsorted(text, of) + w.flatten().field("number").to_numpy()
            line, start, end = spans.lines(start[at], end[at]), start[at], end[at]
            yield rows(schema, line, line)
            size = end - start
            first = np.repeat(start, size)
            place = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
            after = spans.hash(first + place + 1, np.repeat(end, size)) * powers(len(points) + 1)[place]
            rest = spans.hash(first, first + place) + after + np.repeat(size - 1, size).astype(np.uint64)
            if edits < 2:
                rest += mix(place.astype(np.uint64) + np.uint64(1))
            yield rows(schema, mix(rest).view(np.int64), np.repeat(line, size))

    return _with_wanted(docs, wanted).mapInArrow(run, "rest long, line long")


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, words) of the lines wanted (line, doc_id, tid, number)."""
    schema = arrow("line long, words string")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found = [
                (w["line"], own[w["number"]].strip(" \t\n\r\v\f"))
                for text, ws in zip(batch.column("text").to_pylist(), batch.column("w").to_pylist(), strict=True)
                for own in [text.split("\n")]
                for w in ws
            ]
            yield rows(schema, [x for x, _ in found], [x for _, x in found])

    return _with_wanted(docs, wanted).mapInArrow(run, "line long, words string").dropDuplicates(["line"])


def _verified(docs: DataFrame, distinct: DataFrame, pairs: DataFrame, scratch: Scratch, edits: int) -> DataFrame:
    """The pairs (a, b) of lines that are within so many edits of each other."""
    schema = arrow("a long, b long")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    wanted = scratch.save(wanted.join(distinct, "line").select("line", "first.*"), "wanted")
    texts = scratch.save(_line_texts(docs, wanted), "texts")
    x, y = (texts.select(F.col("line").alias(k), F.col("words").alias(t)) for k, t in (("a", "x"), ("b", "y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))
            good = [i for i in range(len(a)) if within(x[i], y[i], edits)]
            yield rows(schema, [a[i] for i in good], [b[i] for i in good])

    return pairs.join(x, "a").join(y, "b").mapInArrow(run, "a long, b long")


def _families(docs: DataFrame, once: DataFrame, distinct: DataFrame, scratch: Scratch, edits: int) -> tuple[DataFrame, ...] | None:
    """Links (a, b) among lines under keys with many of them, (node, root) by these, and the keys whose lines are all linked.

    Each rest links its lines to the smallest, so there are at most as many links as the lines have characters.
    None if no key holds that many lines.
    """
    index = [k for k, (shorter, _, shift) in zip(_names(edits), places(edits), strict=True) if not (shorter or shift)]
    found = once.select(F.explode(F.array(*index)).alias("key")).where("key is not null").groupBy("key").count()
    heavy = scratch.save(found.where(F.col("count") > HEAVY_LINES).select("key"), "heavy")
    if not edits or heavy.isEmpty():
        return None
    held = scratch.save(_keyed(once, edits).join(heavy, "key").select("key", "line"), "held")
    wanted = scratch.save(held.select("line").distinct().join(distinct, "line").select("line", "first.*"), "family")
    least = F.min("line").over(Window.partitionBy("rest"))  # its lines: one character put in at one of its places
    stars = _rests(docs, wanted, edits).select(least.alias("a"), F.col("line").alias("b")).where("a < b").distinct()
    links = scratch.save(_verified(docs, distinct, scratch.save(stars, "stars"), scratch, edits), "linked")
    roots = scratch.save(components(links, scratch), "roots")
    under = held.join(roots, F.col("line") == F.col("node"), "left").select("key", F.coalesce("root", "line").alias("root"))
    settled = under.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a = b").select("key")
    return links, roots, scratch.save(settled, "settled")


def _links(docs: DataFrame, distinct: DataFrame, scratch: Scratch, edits: int, min_chars: int) -> DataFrame:
    """(a, b): lines within so many edits; enough links to connect what the edits connect."""
    once = scratch.save(_once(docs, edits, min_chars), "keys")
    families = _families(docs, once, distinct, scratch, edits)
    letters, couples = "(i.sketch ^ p.sketch) & 4294967295", "shiftrightunsigned(i.sketch ^ p.sketch, 32)"
    near = f"i.line < p.line and bit_count({letters}) <= {2 * edits} and bit_count({couples}) <= {4 * edits}"
    if families is None:
        keyed = _keyed(once, edits, "sketch")
    else:
        links, roots, settled = families
        rooted = once.join(roots, F.col("line") == F.col("node"), "left").withColumn("root", F.coalesce("root", "line"))
        keyed = _keyed(rooted, edits, "sketch", "root").join(settled, "key", "left_anti")
        near += " and i.root <> p.root"
    # One side is an index row; said of both sides at once, so that both read the same shuffle.
    meet = keyed.alias("i").join(
        keyed.alias("p"), (F.col("i.key") == F.col("p.key")) & F.expr(f"i.probe + p.probe < 2 and {near}")
    )
    pairs = scratch.save(meet.select(F.col("i.line").alias("a"), F.col("p.line").alias("b")).distinct(), "pairs")
    found = _verified(docs, distinct, pairs, scratch, edits)
    return found if families is None else found.unionByName(links)


def surplus(docs: DataFrame, scratch: Scratch, edits: int, min_chars: int | None) -> DataFrame:
    """doc_id, tid, gone: numbers of the lines that are not the first of their class.

    A class holds equal lines, and lines linked by at most ``edits`` edits, over any number of links.
    Its first line has the smallest (doc_id, tid, number). Lines too short for links are classes of their own.
    Rows with a null doc_id, which nothing can name, are neither compared nor first.
    """
    docs = docs.where("doc_id is not null")
    equal_chars, near_chars = (1, MIN_CHARS) if min_chars is None else (max(min_chars, 1), min_chars)
    found = scratch.save(_occurrences(docs, equal_chars), "occurrences")
    first = F.min(F.struct("doc_id", "tid", "number")).alias("first")
    distinct = scratch.save(found.groupBy("line").agg(first, F.count(F.lit(1)).alias("n")), "lines")
    classes = components(_links(docs, distinct, scratch, edits, near_chars), scratch)
    linked = distinct.join(classes, F.col("line") == F.col("node"), "left")
    linked = linked.select("line", "first", "n", F.coalesce("root", "line").alias("root"), F.col("root").isNotNull().alias("near"))
    least = linked.where("near").groupBy("root").agg(F.min("first").alias("least"))
    several = linked.where("near or n > 1").join(least, "root", "left").select("line", F.coalesce("least", "first").alias("stays"))
    several = scratch.save(several, "several")  # both sides are plain shuffles: Spark can split a very common line
    gone = found.join(several, "line").where(F.struct("doc_id", "tid", "number") != F.col("stays"))
    return gone.groupBy("doc_id", "tid").agg(F.collect_set("number").alias("gone"))


def _plain(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="long", text="string").withColumn("tid", F.xxhash64("text"))


def _left(text: str | None, gone: list[int] | None) -> str | None:
    if not gone or text is None:
        return text
    rest = set(gone)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in rest)


DIGEST = "doc_id long, n_lines long, n_removed long, kept_sha256 string"


def digests(docs: DataFrame, edits: int = EDITS, min_chars: int | None = None) -> DataFrame:
    """Per document row: doc_id, its lines, how many go, and the SHA-256 of what is left.

    Lines end at newlines and are compared without white space at their ends. Equal lines of any length
    are one class, near ones from MIN_CHARS characters on; empty lines never go. If ``min_chars`` is given,
    shorter lines never go, and longer ones are linked. Of each class only the first stays (smallest
    doc_id, then line number). What is left keeps its lines and newlines as they are; a text of which every
    line goes is empty. Null text: no lines, digest of the empty text. Rows with a null doc_id lose no
    lines and spare none elsewhere. Rows that repeat doc_id and text are
    one document and lose the same lines. An empty table gives no rows, other columns take no part.
    """
    plain = _plain(docs)
    found = surplus(plain, Scratch(docs.sparkSession, "lines"), edits, min_chars)
    schema = arrow(DIGEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
            n = [0 if t is None else t.count("\n") + 1 for t in texts]
            digest = [hashlib.sha256((_left(t, g) or "").encode()).hexdigest() for t, g in zip(texts, gone, strict=True)]
            yield rows(schema, batch.column("doc_id"), n, [len(g or ()) for g in gone], digest)

    return plain.join(found, ["doc_id", "tid"], "left").select("doc_id", "text", "gone").mapInArrow(run, DIGEST)


def dedup(docs: DataFrame, edits: int = EDITS, min_chars: int | None = None) -> DataFrame:
    """The documents without the lines that go (see digests); n_chars, if there, is counted anew. All rows stay."""
    found = surplus(_plain(docs), Scratch(docs.sparkSession, "lines"), edits, min_chars)
    own = found.select(F.col("doc_id").alias("_own_id"), F.col("tid").alias("_own_tid"), F.col("gone").alias("_gone"))
    joined = docs.join(own, (F.col("doc_id").cast("long") == F.col("_own_id")) & (F.xxhash64("text") == F.col("_own_tid")), "left")
    numbered = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("_gone", i))
    out = joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(numbered, "\n")))
    if "n_chars" in docs.columns:
        counted = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
