"""Removal of long passages that earlier documents hold, by suffix automata of reference shards.

A window is a fixed number of consecutive words. Where a window's words also start in a document with
a smaller number, its words go; the windows of a maximal repeated span go together.

A corpus does not fit one automaton, nor can every document be streamed past every shard. So text
is dealt to shards by content: of the GRAM-word runs in a window, the one with the smallest hash is its
anchor, and equal windows have equal anchors. The windows of a document that share an anchor form a
fragment. Only anchors that occur in several documents go on, each distinct fragment once, with the
smallest document number that holds it. A shard gathers the fragments of its anchors, builds
the suffix automaton of them with the smallest document number behind each state, and streams the
fragments past it: the matching statistic tells for each window the first document that holds it.

An anchor with very many distinct fragments (a passage that a large part of the corpus holds, each time
among other words) would make one shard grow with the corpus. Its fragments are cut again, as texts of their
own, by anchors of more words: those that differ part, those that stay together share more. At last an anchor
is a window itself, and the first document that holds it is known without a shard.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.automaton import SuffixAutomaton
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import flat, slices, span_hash, word_hash, words

WINDOW, GRAM = 50, 10
ANCHOR_TEXTS = 200  # distinct fragments of an anchor up to which a shard's automaton takes them
SHARD_TEXTS = 1000

FRAGMENTS = "doc_id long, last_id long, tid long, anchor long, frag long, start int, n int"


def _grams(window: int, gram: int) -> list[int]:
    """Words of an anchor at each level: four even steps from ``gram`` to the window."""
    return sorted({gram + (window - gram) * k // 4 for k in range(5)})


def fragments(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document row, anchor, hash of the words, first word and length of each fragment of these texts."""
    starts, ends, bounds = words(raw, offsets)
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none, none, none, none
    hashes = word_hash(raw, starts, ends)
    at = np.arange(len(hashes) - gram + 1)
    grams = span_hash(hashes, at, at + gram)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    anchor = np.concatenate([part.argmin(1) for part in np.array_split(view, max(1, len(view) // 50_000))]) + np.arange(len(view))
    doc = np.searchsorted(bounds, np.arange(len(view)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(view)) + window <= bounds[doc + 1])
    if not len(inside):
        return none, none, none, none, none
    new = np.append(True, (np.diff(anchor[inside]) != 0) | (np.diff(doc[inside]) != 0))
    heads = np.flatnonzero(new)
    a, b = inside[heads], inside[np.append(heads[1:], len(inside)) - 1] + window
    return doc[a], grams[anchor[a]].view(np.int64), span_hash(hashes, a, b).view(np.int64), a - bounds[doc[a]], b - a


def _cut(docs: DataFrame, window: int, gram: int) -> DataFrame:
    schema = arrow(FRAGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            doc, anchor, frag, start, n = fragments(*flat(batch.column("text")), window, gram)
            at = pa.array(doc)
            yield rows(schema, *(batch.column(c).take(at) for c in ("doc_id", "last_id", "tid")), anchor, frag, start, n)

    return docs.mapInArrow(run, FRAGMENTS)


TEXTS = "anchor long, frag long, first_id long, last_id long, texts long, words string"


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words of each distinct fragment, taken from the first document that holds it."""
    schema = arrow(TEXTS)
    each = wanted.groupBy(F.col("own.doc_id").alias("doc_id"), F.col("own.tid").alias("tid")).agg(
        F.collect_list(F.struct("anchor", "frag", "own.start", "own.n", "last_id", "texts")).alias("w")
    )
    # Rows that repeat are one text; the join below needs the same partitioning.
    once = docs.groupBy("doc_id", "tid").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat(batch.column("text"))
            data = raw.tobytes()
            out: list[list] = [[], [], [], [], [], []]
            for i, (doc_id, own) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("w").to_pylist(), strict=True)):
                found = data[offsets[i] : offsets[i + 1]].split()
                for w in own:
                    text = b" ".join(found[w["start"] : w["start"] + w["n"]])
                    for column, x in zip(out, (w["anchor"], w["frag"], doc_id, w["last_id"], w["texts"], text), strict=True):
                        column.append(x)
            yield rows(schema, *out[:5], pa.array(out[5], pa.binary()).cast(pa.string()))

    return once.join(each, ["doc_id", "tid"]).mapInArrow(run, TEXTS)


RUNS = "anchor long, frag long, low int, high int, first_id long"


def _matched(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """Runs of windows of each fragment (first and last place) and the first document that holds them."""
    schema = arrow(RUNS)

    def match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        names: dict[bytes, int] = {}
        table = table.sort_by([("anchor", "ascending"), ("frag", "ascending")])
        split = [[names.setdefault(w, len(names)) for w in x.split(" ")] for x in table["words"].to_pylist()]
        automaton = SuffixAutomaton()
        for found, number in zip(split, table["first_id"].to_pylist(), strict=True):
            automaton.add(found, number)
        automaton.finish()
        out: list[list[int]] = [[], [], [], [], []]
        for found, anchor, frag in zip(split, table["anchor"].to_pylist(), table["frag"].to_pylist(), strict=True):
            at = 0
            for first, same in itertools.groupby(automaton.firsts(found, window)):
                n = len(list(same))
                for column, x in zip(out, (anchor, frag, at, at + n - 1, int(first)), strict=True):
                    column.append(x)
                at += n
        return pa.Table.from_batches([rows(schema, *out)])

    keep = texts.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "frag", "first_id", "words")
    return keep.groupBy("shard").applyInArrow(match, RUNS)


def _spans(docs: DataFrame, scratch: Scratch, window: int, grams: list[int]) -> DataFrame:
    """doc_id, tid, a, b, first_id: spans [a, b) whose windows stand in ``first_id`` first, and that before last_id.

    ``docs`` has doc_id and last_id, the first and the last document that holds the text, tid and text.
    """
    gram, *longer = grams
    cut = scratch.save(_cut(docs, window, gram), "fragments")
    shared = cut.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("last_id").alias("most")).where("least < most")
    # Sums are written before they are joined back: both sides of the join are then plain shuffles,
    # and Spark can split the rows of an anchor that a large part of the corpus holds.
    shared = scratch.save(shared.select("anchor"), "shared")
    repeated = scratch.save(cut.join(shared, "anchor"), "repeated")
    scratch.drop(cut, shared)
    distinct = repeated.groupBy("anchor", "frag").agg(
        F.min(F.struct("doc_id", "tid", "start", "n")).alias("own"), F.max("last_id").alias("last_id")
    )
    distinct = scratch.save(distinct, "distinct")
    if longer:
        found = _found(docs, distinct, scratch, window, longer)
        scratch.drop(distinct)
    else:
        found = distinct.select("anchor", "frag", F.lit(0).alias("low"), F.lit(0).alias("high"), F.col("own.doc_id").alias("first_id"))
    gone = repeated.join(found, ["anchor", "frag"]).where("first_id < last_id")
    return gone.select("doc_id", "tid", (F.col("start") + F.col("low")).alias("a"), (F.col("start") + F.col("high") + window).alias("b"), "first_id")


def _found(docs: DataFrame, distinct: DataFrame, scratch: Scratch, window: int, longer: list[int]) -> DataFrame:
    """RUNS of the distinct fragments: by the shards of their anchors, or cut again by longer anchors."""
    counts = scratch.save(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts")), "counts")
    texts = scratch.save(_texts(docs, distinct.join(counts, "anchor")), "texts")
    few = F.col("texts") <= ANCHOR_TEXTS
    n_few, n_many = texts.agg(F.count_if(few), F.count_if(~few)).first()
    found = scratch.save(_matched(texts.where(few), window, max(1, -(-n_few // SHARD_TEXTS))), "runs")
    if n_many:
        many = texts.where(~few).select("anchor", "frag", F.col("first_id").alias("doc_id"), "last_id", F.monotonically_increasing_id().alias("tid"), F.col("words").alias("text"))
        many = scratch.save(many, "many")
        inner = _spans(many.select("doc_id", "last_id", "tid", "text"), scratch, window, longer)
        inner = inner.select("tid", F.col("a").alias("low"), (F.col("b") - window).alias("high"), "first_id")
        inner = many.select("tid", "anchor", "frag").join(inner, "tid").select("anchor", "frag", "low", "high", "first_id")
        found = found.unionByName(scratch.save(inner, "inner"))
    scratch.drop(texts, counts)
    return found


def spans(docs: DataFrame, scratch: Scratch, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, tid, s: the word spans [a, b) that earlier documents hold, which may overlap.

    ``docs`` has doc_id, text and tid, a hash of the text that tells rows of one doc_id apart. Rows with
    a null doc_id are neither earlier nor later than others.
    """
    docs = docs.where("doc_id is not null").withColumn("last_id", F.col("doc_id"))
    gone = _spans(docs, scratch, window, _grams(window, gram))
    # Rows that repeat find the same spans: a set holds each once.
    return gone.groupBy("doc_id", "tid").agg(F.collect_set(F.struct("a", "b")).alias("s"))


KEPT = "doc_id long, n_words long, n_removed long, kept string"


def removed(found: list[dict], n: int) -> np.ndarray:
    """Which of n words the spans cover."""
    edges = np.zeros(n + 1, np.int64)
    for span in found or ():
        edges[span["a"]] += 1
        edges[span["b"]] -= 1
    return np.cumsum(edges[:-1]) > 0


def _each(docs: DataFrame, window: int, gram: int, schema: str, finish) -> DataFrame:
    """finish(kept words) for each document, from what is left of it."""
    plain = only(docs, doc_id="long", text="string").withColumn("tid", F.xxhash64("text"))
    found = spans(plain, Scratch(docs.sparkSession, "substrings"), window, gram)
    out = arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat(batch.column("text"))
            data = raw.tobytes()
            ends: list[list] = [[], [], []]
            for i, s in enumerate(batch.column("s").to_pylist()):
                own = data[offsets[i] : offsets[i + 1]].split()
                gone = removed(s, len(own))
                left = list(itertools.compress(own, (~gone).tolist())) if s else own
                for column, x in zip(ends, (len(own), len(own) - len(left), finish(b" ".join(left))), strict=True):
                    column.append(x)
            yield rows(out, batch.column("doc_id"), *ends)

    return plain.join(found, ["doc_id", "tid"], "left").select("doc_id", "text", "s").mapInArrow(run, schema)


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, and the kept words joined by one space.

    A word goes if a window that covers it also starts in a document with a smaller doc_id; windows
    are those of the input, so what goes in one document does not spare another. Copies under one
    doc_id do not count against each other, nor do rows with a null doc_id, which lose nothing. Null and
    empty texts have no words; texts shorter than a window lose nothing. Order and repeats of rows do not matter, an empty table gives no rows,
    other columns take no part.
    """
    return _each(docs, window, gram, KEPT, bytes.decode)


def digests(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """As dedup, with kept_sha256 in place of the kept words."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _each(docs, window, gram, schema, lambda kept: hashlib.sha256(kept).hexdigest())
