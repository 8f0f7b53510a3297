"""Removal of byte strings that occur twice or more anywhere, by run-length indexes of shards.

A window is a fixed number of consecutive bytes of one text. Every byte goes that is covered by a window whose
bytes start somewhere else too, in the same text or another.

One index over a corpus would pass through one task, so text is dealt to shards by content: of the ``gram``
bytes runs in a window, the one with the smallest hash is its anchor, and equal windows have equal anchors.
Windows of a text that follow each other and share the place of their anchor form a fragment. A fragment that
occurs twice is gone as a whole, without being read again. Only where an anchor has several fragments, one of
which occurs once, their bytes are fetched; a shard holds the fragments of its anchors in a run-length
Burrows-Wheeler index and reads the long matches off the matching statistics.

An anchor with very many fragments (a line that a large part of the corpus holds, each time among other bytes) is
cut again: its fragments become texts, with anchors of longer runs, up to the window itself, where no
fragment is longer than its anchor and nothing is left to compare.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.repeat_index import RunLengthIndex
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import BYTE_VALUES, flat_binary, slices, span_hash

WINDOW = 400
GRAMS = 8  # an anchor has at first an eighth of the window's bytes, then 3, 5 and 7 eighths
ANCHOR_TEXTS = 400  # distinct fragments of an anchor up to which it goes to a shard
SHARD_TEXTS = 800  # fragments of a shard, about half a megabyte; an index holds 2 ** 21 bytes


def _grams(window: int) -> list[int]:
    return sorted({max(1, window * k // GRAMS) for k in range(1, GRAMS, 2)} | {window})


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the smallest upper half, the first of equal ones."""
    n = len(values) - width + 1
    place = np.arange(len(values), dtype=np.uint64)
    keys = (values & np.uint64(0xFFFFFFFF00000000)) | place
    padded = np.concatenate((keys, np.full(-len(keys) % width, 0xFFFFFFFFFFFFFFFF, np.uint64))).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(backward[:n], forward[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def fragments(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text row, anchor, hash of the bytes, first byte and length of each fragment of these texts."""
    none = np.zeros(0, np.int64)
    if len(raw) < window:
        return none, none, none, none, none
    values = BYTE_VALUES[raw]
    at = np.arange(len(raw) - gram + 1)
    grams = span_hash(values, at, at + gram)
    least = _least_places(grams, window - gram + 1)
    heads, sizes = [], []
    for d in np.flatnonzero(np.diff(offsets) >= window).tolist():
        a, b = int(offsets[d]), int(offsets[d + 1]) - window + 1
        turns = np.flatnonzero(np.diff(least[a:b])) + a + 1
        first = np.append(a, turns)
        heads.append(np.column_stack((np.full(len(first), d), first)))
        sizes.append(np.append(turns, b) - first + window - 1)
    if not heads:
        return none, none, none, none, none
    doc, start = np.concatenate(heads).T
    n = np.concatenate(sizes)
    return doc, grams[least[start]].view(np.int64), span_hash(values, start, start + n).view(np.int64), start - offsets[doc], n


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a text as one; spans come by text and start."""
    if not len(doc):
        return doc, start, end
    shift = np.int64(max(int(end.max()) + 1, 1))
    reach = np.maximum.accumulate(end + doc * shift)
    new = np.append(True, start[1:] + doc[1:] * shift > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(doc)) - 1
    return doc[new], start[new], reach[last] - doc[new] * shift


FRAGMENTS = "id long, anchor long, frag long, start int, n int, copies long"


def _cut(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """FRAGMENTS of ``texts`` (id, text, copies), each one once a text.

    ``copies`` is how often it occurs in the text and its copies. Where it does so more than once within the
    text, a row without anchor tells the bytes that go for that.
    """
    schema = arrow(FRAGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            doc, anchor, frag, start, n = fragments(*flat_binary(batch.column("text")), window, gram)
            order = np.lexsort((start, frag, anchor, doc))
            own = np.column_stack((doc, anchor, frag))[order]
            new = np.append(True, (own[1:] != own[:-1]).any(1)) if len(own) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            times = np.bincount(group, minlength=0)
            again = np.sort(order[times[group] > 1])
            gone = _merged(doc[again], start[again], start[again] + n[again])
            first = order[new]
            copies = np.asarray(batch.column("copies"))[doc[first]] * times
            at = pa.array(np.concatenate((doc[first], gone[0])))
            pad = [None] * len(gone[0])
            yield rows(
                schema,
                batch.column("id").take(at),
                pa.concat_arrays([pa.array(anchor[first]), pa.array(pad, pa.int64())]),
                pa.concat_arrays([pa.array(frag[first]), pa.array(pad, pa.int64())]),
                np.concatenate((start[first], gone[1])),
                np.concatenate((n[first], gone[2] - gone[1])),
                pa.concat_arrays([pa.array(copies), pa.array(pad, pa.int64())]),
            )

    return texts.mapInArrow(run, FRAGMENTS)


PIECES = "id long, start int, anchor long, occurs long, fragments long, text binary"


def _pieces(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the fragments wanted, from the text that holds them."""
    schema = arrow(PIECES)
    each = wanted.groupBy("id").agg(F.collect_list(F.struct("start", "n", "anchor", "occurs", "fragments")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat_binary(batch.column("text"))
            data = raw.tobytes()
            out: list[tuple] = []
            for i, (number, own) in enumerate(zip(batch.column("id").to_pylist(), batch.column("w").to_pylist(), strict=True)):
                for w in own:
                    a = int(offsets[i]) + w["start"]
                    out.append((number, w["start"], w["anchor"], w["occurs"], w["fragments"], data[a : a + w["n"]]))
            yield rows(schema, *(zip(*out, strict=True) if out else [[]] * len(schema)))

    return texts.join(each, "id").select("id", "text", "w").mapInArrow(run, PIECES)


SPANS = "id long, a int, b int"


def _indexed(pieces: DataFrame, window: int, shards: int) -> DataFrame:
    """SPANS of the pieces that occur once: bytes that stand in another piece of the same anchor too."""
    schema = arrow(SPANS)

    def match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("id", "ascending"), ("start", "ascending")])
        column = table["text"].combine_chunks()
        raw, offsets = flat_binary(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
        ends = offsets[1:] + np.arange(len(offsets) - 1)
        joined = np.zeros(len(raw) + len(ends), np.uint8)
        body = np.ones(len(joined), bool)
        body[ends] = False
        joined[body] = raw
        covered = RunLengthIndex(joined, ends).repeated(window)
        edges = np.diff(np.concatenate((np.zeros(1, np.int8), covered.astype(np.int8), np.zeros(1, np.int8))))
        a, b = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        piece = np.searchsorted(ends, a)
        single = table["occurs"].to_numpy()[piece] == 1
        piece, a, b = piece[single], a[single], b[single]
        shift = table["start"].to_numpy()[piece] - (offsets[:-1] + np.arange(len(ends)))[piece]
        return pa.Table.from_batches([rows(schema, table["id"].to_numpy()[piece], a + shift, b + shift)])

    keep = pieces.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "id", "start", "anchor", "occurs", "text")
    return keep.groupBy("shard").applyInArrow(match, SPANS)


def spans(texts: DataFrame, scratch: Scratch, window: int = WINDOW, grams: list[int] | None = None) -> DataFrame:
    """SPANS that go from texts without copies, which may overlap.

    ``texts`` (id long, text binary, copies long) has distinct numbers; texts with several copies serve as
    places where strings occur.
    """
    gram, *longer = grams or _grams(window)
    cut = scratch.save(_cut(texts, window, gram), "fragments")
    local = cut.where("anchor IS NULL").select("id", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    cut = cut.where("anchor IS NOT NULL")
    # The first values of several columns come from the same row.
    distinct = cut.groupBy("anchor", "frag").agg(F.sum("copies").alias("occurs"), *(F.first(c).alias(c) for c in ("id", "start", "n")))
    distinct = scratch.save(distinct, "distinct")
    whole = distinct.where("occurs > 1").select("anchor", "frag")
    gone = cut.where("copies = 1").join(whole, ["anchor", "frag"]).select("id", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    found = local.unionByName(gone)
    if not longer:
        return found
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("fragments"), F.count_if(F.col("occurs") == 1).alias("single"))
    sizes = scratch.save(sizes.where("fragments > 1 AND single > 0").drop("single"), "sizes")
    pieces = scratch.save(_pieces(texts, distinct.join(sizes, "anchor")), "pieces")
    few = F.col("fragments") <= ANCHOR_TEXTS
    n_few, n_many = pieces.agg(F.count_if(few), F.count_if(~few)).first()
    found = found.unionByName(_indexed(pieces.where(few), window, max(1, -(-n_few // SHARD_TEXTS))))
    if n_many:
        many = pieces.where(~few).select(F.monotonically_increasing_id().alias("piece"), "id", "start", F.col("occurs").alias("copies"), "text")
        many = scratch.save(many, "many")
        inner = spans(many.select(F.col("piece").alias("id"), "text", "copies"), scratch, window, longer)
        inner = many.where("copies = 1").select(F.col("piece"), "id", "start").join(inner.withColumnRenamed("id", "piece"), "piece")
        found = found.unionByName(inner.select("id", (F.col("a") + F.col("start")).alias("a"), (F.col("b") + F.col("start")).alias("b")))
    return found


RESULTS = "tid string, n_bytes long, n_removed long, n_spans long, kept binary"


def _results(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Rows of docs as doc_id and tid, and RESULTS for each distinct text."""
    plain = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))
    keyed = plain.withColumn("tid", F.md5("text"))
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = keyed.groupBy("tid").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    texts = scratch.save(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    found = spans(texts.where(F.octet_length("text") >= window).select("id", "text", "copies"), scratch, window)
    each = scratch.save(found.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("s")), "spans")
    schema = arrow(RESULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat_binary(batch.column("text"))
            out: list[tuple] = []
            cells = (batch.column(c).to_pylist() for c in ("tid", "copies", "s"))
            for a, b, tid, copies, s in zip(offsets[:-1].tolist(), offsets[1:].tolist(), *cells, strict=True):
                n, own = b - a, raw[a:b]
                if copies > 1 and n >= window:
                    out.append((tid, n, n, 1, b""))
                    continue
                edges = np.zeros(n + 1, np.int64)
                for span in s or ():
                    edges[span["a"]] += 1
                    edges[span["b"]] -= 1
                left = np.cumsum(edges[:-1]) == 0
                gone = n - int(left.sum())
                out.append((tid, n, gone, int((left[:-1] & ~left[1:]).sum()) + int(n > 0 and not left[0]), own[left].tobytes() if gone else own.tobytes()))
            yield rows(schema, *(zip(*out, strict=True) if out else [[]] * len(schema)))

    results = texts.join(each, "id", "left").select("tid", "text", "copies", "s").mapInArrow(run, RESULTS)
    return keyed.select("doc_id", "tid"), results


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, and the kept bytes in one piece.

    Texts are UTF-8 bytes; kept bytes may begin or end within a character. A byte goes if a string of ``window``
    bytes covers it that starts anywhere else too, be it in the same text; strings are those of the input, so
    what goes in one place does not spare another. Rows are texts of their own whatever their doc_id, so
    repeated rows lose all windows, and a null doc_id counts like any other. Null and empty texts
    have no bytes; texts shorter than a window lose nothing. Order of rows does not matter, an empty table
    gives no rows, other columns take no part.
    """
    keyed, results = _results(docs, window)
    return keyed.join(results, "tid").drop("tid")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """As dedup, with kept_sha256 in place of the kept bytes."""
    keyed, results = _results(docs, window)
    return keyed.join(results.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept"), "tid").drop("tid")
