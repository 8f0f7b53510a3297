"""Packing of tokenised documents into sequences: first-fit decreasing on a tournament tree.

Each document is cut into whole sequences and a rest shorter than one. A whole sequence fills a
bin by itself. The rests are packed first-fit decreasing, in groups drawn by a hash of the document and
of a number that is written with each piece: groups have a bounded size, however many rows share a
document number or a text, and no group depends on another.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.bpe import bpe, default_path
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import slices

GROUP_DOCS = 4096


class Tournament:
    """Room left in bins; the winner of each match is the larger room, the root the largest of all."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room; (bin, room before)."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        leaf, before = node - self.leaves, room[node]
        room[node] = before - size
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
        return leaf, before


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size, in the order given; larger sizes are placed first, ties in order."""
    tree = Tournament(len(sizes), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        where, before = tree.place(sizes[i])
        out[i] = (where, capacity - before)
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Each document's ids and ``end_id``, cut at multiples of ``capacity``; null text is empty."""
    schema = arrow(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(tokenizer)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found: list[list[int]] = [[], [], [], [], []]
            ids, edges = coder.encode_column(batch.column("text"), end_id)
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for start in range(0, b - a, capacity):
                    part = ids[a + start : min(a + start + capacity, b)]
                    for column, x in zip(found, (doc_id, start, len(part), zlib.crc32(part), b - a), strict=True):
                        column.append(x)
            yield rows(schema, *found)

    return only(docs, doc_id="long", text="string").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 0, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: PIECES, then sequence_id and offset (the piece's place in its sequence).

    Null and empty texts are one end id. Very long texts give many whole pieces, dealt out piece by
    piece. Rows that repeat a doc_id, or have none, are packed like others. An empty table gives no rows. Other
    columns take no part.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = pieces(docs, tokenizer or default_path(), capacity, end_id)
    # The number is written with the piece, so that pieces of equal documents spread over groups, the same on every use.
    cut = scratch.save(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    spread = F.xxhash64("doc_id", "start", "ids_crc32", "piece")
    rest, whole = cut.where(F.col("length") < capacity), cut.where(F.col("length") == capacity)
    n_rest, n_whole = cut.agg(F.count_if(F.col("length") < capacity), F.count_if(F.col("length") == capacity)).first()
    groups = max(1, -(-n_rest // group_docs))
    whole_groups = max(1, -(-n_whole // group_docs))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32", "doc_tokens"], kind="stable")
        placed = first_fit_decreasing(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = [(group << 32) | where for group, (where, _) in zip(pdf.pop("group"), placed, strict=True)]
        pdf["offset"] = [at for _, at in placed]
        return pdf

    packed = rest.withColumn("group", F.pmod(spread, F.lit(groups))).drop("piece").groupBy("group").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")
    drawn = F.pmod(spread, F.lit(whole_groups)) + groups
    number = F.row_number().over(Window.partitionBy("group").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    filled = (
        whole.withColumn("group", drawn)
        .withColumn("sequence_id", F.shiftleft(F.col("group").cast("long"), 32) + number)
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("group", "piece")
    )
    return packed.unionByName(filled)
