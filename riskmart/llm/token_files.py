"""Token-id files: documents in ascending order, in chunks coded by the context-mixing range coder.

The files are Parquet with one row per chunk of whole documents: the file's number and the chunk's
place in it, document numbers and lengths, and the coded ids (see rangecoder). Files follow each
other in document order, so a file written again after a lost executor is the same file.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.bpe import bpe, default_path
from riskmart.llm.rangecoder import decode, encode
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import slices

CHUNK_TOKENS = 4_000_000
CHUNKS = "file long, chunk long, first long, n_tokens long, doc_ids array<long>, lengths array<long>, coded binary"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, chunk_tokens: int = CHUNK_TOKENS) -> None:
    """Encode every text, append ``end_id``, and write the ids to ``path`` in ascending doc_id order.

    A null text counts as empty, a document longer than a chunk is a chunk of its own, rows that
    repeat a doc_id stand in the order of a hash of their text, rows with a null doc_id come first. An empty
    table gives a folder without chunks.
    """
    from pyspark import TaskContext

    tokenizer = tokenizer or default_path()
    schema = arrow(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number, first = bpe(tokenizer), itertools.count(), 0
        file = TaskContext.get().partitionId()
        doc_ids: list[int] = []
        coded: list[np.ndarray] = []
        waiting = 0

        def chunk() -> pa.RecordBatch:
            nonlocal doc_ids, coded, waiting, first
            tokens, lengths = np.concatenate(coded), list(map(len, coded))
            out = rows(schema, [file], [next(number)], [first], [len(tokens)], [doc_ids], [lengths], [encode(tokens)])
            first += len(tokens)
            doc_ids, coded, waiting = [], [], 0
            return out

        for batch in itertools.chain.from_iterable(map(slices, batches)):
            ids, edges = coder.encode_column(batch.column("text"), end_id)
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                doc_ids.append(doc_id)
                coded.append(ids[a:b])
                waiting += b - a
                if waiting >= chunk_tokens:
                    yield chunk()
        if doc_ids:
            yield chunk()

    # The ranges are found from a sample of their keys, so no text is among them.
    plain = only(docs, doc_id="long", text="string").withColumn("tie", F.xxhash64("text"))
    ordered = plain.repartitionByRange(F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie", "text")
    # The ids are compressed already.
    ordered.select("doc_id", "text").mapInArrow(run, CHUNKS).write.option("compression", "uncompressed").parquet(path)


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(chunks: DataFrame, per_document, schema: str) -> DataFrame:
    """Decode chunks; ``per_document(doc_ids, starts, ids)`` makes a batch of ``schema`` from each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {n: batch.column(n)[i] for n in batch.schema.names}
                tokens = decode(one["coded"].as_py())
                lengths = one["lengths"].values.to_numpy()
                ends = np.cumsum(lengths)
                if len(tokens) != one["n_tokens"].as_py() or (len(ends) and ends[-1] != len(tokens)):
                    raise ValueError("a chunk does not hold as many ids as its row says")
                start = one["first"].as_py() + one["base"].as_py()
                pieces = np.split(tokens, ends[:-1])
                yield per_document(one["doc_ids"].values, start + ends - lengths, pieces)

    files = chunks.groupBy("file").agg(F.sum("n_tokens").alias("size"))  # one row a file
    before = F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = files.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    placed = chunks.join(F.broadcast(bases), "file").select("base", "first", "n_tokens", "doc_ids", "lengths", "coded")
    return placed.mapInArrow(run, schema)


def checksums(chunks: DataFrame) -> DataFrame:
    """Per document, from the files alone: ids before it in all files, its ids, and their CRC-32."""
    schema = arrow(READ)

    def summed(doc_ids: pa.Array, starts: np.ndarray, pieces: list[np.ndarray]) -> pa.RecordBatch:
        sums = [zlib.crc32(ids.astype("<u4")) for ids in pieces]
        return rows(schema, doc_ids, starts, [len(ids) for ids in pieces], sums)

    return read(chunks, summed, READ)


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token files to scratch, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = f"{Scratch(spark, 'tokens').base}/ids"
    write(docs, path, tokenizer, end_id)
    return checksums(spark.read.schema(CHUNKS).parquet(path))
