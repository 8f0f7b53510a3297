"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept.
All but the last return the columns of documents.

An empty documents table gives no rows. Rows with a null doc_id pass the filters, as nothing can name them;
null texts pass as empty ones do. Rows that repeat a doc_id are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import decontam, line_dedup, packing, simhash, toxicity
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import ready, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, trained on the labelled documents among these."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: later copies of a line go, documents stay."""
    ready(spark)
    return line_dedup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group the document with the smallest doc_id stays."""
    ready(spark)
    return simhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item go."""
    return decontam.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one row per piece of a packed sequence."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each stage keeps is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs


#: SQL has no string kernel, edit join over a corpus, Golay code or tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
CHECKS = {}
