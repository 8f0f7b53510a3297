"""Records of CSV files whose quoted fields may hold line breaks, found by several tasks per file.

A line ends a record if the quotes before its end are even in number: doubled quotes do not change that. Every
byte range of a file counts its quotes; the sums of the ranges before it tell whether a range begins inside
a field. Within a range the lines are counted on from there, and lines that belong together become one record.
Only the pieces at the edges of ranges, two per range at most, meet those of other ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def _joined(parts: str, text: str) -> str:
    """SQL: the texts of an array of structs in order, with a line break between."""
    return f"array_join(transform(array_sort({parts}), x -> x.{text}), '\n')"


def records(spark: SparkSession, path: str) -> DataFrame:
    """record string, first boolean (the first of its file); line breaks within are single line feeds.

    Blank lines between records are left out. A quote that is never closed takes the rest of its file into one
    record, as it does in any reader.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.regexp_replace("value", "\r$", "").alias("_line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_at"),  # grows along a range
    )
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit(QUOTE)))
    ranges = lines.groupBy("_file", "_range").agg(F.sum(quotes).alias("_quotes"))
    earlier = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_file", "_range", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_file", "_range").orderBy("_at")
    met = F.col("_before") + F.sum(quotes).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ended = F.sum(F.col("_ends").cast("bigint")).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    pieces = (
        lines.join(ranges, ["_file", "_range"])
        .withColumn("_ends", met % 2 == 0)
        .withColumn("_number", F.coalesce(ended, F.lit(0)))
        .groupBy("_file", "_range", "_before", "_number")
        .agg(F.collect_list(F.struct("_at", "_line")).alias("_lines"), F.max("_ends").alias("_ends"))
        .withColumn("record", F.expr(_joined("_lines", "_line")))
        .withColumn("_begins", (F.col("_number") > 0) | (F.col("_before") % 2 == 0))
        .drop("_lines", "_before")
    )
    first = (F.col("_range") == 0) & (F.col("_number") == 0)
    whole = pieces.where("_begins AND _ends").select("record", first.alias("first"))
    along = Window.partitionBy("_file").orderBy("_range", "_number")
    edges = pieces.where("NOT (_begins AND _ends)").withColumn("_chain", F.sum(F.col("_begins").cast("bigint")).over(along))
    mended = edges.groupBy("_file", "_chain").agg(
        F.collect_list(F.struct("_range", "_number", "record")).alias("_parts"), F.max(first).alias("first")
    )
    mended = mended.select(F.expr(_joined("_parts", "record")).alias("record"), "first")
    return whole.unionByName(mended).where(F.trim("record") != "")
