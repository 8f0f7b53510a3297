"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` (a long, b long) to (node, root): each linked node and the smallest node it reaches.

    Each round hangs every node's larger neighbours below its smallest one (large star), then does
    the same for the smaller ones (small star), until nothing changes: a logarithmic number of
    rounds. Minima are aggregated and written before they are joined back: both sides are then
    plain shuffles, and Spark can split the rows of a node with very many links. Nulls and loops are ignored; without links the result is empty.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = scratch.save(links.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = scratch.save(least, "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.distinct(), "large")
        down = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        moved = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.save(moved.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _mark(after)
        scratch.drop(edges, least, large, down)
        edges = after
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)
