"""Reading the given tables, and small helpers the operators share."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Give Python workers the folder that holds this package, and texts in batches of a few megabytes.

    A batch size that the session was given stays.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default, made for narrow rows
        spark.conf.set(_BATCH_ROWS, "1000")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns, cast; other columns, however named, take no part."""
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()))


def draw(df: DataFrame, group: str, most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``group``: those that come first by a hash of doc_id.

    Most rows are passed over by their hash alone, so few are ranked however many there are. Hand in few
    columns, and few different groups. Rows with a null group or doc_id are not drawn.
    """
    df = df.where(F.col("doc_id").isNotNull())
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 31) - 1))
    near = df.join(F.broadcast(sizes), group).where(place / F.lit(float(1 << 31)) <= (2 * most + 50) / F.col("_size"))
    order = Window.partitionBy(group).orderBy(place, "doc_id")
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n", "_size")


def arrow(schema: str) -> pa.Schema:
    """Arrow schema from 'name type, ...' with the few types used here."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }
    fields = []
    for part in schema.split(","):
        name, kind = part.split()
        many = kind.startswith("array<")
        kind = kinds[kind.removeprefix("array<").removesuffix(">")]
        fields.append((name, pa.list_(kind) if many else kind))
    return pa.schema(fields)


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c) if isinstance(c, np.ndarray) else c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
