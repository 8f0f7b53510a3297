"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: How tables are written: ids and keys shrink by more than with Spark's default.
PARQUET = {"compression": "zstd"}

_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a scratch folder only for local sessions without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="riskmart-")
    return _local_roots[app]


def work_path(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/riskmart/{label}-{uuid.uuid4().hex}"


_open: list[list[str]] = []


def remove(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def recording() -> Iterator[list[str]]:
    """The work tables written inside, for the caller to remove when nothing reads them any more."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.remove(made)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was written inside; frames built inside must be used up by then."""
    with recording() as made:
        try:
            yield
        finally:
            remove(spark, made)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the real size.
    """
    path = work_path(df.sparkSession, label)
    for made in _open:
        made.append(path)
    df.write.options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
