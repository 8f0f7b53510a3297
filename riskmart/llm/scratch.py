"""Tables written between steps, in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only in a local session that names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="llm-")
    return _local[app]


class Scratch:
    """Written tables of one run: they cut lineage, outlive lost executors and tell Spark real sizes.

    What a returned DataFrame still reads stays; give the folder an expiry rule.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables of this run that no later step reads."""
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch)
            path.getFileSystem(conf).delete(path, True)
