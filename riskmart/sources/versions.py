"""Tables that are replaced as a whole, all at once, without a moment in which one is missing.

A table is written to a folder of its own that never changes. A manifest lists the folder and schema of every
table; manifests are numbered, and the last complete one is what readers see. A load writes its tables beside the
old ones and then adds one manifest. Readers that opened an earlier one keep reading its folders.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskmart.sources.files import write_table

LOG = "_log"

#: A local file system checks and creates in two steps, and a manifest is empty before it is written.
_turn = threading.Lock()


@dataclass(frozen=True)
class Stored:
    """Where a written table is, below the folder, and its columns."""

    path: str
    schema: str

    def open(self, spark: SparkSession, folder: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(self.schema))
        return spark.read.schema(schema).parquet(f"{folder}/{self.path}")


@dataclass(frozen=True)
class Manifest:
    """The tables of one version, 0 where nothing was published yet."""

    version: int = 0
    tables: Mapping[str, Stored] = field(default_factory=dict)


def _files(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, log = _files(spark, f"{folder}/{LOG}")
    if not files.exists(log):
        return []
    names = [x.getPath().getName() for x in files.listStatus(log)]
    return sorted(int(x.removesuffix(".json")) for x in names if x.removesuffix(".json").isdigit())


def _read(spark: SparkSession, folder: str, number: int) -> Manifest | None:
    """Nothing if the manifest is not complete: its writer is at it, or was lost."""
    files, path = _files(spark, f"{folder}/{LOG}/{number:010d}.json")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Manifest(number, {name: Stored(**x) for name, x in found.items()})


def current(spark: SparkSession, folder: str) -> Manifest:
    """The last complete version."""
    folder = folder.rstrip("/")
    for number in reversed(_numbers(spark, folder)):
        found = _read(spark, folder, number)
        if found is not None:
            return found
    return Manifest()


def write(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> Stored:
    """Write a table that nobody sees before it is published."""
    path = f"{name}/v-{uuid.uuid4().hex}"
    write_table(df, f"{folder.rstrip('/')}/{path}", partition_by=partition_by)
    # Partition columns come last when a table is read.
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    return Stored(path, json.dumps(df.select(*columns).schema.jsonValue()))


def publish(spark: SparkSession, folder: str, tables: Mapping[str, Stored]) -> Manifest:
    """Add a version: these tables, and all others as they were.

    Loads of one driver that meet take turns. Between drivers the file system must refuse to create a file twice.
    """
    folder = folder.rstrip("/")
    with _turn:
        while True:
            number = max(_numbers(spark, folder), default=0) + 1
            after = dict(current(spark, folder).tables) | dict(tables)
            text = json.dumps({name: {"path": x.path, "schema": x.schema} for name, x in after.items()})
            files, path = _files(spark, f"{folder}/{LOG}/{number:010d}.json")
            try:
                stream = files.create(path, False)  # fails where the number is taken
            except Exception:
                if not files.exists(path):
                    raise
                continue
            stream.write(bytearray(text.encode()))
            stream.close()
            return Manifest(number, after)


def expire(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Remove the folders that none of the last ``keep`` versions holds, and older manifests."""
    folder = folder.rstrip("/")
    numbers = _numbers(spark, folder)
    last = [m for m in (_read(spark, folder, n) for n in numbers) if m is not None]
    old, kept = last[:-keep], last[-keep:]
    held = {x.path for m in kept for x in m.tables.values()}
    for m in old:
        for x in m.tables.values():
            if x.path not in held:
                files, path = _files(spark, f"{folder}/{x.path}")
                files.delete(path, True)
        files, path = _files(spark, f"{folder}/{LOG}/{m.version:010d}.json")
        files.delete(path, False)
