"""Reading raw CSV files, writing tables, registering views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskmart.operators.staging import parse
from riskmart.sources.records import records
from riskmart.sources.schemas import FACTS, RAW_FILES, STAGED, raw_schema, record_ids
from riskmart.sources.workspace import PARQUET

CSV = {"quote": '"', "escape": '"'}
GZIP = {"zlib.compress.level": "FOUR"}
RECORD_IDS = tuple(dict.fromkeys(c for fact in FACTS.values() for c in record_ids(fact)))


def read_raw(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """One raw table, every column text.

    The header is checked against the expected names. Quotes are doubled inside quoted
    fields. An empty field is a missing value. ``multi_line`` accepts line breaks in fields, which read as
    line feeds; the lines of a file are then shuffled once by byte range.
    """
    schema = raw_schema(table)
    if not multi_line:
        return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, **CSV)
    names = ",".join(schema.names)
    wrong = F.concat(F.lit(f"the header does not name {names}: "), F.col("record"))
    bare = F.replace(F.col("record"), F.lit('"'))
    rows = records(spark, path).withColumn("_head", F.when(F.col("first") & (bare != names), F.raise_error(wrong)).otherwise(F.col("first").cast("string")))
    return rows.where("_head = 'false'").select(_fields(schema).alias("r")).select("r.*")


def _fields(schema: StructType, text: str = "record") -> Column:
    return F.from_csv(F.col(text), schema.simpleString()[len("struct<") : -1].replace(":", " "), CSV)


MALFORMED = "MalformedRow"


def malformed_rows(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """Lines with too many or too few fields: their fields as far as they go, and the line itself.

    ``read_raw`` drops surplus fields and fills missing ones with NULL; these are the rows where it did.
    Commas count outside quotes only. With ``multi_line`` line breaks do too. A line without quotes and with as
    many commas as it should have is told by one match; fields are counted in the others.
    """
    schema = raw_schema(table)
    line = F.col("value")
    lines = records(spark, path).select(F.col("record").alias("value")) if multi_line else spark.read.text(path)
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    plain = line.rlike(f'^[^",]*+(?:,[^",]*+){{{len(schema) - 1}}}$')
    found = lines.where(~plain & (fields != len(schema)) & (F.trim(line) != ""))
    return found.select(_fields(schema, "value").alias("r"), line.alias(MALFORMED)).select("r.*", MALFORMED)


def read_raw_folder(
    spark: SparkSession, folder: str, tables: Sequence[str] = tuple(RAW_FILES)
) -> dict[str, DataFrame]:
    return {t: read_raw(spark, f"{folder.rstrip('/')}/{RAW_FILES[t]}", t) for t in tables}


def read_dated(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table whose date columns are parsed and whose other columns stay text."""
    raw = read_raw(spark, path, table)
    dates = [c for c, kind in STAGED[table].items() if kind == "date"]
    return raw.withColumns({c: parse(F.col(c), "date") for c in dates})


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    file_rows: int = 0,
) -> None:
    """Replace a whole table. Text is written as it is unless a ``compression`` is named, Parquet in ``PARQUET``.

    Gzip packs at ``GZIP``: its usual level takes as long as all else that writing a table of text does. A file holds
    ``file_rows`` rows at most, if given: a packed file of text is read by one task. Ids of records, which hardly
    repeat, get no dictionary.

    A partitioned table is rebalanced by its partition columns: few files per partition
    value, while a value that holds much of the table is split over several tasks.
    """
    out = df
    if partition_by:
        out = df.hint("rebalance", *partition_by)
    writer = out.write.mode("overwrite").partitionBy(*partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if fmt == "csv":
        writer.options(**(GZIP if compression == "gzip" else {})).csv(
            path,
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            compression=compression,
        )
    elif fmt == "parquet":
        plain = {f"parquet.enable.dictionary#{c}": "false" for c in RECORD_IDS if c in df.columns}
        writer.options(**PARQUET, **plain).parquet(path)
    else:
        writer.format(fmt).save(path)


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
