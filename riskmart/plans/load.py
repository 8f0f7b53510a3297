"""The full refresh: raw files to star schema tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from riskmart.functions.domains import CALENDAR
from riskmart.operators import quality
from riskmart.operators.dimensions import build_dimension, correct_dimension, date_dimension
from riskmart.operators.facts import build_fact, with_fact_key
from riskmart.operators.staging import stage, typed_columns
from riskmart.plans.dashboards import register_all, registered
from riskmart.plans.inventory import SNAPSHOTS, snapshots
from riskmart.sources import versions
from riskmart.sources.files import malformed_rows, read_raw_folder
from riskmart.sources.schemas import DIMENSIONS, FACTS, RAW_FILES, record_ids
from riskmart.sources.workspace import scope

PARTITIONED = {"FactInventory": ["DateKey"]}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: stage(df, table) for table, df in raw.items()}


def store(df: DataFrame, folder: str, name: str) -> versions.Stored:
    return versions.write(df, folder, name, PARTITIONED.get(name, ()))


def save(spark: SparkSession, df: DataFrame, folder: str, name: str) -> DataFrame:
    """Replace a table by rows that may be read from it: the new version is seen when it is complete."""
    kept = store(df, folder, name)
    versions.publish(spark, folder, {name: kept})
    return kept.open(spark, folder.rstrip("/"))


def correct_table(spark: SparkSession, folder: str, name: str, corrections: DataFrame) -> DataFrame:
    """Overwrite attributes in a stored dimension by natural id; keys and unmatched rows stay."""
    dim = DIMENSIONS[name]
    return save(spark, correct_dimension(Star(spark, folder)[name], corrections, dim.natural, dim.key), folder, name)


class Star(Mapping[str, DataFrame]):
    """Star schema tables of one version of a mart, the last one unless another is named.

    It keeps that version: tables read later belong to those read before. What else a load wrote can be
    asked for too (``staged/Orders``, ``malformed/Orders``, ``LoadReport``), but is not listed.
    """

    def __init__(self, spark: SparkSession, folder: str, manifest: versions.Manifest | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = versions.current(spark, self.folder) if manifest is None else manifest

    def __getitem__(self, name: str) -> DataFrame:
        return self.manifest.tables[name].open(self.spark, self.folder)

    def __iter__(self) -> Iterator[str]:
        return (name for name in (*DIMENSIONS, "DimDate", *FACTS) if name in self.manifest.tables)

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, name: object) -> bool:
        return name in self.manifest.tables


def calendar_span(
    staged: Mapping[str, DataFrame], least: tuple[str, str] = CALENDAR
) -> tuple[str, str]:
    """``least``, widened to whole years that hold every date a fact looks up."""
    years = None
    for fact in FACTS.values():
        for day in fact.dates:
            year = staged[fact.staged].select(F.year(day).alias("y"))
            years = year if years is None else years.unionByName(year)
    low, high = years.agg(F.min("y"), F.max("y")).first()
    first, last = int(least[0][:4]), int(least[1][:4])
    if low is not None and low < first:
        least = (f"{max(low, 1):04d}-01-01", least[1])
    if high is not None and high > last:
        least = (least[0], f"{min(high, 9999):04d}-12-31")
    return least


def load_report(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    malformed: Mapping[str, DataFrame],
    staged: Mapping[str, DataFrame],
    star: Mapping[str, DataFrame],
) -> DataFrame:
    """What a load saw and kept: Step, TableName, RowCount.

    Steps are malformed (lines with a wrong number of fields), raw, rejected (rows with a value that
    does not convert), surplus (rows beyond the first of their id), staged, unmapped (staged rows
    that find no partner for some key) and loaded.
    """
    steps = [
        ("malformed", quality.table_counts(malformed)),
        ("raw", quality.table_counts(raw)),
        ("rejected", quality.table_counts({t: quality.rejects(df, t) for t, df in staged.items() if typed_columns(t)})),
        ("staged", quality.table_counts(staged)),
        ("loaded", quality.table_counts(star)),
    ]
    for name, fact in FACTS.items():
        surplus = quality.surplus_rows(staged[fact.staged], record_ids(fact)[:1])
        steps.append(("surplus", surplus.select(F.lit(fact.staged).alias("TableName"), F.col("SurplusRows").alias("RowCount"))))
    cover = quality.mapping_coverage(spark, staged, star)
    missing = (F.col("StagingRows") - F.col("MappedRows")).alias("RowCount")
    steps.append(("unmapped", cover.select(F.col("FactName").alias("TableName"), missing)))
    out = None
    for step, rows in steps:
        named = rows.select(F.lit(step).alias("Step"), "TableName", F.col("RowCount").cast("bigint"))
        out = named if out is None else out.unionByName(named)
    return out


def refresh(
    spark: SparkSession,
    raw_folder: str,
    mart_folder: str,
    calendar: tuple[str, str] | None = None,
    dense_fact_keys: bool = False,
) -> Star:
    """Load everything: staged tables, dimensions, then facts. Existing tables are replaced, all in one moment.

    What was there stays readable until then, and for readers that opened it until the load after the next.

    Without a ``calendar`` it covers the dates of the facts. Lines with a wrong number of
    fields are listed in malformed, and what was rejected or dropped is counted in LoadReport. Views of this mart that the application has registered are registered again.
    Fact keys have gaps unless dense ones are asked for, which costs a second write of each fact.

    Staged tables are written, as the rejects, duplicates and coverage reports and the
    facts all read them, and parsing the text once is cheaper than parsing it for each.
    """
    raw = read_raw_folder(spark, raw_folder)
    raw_folder, mart_folder = raw_folder.rstrip("/"), mart_folder.rstrip("/")
    made: dict[str, versions.Stored] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        made[name] = store(df, mart_folder, name)
        return made[name].open(spark, mart_folder)

    staged = {t: keep(df, f"staged/{t}") for t, df in stage_all(raw).items()}
    star: dict[str, DataFrame] = {}
    with scope(spark):
        for name, dim in DIMENSIONS.items():
            star[name] = keep(build_dimension(staged[dim.staged], name), name)
        star["DimDate"] = keep(date_dimension(spark, *(calendar or calendar_span(staged))), "DimDate")
        for name, fact in FACTS.items():
            rows = with_fact_key(build_fact(staged[fact.staged], star, name), name, dense_fact_keys)
            star[name] = keep(rows, name)
    keep(snapshots(star["FactInventory"], star["DimDate"]), SNAPSHOTS)
    malformed = {
        t: keep(malformed_rows(spark, f"{raw_folder}/{file}", t), f"malformed/{t}") for t, file in RAW_FILES.items()
    }
    keep(load_report(spark, raw, malformed, staged, star), "LoadReport")
    loaded = Star(spark, mart_folder, versions.publish(spark, mart_folder, made))
    versions.expire(spark, mart_folder)
    shown = registered(spark)
    if isinstance(shown, Star) and shown.folder == loaded.folder:
        register_all(loaded)
    return loaded
