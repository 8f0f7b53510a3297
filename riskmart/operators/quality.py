"""Rejects, duplicates, domains, coverage and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.domains import COUNTRIES
from riskmart.functions.exprs import MONEY, mean, money_sum, percent
from riskmart.operators.facts import looked_up
from riskmart.operators.staging import parse, typed_columns
from riskmart.sources.schemas import DIMENSIONS, FACTS


# --- rejects -----------------------------------------------------------------


def rejects(rows: DataFrame, table: str) -> DataFrame:
    """Rows in which a typed column does not convert; a missing value counts too.

    Raw rows are parsed for it. Columns of staged rows have been: what did not convert is missing there.
    """
    texts = {c for c, kind in rows.dtypes if kind == "string"}
    bad = [(parse(F.col(c), kind) if c in texts else F.col(c)).isNull() for c, kind in typed_columns(table).items()]
    return rows.where(reduce(lambda a, b: a | b, bad))


def supplier_date_rejects(raw: DataFrame) -> DataFrame:
    """SupplierSince texts that are present and are no date."""
    since = F.col("SupplierSince")
    return raw.where(since.isNotNull() & parse(since, "date").isNull()).select("SupplierSince")


def broken_quotes(raw: DataFrame) -> DataFrame:
    """Suppliers whose name or country still carries a CSV quote."""
    return raw.where(
        F.col("SupplierName").startswith('"') | F.col("Country").contains('"')
    ).select("SupplierID", "SupplierName", "Country", "Region", "SupplierCategory")


def unknown_countries(
    raw: DataFrame, domain: Sequence[str] = tuple(COUNTRIES)
) -> DataFrame:
    """Suppliers whose country is outside the domain; a missing country is not judged."""
    return raw.where(~F.col("Country").isin(*domain)).select(
        "SupplierID", "SupplierName", "Country"
    )


# --- duplicates ----------------------------------------------------------------


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("DuplicateCount"))
        .where(F.col("DuplicateCount") > 1)
    )


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One number: rows beyond the first of each key. Missing keys equal each other."""
    per_key = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return per_key.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("SurplusRows"))


# --- counts ----------------------------------------------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("RowCount")).select(
            F.lit(name).alias("TableName"), "RowCount"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _partners(dims: Mapping[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Per column that a fact looks up, how many rows of the dimension or the calendar hold each value.

    The calendar comes first and the first dimension of the fact last.
    """
    fact = FACTS[name]
    found = {day: dims["DimDate"].select(F.col("FullDate").alias(day)) for day in fact.dates}
    found |= {DIMENSIONS[d].natural: dims[d].select(DIMENSIONS[d].natural) for d in reversed(fact.dimensions)}
    return {c: df.groupBy(c).agg(F.count(F.lit(1)).alias(f"_n_{c}")) for c, df in found.items()}


def mapping_coverage(
    spark: SparkSession, staged: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]
) -> DataFrame:
    """Per fact: staged rows, and the rows that a load makes of those with a partner for every key and date.

    Each staged table is read once, with the columns that look something up; its rows stay where they are
    unless a dimension is too large to broadcast. What a row has found so far is one number, and before the last
    column rows are summed up by it, so that rows are shuffled for one large dimension, not for each.
    """
    parts = []
    for name, fact in FACTS.items():
        partners = _partners(dims, name)
        *early, last = partners
        found = F.lit(1).cast("bigint")
        rows = staged[fact.staged].select(*partners)
        for column in early:
            rows = rows.join(looked_up(partners[column]), column, "left")
            found = found * F.coalesce(F.col(f"_n_{column}"), F.lit(0))
        sums = rows.groupBy(last).agg(F.count(F.lit(1)).alias("_rows"), F.sum(found).alias("_found"))
        mapped = F.col("_found") * F.coalesce(F.col(f"_n_{last}"), F.lit(0))
        parts.append(
            sums.join(partners[last], last, "left")
            .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("StagingRows"), F.coalesce(F.sum(mapped), F.lit(0)).alias("MappedRows"))
            .select(F.lit(name).alias("FactName"), "StagingRows", "MappedRows")
        )
    return reduce(DataFrame.unionByName, parts)


# --- references ------------------------------------------------------------------


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no partner in the dimension, or is missing."""
    partner = dim.select(F.col(dim_key or key).alias(key))
    return fact.join(partner, key, "left_anti")


def orphan_counts(star: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a partner for each of the 18 foreign keys.

    Every fact is read once: its key columns become rows, which are counted per column and key before they are
    shuffled. What is left, a row per key in use, meets the keys of all dimensions in one join.
    """
    targets = {
        name: [(DIMENSIONS[d].key, d) for d in fact.dimensions] + [(c, "DimDate") for c in fact.dates.values()]
        for name, fact in FACTS.items()
    }
    used = []
    for name, columns in targets.items():
        cells = [
            F.struct(F.lit(c).alias("KeyColumn"), F.lit(d).alias("_dim"), F.col(c).cast("bigint").alias("_key"))
            for c, d in columns
        ]
        keys = star[name].select(F.inline(F.array(*cells))).groupBy("KeyColumn", "_dim", "_key")
        used.append(keys.agg(F.count(F.lit(1)).alias("_rows")).withColumn("FactName", F.lit(name)))
    known = [
        star[d].select(F.lit(d).alias("_dim"), F.col(DIMENSIONS[d].key if d in DIMENSIONS else "DateKey").cast("bigint").alias("_key"))
        for d in (*DIMENSIONS, "DimDate")
    ]
    partner = reduce(DataFrame.unionByName, known).distinct().withColumn("_known", F.lit(True))
    met = reduce(DataFrame.unionByName, used).join(partner, ["_dim", "_key"], "left")
    lost = met.select("FactName", "KeyColumn", F.when(F.col("_known").isNull(), F.col("_rows")).otherwise(0).alias("_lost"))
    # A fact without rows still has its keys listed.
    listed = [(name, c, 0) for name, columns in targets.items() for c, _ in columns]
    every = lost.sparkSession.createDataFrame(listed, "FactName string, KeyColumn string, _lost bigint")
    return lost.unionByName(every).groupBy("FactName", "KeyColumn").agg(F.sum("_lost").alias("OrphanRows"))


def delay_mismatches(shipments: DataFrame) -> DataFrame:
    """Shipments whose stored delay is not delivery date minus promised date."""
    dated = shipments.withColumn("DateDelay", F.datediff("DeliveryDate", "PromisedDate"))
    return dated.where(F.col("DelayDays") != F.col("DateDelay")).select(
        "ShipmentID", "PromisedDate", "DeliveryDate", "DelayDays", "DateDelay"
    )


# --- profiles --------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "ColumnName", "NullCount")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("Value"))
        .agg(F.count(F.lit(1)).alias("Rows"))
        .orderBy(F.desc("Rows"), "Value")
    )


def order_summary(orders: DataFrame) -> DataFrame:
    value = money_sum(F.col("OrderValue"))
    return orders.agg(
        F.count(F.lit(1)).alias("Orders"),
        value.alias("TotalOrderValue"),
        mean(value, F.count("OrderValue"), MONEY).alias("AvgOrderValue"),
        F.min("OrderDate").alias("FirstOrderDate"),
        F.max("OrderDate").alias("LastOrderDate"),
    )


def shipment_summary(shipments: DataFrame) -> DataFrame:
    """Early deliveries lower the mean delay here; it is not clamped."""
    cost = money_sum(F.col("ShippingCost"))
    return shipments.agg(
        F.count(F.lit(1)).alias("Shipments"),
        percent(F.count_if(F.col("DelayDays") <= 0), F.count(F.lit(1))).alias("OnTimeDeliveryPct"),
        mean(F.sum("DelayDays"), F.count("DelayDays")).alias("AvgDelayDays"),
        mean(cost, F.count("ShippingCost"), MONEY).alias("AvgShippingCost"),
        cost.alias("TotalShippingCost"),
    )


def inventory_summary(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count(F.lit(1)).alias("InventoryRecords"),
        mean(F.sum("WarehouseUtilizationPct"), F.count("WarehouseUtilizationPct")).alias(
            "AvgUtilizationPct"
        ),
        money_sum(F.col("InventoryValue")).alias("TotalInventoryValue"),
        mean(F.sum("StockCoverageDays"), F.count("StockCoverageDays"), MONEY).alias(
            "AvgCoverageDays"
        ),
    )


def inspection_summary(inspections: DataFrame) -> DataFrame:
    inspected, defects = F.sum("InspectedQuantity"), F.sum("DefectQuantity")
    return inspections.agg(
        F.count(F.lit(1)).alias("Inspections"),
        mean(F.sum("QualityScore"), F.count("QualityScore")).alias("AvgQualityScore"),
        inspected.alias("TotalInspectedQuantity"),
        defects.alias("TotalDefectQuantity"),
        percent(defects, inspected).alias("DefectRatePct"),
    )


# --- guards and previews -----------------------------------------------------------


def require_rows(df: DataFrame, n: int) -> DataFrame:
    """``df`` itself, or an error when it holds fewer than ``n`` rows."""
    found = df.limit(n).count() if n > 0 else 0
    if found < n:
        raise ValueError(f"not enough rows: wanted {n}, found {found}")
    return df


def preview(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """First rows, in the given order if any."""
    return (df.orderBy(*order) if order else df).limit(n)
