"""Inventory risk on the latest snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.domains import INVENTORY_BANDS, INVENTORY_FLOOR
from riskmart.functions.exprs import PCT, bands, ratio
from riskmart.functions.stock import (
    base_score,
    coverage_status,
    stock_gap,
    stock_status,
    suggested_reorder,
    value_at_risk,
)
from riskmart.operators.ranks import attach_rank
from riskmart.sources.schemas import FACTS
from riskmart.sources.workspace import materialize

POSITION = [
    "InventoryKey",
    "InventoryRecordID",
    "ProductKey",
    "ProductID",
    "ProductName",
    "Category",
    "SubCategory",
    "UnitCost",
    "WarehouseKey",
    "WarehouseID",
    "WarehouseName",
    "WarehouseCountry",
    "WarehouseCity",
    "SnapshotDate",
    "CurrentStock",
    "ReservedStock",
    "AvailableStock",
    "ReorderLevel",
    "SafetyStockLevel",
    "AvgDailyDemand",
    "StockCoverageDays",
    "InventoryValue",
    "WarehouseUtilizationPct",
]

# Columns of the view, in order.
COLUMNS = [
    "InventoryKey",
    "InventoryRecordID",
    "ProductKey",
    "ProductID",
    "ProductName",
    "Category",
    "SubCategory",
    "WarehouseKey",
    "WarehouseID",
    "WarehouseName",
    "WarehouseCountry",
    "WarehouseCity",
    "SnapshotDate",
    "CurrentStock",
    "ReservedStock",
    "AvailableStock",
    "ReorderLevel",
    "SafetyStockLevel",
    "StockGapQty",
    "SuggestedReorderQty",
    "AvgDailyDemand",
    "StockCoverageDays",
    "InventoryValue",
    "InventoryRiskValue",
    "WarehouseUtilizationPct",
    "InventoryRiskStatus",
    "CoverageStatus",
    "InventoryRiskScore",
    "RiskPriority",
]


#: Table of one row per snapshot, written with the load.
SNAPSHOTS = "InventorySnapshots"


def snapshots(inventory: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per snapshot in the calendar: DateKey, FullDate and its rows."""
    counted = inventory.groupBy("DateKey").agg(F.count(F.lit(1)).alias("RowCount"))
    return counted.join(dim_date.select("DateKey", "FullDate"), "DateKey").select("DateKey", "FullDate", "RowCount")


def latest_snapshot(found: DataFrame) -> DataFrame:
    """One row: the last snapshot in the calendar, as date and as key. Reads no stock row."""
    return found.agg(
        F.max("FullDate").alias("LatestInventoryDate"),
        F.max_by("DateKey", "FullDate").alias("LatestDateKey"),
    )


def current_inventory(star: Mapping[str, DataFrame]) -> DataFrame:
    """Stock at the latest snapshot.

    The latest key is a scalar subquery on the table of snapshots: it is looked up when the frame runs,
    before the fact's files are listed, and prunes the fact to one partition.
    """
    found = star[SNAPSHOTS] if SNAPSHOTS in star else snapshots(star["FactInventory"], star["DimDate"])
    latest = latest_snapshot(found).select("LatestDateKey").scalar()
    product = star["DimProduct"].select(
        "ProductKey", "ProductID", "ProductName", "Category", "SubCategory", "UnitCost"
    )
    warehouse = star["DimWarehouse"].select(
        "WarehouseKey",
        "WarehouseID",
        "WarehouseName",
        F.col("Country").alias("WarehouseCountry"),
        F.col("City").alias("WarehouseCity"),
    )
    day = star["DimDate"].select("DateKey", F.col("FullDate").alias("SnapshotDate"))
    fact = star["FactInventory"].where(F.col("DateKey") == latest)
    kept = ["InventoryKey", "InventoryRecordID", "ProductKey", "WarehouseKey", "DateKey"]
    kept += [c for c in FACTS["FactInventory"].measures if c != "RiskStatus"]
    return (
        fact.select(*kept)
        .join(product, "ProductKey")
        .join(warehouse, "WarehouseKey")
        .join(day, "DateKey")
        .select(*POSITION)
    )


def inventory_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Everything that needs one row only; enough for counting statuses."""
    return (
        current_inventory(star)
        .withColumns(
            {
                "StockGapQty": stock_gap(),
                "SuggestedReorderQty": suggested_reorder(),
                "InventoryRiskStatus": stock_status(),
                "CoverageStatus": coverage_status(),
                "InventoryRiskValue": value_at_risk(),
            }
        )
        .withColumn("BaseRiskScore", base_score())
    )


def inventory_scores(star: Mapping[str, DataFrame]) -> DataFrame:
    """Base score and the rank of the value at risk among all current stock rows.

    The rank runs over fact-sized data with one value (nothing at risk) on most rows,
    so only distinct values are ranked and the result is joined back.
    """
    metrics = materialize(inventory_metrics(star), "stock")
    ranked, rows = attach_rank(metrics, "InventoryRiskValue")
    # 70 % of any base score has two digits at most: rounding the rank part rounds the sum.
    place = ratio((F.col("_rank") - 1) * 30, F.lit(rows - 1))
    score = F.col("BaseRiskScore") * F.lit(Decimal("0.70")) + F.coalesce(place, F.lit(0))
    return ranked.withColumn("InventoryRiskScore", score.cast(PCT)).drop("_rank")


def inventory_risk(star: Mapping[str, DataFrame]) -> DataFrame:
    priority = bands(F.col("InventoryRiskScore"), INVENTORY_BANDS, INVENTORY_FLOOR)
    return inventory_scores(star).withColumn("RiskPriority", priority).select(*COLUMNS)
