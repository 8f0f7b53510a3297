"""Row-level stock rules. A missing level makes no shortage and no alarm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.functions.domains import STOCK_BASE_OTHER, STOCK_BASE_SCORES
from riskmart.functions.exprs import MONEY, PCT


def stock_gap() -> Column:
    short = F.col("AvailableStock") < F.col("ReorderLevel")
    return F.when(short, F.col("ReorderLevel") - F.col("AvailableStock")).otherwise(0)


def suggested_reorder() -> Column:
    short = F.col("AvailableStock") < F.col("ReorderLevel")
    refill = F.col("ReorderLevel") + F.col("SafetyStockLevel") - F.col("AvailableStock")
    return F.when(short, refill).otherwise(0)


def stock_status(out_of_stock: Column | None = None) -> Column:
    """First rule that holds; unknown stock is Safe."""
    stock, reorder = F.col("AvailableStock"), F.col("ReorderLevel")
    empty = stock <= 0 if out_of_stock is None else out_of_stock
    return (
        F.when(empty, "Stockout")
        .when(stock < F.col("SafetyStockLevel"), "Critical")
        .when(stock < reorder, "Reorder Required")
        .when(stock > reorder.cast("bigint") * 3, "Overstock")
        .otherwise("Safe")
    )


def coverage_status() -> Column:
    days = F.col("StockCoverageDays")
    return (
        F.when(days <= 0, "Stockout")
        .when(days < 7, "Critical")
        .when(days < 15, "Low Coverage")
        .when(days > 90, "Excess Coverage")
        .otherwise("Healthy")
    )


def value_at_risk() -> Column:
    short = F.col("AvailableStock") < F.col("ReorderLevel")
    missing = (F.col("ReorderLevel") - F.col("AvailableStock")) * F.col("UnitCost")
    return F.when(short, missing).otherwise(F.lit(0)).cast(MONEY)


def base_score() -> Column:
    out: Column | None = None
    for status, score in STOCK_BASE_SCORES:
        hit = F.col("InventoryRiskStatus") == status
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(STOCK_BASE_OTHER).cast(PCT)
