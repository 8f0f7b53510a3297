"""Ad hoc reports over the views. Ties in a top-n list are broken by the natural id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.domains import CARRIER_ORDER, SUPPLIER_ORDER
from riskmart.functions.exprs import mean, money_sum, position_in


def top(
    view: DataFrame, n: int, order: Sequence[Column | str], columns: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` rows: each task keeps its own n, no full sort."""
    best = view.orderBy(*order).limit(n)
    return best.select(*columns) if columns else best


def category_counts(
    view: DataFrame, category: str, count_name: str, order: Sequence[str]
) -> DataFrame:
    """Rows per category in a fixed order of labels."""
    return (
        view.groupBy(category)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(position_in(F.col(category), order))
    )


# --- suppliers ---------------------------------------------------------------


def top_risk_suppliers(risk: DataFrame, n: int = 20) -> DataFrame:
    return top(risk, n, [F.desc("RiskScore"), "SupplierID"])


def risk_distribution(risk: DataFrame) -> DataFrame:
    return category_counts(risk, "RiskCategory", "SupplierCount", SUPPLIER_ORDER)


def highest_risk_brief(risk: DataFrame, n: int = 10) -> DataFrame:
    return top(
        risk,
        n,
        [F.desc("RiskScore"), "SupplierID"],
        [
            "SupplierID",
            "SupplierName",
            "Country",
            "LateShipmentPct",
            "AvgDelayDays",
            "AvgQualityScore",
            "PurchaseDependencyPct",
            "RiskScore",
            "RiskCategory",
        ],
    )


def top_business_impact(dependency: DataFrame, n: int = 20) -> DataFrame:
    return top(
        dependency,
        n,
        [F.desc("BusinessImpactScore"), "SupplierID"],
        [
            "SupplierID",
            "SupplierName",
            "Country",
            "TotalPurchaseValue",
            "CompanyPurchaseDependencyPct",
            "ProductsSupplied",
            "WarehousesSupported",
            "HighlyDependentProducts",
            "BusinessImpactScore",
            "DependencyRiskCategory",
        ],
    )


def dependency_distribution(dependency: DataFrame) -> DataFrame:
    return category_counts(dependency, "DependencyRiskCategory", "SupplierCount", SUPPLIER_ORDER)


def top_products_supplied(dependency: DataFrame, n: int = 10) -> DataFrame:
    return top(
        dependency,
        n,
        [F.desc("ProductsSupplied"), "SupplierID"],
        [
            "SupplierName",
            "Country",
            "ProductsSupplied",
            "WarehousesSupported",
            "TotalPurchaseValue",
            "BusinessImpactScore",
        ],
    )


def top_dependent_products(dependency: DataFrame, n: int = 10) -> DataFrame:
    return top(
        dependency,
        n,
        [F.desc("HighlyDependentProducts"), F.desc("BusinessImpactScore"), "SupplierID"],
        [
            "SupplierName",
            "ProductsSupplied",
            "HighlyDependentProducts",
            "ModerateDependentProducts",
            "MaxProductDependencyPct",
            "BusinessImpactScore",
        ],
    )


# --- inventory ---------------------------------------------------------------

_STOCK_ID = "InventoryRecordID"


def stockouts(stock: DataFrame) -> DataFrame:
    return (
        stock.where(F.col("InventoryRiskStatus") == "Stockout")
        .orderBy(F.desc("InventoryRiskValue"), _STOCK_ID)
        .select(
            "ProductID",
            "ProductName",
            "WarehouseName",
            "AvailableStock",
            "AvgDailyDemand",
            "StockCoverageDays",
            "InventoryRiskValue",
        )
    )


def reorder_candidates(stock: DataFrame, n: int = 20) -> DataFrame:
    return top(
        stock.where(F.col("InventoryRiskStatus").isin("Critical", "Reorder Required")),
        n,
        [F.desc("InventoryRiskScore"), _STOCK_ID],
        [
            "ProductID",
            "ProductName",
            "WarehouseName",
            "AvailableStock",
            "ReorderLevel",
            "SafetyStockLevel",
            "StockGapQty",
            "SuggestedReorderQty",
            "InventoryRiskScore",
        ],
    )


def overstock_by_value(stock: DataFrame, n: int = 20) -> DataFrame:
    return top(
        stock.where(F.col("InventoryRiskStatus") == "Overstock"),
        n,
        [F.desc("InventoryValue"), _STOCK_ID],
        [
            "ProductID",
            "ProductName",
            "WarehouseName",
            "AvailableStock",
            "ReorderLevel",
            "InventoryValue",
            "StockCoverageDays",
        ],
    )


def warehouse_risk(stock: DataFrame) -> DataFrame:
    status = F.col("InventoryRiskStatus")
    used = F.col("WarehouseUtilizationPct")
    return (
        stock.groupBy("WarehouseName")
        .agg(
            F.count(F.lit(1)).alias("InventoryItems"),
            F.count_if(status == "Stockout").alias("StockoutItems"),
            F.count_if(status == "Critical").alias("CriticalItems"),
            mean(F.sum(used), F.count(used)).alias("AvgUtilizationPct"),
            money_sum(F.col("InventoryValue")).alias("TotalInventoryValue"),
        )
        .orderBy(F.desc("StockoutItems"), F.desc("CriticalItems"), "WarehouseName")
    )


# --- carriers ----------------------------------------------------------------


def top_carriers(carriers: DataFrame, n: int = 20) -> DataFrame:
    return top(
        carriers,
        n,
        [F.desc("LogisticsPerformanceScore"), "CarrierID"],
        [
            "CarrierName",
            "CarrierType",
            "ServiceLevel",
            "TotalShipments",
            "OnTimeDeliveryPct",
            "DelayPct",
            "AvgDeliveryDays",
            "AvgDelayDays",
            "AvgShippingCost",
            "ShippingCostPerUnit",
            "DamageRatePct",
            "LogisticsPerformanceScore",
            "CarrierPerformanceCategory",
        ],
    )


def best_carriers(carriers: DataFrame, n: int = 10) -> DataFrame:
    return top(
        carriers,
        n,
        [F.desc("LogisticsPerformanceScore"), "CarrierID"],
        [
            "CarrierName",
            "OnTimeDeliveryPct",
            "AvgDelayDays",
            "ShippingCostPerUnit",
            "DamageRatePct",
            "LogisticsPerformanceScore",
        ],
    )


def worst_carriers(carriers: DataFrame, n: int = 10) -> DataFrame:
    return top(
        carriers,
        n,
        [F.asc_nulls_first("LogisticsPerformanceScore"), "CarrierID"],
        [
            "CarrierName",
            "TotalShipments",
            "DelayPct",
            "AvgDelayDays",
            "AvgShippingCost",
            "DamageRatePct",
            "LogisticsPerformanceScore",
        ],
    )


def carrier_distribution(carriers: DataFrame) -> DataFrame:
    return category_counts(carriers, "CarrierPerformanceCategory", "CarrierCount", CARRIER_ORDER)


# --- previews of the dashboards --------------------------------------------------


def supplier_dashboard_preview(dashboard: DataFrame, n: int = 20) -> DataFrame:
    return top(
        dashboard,
        n,
        ["RiskRank", "SupplierID"],
        [
            "SupplierName",
            "Country",
            "RiskScore",
            "RiskCategory",
            "RiskRank",
            "TotalPurchaseValue",
            "PurchaseValueRank",
            "LateShipmentPct",
            "LateDeliveryRank",
        ],
    )


def inventory_dashboard_preview(dashboard: DataFrame, n: int = 20) -> DataFrame:
    return top(dashboard, n, [F.desc("InventoryRiskScore"), _STOCK_ID])


def logistics_dashboard_preview(dashboard: DataFrame, n: int = 20) -> DataFrame:
    return top(dashboard, n, [F.desc("LogisticsPerformanceScore"), "CarrierID"])


def dependency_dashboard_preview(dashboard: DataFrame, n: int = 20) -> DataFrame:
    return top(dashboard, n, [F.desc("BusinessImpactScore"), "SupplierID"])
