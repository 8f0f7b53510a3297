"""Measures, cards and chart tables behind the report pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.exprs import MONEY, mean, money_sum, percent, ratio
from riskmart.plans.reports import top

FRACTION = "decimal(18,6)"


def _divide(num, den):
    """Fraction with six digits; 0 when the divisor is 0 or missing."""
    return F.coalesce(ratio(num, den, 6, FRACTION), F.lit(0).cast(FRACTION))


# --- measures ------------------------------------------------------------------


def total_purchase_value(orders: DataFrame) -> DataFrame:
    """All orders, cancelled ones included."""
    return orders.agg(money_sum(F.col("OrderValue")).alias("TotalPurchaseValue"))


def dependency_share(dependency: DataFrame, slicers: Sequence[str] = ()) -> DataFrame:
    """Value per supplier name over the value of all names, within the other slicers."""
    value = F.sum("TotalPurchaseValue").alias("TotalPurchaseValue")
    named = dependency.groupBy("SupplierName", *slicers).agg(value)
    share = _divide(F.col("TotalPurchaseValue"), F.col("_all"))
    if slicers:
        whole = dependency.groupBy(*[F.col(s).alias(f"_{s}") for s in slicers]).agg(
            F.sum("TotalPurchaseValue").alias("_all")
        )
        same = [F.col(s).eqNullSafe(F.col(f"_{s}")) for s in slicers]
        joined = named.join(whole, same)
    else:
        joined = named.withColumn("_all", dependency.agg(F.sum("TotalPurchaseValue")).scalar())
    return joined.select(
        "SupplierName", *slicers, "TotalPurchaseValue", share.alias("DependencyShare")
    )


def overstock_ratio(stock: DataFrame, by: Sequence[str] = ("ProductID",)) -> DataFrame:
    held, level = F.sum("CurrentStock"), F.sum("ReorderLevel")
    return stock.groupBy(*by).agg(
        held.alias("CurrentStock"),
        level.alias("ReorderLevel"),
        _divide(held, level).alias("OverstockRatio"),
    )


# --- cards ---------------------------------------------------------------------


def control_tower_cards(star: Mapping[str, DataFrame], summary: DataFrame) -> DataFrame:
    suppliers = star["DimSupplier"].agg(F.count(F.lit(1))).scalar()
    return summary.select(
        suppliers.alias("TotalSuppliers"),
        "TotalOrders",
        "HighRiskSuppliers",
        "OnTimeDeliveryPct",
        "InventoryRiskItems",
        "TotalPurchaseValue",
    )


def supplier_cards(risk: DataFrame) -> DataFrame:
    def average(c: str):
        return mean(F.sum(c), F.count(c))

    return risk.agg(
        F.count(F.lit(1)).alias("TotalSuppliers"),
        F.count_if(F.col("RiskCategory").isin("High", "Critical")).alias("HighRiskSuppliers"),
        average("RiskScore").alias("AvgRiskScore"),
        average("AvgQualityScore").alias("AvgQualityScore"),
        average("AvgDelayDays").alias("AvgDeliveryDelay"),
    )


def inventory_cards(stock: DataFrame) -> DataFrame:
    status = F.col("InventoryRiskStatus")
    return stock.agg(
        F.sum("CurrentStock").alias("TotalInventoryUnits"),
        F.count_if(status == "Critical").alias("CriticalStockItems"),
        F.count_if(status == "Reorder Required").alias("LowStockItems"),
        F.count_if(status == "Overstock").alias("OverstockItems"),
        money_sum(F.col("InventoryValue")).alias("TotalInventoryValue"),
    )


def logistics_cards(shipments: DataFrame) -> DataFrame:
    delay, cost = F.col("DelayDays"), money_sum(F.col("ShippingCost"))
    rows = F.count(F.lit(1))
    return shipments.agg(
        rows.alias("TotalShipments"),
        percent(F.count_if(delay <= 0), rows).alias("OnTimeDeliveryPct"),
        mean(F.sum(F.when(delay > 0, delay).otherwise(0)), rows).alias("AvgDeliveryDelay"),
        cost.alias("TotalShippingCost"),
        mean(cost, F.count("ShippingCost"), MONEY).alias("AvgShippingCost"),
    )


# --- supplier charts -------------------------------------------------------------


def supplier_risk_matrix(risk: DataFrame) -> DataFrame:
    return risk.select(
        "SupplierID",
        "SupplierName",
        "RiskCategory",
        "PurchaseDependencyPct",
        "TotalPurchaseValue",
        "RiskScore",
    )


def top_high_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    high = risk.where(F.col("RiskCategory").isin("High", "Critical"))
    shown = ["SupplierID", "SupplierName", "RiskScore", "RiskCategory"]
    return top(high, n, [F.desc("RiskScore"), "SupplierID"], shown)


def top_late_suppliers(risk: DataFrame, n: int = 10) -> DataFrame:
    shown = ["SupplierID", "SupplierName", "TotalShipments", "LateShipments", "LateShipmentPct"]
    return top(risk, n, [F.desc("LateShipmentPct"), "SupplierID"], shown)


def supplier_detail(risk: DataFrame) -> DataFrame:
    return risk.select(
        "SupplierID",
        "SupplierName",
        "Country",
        "AvgDelayDays",
        "AvgQualityScore",
        "LateShipmentPct",
        "PurchaseDependencyPct",
        "TotalPurchaseValue",
        "RiskScore",
        "RiskCategory",
    )


# --- inventory charts ------------------------------------------------------------


def stock_by_product(stock: DataFrame) -> DataFrame:
    return stock.groupBy("ProductID", "ProductName").agg(
        F.sum("CurrentStock").alias("CurrentStock"), F.sum("ReorderLevel").alias("ReorderLevel")
    )


def lowest_stock_products(stock: DataFrame, n: int = 10) -> DataFrame:
    return top(stock_by_product(stock), n, ["CurrentStock", "ProductID"])


def highest_overstock_products(stock: DataFrame, n: int = 10) -> DataFrame:
    ratios = overstock_ratio(stock, ["ProductID", "ProductName"])
    return top(ratios, n, [F.desc("OverstockRatio"), "ProductID"])


def stock_by_warehouse(stock: DataFrame) -> DataFrame:
    return stock.groupBy("WarehouseName").agg(
        F.sum("CurrentStock").alias("CurrentStock"),
        money_sum(F.col("InventoryValue")).alias("InventoryValue"),
    )


def products_by_warehouse(stock: DataFrame) -> DataFrame:
    return stock.groupBy("WarehouseName").agg(F.count_distinct("ProductKey").alias("Products"))


# --- carrier charts --------------------------------------------------------------


def carrier_on_time(carriers: DataFrame) -> DataFrame:
    return carriers.select("CarrierID", "CarrierName", "OnTimeDeliveryPct")


def top_delayed_carriers(carriers: DataFrame, n: int = 10) -> DataFrame:
    shown = ["CarrierID", "CarrierName", "AvgDelayDays"]
    return top(carriers, n, [F.desc_nulls_last("AvgDelayDays"), "CarrierID"], shown)


def carrier_cost(carriers: DataFrame) -> DataFrame:
    return carriers.select("CarrierID", "CarrierName", "TotalShippingCost", "AvgShippingCost")


def carrier_cost_vs_delay(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        "CarrierID", "CarrierName", "AvgShippingCost", "AvgDelayDays", "TotalShipments"
    )


def carrier_volume(carriers: DataFrame) -> DataFrame:
    return carriers.select("CarrierID", "CarrierName", "TotalShipments")


def carrier_detail(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        "CarrierID",
        "CarrierName",
        "CarrierType",
        "ServiceLevel",
        "TotalShipments",
        "OnTimeDeliveryPct",
        "AvgDelayDays",
        "AvgShippingCost",
        "TotalShippingCost",
        "LogisticsPerformanceScore",
        "CarrierPerformanceCategory",
    )


# --- plain supplier means ----------------------------------------------------------


def supplier_means(shipments: DataFrame) -> DataFrame:
    """Mean signed delay and mean shipment quality per supplier."""
    return shipments.groupBy("SupplierKey").agg(
        mean(F.sum("DelayDays"), F.count("DelayDays")).alias("AvgDelay"),
        mean(F.sum("QualityScore"), F.count("QualityScore")).alias("Quality"),
    )
