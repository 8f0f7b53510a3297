"""Carrier performance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.domains import CARRIER_BANDS, CARRIER_FLOOR, CARRIER_WEIGHTS
from riskmart.functions.exprs import MONEY, bands, mean, money_sum, percent, weighted
from riskmart.operators.ranks import Ranking, with_ranks

PROFILE = ["CarrierKey", "CarrierID", "CarrierName", "CarrierType", "Country", "ServiceLevel"]

# Columns of the view, in order.
COLUMNS = [
    *PROFILE,
    "TotalShipments",
    "OnTimeShipments",
    "LateShipments",
    "OnTimeDeliveryPct",
    "DelayPct",
    "AvgDeliveryDays",
    "AvgDelayDays",
    "AvgShippingCost",
    "TotalShippingCost",
    "ShippingCostPerUnit",
    "TotalQuantityShipped",
    "TotalDamagedQuantity",
    "DamageRatePct",
    "DeliveryPerformanceScore",
    "CostEfficiencyScore",
    "DamagePerformanceScore",
    "LogisticsPerformanceScore",
    "CarrierPerformanceCategory",
]

SCORES = [
    Ranking("OnTimeDeliveryPct", "DeliveryPerformanceScore", True, "percent_rank", few=True),
    Ranking("AvgShippingCost", "CostEfficiencyScore", False, "percent_rank"),
    Ranking("DamageRatePct", "DamagePerformanceScore", False, "percent_rank", few=True),
]


def carrier_metrics(shipments: DataFrame) -> DataFrame:
    delay = F.col("DelayDays")
    sums = shipments.groupBy("CarrierKey").agg(
        F.count(F.lit(1)).alias("TotalShipments"),
        F.count_if(delay <= 0).alias("OnTimeShipments"),
        F.count_if(delay > 0).alias("LateShipments"),
        F.sum("DeliveryDays").alias("_days"),
        F.count("DeliveryDays").alias("_day_rows"),
        F.sum(F.when(delay > 0, delay).otherwise(0)).alias("_late_days"),
        F.count("ShippingCost").alias("_cost_rows"),
        money_sum(F.col("ShippingCost")).alias("TotalShippingCost"),
        F.sum("QuantityShipped").alias("TotalQuantityShipped"),
        F.sum("DamagedQuantity").alias("TotalDamagedQuantity"),
    )
    rows = F.col("TotalShipments")
    return sums.select(
        "CarrierKey",
        "TotalShipments",
        "OnTimeShipments",
        "LateShipments",
        percent(F.col("OnTimeShipments"), rows).alias("OnTimeDeliveryPct"),
        percent(F.col("LateShipments"), rows).alias("DelayPct"),
        mean(F.col("_days"), F.col("_day_rows")).alias("AvgDeliveryDays"),
        mean(F.col("_late_days"), rows).alias("AvgDelayDays"),
        mean(F.col("TotalShippingCost"), F.col("_cost_rows"), MONEY).alias("AvgShippingCost"),
        "TotalShippingCost",
        "TotalQuantityShipped",
        "TotalDamagedQuantity",
        percent(F.col("TotalDamagedQuantity"), F.col("TotalQuantityShipped")).alias(
            "DamageRatePct"
        ),
    )


def carrier_details(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every carrier; one without shipments keeps NULL metrics."""
    return star["DimCarrier"].join(carrier_metrics(star["FactShipments"]), "CarrierKey", "left")


def with_unit_cost(carriers: DataFrame) -> DataFrame:
    cost = mean(F.col("TotalShippingCost"), F.col("TotalQuantityShipped"), MONEY)
    return carriers.withColumn("ShippingCostPerUnit", cost)


def carrier_scores(star: Mapping[str, DataFrame]) -> DataFrame:
    return with_ranks(with_unit_cost(carrier_details(star)), SCORES)


def carrier_composite(star: Mapping[str, DataFrame]) -> DataFrame:
    return carrier_scores(star).withColumn("LogisticsPerformanceScore", weighted(CARRIER_WEIGHTS))


def logistics_performance(star: Mapping[str, DataFrame]) -> DataFrame:
    category = bands(F.col("LogisticsPerformanceScore"), CARRIER_BANDS, CARRIER_FLOOR)
    return (
        carrier_composite(star)
        .withColumn("CarrierPerformanceCategory", category)
        .select(*COLUMNS)
    )
