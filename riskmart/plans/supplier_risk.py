"""Supplier risk: delivery, quality and purchase metrics to one score per supplier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.domains import SUPPLIER_BANDS, SUPPLIER_FLOOR, SUPPLIER_WEIGHTS
from riskmart.functions.exprs import (
    MONEY_SUM,
    PCT,
    bands,
    mean,
    money_sum,
    percent,
    weighted,
    zero_if_null,
)
from riskmart.operators.ranks import Ranking, with_ranks, with_total
from riskmart.sources.workspace import materialize

PROFILE = [
    "SupplierKey",
    "SupplierID",
    "SupplierName",
    "Country",
    "Region",
    "SupplierCategory",
    "ActiveStatus",
]

# Columns of the view, in order.
COLUMNS = [
    *PROFILE,
    "TotalOrders",
    "TotalPurchaseValue",
    "PurchaseDependencyPct",
    "TotalShipments",
    "LateShipments",
    "LateShipmentPct",
    "AvgDelayDays",
    "AvgLateDelayDays",
    "OnTimeDeliveryPct",
    "TotalInspections",
    "AvgQualityScore",
    "DefectRatePct",
    "LateDeliveryRiskScore",
    "DelaySeverityRiskScore",
    "QualityRiskScore",
    "DependencyRiskScore",
    "RiskScore",
    "RiskCategory",
]

SCORES = [
    Ranking("LateShipmentPct", "LateDeliveryRiskScore", True, "percent_rank", few=True),
    Ranking("AvgDelayDays", "DelaySeverityRiskScore", True, "percent_rank", few=True),
    Ranking("AvgQualityScore", "QualityRiskScore", False, "percent_rank", few=True),
    Ranking("PurchaseDependencyPct", "DependencyRiskScore", True, "percent_rank", few=True),
]


def not_cancelled(orders: DataFrame) -> DataFrame:
    """Also leaves out orders without a status."""
    return orders.where(F.col("OrderStatus") != "Cancelled")


def shipment_metrics(shipments: DataFrame) -> DataFrame:
    """Late is a positive delay. An unknown delay is neither late nor on time."""
    late = F.col("DelayDays") > 0
    sums = shipments.groupBy("SupplierKey").agg(
        F.count(F.lit(1)).alias("TotalShipments"),
        F.count_if(late).alias("LateShipments"),
        F.count_if(F.col("DelayDays") <= 0).alias("_on_time"),
        F.sum(F.when(late, F.col("DelayDays"))).alias("_late_days"),
    )
    rows, late_rows = F.col("TotalShipments"), F.col("LateShipments")
    return sums.select(
        "SupplierKey",
        "TotalShipments",
        "LateShipments",
        percent(late_rows, rows).alias("LateShipmentPct"),
        mean(F.coalesce("_late_days", F.lit(0)), rows).alias("AvgDelayDays"),
        mean(F.col("_late_days"), late_rows).alias("AvgLateDelayDays"),
        percent(F.col("_on_time"), rows).alias("OnTimeDeliveryPct"),
    )


def quality_metrics(inspections: DataFrame) -> DataFrame:
    return inspections.groupBy("SupplierKey").agg(
        F.count(F.lit(1)).alias("TotalInspections"),
        mean(F.sum("QualityScore"), F.count("QualityScore")).alias("AvgQualityScore"),
        percent(F.sum("DefectQuantity"), F.sum("InspectedQuantity")).alias("DefectRatePct"),
    )


def purchase_metrics(orders: DataFrame) -> DataFrame:
    return (
        not_cancelled(orders)
        .groupBy("SupplierKey")
        .agg(
            F.count(F.lit(1)).alias("TotalOrders"),
            F.sum("OrderQuantity").alias("TotalOrderQuantity"),
            money_sum(F.col("OrderValue")).alias("TotalPurchaseValue"),
        )
    )


def supplier_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every supplier with its three sets of metrics; facts are aggregated before the joins."""
    joined = (
        star["DimSupplier"]
        .join(shipment_metrics(star["FactShipments"]), "SupplierKey", "left")
        .join(quality_metrics(star["FactSupplierQuality"]), "SupplierKey", "left")
        .join(purchase_metrics(star["FactOrders"]), "SupplierKey", "left")
    )
    counts = [
        "TotalShipments",
        "LateShipments",
        "TotalInspections",
        "TotalOrders",
        "TotalOrderQuantity",
    ]
    shares = [
        "LateShipmentPct",
        "AvgDelayDays",
        "AvgLateDelayDays",
        "OnTimeDeliveryPct",
        "DefectRatePct",
    ]
    return joined.select(
        *PROFILE,
        *[zero_if_null(F.col(c), "bigint").alias(c) for c in counts],
        *[zero_if_null(F.col(c), PCT).alias(c) for c in shares],
        F.coalesce("AvgQualityScore", F.col("QualityRating").cast(PCT)).alias("AvgQualityScore"),
        zero_if_null(F.col("TotalPurchaseValue"), MONEY_SUM).alias("TotalPurchaseValue"),
    )


def with_share(metrics: DataFrame, out: str) -> DataFrame:
    """Each supplier's part of all purchase value; ``metrics`` is read for the total and for the rows."""
    share = percent(F.col("TotalPurchaseValue"), F.col("_all"))
    return with_total(metrics, "TotalPurchaseValue", "_all").withColumn(out, share).drop("_all")


def dependency(star: Mapping[str, DataFrame]) -> DataFrame:
    """The sums are written once, a row per supplier: total, shares and ranks come from them, not from the facts."""
    return with_share(materialize(supplier_metrics(star), "suppliers"), "PurchaseDependencyPct")


def risk_scores(star: Mapping[str, DataFrame]) -> DataFrame:
    return with_ranks(dependency(star), SCORES, written=True)


def composite(star: Mapping[str, DataFrame]) -> DataFrame:
    return risk_scores(star).withColumn("RiskScore", weighted(SUPPLIER_WEIGHTS))


def supplier_risk(star: Mapping[str, DataFrame]) -> DataFrame:
    category = bands(F.col("RiskScore"), SUPPLIER_BANDS, SUPPLIER_FLOOR)
    return composite(star).withColumn("RiskCategory", category).select(*COLUMNS)
