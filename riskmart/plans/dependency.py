"""Supplier dependency: how much of the purchasing rests on each supplier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.domains import DEPENDENCY_WEIGHTS, SUPPLIER_BANDS, SUPPLIER_FLOOR
from riskmart.functions.exprs import (
    MONEY,
    MONEY_SUM,
    PCT,
    bands,
    mean,
    money_sum,
    percent,
    weighted,
    zero_if_null,
)
from riskmart.operators.ranks import Ranking, with_ranks
from riskmart.plans.supplier_risk import PROFILE, not_cancelled, with_share
from riskmart.sources.workspace import materialize

# Columns of the view, in order.
COLUMNS = [
    *PROFILE,
    "TotalOrders",
    "TotalOrderQuantity",
    "TotalPurchaseValue",
    "AvgOrderValue",
    "CompanyPurchaseDependencyPct",
    "ProductsSupplied",
    "WarehousesSupported",
    "HighlyDependentProducts",
    "ModerateDependentProducts",
    "AvgProductDependencyPct",
    "MaxProductDependencyPct",
    "PurchaseExposureScore",
    "ProductExposureScore",
    "WarehouseExposureScore",
    "ProductConcentrationScore",
    "BusinessImpactScore",
    "DependencyRiskCategory",
]

SCORES = [
    Ranking("TotalPurchaseValue", "PurchaseExposureScore", True, "percent_rank"),
    Ranking("ProductsSupplied", "ProductExposureScore", True, "percent_rank", few=True),
    Ranking("WarehousesSupported", "WarehouseExposureScore", True, "percent_rank", few=True),
    Ranking("HighlyDependentProducts", "ProductConcentrationScore", True, "percent_rank", few=True),
]


def product_purchases(orders: DataFrame) -> DataFrame:
    """Per supplier and product: orders, priced orders, quantity, value."""
    return (
        not_cancelled(orders)
        .groupBy("SupplierKey", "ProductKey")
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.count("OrderValue").alias("_priced"),
            F.sum("OrderQuantity").alias("_quantity"),
            money_sum(F.col("OrderValue")).alias("SupplierProductValue"),
        )
    )


def supplier_product_spend(orders: DataFrame) -> DataFrame:
    return product_purchases(orders).select("SupplierKey", "ProductKey", "SupplierProductValue")


def _spend_of(pairs: DataFrame) -> DataFrame:
    total = money_sum(F.col("SupplierProductValue"))
    return pairs.groupBy("ProductKey").agg(total.alias("TotalProductSpend"))


def product_spend(orders: DataFrame) -> DataFrame:
    return _spend_of(product_purchases(orders))


def product_dependency(orders: DataFrame) -> DataFrame:
    """Supplier's share of each product it delivers, with the sums behind it.

    The sums per supplier and product are written once; the product totals come from them.
    """
    pairs = materialize(product_purchases(orders), "pairs")
    share = percent(F.col("SupplierProductValue"), F.col("TotalProductSpend"))
    return (
        pairs.join(_spend_of(pairs), "ProductKey")
        .withColumn("SupplierProductDependencyPct", share)
        .drop("TotalProductSpend")
    )


def warehouses_supported(orders: DataFrame) -> DataFrame:
    """Two plain aggregations: pairs first, so that no task holds a supplier's orders."""
    return (
        not_cancelled(orders)
        .groupBy("SupplierKey", "WarehouseKey")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("SupplierKey")
        .agg(F.count("WarehouseKey").alias("WarehousesSupported"))
    )


def _exposure_columns() -> list:
    share = F.col("SupplierProductDependencyPct")
    return [
        F.count_if(share >= 50).alias("HighlyDependentProducts"),
        F.count_if(share >= 30).alias("ModerateDependentProducts"),
        mean(F.sum(share), F.count(share)).alias("AvgProductDependencyPct"),
        F.max(share).alias("MaxProductDependencyPct"),
    ]


def _spend_columns() -> list:
    value = money_sum(F.col("SupplierProductValue"))
    return [
        F.sum("_orders").alias("TotalOrders"),
        F.sum("_quantity").alias("TotalOrderQuantity"),
        value.alias("TotalPurchaseValue"),
        mean(value, F.sum("_priced"), MONEY).alias("AvgOrderValue"),
        F.count("ProductKey").alias("ProductsSupplied"),
    ]


def supplier_spend(orders: DataFrame) -> DataFrame:
    return (
        product_purchases(orders)
        .groupBy("SupplierKey")
        .agg(*_spend_columns())
        .join(warehouses_supported(orders), "SupplierKey")
    )


def product_exposure(orders: DataFrame) -> DataFrame:
    return product_dependency(orders).groupBy("SupplierKey").agg(*_exposure_columns())


def supplier_exposure(star: Mapping[str, DataFrame]) -> DataFrame:
    """Spend and exposure come from one aggregation of the same supplier-product rows."""
    orders = star["FactOrders"]
    sums = (
        product_dependency(orders)
        .groupBy("SupplierKey")
        .agg(*_spend_columns(), *_exposure_columns())
        .join(warehouses_supported(orders), "SupplierKey")
    )
    joined = star["DimSupplier"].select(*PROFILE).join(sums, "SupplierKey", "left")
    kinds = {
        "TotalOrders": "bigint",
        "TotalOrderQuantity": "bigint",
        "TotalPurchaseValue": MONEY_SUM,
        "AvgOrderValue": MONEY,
        "ProductsSupplied": "bigint",
        "WarehousesSupported": "bigint",
        "HighlyDependentProducts": "bigint",
        "ModerateDependentProducts": "bigint",
        "AvgProductDependencyPct": PCT,
        "MaxProductDependencyPct": PCT,
    }
    return joined.select(
        *PROFILE, *[zero_if_null(F.col(c), kind).alias(c) for c, kind in kinds.items()]
    )


def company_dependency(star: Mapping[str, DataFrame]) -> DataFrame:
    """The sums per supplier are written once; the total and the ranks come from them."""
    return with_share(materialize(supplier_exposure(star), "exposure"), "CompanyPurchaseDependencyPct")


def dependency_scores(star: Mapping[str, DataFrame]) -> DataFrame:
    return with_ranks(company_dependency(star), SCORES, written=True)


def business_impact(star: Mapping[str, DataFrame]) -> DataFrame:
    return dependency_scores(star).withColumn("BusinessImpactScore", weighted(DEPENDENCY_WEIGHTS))


def supplier_dependency(star: Mapping[str, DataFrame]) -> DataFrame:
    category = bands(F.col("BusinessImpactScore"), SUPPLIER_BANDS, SUPPLIER_FLOOR)
    return business_impact(star).withColumn("DependencyRiskCategory", category).select(*COLUMNS)
