"""Dashboard views, the executive summary, and the two parameterised reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.domains import RISK_LEVELS, STOCK_AT_RISK, STOCK_STATUSES
from riskmart.functions.exprs import money_sum, percent
from riskmart.operators.ranks import Ranking, with_ranks
from riskmart.plans import dependency, inventory, logistics, supplier_risk
from riskmart.sources.files import register_views
from riskmart.sources.workspace import recording, remove

_RISK_PARTS = {name for name, _ in supplier_risk.SUPPLIER_WEIGHTS}
_IMPACT_PARTS = {name for name, _ in dependency.DEPENDENCY_WEIGHTS}

RISK_RANKS = [
    Ranking("RiskScore", "RiskRank", False, few=True),
    Ranking("TotalPurchaseValue", "PurchaseValueRank", False),
    Ranking("LateShipmentPct", "LateDeliveryRank", False, few=True),
    Ranking("AvgQualityScore", "QualityRiskRank", True, few=True),
]


# Every dashboard takes the view it shows, if the caller already has it.


def supplier_risk_dashboard(
    star: Mapping[str, DataFrame], view: DataFrame | None = None
) -> DataFrame:
    shown = [c for c in supplier_risk.COLUMNS if c not in _RISK_PARTS]
    view = supplier_risk.supplier_risk(star) if view is None else view
    return with_ranks(view.select(*shown), RISK_RANKS)


def inventory_dashboard(star: Mapping[str, DataFrame], view: DataFrame | None = None) -> DataFrame:
    view = inventory.inventory_risk(star) if view is None else view
    return view.select(*inventory.COLUMNS)


def logistics_dashboard(star: Mapping[str, DataFrame], view: DataFrame | None = None) -> DataFrame:
    view = logistics.logistics_performance(star) if view is None else view
    return view.select(*logistics.COLUMNS)


def supplier_dependency_dashboard(
    star: Mapping[str, DataFrame], view: DataFrame | None = None
) -> DataFrame:
    shown = [c for c in dependency.COLUMNS if c not in _IMPACT_PARTS]
    view = dependency.supplier_dependency(star) if view is None else view
    return view.select(*shown)


def executive_summary(star: Mapping[str, DataFrame], view: DataFrame | None = None) -> DataFrame:
    """Eight figures in one row, one aggregate per source; ``view`` is supplier risk.

    Stock statuses need no rank, so the inventory part reads the unranked metrics.
    """
    view = supplier_risk.supplier_risk(star) if view is None else view
    spark = star["FactOrders"].sparkSession
    one = F.count(F.lit(1))
    suppliers = star["DimSupplier"].agg(
        F.count_if(F.col("ActiveStatus") == "Active").alias("TotalActiveSuppliers")
    )
    risk = view.agg(
        F.count_if(F.col("RiskCategory").isin("High", "Critical")).alias("HighRiskSuppliers")
    )
    bought = money_sum(F.when(F.col("OrderStatus") != "Cancelled", F.col("OrderValue")))
    orders = star["FactOrders"].agg(
        one.alias("TotalOrders"), bought.alias("TotalPurchaseValue")
    )
    shipments = star["FactShipments"].agg(
        percent(F.count_if(F.col("DelayDays") <= 0), one).alias("OnTimeDeliveryPct"),
        money_sum(F.col("ShippingCost")).alias("TotalShippingCost"),
    )
    status = F.col("InventoryRiskStatus")
    stock = inventory.inventory_metrics(star).agg(
        F.count_if(status.isin(*STOCK_AT_RISK)).alias("InventoryRiskItems"),
        F.count_if(status == "Stockout").alias("StockoutItems"),
    )
    parts = [suppliers, risk, orders, shipments, stock]
    rows = {f"p{i}": p.select(F.struct("*")).scalar() for i, p in enumerate(parts)}
    return spark.range(1).select(
        *[rows[f"p{i}"].getField(c).alias(c) for i, p in enumerate(parts) for c in p.columns]
    ).select(
        "TotalActiveSuppliers",
        "HighRiskSuppliers",
        "TotalOrders",
        "TotalPurchaseValue",
        "OnTimeDeliveryPct",
        "InventoryRiskItems",
        "StockoutItems",
        "TotalShippingCost",
    )


# Names of the nine views. A dashboard names the view it shows.
ANALYSES = {
    "vw_supplier_risk_analysis": supplier_risk.supplier_risk,
    "vw_supplier_dependency": dependency.supplier_dependency,
    "vw_inventory_risk": inventory.inventory_risk,
    "vw_logistics_performance": logistics.logistics_performance,
}
DASHBOARDS = {
    "vw_supplier_risk_dashboard": (supplier_risk_dashboard, "vw_supplier_risk_analysis"),
    "vw_inventory_dashboard": (inventory_dashboard, "vw_inventory_risk"),
    "vw_logistics_dashboard": (logistics_dashboard, "vw_logistics_performance"),
    "vw_supplier_dependency_dashboard": (supplier_dependency_dashboard, "vw_supplier_dependency"),
    "vw_supply_chain_executive_summary": (executive_summary, "vw_supplier_risk_analysis"),
}


def build_views(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine views; each analysis is built once and shared by its dashboards."""
    views = {name: build(star) for name, build in ANALYSES.items()}
    views |= {name: build(star, views[base]) for name, (build, base) in DASHBOARDS.items()}
    return views


def build_view(star: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One of the nine views, and nothing that it does not show."""
    if name in ANALYSES:
        return ANALYSES[name](star)
    build, base = DASHBOARDS[name]
    return build(star, ANALYSES[base](star))


_registered: dict[str, tuple[Mapping[str, DataFrame], list[str]]] = {}


def _session(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def register_all(star: Mapping[str, DataFrame], spark: SparkSession | None = None) -> None:
    """The nine views as temporary views of a session, under their usual names.

    They show the tables of ``star``. A load in this session registers the views of its mart again; for loads
    elsewhere use ``Views``, which follows them. The tables that the earlier views read are removed.
    """
    spark = spark or star["DimSupplier"].sparkSession
    with recording() as made:
        register_views(build_views(star))
    before = _registered.get(_session(spark), (None, []))[1]
    _registered[_session(spark)] = star, made
    remove(spark, before)


def registered(spark: SparkSession) -> Mapping[str, DataFrame] | None:
    """The mart whose views are registered in this session."""
    return _registered.get(_session(spark), (None, []))[0]


class Views(Mapping[str, DataFrame]):
    """The nine views of a mart, planned when they are read: they show its last version, whoever loaded it.

    ``open_mart(spark)`` opens the mart as it is now; its ``manifest`` tells its version.
    """

    def __init__(self, spark: SparkSession, open_mart: Callable[[SparkSession], Mapping[str, DataFrame]]):
        self.spark, self.open_mart = spark, open_mart

    def __getitem__(self, name: str) -> DataFrame:
        if name not in (*ANALYSES, *DASHBOARDS):
            raise KeyError(name)
        return build_view(self.open_mart(self.spark), name)

    def __iter__(self) -> Iterator[str]:
        return iter((*ANALYSES, *DASHBOARDS))

    def __len__(self) -> int:
        return len(ANALYSES) + len(DASHBOARDS)

    def sql(self, query: str) -> DataFrame:
        """A query over the views by name; they are registered again first if the mart has a new version."""
        star, shown = self.open_mart(self.spark), registered(self.spark)
        now, then = getattr(star, "manifest", None), getattr(shown, "manifest", None)
        if then is None or now is None or now.tables != then.tables:
            register_all(star, self.spark)
        return self.spark.sql(query)


# Columns of the two reports, and the texts of their errors.


def supplier_risk_report(view: DataFrame, level: str | None) -> DataFrame:
    """Suppliers of one risk level. No level gives no rows; an unknown one is an error."""
    if level is not None and level not in RISK_LEVELS:
        raise ValueError("50001: Invalid RiskLevel. Use Low, Medium, High, or Critical.")
    return (
        view.where(F.col("RiskCategory") == F.lit(level).cast("string"))
        .select(
            "SupplierID",
            "SupplierName",
            "Country",
            "Region",
            "SupplierCategory",
            "TotalOrders",
            "TotalPurchaseValue",
            "PurchaseDependencyPct",
            "TotalShipments",
            "LateShipments",
            "LateShipmentPct",
            "AvgDelayDays",
            "OnTimeDeliveryPct",
            "TotalInspections",
            "AvgQualityScore",
            "DefectRatePct",
            "RiskScore",
            "RiskCategory",
        )
        .orderBy(F.desc("RiskScore"), F.desc("TotalPurchaseValue"), "SupplierID")
    )


def inventory_risk_report(view: DataFrame, status: str | None) -> DataFrame:
    """Stock rows of one status, by score. Parameter rules as for suppliers."""
    if status is not None and status not in STOCK_STATUSES:
        raise ValueError("50002: Invalid inventory risk status.")
    return (
        view.where(F.col("InventoryRiskStatus") == F.lit(status).cast("string"))
        .select(
            "ProductID",
            "ProductName",
            "Category",
            "WarehouseID",
            "WarehouseName",
            "WarehouseCountry",
            "AvailableStock",
            "SafetyStockLevel",
            "ReorderLevel",
            "StockGapQty",
            "SuggestedReorderQty",
            "AvgDailyDemand",
            "StockCoverageDays",
            "InventoryValue",
            "InventoryRiskValue",
            "InventoryRiskStatus",
            "InventoryRiskScore",
            "RiskPriority",
        )
        .orderBy(
            F.desc("InventoryRiskScore"),
            F.desc("InventoryRiskValue"),
            "ProductID",
            "WarehouseID",
        )
    )
