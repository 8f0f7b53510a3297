"""Laws the results must keep, on whole test tables."""

import pytest
from pyspark.sql import functions as F

from riskmart.functions.domains import RISK_LEVELS, STOCK_STATUSES
from riskmart.plans.dashboards import inventory_risk_report, supplier_risk_report
from riskmart.plans import dependency as sd
from riskmart.plans import inventory as ir
from riskmart.plans import logistics as lp
from riskmart.plans import supplier_risk as sr
from suite.mart import Mart

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mart(spark):
    return Mart.open(spark, SF)


def test_shares_add_up(mart):
    total = sr.supplier_risk(mart).agg(F.sum("PurchaseDependencyPct")).first()[0]
    assert abs(total - 100) < 1
    per_product = sd.product_dependency(mart["FactOrders"]).groupBy("ProductKey")
    worst = per_product.agg(F.sum("SupplierProductDependencyPct").alias("s"), F.count("*").alias("n"))
    assert worst.where("abs(s - 100) > 0.01 * n").count() == 0


def test_every_known_delay_is_late_or_on_time(mart):
    carriers = lp.carrier_metrics(mart["FactShipments"])
    assert carriers.where("OnTimeShipments + LateShipments <> TotalShipments").count() == 0
    assert carriers.where("abs(OnTimeDeliveryPct + DelayPct - 100) > 0.01").count() == 0
    total = carriers.agg(F.sum("TotalShipments")).first()[0]
    assert total == mart["FactShipments"].count()


def test_supplier_and_dependency_views_agree_on_spend(mart):
    risk = sr.supplier_risk(mart).select("SupplierKey", "TotalOrders", "TotalPurchaseValue")
    dep = sd.supplier_dependency(mart).select("SupplierKey", "TotalOrders", "TotalPurchaseValue")
    assert risk.exceptAll(dep).count() == 0 and dep.exceptAll(risk).count() == 0
    assert risk.count() == mart["DimSupplier"].count()


def test_each_stock_row_has_one_status(mart):
    stock = ir.inventory_metrics(mart)
    counts = {r[0]: r[1] for r in stock.groupBy("InventoryRiskStatus").count().collect()}
    assert set(counts) <= set(STOCK_STATUSES)
    assert sum(counts.values()) == ir.inventory_risk(mart).count()
    assert stock.where("StockGapQty > 0 and AvailableStock >= ReorderLevel").count() == 0


def test_scores_stay_in_range(mart):
    for view, score in (
        (sr.supplier_risk(mart), "RiskScore"),
        (sd.supplier_dependency(mart), "BusinessImpactScore"),
        (ir.inventory_risk(mart), "InventoryRiskScore"),
        (lp.logistics_performance(mart), "LogisticsPerformanceScore"),
    ):
        assert view.where(~F.col(score).between(0, 100)).count() == 0


def test_order_of_reports_and_top_lists(mart):
    """What the comparison of row bags can not see."""
    view = sr.supplier_risk(mart).cache()
    for level in RISK_LEVELS:
        got = [(r.RiskScore, r.TotalPurchaseValue, r.SupplierID) for r in supplier_risk_report(view, level).collect()]
        assert got == sorted(got, key=lambda r: (-r[0], -r[1], r[2]))
    stock = ir.inventory_risk(mart).cache()
    for status in STOCK_STATUSES:
        rows = inventory_risk_report(stock, status).collect()
        got = [(r.InventoryRiskScore, r.InventoryRiskValue, r.ProductID, r.WarehouseID) for r in rows]
        assert got == sorted(got, key=lambda r: (-r[0], -r[1], r[2], r[3]))
    view.unpersist()
    stock.unpersist()
