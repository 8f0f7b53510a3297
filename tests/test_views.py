from decimal import Decimal as D

import pytest

from helpers import by, inspection, order, shipment, star, stock, supplier
from riskmart.plans import dashboards as db
from riskmart.plans import dependency as sd
from riskmart.plans import inventory as ir
from riskmart.plans import logistics as lp
from riskmart.plans import supplier_risk as sr


def test_supplier_metrics_defaults_and_clamping(spark):
    s = star(
        spark,
        suppliers=[supplier(1), supplier(2, "88.50"), supplier(3)],
        orders=[
            order(1, 1, value="100.00", qty=3),
            order(2, 1, value="50.00", status="Cancelled"),
            order(3, 1, value="25.00", status=None),
            order(4, 3, value="300.00"),
        ],
        shipments=[
            shipment(1, 1, 4),
            shipment(2, 1, -2),
            shipment(3, 1, None),
            shipment(4, 3, -1),
        ],
        inspections=[inspection(1, 1, "90.00", 10, 1), inspection(2, 1, None, 20, 2)],
    )
    m = by(sr.supplier_metrics(s), "SupplierKey")
    one = m[1]
    # The cancelled order and the one without a status are both left out.
    assert (one.TotalOrders, one.TotalPurchaseValue, one.TotalOrderQuantity) == (1, D("100.00"), 3)
    # An unknown delay is neither late nor on time, but a shipment.
    assert (one.TotalShipments, one.LateShipments) == (3, 1)
    assert (one.LateShipmentPct, one.OnTimeDeliveryPct) == (D("33.33"), D("33.33"))
    assert (one.AvgDelayDays, one.AvgLateDelayDays) == (D("1.33"), D("4.00"))
    assert (one.AvgQualityScore, one.DefectRatePct) == (D("90.00"), D("10.00"))
    two = m[2]
    assert (two.LateShipmentPct, two.OnTimeDeliveryPct, two.AvgQualityScore) == (0, 0, D("88.50"))
    assert m[3].AvgLateDelayDays == 0 and m[3].OnTimeDeliveryPct == D("100.00")


def test_supplier_risk_scores(spark):
    s = star(
        spark,
        suppliers=[supplier(k) for k in (1, 2, 3)],
        orders=[order(1, 1, value="75.00"), order(2, 2, value="25.00")],
        shipments=[shipment(1, 1, 5), shipment(2, 2, 1), shipment(3, 2, 0), shipment(4, 3, 0)],
        inspections=[inspection(1, 1, "70.00"), inspection(2, 2, "99.00")],
    )
    v = by(sr.supplier_risk(s), "SupplierKey")
    assert v[1].PurchaseDependencyPct == D("75.00") and v[3].PurchaseDependencyPct == 0
    scores = ("LateDeliveryRiskScore", "DelaySeverityRiskScore", "QualityRiskScore", "DependencyRiskScore")
    assert [v[1][c] for c in scores] == [D("100.00")] * 4
    assert (v[1].RiskScore, v[1].RiskCategory) == (D("100.00"), "Critical")
    assert [v[2][c] for c in scores] == [D("50.00"), D("50.00"), D("0.00"), D("50.00")]
    assert (v[2].RiskScore, v[2].RiskCategory) == (D("37.50"), "Medium")
    # Rating 80 as its quality: between 70 and 99.
    assert (v[3].RiskScore, v[3].RiskCategory) == (D("12.50"), "Low")
    assert sum(r.PurchaseDependencyPct for r in v.values()) == 100


def test_one_supplier_scores_zero(spark):
    s = star(spark, suppliers=[supplier(1)], orders=[order(1, 1)], shipments=[shipment(1, 1, 9)])
    row = sr.supplier_risk(s).first()
    assert (row.RiskScore, row.RiskCategory) == (0, "Low")


def test_no_purchases_leave_the_share_unknown(spark):
    s = star(spark, suppliers=[supplier(1), supplier(2)])
    v = by(sr.supplier_risk(s), "SupplierKey")
    assert v[1].PurchaseDependencyPct is None and v[1].DependencyRiskScore == 0


def test_dependency_shares_overlap_at_fifty(spark):
    s = star(
        spark,
        suppliers=[supplier(k) for k in (1, 2, 3, 4)],
        orders=[
            order(1, 1, product=1, value="50.00", house=1),
            order(2, 2, product=1, value="30.00", house=1),
            order(3, 3, product=1, value="20.00", house=2),
            order(4, 3, product=2, value="10.00", house=1),
            order(5, 3, product=2, value=None, house=1),
        ],
    )
    v = by(sd.supplier_dependency(s), "SupplierKey")
    assert (v[1].HighlyDependentProducts, v[1].ModerateDependentProducts) == (1, 1)
    assert (v[2].HighlyDependentProducts, v[2].ModerateDependentProducts) == (0, 1)
    assert (v[3].HighlyDependentProducts, v[3].ModerateDependentProducts) == (1, 1)
    assert (v[3].ProductsSupplied, v[3].WarehousesSupported, v[3].TotalOrders) == (2, 2, 3)
    assert v[3].AvgOrderValue == D("15.00")
    assert (v[3].AvgProductDependencyPct, v[3].MaxProductDependencyPct) == (D("60.00"), D("100.00"))
    assert (v[4].TotalOrders, v[4].BusinessImpactScore, v[4].DependencyRiskCategory) == (0, 0, "Low")
    # Equal to the step-by-step spend table.
    spend = by(sd.supplier_spend(s["FactOrders"]), "SupplierKey")
    assert spend[3].AvgOrderValue == v[3].AvgOrderValue


@pytest.mark.parametrize(
    "available,status,gap,refill",
    [
        (-1, "Stockout", 11, 16),
        (0, "Stockout", 10, 15),
        (4, "Critical", 6, 11),
        (5, "Reorder Required", 5, 10),
        (9, "Reorder Required", 1, 6),
        (10, "Safe", 0, 0),
        (30, "Safe", 0, 0),
        (31, "Overstock", 0, 0),
        (None, "Safe", 0, 0),
    ],
)
def test_stock_rules(spark, available, status, gap, refill):
    row = ir.inventory_metrics(star(spark, inventory=[stock(1, available)])).first()
    assert (row.InventoryRiskStatus, row.StockGapQty, row.SuggestedReorderQty) == (
        status, gap, refill,
    )
    assert row.InventoryRiskValue == D("2.50") * gap


@pytest.mark.parametrize(
    "days,status",
    [("0.00", "Stockout"), ("6.99", "Critical"), ("7.00", "Low Coverage"),
     ("14.99", "Low Coverage"), ("15.00", "Healthy"), ("90.00", "Healthy"),
     ("90.01", "Excess Coverage"), (None, "Healthy")],
)
def test_coverage_rules(spark, days, status):
    row = ir.inventory_metrics(star(spark, inventory=[stock(1, 20, cover=days)])).first()
    assert row.CoverageStatus == status


def inventory_star(spark):
    return star(
        spark,
        inventory=[
            stock(1, 0, day=20220131),
            stock(2, 0, day=20220228),
            stock(3, 4, day=20220228),
            stock(4, 20, day=20220228),
            stock(5, 20, day=20220228, product=2),
            stock(6, 5, day=20220228, product=9),
            stock(7, 5, day=20231231),
        ],
    )


def test_inventory_view_uses_one_global_latest_date(spark):
    s = inventory_star(spark)
    v = by(ir.inventory_risk(s), "InventoryKey")
    # Not 1 (older), not 6 (unknown product), not 7 (outside the calendar).
    assert sorted(v) == [2, 3, 4, 5]
    assert (v[2].InventoryRiskScore, v[2].RiskPriority) == (D("100.00"), "Critical")
    assert (v[3].InventoryRiskScore, v[3].RiskPriority) == (D("79.50"), "High")
    assert (v[4].InventoryRiskScore, v[4].RiskPriority) == (D("7.00"), "Low")


def test_inventory_scores_of_all_rows(spark):
    v = by(ir.inventory_risk(inventory_star(spark)), "InventoryKey")
    assert {k: str(r.InventoryRiskScore) for k, r in v.items()} == {
        2: "100.00", 3: "79.50", 4: "7.00", 5: "7.00",
    }


def test_inventory_without_rows(spark):
    assert ir.inventory_risk(star(spark)).count() == 0


def test_carriers_without_shipments(spark):
    s = star(
        spark,
        shipments=[
            shipment(1, 1, 0, carrier=1, cost="10.00"),
            shipment(2, 1, 3, carrier=2, cost="20.00", damaged=1),
        ],
        carriers=4,
    )
    v = by(lp.logistics_performance(s), "CarrierKey")
    assert v[3].TotalShipments is None and v[3].ShippingCostPerUnit is None
    parts = ("DeliveryPerformanceScore", "CostEfficiencyScore", "DamagePerformanceScore")
    # Missing metrics sort first upwards and last downwards; the two idle carriers tie.
    assert [v[3][c] for c in parts] == [D("0.00"), D("66.67"), D("66.67")]
    assert [v[1][c] for c in parts] == [D("100.00"), D("33.33"), D("33.33")]
    assert [v[2][c] for c in parts] == [D("66.67"), D("0.00"), D("0.00")]
    assert v[1].ShippingCostPerUnit == D("1.00") and v[2].DamageRatePct == D("10.00")
    assert v[1].CarrierPerformanceCategory == "Good"


def test_zero_quantity_has_no_unit_cost(spark):
    s = star(spark, shipments=[shipment(1, 1, 0, qty=0)])
    row = lp.logistics_performance(s).first()
    assert row.ShippingCostPerUnit is None and row.DamageRatePct is None


def full_star(spark):
    s = star(
        spark,
        suppliers=[supplier(k, status="Inactive" if k == 4 else "Active") for k in (1, 2, 3, 4)],
        orders=[order(1, 1, value="75.00"), order(2, 2, value="25.00"),
                order(3, 2, value="9.00", status="Cancelled")],
        shipments=[shipment(1, 1, 5), shipment(2, 2, 0), shipment(3, 2, 0)],
        inspections=[inspection(1, 1, "70.00")],
        inventory=[stock(1, 0), stock(2, 4), stock(3, 7), stock(4, 40), stock(5, 20)],
        carriers=2,
    )
    return s


def test_executive_summary(spark):
    row = db.executive_summary(full_star(spark)).first().asDict()
    assert row == {
        "TotalActiveSuppliers": 3,
        "HighRiskSuppliers": 1,
        "TotalOrders": 3,
        "TotalPurchaseValue": D("100.00"),
        "OnTimeDeliveryPct": D("66.67"),
        "InventoryRiskItems": 3,
        "StockoutItems": 1,
        "TotalShippingCost": D("15.00"),
    }


def test_dashboard_ranks_leave_gaps(spark):
    v = by(db.supplier_risk_dashboard(full_star(spark)), "SupplierKey")
    assert v[1].RiskRank == 1 and v[1].PurchaseValueRank == 1
    assert [v[k].PurchaseValueRank for k in (2, 3, 4)] == [2, 3, 3]
    assert [v[k].LateDeliveryRank for k in (2, 3, 4)] == [2, 2, 2]
    assert v[1].QualityRiskRank == 1
    assert "QualityRiskScore" not in v[1].asDict()


def test_named_views(spark):
    db.register_all(full_star(spark))
    names = {t.name for t in spark.catalog.listTables()}
    assert {*db.ANALYSES, *db.DASHBOARDS} <= names
    assert spark.sql("select count(*) n from vw_inventory_dashboard").first().n == 5


@pytest.mark.parametrize("level", ["high", "", "Severe"])
def test_report_refuses_unknown_levels(spark, level):
    view = sr.supplier_risk(full_star(spark))
    with pytest.raises(ValueError, match="50001"):
        db.supplier_risk_report(view, level)
    with pytest.raises(ValueError, match="50002"):
        db.inventory_risk_report(view, level)


def test_reports(spark):
    s = full_star(spark)
    risk = sr.supplier_risk(s)
    assert db.supplier_risk_report(risk, None).count() == 0
    assert [r.SupplierID for r in db.supplier_risk_report(risk, "Critical").collect()] == ["SUP0001"]
    stock_view = ir.inventory_risk(s)
    assert len(db.inventory_risk_report(stock_view, "Overstock").columns) == 18
    assert db.inventory_risk_report(stock_view, "Stockout").count() == 1


def test_result_does_not_depend_on_partitions(spark):
    s = full_star(spark)
    want = {tuple(r) for r in sr.supplier_risk(s).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert {tuple(r) for r in sr.supplier_risk(s).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
