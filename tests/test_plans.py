"""Physical plans: what must not be there at scale."""

import re

import pytest

from riskmart.operators import facts as fct
from riskmart.operators import quality as dq
from riskmart.operators import transforms as tr
from riskmart.operators.ranks import Ranking, with_global_rank
from riskmart.plans import dashboards as db
from riskmart.plans import dependency as sd
from riskmart.plans import inventory as ir
from riskmart.plans import supplier_risk as sr
from riskmart.sources.schemas import FACTS
from suite.catalog import QUERIES
from suite.mart import Mart

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return Mart.open(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, columns_of):
    """Columns read by the scans whose first column is in ``columns_of``."""
    return [s.split(",") for s in re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", text))
            if columns_of in s]


def test_supplier_scans_read_only_what_they_need(mart):
    text = plan(sr.supplier_metrics(mart))
    assert ["SupplierKey", "DelayDays"] in scans(text, "DelayDays")
    assert "SinglePartition" not in text
    bought = plan(sr.purchase_metrics(mart["FactOrders"]))
    assert "Not(EqualTo(OrderStatus,Cancelled))" in bought


def test_aggregates_are_partial_before_the_shuffle(mart):
    for df in (
        sr.shipment_metrics(mart["FactShipments"]),
        sd.supplier_product_spend(mart["FactOrders"]),
        sd.warehouses_supported(mart["FactOrders"]),
    ):
        text = plan(df)
        assert text.count("HashAggregate") >= 2 and "Expand" not in text


def test_total_and_ranks_come_from_written_sums(mart):
    """Facts are scanned once, when the sums are written: no plan that ranks them reads a fact."""
    for df in (sr.dependency(mart), sr.supplier_risk(mart), sd.company_dependency(mart), sd.supplier_dependency(mart)):
        text = plan(df)
        assert not re.search(r"FactOrders|FactShipments|FactSupplierQuality|OrderStatus|\bDelayDays#", text)
    views = db.build_views(mart)
    for name in ("vw_supplier_risk_dashboard", "vw_supplier_dependency_dashboard"):
        assert "OrderStatus" not in plan(views[name])


def test_inventory_reads_one_partition_and_has_no_global_window(spark, mart):
    df = ir.inventory_risk(mart)
    text = plan(df)
    assert "SinglePartition" not in text
    text = plan(ir.current_inventory(mart))
    assert re.search(r"PartitionFilters: \[[^\]]*DateKey#\d+ = Subquery", text)


def test_status_counts_need_no_rank(mart):
    text = plan(ir.inventory_metrics(mart).groupBy("InventoryRiskStatus").count())
    assert "Window" not in text and "UnitCost" not in text


def test_fact_load_broadcasts_small_dimensions_and_moves_no_fact_rows(mart):
    text = plan(fct.build_fact(mart.staged("Orders"), mart, "FactOrders"))
    assert text.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_fact_load_joins_by_sort_merge_when_dimensions_are_large(spark, mart):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(fct.build_fact(mart.staged("Orders"), mart, "FactOrders"))
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_sides_leave_the_stock_where_it_is(spark, mart):
    """The broadcast limit lies between the small and the large side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stock = mart.staged("Inventory")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
        demand = tr.daily_demand(mart.staged("Orders"), mart.staged("Products"))
        for df in (
            tr.with_coverage(stock.drop("StockCoverageDays"), demand),
            tr.with_utilization(stock.drop("WarehouseUtilizationPct"), mart.staged("Warehouses")),
        ):
            text = plan(df)
            assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
            assert "hashpartitioning" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_ranks_have_no_single_task(mart):
    df = with_global_rank(
        mart["FactOrders"].select("OrderID", "OrderValue"), Ranking("OrderValue", "r")
    )
    text = plan(df)
    assert "SinglePartition" not in text and "Window" in text


def test_nothing_runs_in_python(spark, mart):
    for name in ("sr_08_supplier_risk", "sd_10_supplier_dependency", "ir_10_inventory_risk",
                 "lp_06_logistics_performance", "db_05_executive_summary", "tr_14_draw",
                 "stg_05_orders", "dq_05_shipments_rejects"):
        text = plan(QUERIES[name](spark, SF))
        assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|PythonUDF", text), name


def test_no_cross_joins(spark, mart):
    for name, build in db.build_views(mart).items():
        text = plan(build)
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
    assert "NestedLoop" not in plan(QUERIES["tr_13_stock_grid"](spark, SF))


def test_key_checks_read_every_fact_once(mart):
    """Four facts and five dimensions for all 18 keys; per staged table one scan and one of each partner."""
    assert plan(dq.orphan_counts({k: mart[k] for k in mart})).count("FileScan parquet") == 9
    staged = mart.staged_all()
    text = plan(dq.mapping_coverage(mart.spark, staged, mart))
    partners = sum(len(f.dimensions) + len(f.dates) for f in FACTS.values())
    assert text.count("FileScan parquet") == len(FACTS) + partners and "CartesianProduct" not in text


def test_a_draw_reads_its_table_twice(mart):
    """Once for the counts and once for the rows, both while it is built: the frame reads what was written."""
    text = plan(tr.draw(mart["FactOrders"].select("OrderID", "OrderValue"), ["OrderID"], 500))
    scanned = set(re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", text)))
    assert scanned and all("_last" in s.split(",") or "_h" in s.split(",") for s in scanned)


def test_counting_orphans_joins_distinct_keys(mart):
    text = plan(dq.orphan_counts({k: mart[k] for k in mart}))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
