import datetime as dt
import re

import pytest

from helpers import star, supplier
from riskmart.operators import dimensions as dim
from riskmart.operators import facts as fct
from riskmart.operators import quality as dq
from riskmart.sources.schemas import FACTS, STAGED, record_ids


def test_calendar(spark):
    days = {r.FullDate: r for r in dim.date_dimension(spark).collect()}
    assert len(days) == 1826
    weeks = {
        dt.date(2022, 1, 1): 1,
        dt.date(2022, 1, 2): 2,
        dt.date(2023, 1, 1): 1,
        dt.date(2026, 12, 31): 53,
    }
    assert {d: days[d].WeekNumber for d in weeks} == weeks
    leap = days[dt.date(2024, 2, 29)]
    assert (leap.DateKey, leap.DayName, leap.MonthName, leap.QuarterName) == (
        20240229, "Thursday", "February", "Q1",
    )
    assert days[dt.date(2022, 1, 1)].IsWeekend and days[dt.date(2022, 1, 2)].IsWeekend
    assert not days[dt.date(2022, 1, 3)].IsWeekend
    assert dim.first_days(dim.date_dimension(spark)).first().DateKey == 20220101


def test_dimension_keys_follow_the_natural_id(spark):
    rows = [("WH3", "c"), ("WH1", "a"), ("WH2", "b")]
    staged = spark.createDataFrame(
        [(i, n, "x", "y", 1, "t") for i, n in rows],
        "WarehouseID string, WarehouseName string, Country string, City string, Capacity int, "
        "WarehouseType string",
    )
    got = dim.build_dimension(staged, "DimWarehouse")
    assert got.columns == ["WarehouseKey", *STAGED["Warehouses"]]
    assert sorted((r.WarehouseKey, r.WarehouseID) for r in got.collect()) == [
        (1, "WH1"), (2, "WH2"), (3, "WH3"),
    ]


def test_correction_overwrites_matched_rows_only(spark):
    s = star(spark, suppliers=[supplier(1), supplier(2)])
    fix = s["DimSupplier"].drop("SupplierKey").where("SupplierID = 'SUP0001'")
    fix = fix.selectExpr(*[c if c != "Country" else "cast(null as string) Country" for c in fix.columns])
    got = {r.SupplierKey: r for r in dim.correct_dimension(
        s["DimSupplier"], fix, "SupplierID", "SupplierKey").collect()}
    assert got[1].Country is None and got[1].SupplierName == "Supplier 1"
    assert got[2].Country == "India"
    with pytest.raises(ValueError, match="more than once"):
        dim.correct_dimension(s["DimSupplier"], fix.union(fix), "SupplierID", "SupplierKey")


def test_lookup(spark):
    s = star(spark, suppliers=[supplier(1), supplier(75)])
    got = dim.supplier_lookup(s["DimSupplier"], "SUP0075").collect()
    assert [(r.SupplierKey, r.Country) for r in got] == [(75, "India")]


def test_fact_drops_rows_without_partner(spark):
    s = star(spark, suppliers=[supplier(1)])
    d = dt.date
    rows = [
        ("ok", "SUP0001", "PRD1", "WH1", d(2022, 1, 3), d(2022, 1, 9)),
        ("orphan", "SUP0009", "PRD1", "WH1", d(2022, 1, 3), d(2022, 1, 9)),
        ("late", "SUP0001", "PRD1", "WH1", d(2022, 1, 3), d(2023, 1, 9)),
        ("nodate", "SUP0001", "PRD1", "WH1", None, d(2022, 1, 9)),
        ("nokey", None, "PRD1", "WH1", d(2022, 1, 3), d(2022, 1, 9)),
    ]
    staged = spark.createDataFrame(
        rows,
        "OrderID string, SupplierID string, ProductID string, WarehouseID string, "
        "OrderDate date, ExpectedDeliveryDate date",
    ).selectExpr(
        "*",
        "1 OrderQuantity",
        "cast(2 as decimal(18,2)) UnitCost",
        "cast(2 as decimal(18,2)) OrderValue",
        "'Completed' OrderStatus",
    )
    got = fct.build_fact(staged, s, "FactOrders").collect()
    assert [(r.OrderID, r.SupplierKey, r.OrderDateKey, r.ExpectedDeliveryDateKey) for r in got] == [
        ("ok", 1, 20220103, 20220109)
    ]
    gaps = fct.with_fact_key(fct.build_fact(staged, s, "FactOrders"), "FactOrders", dense=False)
    assert gaps.columns[0] == "OrderKey" and gaps.count() == 1
    empty = {t: spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in STAGED[t].items()))
             for t in ("Shipments", "Inventory", "SupplierQuality")}
    cover = {r.FactName: r for r in dq.mapping_coverage(spark, empty | {"Orders": staged}, s).collect()}
    assert (cover["FactOrders"].StagingRows, cover["FactOrders"].MappedRows) == (5, 1)
    assert cover["FactShipments"].StagingRows == 0


def test_large_dimensions_are_hashed(spark, tmp_path):
    """A dimension above the broadcast limit is hashed by partitions, so the fact is not sorted; unless they are large too."""
    s = star(spark, suppliers=[supplier(k) for k in range(1, 3001)])
    s["DimSupplier"].write.parquet(f"{tmp_path}/DimSupplier")
    s["DimSupplier"] = spark.read.schema(s["DimSupplier"].schema).parquet(f"{tmp_path}/DimSupplier")
    day = dt.date(2022, 1, 3)
    rows = [(f"INS{i}", f"ORD{i}", f"SUP{i % 4000:04d}", "PRD1", day) for i in range(5000)]
    staged = spark.createDataFrame(rows, "InspectionID string, OrderID string, SupplierID string, ProductID string, InspectionDate date")
    staged = staged.selectExpr("*", *[f"CAST(1 AS {k}) AS {c}" for c, k in STAGED["SupplierQuality"].items() if c not in staged.columns])
    empty = {t: spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in STAGED[t].items())) for t in ("Orders", "Shipments", "Inventory")}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    size = fct.stored_bytes(s["DimSupplier"].select("SupplierID", "SupplierKey"))
    joins = {}
    try:
        for most in (size + 1, size // 2, 1):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            found = fct.build_fact(staged, s, "FactSupplierQuality")
            text = found._jdf.queryExecution().executedPlan().toString()
            joins[most] = re.findall(r"(\w*Join) \[SupplierID", text)
            assert sorted(r.SupplierKey for r in found.collect()) == sorted(i % 4000 for i in range(5000) if 0 < i % 4000 <= 3000)
            cover = {r.FactName: r for r in dq.mapping_coverage(spark, empty | {"SupplierQuality": staged}, s).collect()}
            assert (cover["FactSupplierQuality"].StagingRows, cover["FactSupplierQuality"].MappedRows) == (5000, found.count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert list(joins.values()) == [["BroadcastHashJoin"], ["ShuffledHashJoin"], ["SortMergeJoin"]]


def test_record_ids():
    assert record_ids(FACTS["FactOrders"]) == ["OrderID"]
    assert record_ids(FACTS["FactShipments"]) == ["ShipmentID", "OrderID"]
    assert record_ids(FACTS["FactInventory"]) == ["InventoryRecordID"]
    assert record_ids(FACTS["FactSupplierQuality"]) == ["InspectionID", "OrderID"]
