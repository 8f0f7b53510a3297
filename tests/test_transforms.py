import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from riskmart.operators import transforms as tr
from riskmart.operators.ranks import ordered_keys


def test_tiers(spark):
    df = spark.createDataFrame(
        [(D("94.00"),), (D("93.99"),), (D("86.00"),), (D("75.00"),), (D("74.99"),)],
        "QualityRating decimal(5,2)",
    )
    assert [r.RiskTier for r in tr.with_risk_tier(df).collect()] == [
        "Low", "Medium", "Medium", "High", "Critical",
    ]


def suppliers(spark):
    return spark.createDataFrame(
        [("S1", "Raw Materials"), ("S2", "Chemicals"), ("S3", "Packaging")],
        "SupplierID string, SupplierCategory string",
    )


@pytest.mark.parametrize(
    "category,want",
    [
        ("Raw Materials", {"S1", "S2"}),
        ("Packaging", {"S1", "S3"}),
        ("Unheard of", {"S1", "S2", "S3"}),
        ("Electronic Components", {"S1", "S2", "S3"}),
    ],
)
def test_eligible_suppliers(spark, category, want):
    got = tr.eligible_suppliers(suppliers(spark), tr.category_map(spark), category)
    assert {r.SupplierID for r in got.collect()} == want
    assert got.count() == len(want)


def test_eligible_counts(spark):
    products = spark.createDataFrame(
        [("Packaging",), ("Packaging",), ("Toys",), ("Electronic Components",)], "Category string"
    )
    got = tr.eligible_counts(products, suppliers(spark), tr.category_map(spark))
    assert {tuple(r) for r in got.collect()} == {
        ("Packaging", 2, False), ("Toys", 3, True), ("Electronic Components", 3, True),
    }


def test_order_age(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2021, 12, 31),), (None,)], "OrderDate date")
    got = tr.with_order_age(df, "2022-03-02").collect()
    assert [(r.DaysFromEnd, r.IsRecent) for r in got] == [(60, True), (61, False), (None, False)]


def test_delivery_is_never_before_shipping(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(d(2022, 1, 5), d(2022, 1, 7), 2), (d(2022, 1, 5), d(2022, 1, 4), -3), (d(2022, 1, 5), None, 1)],
        "ShipDate date, PromisedDate date, DelayDays int",
    )
    got = tr.with_delivery(df).collect()
    assert [(r.DeliveryDate, r.DeliveryDays) for r in got] == [
        (d(2022, 1, 9), 4), (d(2022, 1, 5), 0), (None, None),
    ]


def test_shipment_status(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 1, 3, 4, 7, 8)], "DelayDays int")
    assert [r.ShipmentStatus for r in tr.with_shipment_status(df).collect()] == [
        "On Time", "On Time", "Minor Delay", "Minor Delay", "Moderate Delay", "Moderate Delay",
        "Severe Delay",
    ]


def test_demand_and_coverage(spark):
    orders = spark.createDataFrame(
        [("P1", dt.date(2022, 1, 1), 30), ("P1", dt.date(2022, 1, 11), 70)],
        "ProductID string, OrderDate date, OrderQuantity int",
    )
    products = spark.createDataFrame([("P1",), ("P2",)], "ProductID string")
    demand = tr.daily_demand(orders, products)
    got = {r.ProductID: r for r in demand.collect()}
    assert got["P1"].AvgDailyDemand == D("10.00") and got["P2"].AvgDailyDemand == D("5.00")
    stock = spark.createDataFrame([("P1", 25), ("P2", 1)], "ProductID string, AvailableStock int")
    days = {r.ProductID: r.StockCoverageDays for r in tr.with_coverage(stock, demand).collect()}
    assert days == {"P1": D("2.50"), "P2": D("0.20")}
    idle = demand.withColumn("DemandQuantity", F.lit(0))
    assert {r.StockCoverageDays for r in tr.with_coverage(stock, idle).collect()} == {D("999.00")}


def test_one_day_of_orders_counts_as_one_day(spark):
    orders = spark.createDataFrame(
        [("P1", dt.date(2022, 1, 1), 30)], "ProductID string, OrderDate date, OrderQuantity int"
    )
    products = spark.createDataFrame([("P1",)], "ProductID string")
    assert tr.daily_demand(orders, products).first().AvgDailyDemand == D("30.00")


def test_month_ends(spark):
    days = sorted(r.SnapshotDate for r in tr.month_ends(spark).collect())
    assert len(days) == 57
    assert days[0] == dt.date(2022, 1, 31) and days[-1] == dt.date(2026, 9, 30)
    assert dt.date(2024, 2, 29) in days
    partial = tr.month_ends(spark, "2022-01-15", "2022-03-30")
    assert [r.SnapshotDate.month for r in partial.orderBy("SnapshotDate").collect()] == [1, 2]


def test_grid_numbers_every_cell_once(spark):
    def axis(name, values):
        df = spark.createDataFrame([(v,) for v in values], f"{name} string")
        keyed = ordered_keys(df, name, "Position")
        return keyed.withColumn("Position", F.col("Position").cast("bigint") - 1)

    axes = axis("P", "abc"), axis("W", "xy"), axis("D", "12")
    every = spark.range(12).withColumnRenamed("id", "Cell")
    got = {r.Cell: (r.D, r.P, r.W) for r in tr.stock_cells(every, *axes).collect()}
    want = [(d, p, w) for d in "12" for p in "abc" for w in "xy"]
    assert [got[i] for i in range(12)] == want
    cells = spark.createDataFrame([(11,), (0,)], "Cell bigint")
    assert {r.Cell for r in tr.stock_cells(cells, *axes).collect()} == {0, 11}


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_draw_takes_n_distinct_rows(spark, n):
    df = spark.range(1000)
    got = sorted(r.id for r in tr.draw(df, ["id"], n).collect())
    assert len(got) == len(set(got)) == min(n, 1000)
    # The same rows however the input is partitioned; other rows for another seed.
    assert got == sorted(r.id for r in tr.draw(df.repartition(13), ["id"], n).collect())
    if n == 37:
        assert got != sorted(r.id for r in tr.draw(df, ["id"], n, seed=7).collect())


def test_draw_matches_a_full_sort(spark):
    df = spark.range(5000)
    want = {r.id for r in df.orderBy(F.xxhash64("id", F.lit(42))).limit(1234).collect()}
    assert {r.id for r in tr.draw(df, ["id"], 1234).collect()} == want


def test_stock_amounts(spark):
    df = spark.createDataFrame(
        [("P1", 10, 3), ("P1", 2, 5), ("P1", None, 5)], "ProductID string, CurrentStock int, ReservedStock int"
    )
    assert [r.AvailableStock for r in tr.with_available_stock(df).collect()] == [7, 0, None]
    cost = spark.createDataFrame([("P1", D("1.25"))], "ProductID string, UnitCost decimal(18,2)")
    values = [r.InventoryValue for r in tr.with_inventory_value(df, cost).collect()]
    assert sorted(values, key=str) == [D("12.50"), D("2.50"), None]


def test_source_status_needs_exactly_zero(spark):
    df = spark.createDataFrame(
        [(0, 5, 10), (-1, 5, 10), (4, 5, 10)],
        "AvailableStock int, SafetyStockLevel int, ReorderLevel int",
    )
    assert [r.RiskStatus for r in tr.with_source_status(df).collect()] == [
        "Stockout", "Critical", "Critical",
    ]


def test_utilization(spark):
    day = dt.date(2022, 1, 31)
    rows = [("W1", day, 30), ("W1", day, 20), ("W2", day, 900), ("W3", day, 5), ("W4", day, 5),
            ("W5", day, 0), ("W1", None, 7)]
    stock = spark.createDataFrame(rows, "WarehouseID string, SnapshotDate date, CurrentStock int")
    houses = spark.createDataFrame(
        [("W1", 80), ("W2", 100), ("W3", None), ("W4", 0), ("W5", 0)], "WarehouseID string, Capacity int"
    )
    got = tr.with_utilization(stock, houses).collect()
    assert len(got) == len(rows)
    rate = {(r.WarehouseID, r.SnapshotDate): r.WarehouseUtilizationPct for r in got}
    assert rate == {
        ("W1", day): D("62.50"), ("W2", day): D("100.00"), ("W3", day): None,
        ("W4", day): D("100.00"), ("W5", day): None, ("W1", None): None,
    }


def test_inspections(spark):
    df = spark.createDataFrame([(20, 1), (3, 1), (0, 0)], "InspectedQuantity int, DefectQuantity int")
    got = tr.with_inspection_result(tr.with_inspection_outcome(df)).collect()
    assert [(r.AcceptedQuantity, r.QualityScore, r.InspectionResult) for r in got] == [
        (19, D("95.00"), "Passed"), (2, D("66.67"), "Failed"), (0, D("0.00"), "Failed"),
    ]


def test_sort_on_write_splits_a_hot_value(spark):
    df = spark.range(20000).select(F.lit(1).alias("v"), "id")
    parts = tr.sort_on_write(df, ["v"]).groupBy(F.spark_partition_id().alias("p")).count()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert max(r["count"] for r in parts.collect()) < 10000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_sort_on_write_orders_across_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    parts = tr.sort_on_write(df, ["v"]).select("v", F.spark_partition_id().alias("p")).collect()
    assert [r.v for r in parts] == list(range(1000))
