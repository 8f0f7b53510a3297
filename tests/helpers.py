"""Small star schemas for hand-made cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from riskmart.operators.dimensions import date_dimension

SUPPLIER = (
    "SupplierKey int, SupplierID string, SupplierName string, Country string, Region string, "
    "SupplierCategory string, SupplierSince date, QualityRating decimal(5,2), RiskTier string, "
    "ActiveStatus string"
)
PRODUCT = (
    "ProductKey int, ProductID string, ProductName string, Category string, SubCategory string, "
    "UnitCost decimal(18,2), StandardPrice decimal(18,2), ReorderLevel int, SafetyStockLevel int, "
    "LeadTimeDays int"
)
WAREHOUSE = (
    "WarehouseKey int, WarehouseID string, WarehouseName string, Country string, City string, "
    "Capacity int, WarehouseType string"
)
CARRIER = (
    "CarrierKey int, CarrierID string, CarrierName string, CarrierType string, Country string, "
    "ServiceLevel string"
)
ORDERS = (
    "OrderKey bigint, OrderID string, SupplierKey int, ProductKey int, WarehouseKey int, "
    "OrderDateKey int, ExpectedDeliveryDateKey int, OrderQuantity int, UnitCost decimal(18,2), "
    "OrderValue decimal(18,2), OrderStatus string"
)
SHIPMENTS = (
    "ShipmentKey bigint, ShipmentID string, OrderID string, SupplierKey int, ProductKey int, "
    "WarehouseKey int, CarrierKey int, ShipDateKey int, PromisedDateKey int, DeliveryDateKey int, "
    "QuantityShipped int, ShippingCost decimal(18,2), QualityScore decimal(5,2), "
    "DamagedQuantity int, DeliveryDays int, DelayDays int, ShipmentStatus string"
)
INVENTORY = (
    "InventoryKey bigint, InventoryRecordID string, ProductKey int, WarehouseKey int, DateKey int, "
    "CurrentStock int, ReservedStock int, AvailableStock int, ReorderLevel int, "
    "SafetyStockLevel int, AvgDailyDemand decimal(18,2), StockCoverageDays decimal(18,2), "
    "InventoryValue decimal(18,2), RiskStatus string, WarehouseUtilizationPct decimal(6,2)"
)
QUALITY = (
    "InspectionKey bigint, InspectionID string, OrderID string, SupplierKey int, ProductKey int, "
    "DateKey int, InspectedQuantity int, AcceptedQuantity int, RejectedQuantity int, "
    "DefectQuantity int, QualityScore decimal(5,2), InspectionResult string"
)


def supplier(key, rating="80.00", status="Active", name=None):
    return (
        key,
        f"SUP{key:04d}",
        name or f"Supplier {key}",
        "India",
        "Asia",
        "Packaging",
        dt.date(2020, 1, 1),
        D(rating),
        "High",
        status,
    )


def order(key, sup, product=1, house=1, value="10.00", status="Completed", qty=1):
    v = None if value is None else D(value)
    return (key, f"ORD{key}", sup, product, house, 20220103, 20220110, qty, v, v, status)


def shipment(key, sup, delay, carrier=1, cost="5.00", qty=10, damaged=0, days=4):
    return (
        key,
        f"SHP{key}",
        f"ORD{key}",
        sup,
        1,
        1,
        carrier,
        20220103,
        20220110,
        20220110,
        qty,
        D(cost),
        D("90.00"),
        damaged,
        days,
        delay,
        "On Time",
    )


def inspection(key, sup, score="95.00", inspected=10, defects=0):
    s = None if score is None else D(score)
    return (key, f"INS{key}", f"ORD{key}", sup, 1, 20220105, inspected, 0, 0, defects, s, "Passed")


def stock(key, available, reorder=10, safety=5, day=20220131, cover="20.00", product=1, house=1):
    c = None if cover is None else D(cover)
    return (
        key,
        f"INV{key}",
        product,
        house,
        day,
        available,
        0,
        available,
        reorder,
        safety,
        D("1.00"),
        c,
        D("100.00"),
        "Safe",
        D("50.00"),
    )


def star(spark, suppliers=(), orders=(), shipments=(), inspections=(), inventory=(), carriers=1):
    def table(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return {
        "DimSupplier": table(suppliers, SUPPLIER),
        "DimProduct": table(
            [
                (1, "PRD1", "Bolt", "Packaging", "A", D("2.50"), D("3.00"), 10, 5, 7),
                (2, "PRD2", "Nut", "Packaging", "A", D("4.00"), D("5.00"), 10, 5, 7),
            ],
            PRODUCT,
        ),
        "DimWarehouse": table(
            [(1, "WH1", "North", "India", "Pune", 100, "T"), (2, "WH2", "South", "India", "X", 100, "T")],
            WAREHOUSE,
        ),
        "DimCarrier": table(
            [(k, f"CAR{k}", f"Carrier {k}", "Air", "India", "Express") for k in range(1, carriers + 1)],
            CARRIER,
        ),
        "DimDate": date_dimension(spark, "2022-01-01", "2022-12-31"),
        "FactOrders": table(orders, ORDERS),
        "FactShipments": table(shipments, SHIPMENTS),
        "FactInventory": table(inventory, INVENTORY),
        "FactSupplierQuality": table(inspections, QUALITY),
    }


def by(df, key):
    return {r[key]: r for r in df.collect()}
