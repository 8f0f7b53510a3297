"""Raw tables: column names, staged types, file names, natural keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Staged tables and their columns; "string" columns are kept as they come.
STAGED: dict[str, dict[str, str]] = {
    "Suppliers": {
        "SupplierID": "string",
        "SupplierName": "string",
        "Country": "string",
        "Region": "string",
        "SupplierCategory": "string",
        "SupplierSince": "date",
        "QualityRating": "decimal(5,2)",
        "RiskTier": "string",
        "ActiveStatus": "string",
    },
    "Products": {
        "ProductID": "string",
        "ProductName": "string",
        "Category": "string",
        "SubCategory": "string",
        "UnitCost": "decimal(18,2)",
        "StandardPrice": "decimal(18,2)",
        "ReorderLevel": "int",
        "SafetyStockLevel": "int",
        "LeadTimeDays": "int",
    },
    "Warehouses": {
        "WarehouseID": "string",
        "WarehouseName": "string",
        "Country": "string",
        "City": "string",
        "Capacity": "int",
        "WarehouseType": "string",
    },
    "Carriers": {
        "CarrierID": "string",
        "CarrierName": "string",
        "CarrierType": "string",
        "Country": "string",
        "ServiceLevel": "string",
    },
    "Orders": {
        "OrderID": "string",
        "SupplierID": "string",
        "ProductID": "string",
        "WarehouseID": "string",
        "OrderDate": "date",
        "ExpectedDeliveryDate": "date",
        "OrderQuantity": "int",
        "UnitCost": "decimal(18,2)",
        "OrderValue": "decimal(18,2)",
        "OrderStatus": "string",
    },
    "Shipments": {
        "ShipmentID": "string",
        "OrderID": "string",
        "SupplierID": "string",
        "ProductID": "string",
        "WarehouseID": "string",
        "CarrierID": "string",
        "ShipDate": "date",
        "PromisedDate": "date",
        "DeliveryDate": "date",
        "QuantityShipped": "int",
        "ShippingCost": "decimal(18,2)",
        "QualityScore": "decimal(5,2)",
        "DamagedQuantity": "int",
        "DeliveryDays": "int",
        "DelayDays": "int",
        "ShipmentStatus": "string",
    },
    "Inventory": {
        "InventoryRecordID": "string",
        "ProductID": "string",
        "WarehouseID": "string",
        "SnapshotDate": "date",
        "CurrentStock": "int",
        "ReservedStock": "int",
        "AvailableStock": "int",
        "ReorderLevel": "int",
        "SafetyStockLevel": "int",
        "AvgDailyDemand": "decimal(18,2)",
        "StockCoverageDays": "decimal(18,2)",
        "InventoryValue": "decimal(18,2)",
        "RiskStatus": "string",
        "WarehouseUtilizationPct": "decimal(6,2)",
    },
    "SupplierQuality": {
        "InspectionID": "string",
        "OrderID": "string",
        "SupplierID": "string",
        "ProductID": "string",
        "InspectionDate": "date",
        "InspectedQuantity": "int",
        "AcceptedQuantity": "int",
        "RejectedQuantity": "int",
        "DefectQuantity": "int",
        "QualityScore": "decimal(5,2)",
        "InspectionResult": "string",
    },
}

# CSV file of each raw table.
RAW_FILES = {
    "Suppliers": "suppliers.csv",
    "Products": "products.csv",
    "Warehouses": "warehouses.csv",
    "Carriers": "carriers.csv",
    "Orders": "orders.csv",
    "Shipments": "shipments.csv",
    "Inventory": "inventory.csv",
    "SupplierQuality": "supplier_quality.csv",
}


@dataclass(frozen=True)
class Dimension:
    staged: str
    natural: str
    key: str


# Dimension tables over the staged masters.
DIMENSIONS = {
    "DimSupplier": Dimension("Suppliers", "SupplierID", "SupplierKey"),
    "DimProduct": Dimension("Products", "ProductID", "ProductKey"),
    "DimWarehouse": Dimension("Warehouses", "WarehouseID", "WarehouseKey"),
    "DimCarrier": Dimension("Carriers", "CarrierID", "CarrierKey"),
}


@dataclass(frozen=True)
class Fact:
    staged: str
    key: str
    dimensions: tuple[str, ...]
    dates: dict[str, str]  # staged date column -> fact date key column
    measures: tuple[str, ...]


# Fact tables over the staged records.
FACTS = {
    "FactOrders": Fact(
        "Orders",
        "OrderKey",
        ("DimSupplier", "DimProduct", "DimWarehouse"),
        {"OrderDate": "OrderDateKey", "ExpectedDeliveryDate": "ExpectedDeliveryDateKey"},
        ("OrderQuantity", "UnitCost", "OrderValue", "OrderStatus"),
    ),
    "FactShipments": Fact(
        "Shipments",
        "ShipmentKey",
        ("DimSupplier", "DimProduct", "DimWarehouse", "DimCarrier"),
        {
            "ShipDate": "ShipDateKey",
            "PromisedDate": "PromisedDateKey",
            "DeliveryDate": "DeliveryDateKey",
        },
        (
            "QuantityShipped",
            "ShippingCost",
            "QualityScore",
            "DamagedQuantity",
            "DeliveryDays",
            "DelayDays",
            "ShipmentStatus",
        ),
    ),
    "FactInventory": Fact(
        "Inventory",
        "InventoryKey",
        ("DimProduct", "DimWarehouse"),
        {"SnapshotDate": "DateKey"},
        (
            "CurrentStock",
            "ReservedStock",
            "AvailableStock",
            "ReorderLevel",
            "SafetyStockLevel",
            "AvgDailyDemand",
            "StockCoverageDays",
            "InventoryValue",
            "RiskStatus",
            "WarehouseUtilizationPct",
        ),
    ),
    "FactSupplierQuality": Fact(
        "SupplierQuality",
        "InspectionKey",
        ("DimSupplier", "DimProduct"),
        {"InspectionDate": "DateKey"},
        (
            "InspectedQuantity",
            "AcceptedQuantity",
            "RejectedQuantity",
            "DefectQuantity",
            "QualityScore",
            "InspectionResult",
        ),
    ),
}


def record_ids(fact: Fact) -> list[str]:
    """Text ids a fact keeps: its own id, and the order it belongs to."""
    looked_up = {DIMENSIONS[d].natural for d in fact.dimensions}
    return [
        c
        for c, kind in STAGED[fact.staged].items()
        if c.endswith("ID") and kind == "string" and c not in looked_up
    ]


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in STAGED[table]])
