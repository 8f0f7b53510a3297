"""The test tables as a star schema and as raw text.

Every column is one expression that Spark SQL and DuckDB read alike; the Spark side
selects it from DataFrames, the checking side from a subquery with the same columns.
"""

from __future__ import annotations

CALENDAR = ("1995-01-01", "2002-12-31")


def _money(cents: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,2))*0.01 AS {kind})"


def _whole(num: str, den: str) -> str:
    return f"CAST(FLOOR(({num})/({den})) AS BIGINT)"


def _key_of(day: str) -> str:
    return f"CAST(year({day})*10000+month({day})*100+day({day}) AS INT)"


_ORDER_ID = "'ORD' || LPAD(CAST(l_orderkey AS STRING),7,'0') || '-' || CAST(l_linenumber AS STRING)"
_DELAY = "(l_orderkey*7+l_partkey*3+sk*(l_linenumber+1))%(5+sk%9)-2"
_DELIVERY = f"GREATEST(lead+{_DELAY},0)"
_DEFECTS = _whole("q*disc*2", "100")
_SCORE = _whole(f"20000*(q-{_DEFECTS})+q", "2*q")
_RATING = "6000+(s_suppkey*397)%4001"
_ODATE = "CAST(o_orderdate AS DATE)"
_SDATE = "CAST(l_shipdate AS DATE)"

# Where the columns come from: the row source and the rows kept.
SOURCE = {
    "DimSupplier": ("SUPPLIER_PLACE", None),
    "DimProduct": ("part", None),
    "DimWarehouse": ("nation", None),
    "DimCarrier": ("nation", None),
    "FactOrders": ("LINE", None),
    "FactShipments": ("LINE", "st='Completed'"),
    "FactSupplierQuality": ("LINE", "st='Completed'"),
    "FactInventory": ("INV", None),
}

COLUMNS: dict[str, dict[str, str]] = {
    "DimSupplier": {
        "SupplierKey": "CAST(s_suppkey AS INT)",
        "SupplierID": "'SUP' || LPAD(CAST(s_suppkey AS STRING),6,'0')",
        "SupplierName": "s_name",
        "Country": "n_name",
        "Region": "r_name",
        "SupplierCategory": "'Category ' || CAST(s_suppkey%8 AS STRING)",
        "SupplierSince": "DATE '1990-01-01' + CAST(s_suppkey%1500 AS INT)",
        "QualityRating": _money(_RATING, "DECIMAL(5,2)"),
        "RiskTier": f"CASE WHEN {_RATING}>=9400 THEN 'Low' WHEN {_RATING}>=8600 THEN 'Medium' "
        f"WHEN {_RATING}>=7500 THEN 'High' ELSE 'Critical' END",
        "ActiveStatus": "CASE WHEN s_suppkey%20=0 THEN 'Inactive' ELSE 'Active' END",
    },
    "DimProduct": {
        "ProductKey": "CAST(p_partkey AS INT)",
        "ProductID": "'PRD' || LPAD(CAST(p_partkey AS STRING),7,'0')",
        "ProductName": "p_name",
        "Category": "p_type",
        "SubCategory": "p_brand",
        "UnitCost": _money("ROUND(p_retailprice*100)"),
        "StandardPrice": _money("ROUND(p_retailprice*125)"),
        "ReorderLevel": "CAST(20+(p_partkey*7)%481 AS INT)",
        "SafetyStockLevel": f"CAST(10+{_whole('(p_partkey*7)%481*3', '5')} AS INT)",
        "LeadTimeDays": "CAST(3+p_partkey%43 AS INT)",
    },
    "DimWarehouse": {
        "WarehouseKey": "CAST(n_nationkey AS INT)",
        "WarehouseID": "'WH' || LPAD(CAST(n_nationkey AS STRING),3,'0')",
        "WarehouseName": "n_name || ' Distribution Center'",
        "Country": "n_name",
        "City": "'City ' || CAST(n_nationkey AS STRING)",
        "Capacity": "CAST(100000+(n_nationkey*88003)%700001 AS INT)",
        "WarehouseType": "'Type ' || CAST(n_nationkey%4 AS STRING)",
    },
    "DimCarrier": {
        "CarrierKey": "CAST(n_nationkey AS INT)",
        "CarrierID": "'CAR' || LPAD(CAST(n_nationkey AS STRING),3,'0')",
        "CarrierName": "'Carrier ' || CAST(n_nationkey AS STRING)",
        "CarrierType": "'Mode ' || CAST(n_nationkey%5 AS STRING)",
        "Country": "n_name",
        "ServiceLevel": "CASE n_nationkey%4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express' "
        "WHEN 2 THEN 'Economy' ELSE 'Priority' END",
    },
    "FactOrders": {
        "OrderID": _ORDER_ID,
        "SupplierKey": "CAST(sk AS INT)",
        "ProductKey": "CAST(l_partkey AS INT)",
        "WarehouseKey": "CAST(c_nationkey AS INT)",
        "OrderDateKey": _key_of(_ODATE),
        "ExpectedDeliveryDateKey": _key_of(f"({_ODATE} + CAST(lead AS INT))"),
        "OrderDate": _ODATE,
        "ExpectedDeliveryDate": f"{_ODATE} + CAST(lead AS INT)",
        "OrderQuantity": "CAST(q AS INT)",
        "UnitCost": _money(_whole("cents", "q")),
        "OrderValue": _money("cents"),
        "OrderStatus": "st",
    },
    "FactShipments": {
        "ShipmentID": f"'SHP' || SUBSTRING({_ORDER_ID},4)",
        "OrderID": _ORDER_ID,
        "SupplierKey": "CAST(sk AS INT)",
        "ProductKey": "CAST(l_partkey AS INT)",
        "WarehouseKey": "CAST(c_nationkey AS INT)",
        "CarrierKey": "CAST((l_linenumber*3+l_partkey)%20 AS INT)",
        "ShipDateKey": _key_of(_SDATE),
        "PromisedDateKey": _key_of(f"({_SDATE} + CAST(lead AS INT))"),
        "DeliveryDateKey": _key_of(f"({_SDATE} + CAST({_DELIVERY} AS INT))"),
        "ShipDate": _SDATE,
        "PromisedDate": f"{_SDATE} + CAST(lead AS INT)",
        "DeliveryDate": f"{_SDATE} + CAST({_DELIVERY} AS INT)",
        "QuantityShipped": "CAST(q AS INT)",
        "ShippingCost": _money("q*(150+(l_partkey*17+l_orderkey)%650)"),
        "QualityScore": _money("5500+(l_partkey*131+l_orderkey)%4501", "DECIMAL(5,2)"),
        "DamagedQuantity": f"CAST(CASE WHEN l_returnflag='R' THEN {_whole('q*disc', '100')} "
        "ELSE 0 END AS INT)",
        "DeliveryDays": f"CAST({_DELIVERY} AS INT)",
        "DelayDays": f"CAST({_DELAY} AS INT)",
        "ShipmentStatus": f"CASE WHEN {_DELAY}<=0 THEN 'On Time' WHEN {_DELAY}<=3 THEN "
        f"'Minor Delay' WHEN {_DELAY}<=7 THEN 'Moderate Delay' ELSE 'Severe Delay' END",
    },
    "FactSupplierQuality": {
        "InspectionID": f"'INS' || SUBSTRING({_ORDER_ID},4)",
        "OrderID": _ORDER_ID,
        "SupplierKey": "CAST(sk AS INT)",
        "ProductKey": "CAST(l_partkey AS INT)",
        "DateKey": _key_of(f"({_ODATE} + CAST(5+l_partkey%41 AS INT))"),
        "InspectionDate": f"{_ODATE} + CAST(5+l_partkey%41 AS INT)",
        "InspectedQuantity": "CAST(q AS INT)",
        "AcceptedQuantity": f"CAST(q-{_DEFECTS} AS INT)",
        "RejectedQuantity": f"CAST({_DEFECTS} AS INT)",
        "DefectQuantity": f"CAST({_DEFECTS} AS INT)",
        "QualityScore": _money(_SCORE, "DECIMAL(5,2)"),
        "InspectionResult": f"CASE WHEN {_SCORE}>=9500 THEN 'Passed' WHEN {_SCORE}>=8500 THEN "
        "'Conditional' ELSE 'Failed' END",
    },
    "FactInventory": {
        "InventoryKey": "p_partkey*75+n_nationkey*3+sn",
        "InventoryRecordID": "'INV' || LPAD(CAST(p_partkey AS STRING),7,'0') || '-' || "
        "LPAD(CAST(n_nationkey AS STRING),2,'0') || '-' || CAST(sn AS STRING)",
        "ProductKey": "CAST(p_partkey AS INT)",
        "WarehouseKey": "CAST(n_nationkey AS INT)",
        "DateKey": _key_of("sd"),
        "SnapshotDate": "sd",
        "CurrentStock": f"CAST(av+{_whole('av', '10')} AS INT)",
        "ReservedStock": f"CAST({_whole('av', '10')} AS INT)",
        "AvailableStock": "CAST(av AS INT)",
        "ReorderLevel": "CAST(rl AS INT)",
        "SafetyStockLevel": "CAST(ss AS INT)",
        "AvgDailyDemand": "CAST(dem AS DECIMAL(18,2))",
        "StockCoverageDays": f"CAST(CAST({_whole('20*av+dem', '2*dem')} AS DECIMAL(18,2))*0.1 "
        "AS DECIMAL(18,2))",
        "InventoryValue": _money(f"(av+{_whole('av', '10')})*uc"),
        "RiskStatus": "CASE WHEN av=0 THEN 'Stockout' WHEN av<ss THEN 'Critical' WHEN av<rl THEN "
        "'Reorder Required' WHEN av>rl*3 THEN 'Overstock' ELSE 'Safe' END",
    },
}

# Columns worked out from others, in this order.
LINE_STEPS = {
    "q": "CAST(l_quantity AS BIGINT)",
    "cents": "CAST(ROUND(l_extendedprice*100) AS BIGINT)",
    "disc": "CAST(ROUND(l_discount*100) AS BIGINT)",
    "lead": "3+l_partkey%43",
    "wanted": "CASE WHEN l_partkey%3=0 AND l_linenumber<=4 THEN l_partkey%n ELSE l_suppkey END",
    # Some suppliers stay without orders: theirs go to the supplier before.
    "sk": "CASE WHEN wanted%25=24 THEN wanted-1 ELSE wanted END",
    "st": "CASE WHEN (l_orderkey+l_linenumber)%50=0 THEN 'Cancelled' WHEN o_orderstatus='F' THEN "
    "'Completed' WHEN o_orderstatus='O' THEN 'Processing' ELSE 'Pending' END",
}

INV_STEPS = {
    "rl": "20+(p_partkey*7)%481",
    "ss": f"10+{_whole('(p_partkey*7)%481*3', '5')}",
    "u": "(p_partkey*7919+n_nationkey*104729+sn*1299709)%100",
    "dem": "1+p_partkey%40",
    "uc": "CAST(ROUND(p_retailprice*100) AS BIGINT)",
}

INV_STOCK = (
    "CASE WHEN u<3 THEN 0 WHEN u<11 THEN 1+(u*31+p_partkey)%GREATEST(ss-1,1) "
    "WHEN u<26 THEN ss+(p_partkey*13)%GREATEST(rl-ss,1) "
    "WHEN u<38 THEN rl*3+1+(p_partkey*17)%(rl*4) ELSE rl+(p_partkey*11)%(rl*2) END"
)

SNAPSHOTS = ["2001-08-31", "2001-09-30", "2001-10-31"]


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _spoil(expr: str, cases: list[tuple[str, str]]) -> str:
    """Text of a column with some rows replaced, to give the checks something to find."""
    arms = " ".join(f"WHEN {when} THEN {then}" for when, then in cases)
    return f"CASE {arms} ELSE {_text(expr)} END"


def _raw(table: str, spoiled: dict[str, str], plain: dict[str, str]) -> dict[str, str]:
    """Every column of a star table as text, natural ids for keys, some columns spoiled."""
    return {c: spoiled.get(c, _text(e)) for c, e in plain.items()}


_D, _F = COLUMNS, COLUMNS
_SUPPLIER_ID = "'SUP' || LPAD(CAST(sk AS STRING),6,'0')"
_PRODUCT_ID = "'PRD' || LPAD(CAST(l_partkey AS STRING),7,'0')"
_WAREHOUSE_ID = "'WH' || LPAD(CAST(c_nationkey AS STRING),3,'0')"
_CARRIER_ID = "'CAR' || LPAD(CAST((l_linenumber*3+l_partkey)%20 AS STRING),3,'0')"
_LINE_NO = "(l_orderkey*3+l_partkey+l_linenumber)"


def _plain(name: str, drop: tuple[str, ...], **first: str) -> dict[str, str]:
    kept = {c: e for c, e in COLUMNS[name].items() if c not in drop}
    return kept | first


RAW_SOURCE = {
    "Suppliers": SOURCE["DimSupplier"],
    "Products": SOURCE["DimProduct"],
    "Warehouses": SOURCE["DimWarehouse"],
    "Carriers": SOURCE["DimCarrier"],
    "Orders": ("LINE", None),
    "Shipments": ("LINE", "st='Completed'"),
    "Inventory": ("INV", None),
    "SupplierQuality": ("LINE", "st='Completed'"),
}

RAW_COLUMNS: dict[str, dict[str, str]] = {
    "Suppliers": _raw(
        "Suppliers",
        {
            "SupplierName": _spoil(
                "s_name",
                [
                    ("s_suppkey%29=3", "'\"' || s_name"),
                    ("s_suppkey%41=7", "'Smith, Jones and \"Sons\", ' || s_name"),
                ],
            ),
            "Country": _spoil(
                "n_name",
                [
                    ("s_suppkey%31=5", "'North\" East'"),
                    ("s_suppkey%37=6", "NULL"),
                    ("s_suppkey%3=0", "'India'"),
                    ("s_suppkey%3=1", "'Germany'"),
                ],
            ),
            "SupplierSince": _spoil(
                _D["DimSupplier"]["SupplierSince"],
                [
                    ("s_suppkey%11=1", "'unknown'"),
                    ("s_suppkey%13=2", "NULL"),
                    ("s_suppkey%17=3", "'01/05/2024'"),
                    ("s_suppkey%19=4", "'2024'"),
                    ("s_suppkey%23=5", "'2024-2-3'"),
                ],
            ),
            "QualityRating": _spoil(
                _D["DimSupplier"]["QualityRating"],
                [
                    ("s_suppkey%17=1", "'1234.5'"),
                    ("s_suppkey%19=2", "''"),
                    ("s_suppkey%23=3", "'87.655'"),
                    ("s_suppkey%29=4", "'n/a'"),
                ],
            ),
        },
        _plain("DimSupplier", ("SupplierKey",)),
    ),
    "Products": _raw(
        "Products",
        {
            "UnitCost": _spoil(_D["DimProduct"]["UnitCost"], [("p_partkey%101=1", "'free'")]),
            "ReorderLevel": _spoil(
                _D["DimProduct"]["ReorderLevel"],
                [("p_partkey%103=2", "'12.5'"), ("p_partkey%107=3", "NULL")],
            ),
            "LeadTimeDays": _spoil(
                _D["DimProduct"]["LeadTimeDays"],
                [("p_partkey%109=4", "'99999999999'"), ("p_partkey%113=5", "' 7 '")],
            ),
        },
        _plain("DimProduct", ("ProductKey",)),
    ),
    "Warehouses": _raw(
        "Warehouses",
        {"Capacity": _spoil(_D["DimWarehouse"]["Capacity"], [("n_nationkey%11=10", "'large'")])},
        _plain("DimWarehouse", ("WarehouseKey",)),
    ),
    "Carriers": _raw("Carriers", {}, _plain("DimCarrier", ("CarrierKey",))),
    "Orders": _raw(
        "Orders",
        {
            "OrderDate": _spoil(
                _ODATE,
                [
                    (f"{_LINE_NO}%211=1", "'2031-01-01'"),
                    (f"{_LINE_NO}%223=2", "'soon'"),
                    (f"{_LINE_NO}%227=3", "NULL"),
                ],
            ),
            "OrderQuantity": _spoil("CAST(q AS INT)", [(f"{_LINE_NO}%229=4", "'12.5'")]),
            "OrderValue": _spoil(_F["FactOrders"]["OrderValue"], [(f"{_LINE_NO}%233=5", "''")]),
        },
        {
            "OrderID": _ORDER_ID,
            "SupplierID": f"CASE WHEN {_LINE_NO}%239=6 THEN 'SUP999999' ELSE {_SUPPLIER_ID} END",
            "ProductID": _PRODUCT_ID,
            "WarehouseID": f"CASE WHEN {_LINE_NO}%241=7 THEN 'WH999' ELSE {_WAREHOUSE_ID} END",
        }
        | _plain(
            "FactOrders",
            (
                "OrderID",
                "SupplierKey",
                "ProductKey",
                "WarehouseKey",
                "OrderDateKey",
                "ExpectedDeliveryDateKey",
            ),
        ),
    ),
    "Shipments": _raw(
        "Shipments",
        {
            "DeliveryDate": _spoil(
                _F["FactShipments"]["DeliveryDate"], [(f"{_LINE_NO}%211=1", "'1890-12-31'")]
            ),
            "DelayDays": _spoil(
                _F["FactShipments"]["DelayDays"],
                [(f"{_LINE_NO}%223=2", "'late'"), (f"{_LINE_NO}%227=3", "NULL")],
            ),
            "QualityScore": _spoil(
                _F["FactShipments"]["QualityScore"], [(f"{_LINE_NO}%229=4", "'1000'")]
            ),
        },
        {
            "ShipmentID": _F["FactShipments"]["ShipmentID"],
            "OrderID": _ORDER_ID,
            "SupplierID": _SUPPLIER_ID,
            "ProductID": _PRODUCT_ID,
            "WarehouseID": _WAREHOUSE_ID,
            "CarrierID": f"CASE WHEN {_LINE_NO}%233=5 THEN 'CAR999' ELSE {_CARRIER_ID} END",
        }
        | _plain(
            "FactShipments",
            (
                "ShipmentID",
                "OrderID",
                "SupplierKey",
                "ProductKey",
                "WarehouseKey",
                "CarrierKey",
                "ShipDateKey",
                "PromisedDateKey",
                "DeliveryDateKey",
            ),
        ),
    ),
    "Inventory": _raw(
        "Inventory",
        {
            "SnapshotDate": _spoil("sd", [("(p_partkey+n_nationkey)%211=1", "'2001-13-01'")]),
            "CurrentStock": _spoil(
                _F["FactInventory"]["CurrentStock"], [("(p_partkey+n_nationkey)%223=2", "'none'")]
            ),
        },
        {
            # Some records carry the id of another product's record.
            "InventoryRecordID": _F["FactInventory"]["InventoryRecordID"].replace(
                "p_partkey", "CASE WHEN p_partkey%97=6 THEN p_partkey-5 ELSE p_partkey END"
            ),
            "ProductID": "'PRD' || LPAD(CAST(p_partkey AS STRING),7,'0')",
            "WarehouseID": "'WH' || LPAD(CAST(n_nationkey AS STRING),3,'0')",
        }
        | _plain(
            "FactInventory",
            ("InventoryKey", "InventoryRecordID", "ProductKey", "WarehouseKey", "DateKey"),
        )
        | {"WarehouseUtilizationPct": "CAST(u AS DECIMAL(6,2))"},
    ),
    "SupplierQuality": _raw(
        "SupplierQuality",
        {
            "InspectionDate": _spoil(
                _F["FactSupplierQuality"]["InspectionDate"], [(f"{_LINE_NO}%211=1", "'later'")]
            ),
            "DefectQuantity": _spoil(
                _F["FactSupplierQuality"]["DefectQuantity"], [(f"{_LINE_NO}%223=2", "'few'")]
            ),
        },
        {
            "InspectionID": _F["FactSupplierQuality"]["InspectionID"],
            "OrderID": _ORDER_ID,
            "SupplierID": _SUPPLIER_ID,
            "ProductID": _PRODUCT_ID,
        }
        | _plain(
            "FactSupplierQuality",
            ("InspectionID", "OrderID", "SupplierKey", "ProductKey", "DateKey"),
        ),
    ),
}
