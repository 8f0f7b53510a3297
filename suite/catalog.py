"""Every operator as a query over the test tables, with its checking SQL.

``add(name, build, sql)``: ``build`` takes the test mart; ``sql`` is DuckDB text over the
parts of ``suite.cte``, or None where no plain SQL gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions import stock
from riskmart.functions.domains import COUNTRIES, RISK_LEVELS, STOCK_STATUSES
from riskmart.operators import dimensions as dim
from riskmart.operators import facts as fct
from riskmart.operators import quality as dq
from riskmart.operators import transforms as tr
from riskmart.operators.ranks import Ranking, dense_keys, ordered_keys, with_global_rank
from riskmart.operators.staging import typed_columns
from riskmart.plans import dashboards as db
from riskmart.plans import dependency as sd
from riskmart.plans import inventory as ir
from riskmart.plans import kpis, load, reports
from riskmart.plans import logistics as lp
from riskmart.plans import supplier_risk as sr
from riskmart.sources import files, versions
from riskmart.sources.schemas import DIMENSIONS, FACTS, RAW_FILES, STAGED
from riskmart.sources.workspace import materialize, work_path
from suite import cte, mapping
from suite.mart import TASK_ROWS, Mart

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def add(name: str, build: Callable[[Mart], DataFrame], sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Mart.open(spark, sf_dir))
    if sql is not None:
        CHECKS[name] = cte.with_parts(sql)


def _list(*names: str) -> str:
    return ", ".join(names)


# --- sources and sinks -----------------------------------------------------------


def _landed(m: Mart, table: str) -> str:
    """The raw rows of one table as CSV in a landing folder."""
    path = f"{work_path(m.spark, 'landing')}/{RAW_FILES[table]}"
    files.write_table(m.raw(table), path, fmt="csv")
    return path


def _landing(m: Mart) -> str:
    """A landing folder with the raw rows of all tables as CSV, in compressed files of at most TASK_ROWS rows."""
    folder = work_path(m.spark, "landing")
    for t in RAW_FILES:
        files.write_table(m.raw_once(t), f"{folder}/{RAW_FILES[t]}", fmt="csv", compression="gzip", file_rows=TASK_ROWS)
    return folder


def _landed_all(m: Mart) -> dict[str, DataFrame]:
    return files.read_raw_folder(m.spark, _landing(m))


for _t in ("Suppliers", "Products", "Warehouses", "Carriers"):
    add(
        f"src_01_csv_{_t.lower()}",
        lambda m, t=_t: files.read_raw(m.spark, _landed(m, t), t),
        "SELECT " + _list(*[f"NULLIF({c},'') AS {c}" for c in STAGED[_t]]) + f" FROM Raw{_t}",
    )
add(
    "src_02_csv_orders_dated",
    lambda m: files.read_dated(m.spark, _landed(m, "Orders"), "Orders"),
    "SELECT "
    + _list(
        *[
            f"{cte.parse(c, k) if k == 'date' else f'NULLIF({c},{chr(39) * 2})'} AS {c}"
            for c, k in STAGED["Orders"].items()
        ]
    )
    + " FROM RawOrders",
)
add(
    "src_03_landing_counts",
    lambda m: dq.table_counts(_landed_all(m)),
    " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, COUNT(*) AS RowCount FROM Raw{t}" for t in RAW_FILES
    ),
)
add(
    "src_04_quoted_names",
    lambda m: files.read_raw(m.spark, _landed(m, "Suppliers"), "Suppliers")
    .where(F.col("SupplierName").contains(","))
    .select("SupplierID", "SupplierName", "Country"),
    "SELECT SupplierID, SupplierName, Country FROM RawSuppliers WHERE contains(SupplierName, ',')",
)


def _line_breaks(m: Mart) -> DataFrame:
    """Suppliers with line breaks and quotes in their names, as CSV and read again by byte ranges."""
    path = f"{work_path(m.spark, 'landing')}/{RAW_FILES['Suppliers']}"
    name = F.expr("SupplierName || chr(10) || chr(34) || Country || chr(34) || ',' || chr(10)")
    files.write_table(m.raw("Suppliers").withColumn("SupplierName", name), path, fmt="csv")
    return files.read_raw(m.spark, path, "Suppliers", multi_line=True)


add(
    "src_04_line_breaks",
    _line_breaks,
    "SELECT "
    + _list(*[f"NULLIF({c},'') AS {c}" for c in STAGED["Suppliers"] if c != "SupplierName"])
    + ", SupplierName || chr(10) || chr(34) || Country || chr(34) || ',' || chr(10) AS SupplierName FROM RawSuppliers",
)


def _broken_lines(m: Mart) -> DataFrame:
    """Carriers as lines without quotes: some with a comma too many, some with a field too few."""
    path = f"{work_path(m.spark, 'landing')}/{RAW_FILES['Carriers']}"
    head = F.lit(",".join(STAGED["Carriers"])).alias("value")
    lines = m.raw("Carriers").select(F.expr(_LINE).alias("value"))
    m.spark.range(1).select(head).unionByName(lines).coalesce(1).write.text(path)
    return files.malformed_rows(m.spark, path, "Carriers").select("CarrierID", "MalformedRow")


_LINE = (
    "CASE WHEN CAST(SUBSTRING(CarrierID,4) AS INT)%3=0 THEN CarrierID || ',' || CarrierName || ', Ltd,' "
    "|| CarrierType || ',' || Country || ',' || ServiceLevel WHEN CAST(SUBSTRING(CarrierID,4) AS INT)%3=1 "
    "THEN CarrierID || ',' || CarrierName ELSE CarrierID || ',' || CarrierName || ',' || CarrierType || "
    "',' || Country || ',' || ServiceLevel END"
)
add(
    "src_05_malformed_rows",
    _broken_lines,
    f"SELECT CarrierID, {_LINE} AS MalformedRow FROM RawCarriers "
    "WHERE CAST(SUBSTRING(CarrierID,4) AS INT)%3<2",
)


def _refreshed(m: Mart) -> DataFrame:
    """The whole load from CSV, by what it reports."""
    folder = work_path(m.spark, "refreshed")
    load.refresh(m.spark, _landing(m), folder, mapping.CALENDAR)
    report = load.Star(m.spark, folder)["LoadReport"]
    return report.where("Step in ('malformed', 'raw', 'staged') or TableName like 'Fact%'")


add(
    "load_01_refresh_report",
    _refreshed,
    " UNION ALL ".join(
        [
            f"SELECT '{step}' AS Step, '{t}' AS TableName, COUNT(*) AS RowCount FROM {part}{t}"
            for t in RAW_FILES
            for step, part in (("raw", "Raw"), ("staged", "Stg"))
        ]
        + [f"SELECT 'malformed', '{t}', CAST(0 AS BIGINT)" for t in RAW_FILES]
        + [f"SELECT 'loaded', '{t}', COUNT(*) FROM Built{t}" for t in FACTS]
        + [
            f"SELECT 'unmapped', '{t}', (SELECT COUNT(*) FROM Stg{fact.staged})-COUNT(*) FROM Built{t}"
            for t, fact in FACTS.items()
        ]
    ),
)


def _written_orders(m: Mart) -> DataFrame:
    path = work_path(m.spark, "sink")
    files.write_table(m["FactOrders"], path)
    return m.spark.read.parquet(path)


def _refreshed_inventory(m: Mart) -> DataFrame:
    """Written twice: the second load replaces the first, which held every row double."""
    folder = work_path(m.spark, "refresh")
    double = m["FactInventory"].unionByName(m["FactInventory"])
    load.save(m.spark, double, folder, "FactInventory")
    saved = load.save(m.spark, m["FactInventory"], folder, "FactInventory")
    return saved.groupBy("DateKey").agg(
        F.count(F.lit(1)).alias("RowCount"), F.sum("CurrentStock").alias("CurrentStock")
    )


def _followed(m: Mart) -> DataFrame:
    """Views opened on a mart without its last snapshots, read after another session has loaded them."""
    folder = work_path(m.spark, "followed")
    is_early = F.col("DateKey") < m["FactInventory"].agg(F.max("DateKey")).scalar()
    early = m["FactInventory"].where(is_early)
    tables = {t: m[t] for t in m} | {"FactInventory": early}
    first = {t: load.store(df, folder, t) for t, df in tables.items()}
    first[ir.SNAPSHOTS] = load.store(ir.snapshots(early, m["DimDate"]), folder, ir.SNAPSHOTS)
    versions.publish(m.spark, folder, first)
    views = db.Views(m.spark, lambda spark: load.Star(spark, folder))
    views.sql("SELECT COUNT(*) FROM vw_inventory_dashboard").collect()
    other = m.spark.newSession()
    late = other.read.schema(m["FactInventory"].schema).parquet(f"{folder}/{first['FactInventory'].path}")
    late = late.unionByName(m["FactInventory"].where(~F.coalesce(is_early, F.lit(False))))
    second = {"FactInventory": load.store(late, folder, "FactInventory")}
    second[ir.SNAPSHOTS] = load.store(ir.snapshots(late, m["DimDate"]), folder, ir.SNAPSHOTS)
    versions.publish(other, folder, second)
    return views.sql("SELECT SnapshotDate, InventoryRiskStatus, COUNT(*) AS RowCount FROM vw_inventory_dashboard GROUP BY ALL")


def _by_name(m: Mart) -> DataFrame:
    """Rows of all nine views, by name."""
    db.register_all(m)
    return dq.table_counts({name: m.spark.table(name) for name in (*db.ANALYSES, *db.DASHBOARDS)})


add(
    "snk_01_write_orders",
    lambda m: _written_orders(m),
    f"SELECT {_list(*mapping.COLUMNS['FactOrders'])} FROM FactOrders",
)
add(
    "snk_02_refresh_inventory",
    _refreshed_inventory,
    "SELECT DateKey, COUNT(*) AS RowCount, CAST(SUM(CurrentStock) AS BIGINT) AS CurrentStock "
    "FROM FactInventory GROUP BY DateKey",
)
add(
    "snk_03_views_follow_a_load",
    _followed,
    "SELECT SnapshotDate, InventoryRiskStatus, COUNT(*) AS RowCount FROM IrRow GROUP BY ALL",
)
add(
    "snk_03_named_views",
    _by_name,
    " UNION ALL ".join(
        f"SELECT '{view}' AS TableName, COUNT(*) AS RowCount FROM {part}"
        for view, part in (
            ("vw_supplier_risk_analysis", "Sr"),
            ("vw_supplier_dependency", "Sd"),
            ("vw_inventory_risk", "IrRow"),
            ("vw_logistics_performance", "Lp"),
            ("vw_supplier_risk_dashboard", "DbSupplier"),
            ("vw_inventory_dashboard", "IrRow"),
            ("vw_logistics_dashboard", "Lp"),
            ("vw_supplier_dependency_dashboard", "DbDependency"),
            ("vw_supply_chain_executive_summary", "DbSummary"),
        )
    ),
)

# --- staging -----------------------------------------------------------------------

for _i, _t in enumerate(RAW_FILES, start=1):
    add(
        f"stg_{_i:02d}_{_t.lower()}",
        lambda m, t=_t: load.stage_all({t: m.raw(t)})[t],
        f"SELECT {_list(*STAGED[_t])} FROM Stg{_t}",
    )
add(
    "stg_09_suppliers_reload",
    lambda m: load.stage_all(
        {"Suppliers": files.read_raw(m.spark, _landed(m, "Suppliers"), "Suppliers")}
    )["Suppliers"],
    f"SELECT {_list(*STAGED['Suppliers'])} FROM StgSuppliers",
)

# --- data quality --------------------------------------------------------------------

add(
    "dq_01_supplier_rejects",
    lambda m: dq.supplier_date_rejects(m.raw("Suppliers")),
    "SELECT SupplierSince FROM RawSuppliers WHERE SupplierSince IS NOT NULL AND "
    f"({cte.parse('SupplierSince', 'date')}) IS NULL",
)
for _i, _t in enumerate(
    ("Products", "Warehouses", "Orders", "Shipments", "Inventory", "SupplierQuality"), start=2
):
    add(
        f"dq_{_i:02d}_{_t.lower()}_rejects",
        lambda m, t=_t: dq.rejects(m.raw(t), t),
        f"SELECT {_list(*STAGED[_t])} FROM Raw{_t} WHERE "
        + " OR ".join(f"({cte.parse(c, k)}) IS NULL" for c, k in typed_columns(_t).items()),
    )
for _i, (_t, _k) in enumerate(
    (("Orders", "OrderID"), ("Shipments", "ShipmentID"), ("Inventory", "InventoryRecordID")),
    start=8,
):
    add(
        f"dq_{_i:02d}_{_t.lower()}_duplicates",
        lambda m, t=_t, k=_k: dq.duplicates(m.staged(t), [k]),
        f"SELECT {_k}, COUNT(*) AS DuplicateCount FROM Stg{_t} GROUP BY {_k} HAVING COUNT(*)>1",
    )
for _t, _k in (
    ("Orders", "OrderID"),
    ("Shipments", "ShipmentID"),
    ("SupplierQuality", "InspectionID"),
):
    add(
        f"dq_11_{_t.lower()}_surplus",
        lambda m, t=_t, k=_k: dq.surplus_rows(m.staged(t), [k]),
        f"SELECT (SELECT COUNT(*) FROM Stg{_t})-(SELECT COUNT(*) FROM "
        f"(SELECT DISTINCT {_k} FROM Stg{_t})) AS SurplusRows",
    )
add(
    "dq_12_inventory_surplus",
    lambda m: dq.surplus_rows(m.staged("Inventory"), ["ProductID", "WarehouseID", "SnapshotDate"]),
    "SELECT (SELECT COUNT(*) FROM StgInventory)-(SELECT COUNT(*) FROM (SELECT DISTINCT ProductID, "
    "WarehouseID, SnapshotDate FROM StgInventory)) AS SurplusRows",
)
for _t in ("Orders", "Shipments", "Inventory", "SupplierQuality"):
    add(
        f"dq_13_{_t.lower()}_nulls",
        lambda m, t=_t: dq.null_profile(m.staged(t)),
        " UNION ALL ".join(
            f"SELECT '{c}' AS ColumnName, COUNT(*)-COUNT({c}) AS NullCount FROM Stg{_t}"
            for c in STAGED[_t]
        ),
    )
add(
    "dq_14_broken_quotes",
    lambda m: dq.broken_quotes(m.raw("Suppliers")),
    "SELECT SupplierID, SupplierName, Country, Region, SupplierCategory FROM RawSuppliers "
    "WHERE SupplierName LIKE '\"%' OR Country LIKE '%\"%'",
)
add(
    "dq_15_unknown_countries",
    lambda m: dq.unknown_countries(m.raw("Suppliers")),
    "SELECT SupplierID, SupplierName, Country FROM RawSuppliers WHERE Country NOT IN ("
    + _list(*[f"'{c}'" for c in COUNTRIES])
    + ")",
)


def _counted(prefix: str, names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, COUNT(*) AS RowCount FROM {prefix}{t}" for t in names
    )


add("dq_16_raw_counts", lambda m: dq.table_counts(m.raw_all()), _counted("Raw", RAW_FILES))
add("dq_17_staged_counts", lambda m: dq.table_counts(m.staged_all()), _counted("Stg", RAW_FILES))
for _t in ("Suppliers", "Products", "Warehouses", "Carriers"):
    add(
        f"dq_18_{_t.lower().rstrip('s')}_count",
        lambda m, t=_t: dq.table_counts({t: m.staged(t)}),
        _counted("Stg", [_t]),
    )
for _t, _n in (
    ("Suppliers", 5),
    ("Products", 5),
    ("Warehouses", 5),
    ("Carriers", 5),
    ("Orders", 10),
    ("Shipments", 10),
    ("Inventory", 20),
    ("SupplierQuality", 10),
):
    _cols = list(STAGED[_t])
    add(
        f"dq_19_{_t.lower()}_preview",
        lambda m, t=_t, n=_n, cols=_cols: dq.preview(m.staged(t), n, cols),
        f"SELECT {_list(*_cols)} FROM Stg{_t} ORDER BY "
        + _list(*[f"{c} NULLS FIRST" for c in _cols])
        + f" LIMIT {_n}",
    )
for _t, _cols in (
    ("Suppliers", ["SupplierSince"]),
    ("Orders", ["OrderDate", "ExpectedDeliveryDate"]),
):
    add(
        f"dq_19_{_t.lower()}_dates",
        lambda m, t=_t, cols=_cols: dq.preview(m.raw(t).select(*cols), 20, cols),
        f"SELECT {_list(*_cols)} FROM Raw{_t} ORDER BY "
        + _list(*[f"{c} NULLS FIRST" for c in _cols])
        + " LIMIT 20",
    )
for _t, _c in (
    ("Orders", "OrderStatus"),
    ("Shipments", "ShipmentStatus"),
    ("Inventory", "RiskStatus"),
    ("SupplierQuality", "InspectionResult"),
):
    add(
        f"dq_20_{_t.lower()}_distribution",
        lambda m, t=_t, c=_c: dq.distribution(m.staged(t), c),
        f"SELECT {_c} AS Value, COUNT(*) AS Rows FROM Stg{_t} WHERE {_c} IS NOT NULL GROUP BY {_c}",
    )
_WIDE = "DECIMAL(28,2)"
_CASH = "DECIMAL(18,2)"
add(
    "dq_21_order_summary",
    lambda m: dq.order_summary(m.staged("Orders")),
    f"SELECT COUNT(*) AS Orders, CAST(SUM(OrderValue) AS {_WIDE}) AS TotalOrderValue, "
    f"{cte.avg(cte.cents('OrderValue'), 'COUNT(OrderValue)', _CASH)} AS AvgOrderValue, "
    "MIN(OrderDate) AS FirstOrderDate, MAX(OrderDate) AS LastOrderDate FROM StgOrders",
)
add(
    "dq_22_shipment_summary",
    lambda m: dq.shipment_summary(m.staged("Shipments")),
    "SELECT COUNT(*) AS Shipments, "
    f"{cte.pct('COUNT(*) FILTER (WHERE DelayDays<=0)', 'COUNT(*)')} AS OnTimeDeliveryPct, "
    f"{cte.avg('100*SUM(DelayDays)', 'COUNT(DelayDays)')} AS AvgDelayDays, "
    f"{cte.avg(cte.cents('ShippingCost'), 'COUNT(ShippingCost)', _CASH)} AS AvgShippingCost, "
    f"CAST(SUM(ShippingCost) AS {_WIDE}) AS TotalShippingCost FROM StgShipments",
)
add(
    "dq_23_mapping_coverage",
    lambda m: dq.mapping_coverage(m.spark, m.staged_all(), m),
    " UNION ALL ".join(
        f"SELECT '{n}' AS FactName, (SELECT COUNT(*) FROM Stg{f.staged}) AS StagingRows, "
        f"(SELECT COUNT(*) FROM Built{n}) AS MappedRows"
        for n, f in FACTS.items()
    ),
)
add(
    "dq_24_warehouse_counts",
    lambda m: dq.table_counts(m),
    _counted("", [*mapping.SOURCE, "DimDate"]),
)
add(
    "dq_24_dimension_counts",
    lambda m: dq.table_counts({d: m[d] for d in DIMENSIONS}),
    _counted("", DIMENSIONS),
)
add(
    "dq_25_orphan_orders",
    lambda m: dq.orphans(m.staged("Orders"), m["DimSupplier"], "SupplierID").select(
        "SupplierID", "OrderID"
    ),
    "SELECT SupplierID, OrderID FROM StgOrders WHERE SupplierID IS NULL OR SupplierID NOT IN "
    "(SELECT SupplierID FROM DimSupplier)",
)
add(
    "dq_25_orphan_counts",
    lambda m: dq.orphan_counts(m),
    " UNION ALL ".join(
        f"SELECT '{n}' AS FactName, '{c}' AS KeyColumn, (SELECT COUNT(*) FROM {n} f WHERE NOT "
        f"EXISTS (SELECT 1 FROM {d} x WHERE x.{k}=f.{c})) AS OrphanRows"
        for n, f in FACTS.items()
        for c, d, k in [
            *[(DIMENSIONS[d].key, d, DIMENSIONS[d].key) for d in f.dimensions],
            *[(c, "DimDate", "DateKey") for c in f.dates.values()],
        ]
    ),
)
add(
    "dq_26_delay_mismatches",
    lambda m: dq.delay_mismatches(m.staged("Shipments")),
    "SELECT ShipmentID, PromisedDate, DeliveryDate, DelayDays, "
    "CAST(DeliveryDate-PromisedDate AS INT) AS DateDelay FROM StgShipments "
    "WHERE DelayDays<>DeliveryDate-PromisedDate",
)
add(
    "dq_27_inventory_summary",
    lambda m: dq.inventory_summary(m.staged("Inventory")),
    "SELECT COUNT(*) AS InventoryRecords, "
    + cte.avg(cte.cents("WarehouseUtilizationPct"), "COUNT(WarehouseUtilizationPct)")
    + f" AS AvgUtilizationPct, CAST(SUM(InventoryValue) AS {_WIDE}) AS TotalInventoryValue, "
    + cte.avg(cte.cents("StockCoverageDays"), "COUNT(StockCoverageDays)", _CASH)
    + " AS AvgCoverageDays FROM StgInventory",
)
add(
    "dq_28_inspection_summary",
    lambda m: dq.inspection_summary(m.staged("SupplierQuality")),
    "SELECT COUNT(*) AS Inspections, "
    + cte.avg(cte.cents("QualityScore"), "COUNT(QualityScore)")
    + " AS AvgQualityScore, CAST(SUM(InspectedQuantity) AS BIGINT) AS TotalInspectedQuantity, "
    "CAST(SUM(DefectQuantity) AS BIGINT) AS TotalDefectQuantity, "
    + cte.pct("SUM(DefectQuantity)", "SUM(InspectedQuantity)")
    + " AS DefectRatePct FROM StgSupplierQuality",
)
add(
    "dq_29_enough_completed",
    lambda m: dq.require_rows(tr.completed_orders(m["FactOrders"]), 100).select(
        "OrderID", "SupplierKey"
    ),
    "SELECT OrderID, SupplierKey FROM FactOrders WHERE OrderStatus='Completed'",
)

# --- dimensions ------------------------------------------------------------------------

for _i, (_n, _d) in enumerate(DIMENSIONS.items(), start=1):
    add(
        f"dim_{_i:02d}_{_d.staged.lower()}",
        lambda m, n=_n, d=_d: dim.build_dimension(m.staged(d.staged), n),
        f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_d.natural}) AS INT) AS {_d.key}, "
        f"{_list(*STAGED[_d.staged])} FROM Stg{_d.staged}",
    )


def _order_span(m: Mart) -> tuple[Column, Column]:
    """First and last order date as scalar subqueries, for calendars that follow the data."""
    day, orders = F.col("o_orderdate").cast("date"), m.sources.table("orders")
    return orders.agg(F.min(day)).scalar(), orders.agg(F.max(day)).scalar()


_SPAN = (
    "generate_series((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders), "
    "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY) t(d)"
)
add(
    "dim_05_calendar",
    lambda m: dim.date_dimension(m.spark, *_order_span(m)),
    "SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS FullDate, "
    "CAST(day(d) AS INT) AS DayNumber, dayname(d) AS DayName, CAST(month(d) AS INT) AS MonthNumber,"
    " monthname(d) AS MonthName, CAST(quarter(d) AS INT) AS QuarterNumber, "
    "'Q' || quarter(d) AS QuarterName, CAST(year(d) AS INT) AS YearNumber, "
    "CAST((dayofyear(d)+dayofweek(date_trunc('year',d))-1)//7+1 AS INT) AS WeekNumber, "
    f"dayofweek(d) IN (0,6) AS IsWeekend FROM {_SPAN}",
)
add(
    "dim_06_ordered_keys",
    lambda m: ordered_keys(m.staged("Inventory"), "InventoryRecordID", "Key").select(
        "Key", "InventoryRecordID"
    ),
    "SELECT CAST(ROW_NUMBER() OVER (ORDER BY InventoryRecordID) AS INT) AS Key, InventoryRecordID "
    "FROM StgInventory",
)
add(
    "dim_06_fact_keys",
    lambda m: dense_keys(m["FactOrders"], "OrderKey").agg(
        F.min("OrderKey").alias("FirstKey"),
        F.max("OrderKey").alias("LastKey"),
        F.count_distinct("OrderKey").alias("Keys"),
    ),
    "SELECT CAST(1 AS BIGINT) AS FirstKey, COUNT(*) AS LastKey, COUNT(*) AS Keys FROM FactOrders",
)
_FIXED = "StgSuppliers WHERE QualityRating IS NOT NULL"
_ATTRIBUTES = [c for c in STAGED["Suppliers"] if c != "SupplierID"]
add(
    "dim_07_correction",
    lambda m: dim.correct_dimension(
        m["DimSupplier"],
        m.staged("Suppliers").where(F.col("QualityRating").isNotNull()),
        "SupplierID",
        "SupplierKey",
    ),
    "SELECT d.SupplierKey, d.SupplierID, "
    + _list(
        *[
            f"CASE WHEN s.SupplierID IS NULL THEN d.{c} ELSE s.{c} END AS {c}"
            for c in _ATTRIBUTES
        ]
    )
    + f" FROM DimSupplier d LEFT JOIN (SELECT * FROM {_FIXED}) s ON d.SupplierID=s.SupplierID",
)
add(
    "dim_08_lookup",
    lambda m: dim.supplier_lookup(m["DimSupplier"], "SUP000005"),
    "SELECT SupplierKey, SupplierID, SupplierName, Country, Region FROM DimSupplier "
    "WHERE SupplierID='SUP000005'",
)
add(
    "dim_09_date_rows",
    lambda m: dq.table_counts({"DimDate": dim.date_dimension(m.spark, *_order_span(m))}),
    f"SELECT 'DimDate' AS TableName, COUNT(*) AS RowCount FROM {_SPAN}",
)
add(
    "dim_09_first_days",
    lambda m: dim.first_days(dim.date_dimension(m.spark, *_order_span(m))).select(
        "DateKey", "FullDate"
    ),
    "SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS FullDate "
    f"FROM {_SPAN} ORDER BY d LIMIT 10",
)

# --- facts -------------------------------------------------------------------------------

for _i, (_n, _f) in enumerate(FACTS.items(), start=1):
    add(
        f"fct_{_i:02d}_{_f.staged.lower()}",
        lambda m, n=_n, f=_f: fct.build_fact(m.staged(f.staged), m, n),
        f"SELECT * FROM Built{_n}",
    )

# --- supplier risk -----------------------------------------------------------------------

add(
    "sr_01_shipment_metrics",
    lambda m: sr.shipment_metrics(m["FactShipments"]),
    "SELECT * FROM SrShip",
)
add(
    "sr_02_quality_metrics",
    lambda m: sr.quality_metrics(m["FactSupplierQuality"]),
    "SELECT * FROM SrQual",
)
add(
    "sr_03_purchase_metrics",
    lambda m: sr.purchase_metrics(m["FactOrders"]),
    "SELECT * FROM SrBuy",
)
add("sr_04_combined", lambda m: sr.supplier_metrics(m), "SELECT * FROM SrAll")
add(
    "sr_05_purchase_share",
    lambda m: sr.dependency(m).select("SupplierID", "PurchaseDependencyPct"),
    "SELECT SupplierID, PurchaseDependencyPct FROM SrDep",
)
_SR_PARTS = [name for name, _ in sr.SUPPLIER_WEIGHTS]
add(
    "sr_06_scores",
    lambda m: sr.risk_scores(m).select("SupplierID", *_SR_PARTS),
    f"SELECT SupplierID, {_list(*_SR_PARTS)} FROM SrScore",
)
add(
    "sr_07_composite",
    lambda m: sr.composite(m).select("SupplierID", "RiskScore"),
    "SELECT SupplierID, RiskScore FROM SrSum",
)
add("sr_08_supplier_risk", lambda m: sr.supplier_risk(m), "SELECT * FROM Sr")

# --- dependency --------------------------------------------------------------------------

add(
    "sd_01_supplier_spend",
    lambda m: sd.supplier_spend(m["FactOrders"]),
    "SELECT * FROM SdSpend",
)
add(
    "sd_02_supplier_product_spend",
    lambda m: sd.supplier_product_spend(m["FactOrders"]),
    "SELECT * FROM SdPair",
)
add("sd_03_product_spend", lambda m: sd.product_spend(m["FactOrders"]), "SELECT * FROM SdProduct")
add(
    "sd_04_product_share",
    lambda m: sd.product_dependency(m["FactOrders"]).select(
        "SupplierKey", "ProductKey", "SupplierProductDependencyPct"
    ),
    "SELECT * FROM SdShare",
)
add(
    "sd_05_exposure",
    lambda m: sd.product_exposure(m["FactOrders"]),
    "SELECT * FROM SdExposure",
)
add("sd_06_combined", lambda m: sd.supplier_exposure(m), "SELECT * FROM SdAll")
add(
    "sd_07_company_share",
    lambda m: sd.company_dependency(m).select("SupplierID", "CompanyPurchaseDependencyPct"),
    "SELECT SupplierID, CompanyPurchaseDependencyPct FROM SdDep",
)
_SD_PARTS = [name for name, _ in sd.DEPENDENCY_WEIGHTS]
add(
    "sd_08_scores",
    lambda m: sd.dependency_scores(m).select("SupplierID", *_SD_PARTS),
    f"SELECT SupplierID, {_list(*_SD_PARTS)} FROM SdScore",
)
add(
    "sd_09_business_impact",
    lambda m: sd.business_impact(m).select("SupplierID", "BusinessImpactScore"),
    "SELECT SupplierID, BusinessImpactScore FROM SdSum",
)
add("sd_10_supplier_dependency", lambda m: sd.supplier_dependency(m), "SELECT * FROM Sd")

# --- inventory ---------------------------------------------------------------------------

add(
    "ir_01_latest_snapshot",
    lambda m: ir.latest_snapshot(m[ir.SNAPSHOTS]),
    "SELECT * FROM IrLatest",
)
add("ir_02_current_inventory", lambda m: ir.current_inventory(m), "SELECT * FROM IrNow")
for _name, _column, _expr in (
    ("ir_03_stock_gap", "StockGapQty", stock.stock_gap),
    ("ir_04_suggested_reorder", "SuggestedReorderQty", stock.suggested_reorder),
    ("ir_05_stock_status", "InventoryRiskStatus", stock.stock_status),
    ("ir_06_coverage_status", "CoverageStatus", stock.coverage_status),
    ("ir_07_value_at_risk", "InventoryRiskValue", stock.value_at_risk),
):
    add(
        _name,
        lambda m, c=_column, e=_expr: ir.current_inventory(m).select(
            "InventoryRecordID", e().alias(c)
        ),
        f"SELECT InventoryRecordID, {_column} FROM IrRow",
    )
add(
    "ir_08_base_score",
    lambda m: ir.inventory_metrics(m).select("InventoryRecordID", "BaseRiskScore"),
    "SELECT InventoryRecordID, BaseRiskScore FROM IrBase",
)
add(
    "ir_09_inventory_score",
    lambda m: ir.inventory_scores(m).select("InventoryRecordID", "InventoryRiskScore"),
    "SELECT InventoryRecordID, InventoryRiskScore FROM IrScore",
)
add("ir_10_inventory_risk", lambda m: ir.inventory_risk(m), "SELECT * FROM Ir")

# --- logistics ---------------------------------------------------------------------------

add(
    "lp_01_carrier_metrics",
    lambda m: lp.carrier_metrics(m["FactShipments"]),
    "SELECT * FROM LpSum",
)
add("lp_02_carrier_details", lambda m: lp.carrier_details(m), "SELECT * FROM LpAll")
add(
    "lp_03_unit_cost",
    lambda m: lp.with_unit_cost(lp.carrier_details(m)).select("CarrierID", "ShippingCostPerUnit"),
    "SELECT CarrierID, ShippingCostPerUnit FROM LpCost",
)
_LP_PARTS = [name for name, _ in lp.CARRIER_WEIGHTS]
add(
    "lp_04_scores",
    lambda m: lp.carrier_scores(m).select("CarrierID", *_LP_PARTS),
    f"SELECT CarrierID, {_list(*_LP_PARTS)} FROM LpScore",
)
add(
    "lp_05_composite",
    lambda m: lp.carrier_composite(m).select("CarrierID", "LogisticsPerformanceScore"),
    "SELECT CarrierID, LogisticsPerformanceScore FROM LpTotal",
)
add("lp_06_logistics_performance", lambda m: lp.logistics_performance(m), "SELECT * FROM Lp")

# --- dashboards and parameterised reports ------------------------------------------------

add(
    "db_01_supplier_dashboard",
    lambda m: db.supplier_risk_dashboard(m),
    "SELECT * FROM DbSupplier",
)
add("db_02_inventory_dashboard", lambda m: db.inventory_dashboard(m), "SELECT * FROM Ir")
add("db_03_logistics_dashboard", lambda m: db.logistics_dashboard(m), "SELECT * FROM Lp")
add(
    "db_04_dependency_dashboard",
    lambda m: db.supplier_dependency_dashboard(m),
    "SELECT * FROM DbDependency",
)
add("db_05_executive_summary", lambda m: db.executive_summary(m), "SELECT * FROM DbSummary")

_RP1 = (
    "SupplierID, SupplierName, Country, Region, SupplierCategory, TotalOrders, TotalPurchaseValue, "
    "PurchaseDependencyPct, TotalShipments, LateShipments, LateShipmentPct, AvgDelayDays, "
    "OnTimeDeliveryPct, TotalInspections, AvgQualityScore, DefectRatePct, RiskScore, RiskCategory"
)
_RP2 = (
    "ProductID, ProductName, Category, WarehouseID, WarehouseName, WarehouseCountry, "
    "AvailableStock, SafetyStockLevel, ReorderLevel, StockGapQty, SuggestedReorderQty, "
    "AvgDailyDemand, StockCoverageDays, InventoryValue, InventoryRiskValue, InventoryRiskStatus, "
    "InventoryRiskScore, RiskPriority"
)
# The sample calls of both reports (rp_03) are among these.
for _level in RISK_LEVELS:
    add(
        f"rp_01_supplier_report_{_level.lower()}",
        lambda m, v=_level: db.supplier_risk_report(sr.supplier_risk(m), v),
        f"SELECT {_RP1} FROM Sr WHERE RiskCategory='{_level}'",
    )
add(
    "rp_01_supplier_report_none",
    lambda m: db.supplier_risk_report(sr.supplier_risk(m), None),
    f"SELECT {_RP1} FROM Sr WHERE FALSE",
)


def _rows_per_level(m: Mart) -> DataFrame:
    """Rows of the report for every level, and for no level."""
    view = materialize(sr.supplier_risk(m), "report")
    return dq.table_counts({level or "none": db.supplier_risk_report(view, level) for level in (*RISK_LEVELS, None)})


add(
    "rp_01_supplier_report_rows",
    _rows_per_level,
    " UNION ALL ".join(
        [f"SELECT '{v}' AS TableName, COUNT(*) AS RowCount FROM Sr WHERE RiskCategory='{v}'" for v in RISK_LEVELS]
        + ["SELECT 'none', COUNT(*) FROM Sr WHERE RiskCategory=NULL"]
    ),
)
for _status in STOCK_STATUSES:
    add(
        f"rp_02_inventory_report_{_status.lower().replace(' ', '_')}",
        lambda m, v=_status: db.inventory_risk_report(ir.inventory_risk(m), v),
        f"SELECT {_RP2} FROM Ir WHERE InventoryRiskStatus='{_status}'",
    )

# --- ad hoc reports ------------------------------------------------------------------------


def _top(columns: str, source: str, order: str, n: int) -> str:
    return f"SELECT {columns} FROM {source} ORDER BY {order} LIMIT {n}"


def _down(column: str) -> str:
    return f"{column} DESC NULLS LAST"


add(
    "ah_01_top_risk_suppliers",
    lambda m: reports.top_risk_suppliers(sr.supplier_risk(m)),
    _top("*", "Sr", f"{_down('RiskScore')}, SupplierID", 20),
)
add(
    "ah_02_risk_distribution",
    lambda m: reports.risk_distribution(sr.supplier_risk(m)),
    "SELECT RiskCategory, COUNT(*) AS SupplierCount FROM Sr GROUP BY RiskCategory",
)
add(
    "ah_03_highest_risk_brief",
    lambda m: reports.highest_risk_brief(sr.supplier_risk(m)),
    _top(
        "SupplierID, SupplierName, Country, LateShipmentPct, AvgDelayDays, AvgQualityScore, "
        "PurchaseDependencyPct, RiskScore, RiskCategory",
        "Sr",
        f"{_down('RiskScore')}, SupplierID",
        10,
    ),
)
add(
    "ah_04_top_business_impact",
    lambda m: reports.top_business_impact(sd.supplier_dependency(m)),
    _top(
        "SupplierID, SupplierName, Country, TotalPurchaseValue, CompanyPurchaseDependencyPct, "
        "ProductsSupplied, WarehousesSupported, HighlyDependentProducts, BusinessImpactScore, "
        "DependencyRiskCategory",
        "Sd",
        f"{_down('BusinessImpactScore')}, SupplierID",
        20,
    ),
)
add(
    "ah_05_dependency_distribution",
    lambda m: reports.dependency_distribution(sd.supplier_dependency(m)),
    "SELECT DependencyRiskCategory, COUNT(*) AS SupplierCount FROM Sd GROUP BY ALL",
)
add(
    "ah_06_top_products_supplied",
    lambda m: reports.top_products_supplied(sd.supplier_dependency(m)),
    _top(
        "SupplierName, Country, ProductsSupplied, WarehousesSupported, TotalPurchaseValue, "
        "BusinessImpactScore",
        "Sd",
        f"{_down('ProductsSupplied')}, SupplierID",
        10,
    ),
)
add(
    "ah_07_top_dependent_products",
    lambda m: reports.top_dependent_products(sd.supplier_dependency(m)),
    _top(
        "SupplierName, ProductsSupplied, HighlyDependentProducts, ModerateDependentProducts, "
        "MaxProductDependencyPct, BusinessImpactScore",
        "Sd",
        f"{_down('HighlyDependentProducts')}, {_down('BusinessImpactScore')}, SupplierID",
        10,
    ),
)
add(
    "ah_08_stockouts",
    lambda m: reports.stockouts(ir.inventory_metrics(m)),
    "SELECT ProductID, ProductName, WarehouseName, AvailableStock, AvgDailyDemand, "
    "StockCoverageDays, InventoryRiskValue FROM IrRow WHERE InventoryRiskStatus='Stockout'",
)
add(
    "ah_09_reorder_candidates",
    lambda m: reports.reorder_candidates(ir.inventory_risk(m)),
    _top(
        "ProductID, ProductName, WarehouseName, AvailableStock, ReorderLevel, SafetyStockLevel, "
        "StockGapQty, SuggestedReorderQty, InventoryRiskScore",
        "Ir WHERE InventoryRiskStatus IN ('Critical','Reorder Required')",
        f"{_down('InventoryRiskScore')}, InventoryRecordID",
        20,
    ),
)
add(
    "ah_10_overstock_by_value",
    lambda m: reports.overstock_by_value(ir.inventory_metrics(m)),
    _top(
        "ProductID, ProductName, WarehouseName, AvailableStock, ReorderLevel, InventoryValue, "
        "StockCoverageDays",
        "IrRow WHERE InventoryRiskStatus='Overstock'",
        f"{_down('InventoryValue')}, InventoryRecordID",
        20,
    ),
)
add(
    "ah_11_warehouse_risk",
    lambda m: reports.warehouse_risk(ir.inventory_metrics(m)),
    "SELECT WarehouseName, COUNT(*) AS InventoryItems, "
    "COUNT(*) FILTER (WHERE InventoryRiskStatus='Stockout') AS StockoutItems, "
    "COUNT(*) FILTER (WHERE InventoryRiskStatus='Critical') AS CriticalItems, "
    + cte.avg(cte.cents("WarehouseUtilizationPct"), "COUNT(WarehouseUtilizationPct)")
    + f" AS AvgUtilizationPct, CAST(SUM(InventoryValue) AS {_WIDE}) AS TotalInventoryValue "
    "FROM IrRow GROUP BY WarehouseName",
)
add(
    "ah_12_top_carriers",
    lambda m: reports.top_carriers(lp.logistics_performance(m)),
    _top(
        "CarrierName, CarrierType, ServiceLevel, TotalShipments, OnTimeDeliveryPct, DelayPct, "
        "AvgDeliveryDays, AvgDelayDays, AvgShippingCost, ShippingCostPerUnit, DamageRatePct, "
        "LogisticsPerformanceScore, CarrierPerformanceCategory",
        "Lp",
        f"{_down('LogisticsPerformanceScore')}, CarrierID",
        20,
    ),
)
add(
    "ah_13_best_carriers",
    lambda m: reports.best_carriers(lp.logistics_performance(m)),
    _top(
        "CarrierName, OnTimeDeliveryPct, AvgDelayDays, ShippingCostPerUnit, DamageRatePct, "
        "LogisticsPerformanceScore",
        "Lp",
        f"{_down('LogisticsPerformanceScore')}, CarrierID",
        10,
    ),
)
add(
    "ah_14_worst_carriers",
    lambda m: reports.worst_carriers(lp.logistics_performance(m)),
    _top(
        "CarrierName, TotalShipments, DelayPct, AvgDelayDays, AvgShippingCost, DamageRatePct, "
        "LogisticsPerformanceScore",
        "Lp",
        "LogisticsPerformanceScore NULLS FIRST, CarrierID",
        10,
    ),
)
add(
    "ah_15_carrier_distribution",
    lambda m: reports.carrier_distribution(lp.logistics_performance(m)),
    "SELECT CarrierPerformanceCategory, COUNT(*) AS CarrierCount FROM Lp GROUP BY ALL",
)
add(
    "ah_16_supplier_preview",
    lambda m: reports.supplier_dashboard_preview(db.supplier_risk_dashboard(m)),
    _top(
        "SupplierName, Country, RiskScore, RiskCategory, RiskRank, TotalPurchaseValue, "
        "PurchaseValueRank, LateShipmentPct, LateDeliveryRank",
        "DbSupplier",
        "RiskRank, SupplierID",
        20,
    ),
)
add(
    "ah_16_inventory_preview",
    lambda m: reports.inventory_dashboard_preview(db.inventory_dashboard(m)),
    _top("*", "Ir", f"{_down('InventoryRiskScore')}, InventoryRecordID", 20),
)
add(
    "ah_16_logistics_preview",
    lambda m: reports.logistics_dashboard_preview(db.logistics_dashboard(m)),
    _top("*", "Lp", f"{_down('LogisticsPerformanceScore')}, CarrierID", 20),
)
add(
    "ah_16_dependency_preview",
    lambda m: reports.dependency_dashboard_preview(db.supplier_dependency_dashboard(m)),
    _top("*", "DbDependency", f"{_down('BusinessImpactScore')}, SupplierID", 20),
)

# --- measures, cards, charts -----------------------------------------------------------------

add(
    "kpi_01_total_purchase_value",
    lambda m: kpis.total_purchase_value(m["FactOrders"]),
    f"SELECT CAST(SUM(OrderValue) AS {_WIDE}) AS TotalPurchaseValue FROM FactOrders",
)
for _slicers in ((), ("Region",), ("Region", "SupplierCategory")):
    _tail = "".join(f"_{s.lower()}" for s in _slicers)
    _cols = "".join(f", {s}" for s in _slicers)
    _part = f"PARTITION BY {_list(*_slicers)}" if _slicers else ""
    _v = "CAST(SUM(TotalPurchaseValue)*100 AS HUGEINT)"
    add(
        f"kpi_02_dependency_share{_tail}",
        lambda m, s=_slicers: kpis.dependency_share(sd.supplier_exposure(m), s),
        f"SELECT SupplierName{_cols}, CAST(SUM(TotalPurchaseValue) AS {_WIDE}) "
        f"AS TotalPurchaseValue, {cte.fraction(_v, f'SUM({_v}) OVER ({_part})')} "
        f"AS DependencyShare FROM SdAll GROUP BY SupplierName{_cols}",
    )
_RATIO = (
    "CAST(SUM(CurrentStock) AS BIGINT) AS CurrentStock, "
    "CAST(SUM(ReorderLevel) AS BIGINT) AS ReorderLevel, "
    + cte.fraction("SUM(CurrentStock)", "SUM(ReorderLevel)")
    + " AS OverstockRatio"
)
add(
    "kpi_03_overstock_ratio",
    lambda m: kpis.overstock_ratio(ir.inventory_metrics(m)),
    f"SELECT ProductID, {_RATIO} FROM IrRow GROUP BY ProductID",
)
add(
    "kpi_04_control_tower",
    lambda m: kpis.control_tower_cards(m, db.executive_summary(m)),
    "SELECT (SELECT COUNT(*) FROM DimSupplier) AS TotalSuppliers, TotalOrders, HighRiskSuppliers, "
    "OnTimeDeliveryPct, InventoryRiskItems, TotalPurchaseValue FROM DbSummary",
)


def _card(c: str) -> str:
    return cte.avg(cte.cents(c), f"COUNT({c})")


add(
    "kpi_05_supplier_cards",
    lambda m: kpis.supplier_cards(sr.supplier_risk(m)),
    "SELECT COUNT(*) AS TotalSuppliers, COUNT(*) FILTER (WHERE RiskCategory IN ('High','Critical'))"
    f" AS HighRiskSuppliers, {_card('RiskScore')} AS AvgRiskScore, {_card('AvgQualityScore')} AS "
    f"AvgQualityScore, {_card('AvgDelayDays')} AS AvgDeliveryDelay FROM Sr",
)
add(
    "kpi_06_inventory_cards",
    lambda m: kpis.inventory_cards(ir.inventory_metrics(m)),
    "SELECT CAST(SUM(CurrentStock) AS BIGINT) AS TotalInventoryUnits, "
    "COUNT(*) FILTER (WHERE InventoryRiskStatus='Critical') AS CriticalStockItems, "
    "COUNT(*) FILTER (WHERE InventoryRiskStatus='Reorder Required') AS LowStockItems, "
    "COUNT(*) FILTER (WHERE InventoryRiskStatus='Overstock') AS OverstockItems, "
    f"CAST(SUM(InventoryValue) AS {_WIDE}) AS TotalInventoryValue FROM IrRow",
)
add(
    "kpi_07_logistics_cards",
    lambda m: kpis.logistics_cards(m["FactShipments"]),
    "SELECT COUNT(*) AS TotalShipments, "
    f"{cte.pct('COUNT(*) FILTER (WHERE DelayDays<=0)', 'COUNT(*)')} AS OnTimeDeliveryPct, "
    f"{cte.avg('100*SUM(GREATEST(DelayDays,0))', 'COUNT(*)')} AS AvgDeliveryDelay, "
    f"CAST(SUM(ShippingCost) AS {_WIDE}) AS TotalShippingCost, "
    f"{cte.avg(cte.cents('ShippingCost'), 'COUNT(ShippingCost)', _CASH)} AS AvgShippingCost "
    "FROM FactShipments",
)
add(
    "kpi_08_risk_matrix",
    lambda m: kpis.supplier_risk_matrix(sr.supplier_risk(m)),
    "SELECT SupplierID, SupplierName, RiskCategory, PurchaseDependencyPct, TotalPurchaseValue, "
    "RiskScore FROM Sr",
)
add(
    "kpi_08_top_high_risk",
    lambda m: kpis.top_high_risk(sr.supplier_risk(m)),
    _top(
        "SupplierID, SupplierName, RiskScore, RiskCategory",
        "Sr WHERE RiskCategory IN ('High','Critical')",
        "RiskScore DESC, SupplierID",
        10,
    ),
)
add(
    "kpi_08_dependency_chart",
    lambda m: kpis.dependency_share(sd.supplier_dependency(m)),
    "SELECT SupplierName, CAST(SUM(TotalPurchaseValue) AS DECIMAL(28,2)) AS TotalPurchaseValue, "
    + cte.fraction(
        "CAST(SUM(TotalPurchaseValue)*100 AS HUGEINT)",
        "SUM(CAST(SUM(TotalPurchaseValue)*100 AS HUGEINT)) OVER ()",
    )
    + " AS DependencyShare FROM Sd GROUP BY SupplierName",
)
add(
    "kpi_08_distribution",
    lambda m: reports.risk_distribution(sr.supplier_risk(m)),
    "SELECT RiskCategory, COUNT(*) AS SupplierCount FROM Sr GROUP BY RiskCategory",
)
add(
    "kpi_08_top_late",
    lambda m: kpis.top_late_suppliers(sr.supplier_risk(m)),
    _top(
        "SupplierID, SupplierName, TotalShipments, LateShipments, LateShipmentPct",
        "Sr",
        "LateShipmentPct DESC, SupplierID",
        10,
    ),
)
add(
    "kpi_08_detail",
    lambda m: kpis.supplier_detail(sr.supplier_risk(m)),
    "SELECT SupplierID, SupplierName, Country, AvgDelayDays, AvgQualityScore, LateShipmentPct, "
    "PurchaseDependencyPct, TotalPurchaseValue, RiskScore, RiskCategory FROM Sr",
)
_BY_PRODUCT = (
    "SELECT ProductID, ProductName, CAST(SUM(CurrentStock) AS BIGINT) AS CurrentStock, "
    "CAST(SUM(ReorderLevel) AS BIGINT) AS ReorderLevel FROM IrNow GROUP BY ProductID, ProductName"
)
add(
    "kpi_09_stock_vs_reorder",
    lambda m: kpis.stock_by_product(ir.current_inventory(m)),
    _BY_PRODUCT,
)
add(
    "kpi_09_lowest_stock",
    lambda m: kpis.lowest_stock_products(ir.current_inventory(m)),
    f"{_BY_PRODUCT} ORDER BY CurrentStock, ProductID LIMIT 10",
)
add(
    "kpi_09_highest_overstock",
    lambda m: kpis.highest_overstock_products(ir.current_inventory(m)),
    f"SELECT ProductID, ProductName, {_RATIO} FROM IrNow GROUP BY ProductID, ProductName "
    "ORDER BY OverstockRatio DESC, ProductID LIMIT 10",
)
add(
    "kpi_09_stock_by_warehouse",
    lambda m: kpis.stock_by_warehouse(ir.current_inventory(m)),
    "SELECT WarehouseName, CAST(SUM(CurrentStock) AS BIGINT) AS CurrentStock, "
    f"CAST(SUM(InventoryValue) AS {_WIDE}) AS InventoryValue FROM IrNow GROUP BY WarehouseName",
)
add(
    "kpi_09_products_by_warehouse",
    lambda m: kpis.products_by_warehouse(ir.current_inventory(m)),
    "SELECT WarehouseName, COUNT(DISTINCT ProductKey) AS Products FROM IrNow GROUP BY ALL",
)
add(
    "kpi_10_on_time",
    lambda m: kpis.carrier_on_time(lp.logistics_performance(m)),
    "SELECT CarrierID, CarrierName, OnTimeDeliveryPct FROM Lp",
)
add(
    "kpi_10_top_delayed",
    lambda m: kpis.top_delayed_carriers(lp.logistics_performance(m)),
    _top("CarrierID, CarrierName, AvgDelayDays", "Lp", f"{_down('AvgDelayDays')}, CarrierID", 10),
)
add(
    "kpi_10_cost",
    lambda m: kpis.carrier_cost(lp.logistics_performance(m)),
    "SELECT CarrierID, CarrierName, TotalShippingCost, AvgShippingCost FROM Lp",
)
add(
    "kpi_10_cost_vs_delay",
    lambda m: kpis.carrier_cost_vs_delay(lp.logistics_performance(m)),
    "SELECT CarrierID, CarrierName, AvgShippingCost, AvgDelayDays, TotalShipments FROM Lp",
)
add(
    "kpi_10_volume",
    lambda m: kpis.carrier_volume(lp.logistics_performance(m)),
    "SELECT CarrierID, CarrierName, TotalShipments FROM Lp",
)
add(
    "kpi_10_detail",
    lambda m: kpis.carrier_detail(lp.logistics_performance(m)),
    "SELECT CarrierID, CarrierName, CarrierType, ServiceLevel, TotalShipments, OnTimeDeliveryPct, "
    "AvgDelayDays, AvgShippingCost, TotalShippingCost, LogisticsPerformanceScore, "
    "CarrierPerformanceCategory FROM Lp",
)
add(
    "kpi_11_supplier_means",
    lambda m: kpis.supplier_means(m["FactShipments"]),
    f"SELECT SupplierKey, {cte.avg('100*SUM(DelayDays)', 'COUNT(DelayDays)')} AS AvgDelay, "
    f"{cte.avg(cte.cents('QualityScore'), 'COUNT(QualityScore)')} AS Quality "
    "FROM FactShipments GROUP BY SupplierKey",
)

# --- transforms --------------------------------------------------------------------------------

add(
    "tr_01_risk_tier",
    lambda m: tr.with_risk_tier(m.staged("Suppliers")).select("SupplierID", "RiskTier"),
    "SELECT SupplierID, CASE WHEN QualityRating>=94 THEN 'Low' WHEN QualityRating>=86 THEN 'Medium'"
    " WHEN QualityRating>=75 THEN 'High' ELSE 'Critical' END AS RiskTier FROM StgSuppliers",
)
add(
    "tr_02_suppliers_per_category",
    lambda m: tr.suppliers_per_category(m["DimSupplier"]),
    "SELECT SupplierCategory, SupplierID FROM DimSupplier",
)
# Product types of the test data mapped to supplier categories; the last names none that exists.
_TEST_MAP = {
    "ECONOMY": ["Category 1", "Category 2"],
    "SMALL": ["Category 2", "Category 3"],
    "LARGE": ["Category 4"],
    "STANDARD": ["Category 99"],
}
_MAP_ROWS = " UNION ALL ".join(
    f"SELECT '{p}' AS Category, '{s}' AS SupplierCategory"
    for p, names in _TEST_MAP.items()
    for s in names
)
for _category in ("ECONOMY", "STANDARD", "UNMAPPED"):
    add(
        f"tr_03_eligible_{_category.lower()}",
        lambda m, c=_category: tr.eligible_suppliers(
            m["DimSupplier"], tr.category_map(m.spark, _TEST_MAP), c
        ),
        f"SELECT SupplierID, SupplierCategory FROM DimSupplier s WHERE SupplierCategory IN "
        f"(SELECT SupplierCategory FROM ({_MAP_ROWS}) WHERE Category='{_category}') OR NOT EXISTS "
        f"(SELECT 1 FROM DimSupplier JOIN ({_MAP_ROWS}) USING (SupplierCategory) "
        f"WHERE Category='{_category}')",
    )
add(
    "tr_03_eligible_counts",
    lambda m: tr.eligible_counts(
        m["DimProduct"], m["DimSupplier"], tr.category_map(m.spark, _TEST_MAP)
    ),
    f"SELECT Category, CAST(COALESCE(n, (SELECT COUNT(*) FROM DimSupplier)) AS BIGINT) "
    "AS EligibleSuppliers, n IS NULL AS FellBack FROM (SELECT DISTINCT Category FROM DimProduct) "
    f"LEFT JOIN (SELECT Category, COUNT(*) AS n FROM ({_MAP_ROWS}) JOIN DimSupplier "
    "USING (SupplierCategory) GROUP BY Category) USING (Category)",
)
add(
    "tr_04_order_value",
    lambda m: tr.with_order_value(m.staged("Orders")).select("OrderID", "OrderValue"),
    "SELECT OrderID, CAST(OrderQuantity*UnitCost AS DECIMAL(18,2)) AS OrderValue FROM StgOrders",
)
add(
    "tr_05_expected_delivery",
    lambda m: tr.with_expected_delivery(
        m.staged("Orders").drop("ExpectedDeliveryDate"),
        m.staged("Products"),
        F.col("OrderQuantity") % 6,
    ).select("OrderID", "ProductID", "ExpectedDeliveryDate"),
    "SELECT OrderID, ProductID, OrderDate+LeadTimeDays+OrderQuantity%6 AS ExpectedDeliveryDate "
    "FROM StgOrders JOIN StgProducts USING (ProductID)",
)
add(
    "tr_06_order_age",
    lambda m: tr.with_order_age(m.staged("Orders"), "2001-08-31").select(
        "OrderID", "OrderDate", "DaysFromEnd", "IsRecent"
    ),
    "SELECT OrderID, OrderDate, CAST(DATE '2001-08-31'-OrderDate AS INT) AS DaysFromEnd, "
    "COALESCE(DATE '2001-08-31'-OrderDate<=60, FALSE) AS IsRecent FROM StgOrders",
)


def _sorted_positions(m: Mart) -> DataFrame:
    """Each row's predecessor in a written, sorted table is not larger: no row is misplaced."""
    from pyspark.sql import Window

    columns = ["SnapshotDate", "WarehouseID", "ProductID"]
    path = work_path(m.spark, "sorted")
    files.write_table(tr.sort_on_write(m.staged("Inventory"), columns), path)
    rows = m.spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("File"),
        F.col("_metadata.row_index").alias("Row"),
        F.struct(*columns).alias("Place"),
    )
    before = F.lag("Place").over(Window.partitionBy("File").orderBy("Row"))
    inside = rows.select((before > F.col("Place")).alias("Down")).agg(
        F.count(F.lit(1)).alias("RowCount"),
        F.count_if(F.col("Down")).alias("OutOfOrder"),
    )
    # One row a file: files by name must not overlap either.
    ends = rows.groupBy("File").agg(F.min("Place").alias("First"), F.max("Place").alias("Last"))
    earlier = F.lag("Last").over(Window.orderBy("File"))
    between = ends.select((earlier > F.col("First")).alias("Down")).agg(F.count_if(F.col("Down")).alias("n"))
    return inside.withColumn("OutOfOrder", F.col("OutOfOrder") + between.scalar())


add(
    "tr_07_sorted_inventory",
    _sorted_positions,
    "SELECT COUNT(*) AS RowCount, CAST(0 AS BIGINT) AS OutOfOrder FROM StgInventory",
)
add(
    "tr_08_completed_orders",
    lambda m: tr.completed_orders(m.staged("Orders")),
    f"SELECT {_list(*STAGED['Orders'])} FROM StgOrders WHERE OrderStatus='Completed'",
)
add(
    "tr_09_delivery",
    lambda m: tr.with_delivery(m.staged("Shipments")).select(
        "ShipmentID", "ShipDate", "DeliveryDate", "DeliveryDays"
    ),
    "SELECT ShipmentID, ShipDate, d AS DeliveryDate, CAST(d-ShipDate AS INT) AS DeliveryDays FROM "
    "(SELECT *, CASE WHEN PromisedDate+DelayDays<ShipDate THEN ShipDate "
    "ELSE PromisedDate+DelayDays END AS d FROM StgShipments)",
)
add(
    "tr_10_shipment_status",
    lambda m: tr.with_shipment_status(m.staged("Shipments")).select(
        "ShipmentID", "DelayDays", "ShipmentStatus"
    ),
    "SELECT ShipmentID, DelayDays, CASE WHEN DelayDays<=0 THEN 'On Time' WHEN DelayDays<=3 THEN "
    "'Minor Delay' WHEN DelayDays<=7 THEN 'Moderate Delay' ELSE 'Severe Delay' END "
    "AS ShipmentStatus FROM StgShipments",
)
_DEMAND = (
    "(SELECT ProductID, COALESCE(q, (SELECT SUM(OrderQuantity) FROM StgOrders)) AS dq, "
    "days*CASE WHEN q IS NULL THEN (SELECT COUNT(*) FROM StgProducts) ELSE 1 END AS dd FROM "
    "StgProducts LEFT JOIN (SELECT ProductID, SUM(OrderQuantity) AS q FROM StgOrders GROUP BY "
    "ProductID) USING (ProductID), (SELECT GREATEST(MAX(OrderDate)-MIN(OrderDate),1) AS days "
    "FROM StgOrders))"
)
add(
    "tr_11_daily_demand",
    lambda m: tr.daily_demand(m.staged("Orders"), m.staged("Products")),
    "SELECT ProductID, CAST(dq AS BIGINT) AS DemandQuantity, CAST(dd AS BIGINT) AS DemandDays, "
    f"{cte.avg('100*dq', 'dd', _CASH)} AS AvgDailyDemand FROM {_DEMAND}",
)
add(
    "tr_12_month_ends",
    lambda m: tr.month_ends(m.spark, *_order_span(m)),
    f"SELECT DISTINCT last_day(d) AS SnapshotDate FROM {_SPAN} WHERE last_day(d)<="
    "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)",
)


def _positions(df: DataFrame, column: str) -> DataFrame:
    numbered = ordered_keys(df.select(column), column, "Position")
    return numbered.withColumn("Position", F.col("Position").cast("bigint") - 1)


def _grid_axes(m: Mart) -> tuple[DataFrame, DataFrame, DataFrame]:
    days = m["FactInventory"].select("SnapshotDate").distinct()
    return (
        _positions(m["DimProduct"], "ProductID"),
        _positions(m["DimWarehouse"], "WarehouseID"),
        _positions(days, "SnapshotDate"),
    )


_GRID = (
    "SELECT ((ds*(SELECT COUNT(*) FROM DimProduct))+ps)*(SELECT COUNT(*) FROM DimWarehouse)+ws "
    "AS Cell, ProductID, WarehouseID, SnapshotDate FROM "
    "(SELECT ProductID, ROW_NUMBER() OVER (ORDER BY ProductID)-1 AS ps FROM DimProduct), "
    "(SELECT WarehouseID, ROW_NUMBER() OVER (ORDER BY WarehouseID)-1 AS ws FROM DimWarehouse), "
    "(SELECT SnapshotDate, ROW_NUMBER() OVER (ORDER BY SnapshotDate)-1 AS ds FROM "
    "(SELECT DISTINCT SnapshotDate FROM FactInventory))"
)


def _drawn_cells(m: Mart) -> DataFrame:
    """Each order of the given table asks for one cell."""
    axes = _grid_axes(m)
    size = axes[0].count() * axes[1].count() * axes[2].count()
    orders = m.sources.table("orders")
    cells = orders.select(((F.col("o_orderkey") * 999_983 + 42) % size).alias("Cell")).distinct()
    return tr.stock_cells(cells, *axes)


add(
    "tr_13_stock_grid",
    _drawn_cells,
    f"SELECT * FROM ({_GRID}) WHERE Cell IN (SELECT (o_orderkey*999983+42)%((SELECT COUNT(*) FROM "
    "DimProduct)*(SELECT COUNT(*) FROM DimWarehouse)*(SELECT COUNT(DISTINCT SnapshotDate) FROM "
    "FactInventory)) FROM orders)",
)


def _drawn(m: Mart) -> DataFrame:
    """What any draw must satisfy, whichever rows it picks."""
    source = m["FactInventory"].select("InventoryRecordID")
    drawn = tr.draw(source, ["InventoryRecordID"], 500)
    again = tr.draw(source.repartition(3, "InventoryRecordID"), ["InventoryRecordID"], 500)
    both = drawn.withColumn("Again", F.lit(0)).unionByName(again.withColumn("Again", F.lit(1)))
    per_key = both.groupBy("InventoryRecordID").agg(
        F.count_if(F.col("Again") == 0).alias("_one"), F.count_if(F.col("Again") == 1).alias("_two")
    )
    return per_key.agg(
        F.sum("_one").alias("Drawn"),
        F.count_if(F.col("_one") > 0).alias("DistinctKeys"),
        F.count_if(F.col("_one") != F.col("_two")).alias("Differences"),
    )


add(
    "tr_14_draw",
    _drawn,
    "SELECT LEAST(500, COUNT(*)) AS Drawn, LEAST(500, COUNT(*)) AS DistinctKeys, "
    "CAST(0 AS BIGINT) AS Differences FROM FactInventory",
)
add(
    "tr_15_available_stock",
    lambda m: tr.with_available_stock(m.staged("Inventory")).select(
        "InventoryRecordID", "AvailableStock"
    ),
    "SELECT InventoryRecordID, CASE WHEN CurrentStock<ReservedStock THEN 0 ELSE "
    "CurrentStock-ReservedStock END AS AvailableStock FROM StgInventory",
)
add(
    "tr_16_inventory_value",
    lambda m: tr.with_inventory_value(m.staged("Inventory"), m.staged("Products")).select(
        "InventoryRecordID", "InventoryValue"
    ),
    "SELECT InventoryRecordID, CAST(CurrentStock*UnitCost AS DECIMAL(18,2)) AS InventoryValue "
    "FROM StgInventory JOIN StgProducts USING (ProductID)",
)
add(
    "tr_17_coverage",
    lambda m: tr.with_coverage(
        m.staged("Inventory"), tr.daily_demand(m.staged("Orders"), m.staged("Products"))
    ).select("InventoryRecordID", "StockCoverageDays"),
    "SELECT InventoryRecordID, CASE WHEN dq>0 THEN CAST(CAST("
    + cte.half_up("10*CAST(AvailableStock AS HUGEINT)*dd", "dq")
    + " AS DECIMAL(28,2))*0.1 AS DECIMAL(18,2)) ELSE 999 END AS StockCoverageDays "
    f"FROM StgInventory JOIN {_DEMAND} USING (ProductID)",
)
add(
    "tr_18_source_status",
    lambda m: tr.with_source_status(m.staged("Inventory")).select(
        "InventoryRecordID", "RiskStatus"
    ),
    f"SELECT InventoryRecordID, {cte.stock_label('AvailableStock=0')} AS RiskStatus "
    "FROM StgInventory",
)
add(
    "tr_19_utilization",
    lambda m: tr.with_utilization(
        m.staged("Inventory").drop("WarehouseUtilizationPct"), m.staged("Warehouses")
    ).select("InventoryRecordID", "WarehouseUtilizationPct"),
    "SELECT InventoryRecordID, CASE WHEN SnapshotDate IS NOT NULL AND Capacity IS NOT NULL THEN "
    "CAST(LEAST(100, "
    + cte.pct(
        "COALESCE(SUM(CurrentStock) OVER (PARTITION BY WarehouseID, SnapshotDate),0)",
        "Capacity",
        _WIDE,
    )
    + ") AS DECIMAL(6,2)) END AS WarehouseUtilizationPct "
    "FROM StgInventory LEFT JOIN StgWarehouses USING (WarehouseID)",
)
_OUTCOME = cte.pct(
    "(InspectedQuantity-DefectQuantity)", "InspectedQuantity", "DECIMAL(5,2)"
)
add(
    "tr_20_inspection_outcome",
    lambda m: tr.with_inspection_outcome(m.staged("SupplierQuality")).select(
        "InspectionID", "AcceptedQuantity", "RejectedQuantity", "QualityScore"
    ),
    "SELECT InspectionID, InspectedQuantity-DefectQuantity AS AcceptedQuantity, "
    "DefectQuantity AS RejectedQuantity, CASE WHEN InspectedQuantity>0 THEN "
    f"{_OUTCOME} ELSE 0 END AS QualityScore FROM StgSupplierQuality",
)
add(
    "tr_21_inspection_result",
    lambda m: tr.with_inspection_result(m.staged("SupplierQuality")).select(
        "InspectionID", "InspectionResult"
    ),
    "SELECT InspectionID, CASE WHEN QualityScore>=95 THEN 'Passed' WHEN QualityScore>=85 THEN "
    "'Conditional' ELSE 'Failed' END AS InspectionResult FROM StgSupplierQuality",
)
add(
    "tr_22_capped_damage",
    lambda m: m.staged("Shipments").select(
        "ShipmentID",
        tr.capped(F.col("DamagedQuantity") * 30, F.col("QuantityShipped")).alias("Damaged"),
    ),
    "SELECT ShipmentID, LEAST(DamagedQuantity*30, QuantityShipped) AS Damaged FROM StgShipments",
)

# --- distributed ranks -------------------------------------------------------------------------

add(
    "rnk_01_rank",
    lambda m: with_global_rank(
        m["FactOrders"].select("OrderID", "OrderValue"),
        Ranking("OrderValue", "ValueRank", False),
    ),
    "SELECT OrderID, OrderValue, RANK() OVER (ORDER BY OrderValue DESC NULLS LAST) AS ValueRank "
    "FROM FactOrders",
)
add(
    "rnk_01_percent_rank",
    lambda m: with_global_rank(
        m.staged("Shipments").select("ShipmentID", "DelayDays"),
        Ranking("DelayDays", "DelayScore", True, "percent_rank"),
    ),
    f"SELECT ShipmentID, DelayDays, {cte.score('DelayDays NULLS FIRST')} AS DelayScore "
    "FROM StgShipments",
)
