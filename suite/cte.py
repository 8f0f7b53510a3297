"""Checking SQL for DuckDB: named parts, put together by the names a query uses."""

from __future__ import annotations

import re

from riskmart.sources.schemas import DIMENSIONS, FACTS, STAGED, record_ids
from suite import mapping


def half_up(num: str, den: str) -> str:
    """Whole quotient rounded half away from zero; NULL for a zero divisor."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT),0)"
    return f"CASE WHEN {n}>=0 THEN (2*{n}+{d})//(2*{d}) ELSE -((-2*{n}+{d})//(2*{d})) END"


def hundredths(units: str, kind: str = "DECIMAL(10,2)") -> str:
    return f"CAST(CAST({units} AS DECIMAL(28,2))*0.01 AS {kind})"


def pct(num: str, den: str, kind: str = "DECIMAL(10,2)") -> str:
    return hundredths(half_up(f"10000*CAST({num} AS HUGEINT)", den), kind)


def avg(cents: str, n: str, kind: str = "DECIMAL(10,2)") -> str:
    """Mean of values given as a sum of hundredths."""
    return hundredths(half_up(cents, n), kind)


def cents(column: str) -> str:
    return f"SUM(CAST(ROUND({column}*100) AS BIGINT))"


def fraction(num: str, den: str) -> str:
    q = half_up(f"1000000*CAST({num} AS HUGEINT)", den)
    return (
        f"COALESCE(CAST(CAST({q} AS DECIMAL(24,6))*0.000001 AS DECIMAL(18,6)),"
        "CAST(0 AS DECIMAL(18,6)))"
    )


def score(order: str, rows: str = "COUNT(*) OVER ()") -> str:
    """Percent rank from whole numbers; 0 when there is one row."""
    place = f"(RANK() OVER (ORDER BY {order})-1)"
    return f"COALESCE({pct(place, f'(({rows})-1)')},CAST(0 AS DECIMAL(10,2)))"


def weigh(*parts: tuple[str, int]) -> str:
    """Hundredths of a weighted sum, weights in percent, rounded half up."""
    total = "+".join(f"CAST({c}*100 AS BIGINT)*{w}" for c, w in parts)
    return hundredths(f"({total}+50)//100")


def grade(column: str, *floors: tuple[int, str], other: str) -> str:
    arms = " ".join(f"WHEN {column}>={v} THEN '{label}'" for v, label in floors)
    return f"CASE {arms} ELSE '{other}' END"


def parse(column: str, kind: str) -> str:
    if kind == "string":
        return column
    if kind == "date":
        iso = r"\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*"
        return f"CASE WHEN regexp_full_match({column},'{iso}') THEN TRY_CAST({column} AS DATE) END"
    if kind == "int":
        whole = r"\s*[+-]?[0-9]+\s*"
        return (
            f"CASE WHEN regexp_full_match({column},'{whole}') "
            f"THEN TRY_CAST(TRIM({column}) AS INT) END"
        )
    return f"TRY_CAST({column} AS {kind})"


def _select(source: tuple[str, str | None], columns: dict[str, str]) -> str:
    rows, kept = source
    exprs = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT {exprs} FROM {rows}" + (f" WHERE {kept}" if kept else "")


def _steps(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


PARTS: dict[str, str] = {
    "SUPPLIER_PLACE": "SELECT * FROM supplier JOIN nation ON s_nationkey=n_nationkey "
    "JOIN region ON n_regionkey=r_regionkey",
    "LINE": f"SELECT *, {_steps(mapping.LINE_STEPS)} FROM (SELECT l.*, o_orderstatus, o_orderdate, "
    "c_nationkey, (SELECT COUNT(*) FROM supplier) AS n FROM lineitem l JOIN orders ON "
    "l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey)",
    "INV": f"SELECT *, {mapping.INV_STOCK} AS av FROM (SELECT *, {_steps(mapping.INV_STEPS)} FROM "
    "(SELECT *, (5-(p_partkey+sn)%5)%5 AS rest FROM part CROSS JOIN ("
    + " UNION ALL ".join(
        f"SELECT {i} AS sn, DATE '{d}' AS sd" for i, d in enumerate(mapping.SNAPSHOTS)
    )
    + ")) JOIN (SELECT n_nationkey, n_nationkey%5 AS rest FROM nation) USING (rest))",
    "DimDate": "SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS FullDate, "
    f"year(d) AS YearNumber FROM generate_series(TIMESTAMP '{mapping.CALENDAR[0]}', "
    f"TIMESTAMP '{mapping.CALENDAR[1]}', INTERVAL 1 DAY) t(d)",
}
for _name, _columns in mapping.COLUMNS.items():
    _body = _select(mapping.SOURCE[_name], _columns)
    if _name == "FactInventory":
        _body = (
            "SELECT s.*, CAST(LEAST(100, "
            + pct("SUM(s.CurrentStock) OVER (PARTITION BY s.WarehouseKey, s.DateKey)",
                  "w.Capacity", "DECIMAL(28,2)")
            + f") AS DECIMAL(6,2)) AS WarehouseUtilizationPct FROM ({_body}) s "
            "JOIN DimWarehouse w ON s.WarehouseKey=w.WarehouseKey"
        )
    PARTS[_name] = _body
for _name, _columns in mapping.RAW_COLUMNS.items():
    PARTS[f"Raw{_name}"] = _select(mapping.RAW_SOURCE[_name], _columns)
    PARTS[f"Stg{_name}"] = (
        "SELECT "
        + ", ".join(f"{parse(c, k)} AS {c}" for c, k in STAGED[_name].items())
        + f" FROM Raw{_name}"
    )

# --- supplier risk -------------------------------------------------------------

PARTS["SrShip"] = f"""
SELECT SupplierKey, COUNT(*) AS TotalShipments,
  COUNT(*) FILTER (WHERE DelayDays>0) AS LateShipments,
  {pct("COUNT(*) FILTER (WHERE DelayDays>0)", "COUNT(*)")} AS LateShipmentPct,
  {avg("100*COALESCE(SUM(DelayDays) FILTER (WHERE DelayDays>0),0)", "COUNT(*)")} AS AvgDelayDays,
  {avg("100*SUM(DelayDays) FILTER (WHERE DelayDays>0)",
       "COUNT(*) FILTER (WHERE DelayDays>0)")} AS AvgLateDelayDays,
  {pct("COUNT(*) FILTER (WHERE DelayDays<=0)", "COUNT(*)")} AS OnTimeDeliveryPct
FROM FactShipments GROUP BY ALL"""
PARTS["SrQual"] = f"""
SELECT SupplierKey, COUNT(*) AS TotalInspections,
  {avg(cents("QualityScore"), "COUNT(QualityScore)")} AS AvgQualityScore,
  {pct("SUM(DefectQuantity)", "SUM(InspectedQuantity)")} AS DefectRatePct
FROM FactSupplierQuality GROUP BY ALL"""
PARTS["SrBuy"] = """
SELECT SupplierKey, COUNT(*) AS TotalOrders,
  CAST(SUM(OrderQuantity) AS BIGINT) AS TotalOrderQuantity,
  CAST(SUM(OrderValue) AS DECIMAL(28,2)) AS TotalPurchaseValue
FROM FactOrders WHERE OrderStatus<>'Cancelled' GROUP BY ALL"""
_PROFILE = (
    "d.SupplierKey, d.SupplierID, d.SupplierName, d.Country, d.Region, d.SupplierCategory, "
    "d.ActiveStatus"
)


def _or_zero(*columns: str) -> str:
    return ", ".join(f"COALESCE({c},0) AS {c}" for c in columns)


PARTS["SrAll"] = f"""
SELECT {_PROFILE}, {_or_zero("TotalShipments", "LateShipments", "LateShipmentPct", "AvgDelayDays",
  "AvgLateDelayDays", "OnTimeDeliveryPct", "TotalInspections", "DefectRatePct", "TotalOrders",
  "TotalOrderQuantity", "TotalPurchaseValue")},
  COALESCE(AvgQualityScore, CAST(QualityRating AS DECIMAL(10,2))) AS AvgQualityScore
FROM DimSupplier d LEFT JOIN SrShip s ON d.SupplierKey=s.SupplierKey
LEFT JOIN SrQual q ON d.SupplierKey=q.SupplierKey LEFT JOIN SrBuy b ON d.SupplierKey=b.SupplierKey"""
_SHARE = pct(
    "CAST(TotalPurchaseValue*100 AS BIGINT)",
    "(SUM(CAST(TotalPurchaseValue*100 AS BIGINT)) OVER ())",
)
PARTS["SrDep"] = f"SELECT *, {_SHARE} AS PurchaseDependencyPct FROM SrAll"
PARTS["SrScore"] = f"""
SELECT *, {score("LateShipmentPct NULLS FIRST")} AS LateDeliveryRiskScore,
  {score("AvgDelayDays NULLS FIRST")} AS DelaySeverityRiskScore,
  {score("AvgQualityScore DESC NULLS LAST")} AS QualityRiskScore,
  {score("PurchaseDependencyPct NULLS FIRST")} AS DependencyRiskScore FROM SrDep"""
PARTS["SrSum"] = (
    "SELECT *, "
    + weigh(
        ("LateDeliveryRiskScore", 40),
        ("DelaySeverityRiskScore", 20),
        ("QualityRiskScore", 25),
        ("DependencyRiskScore", 15),
    )
    + " AS RiskScore FROM SrScore"
)
_LEVELS = ((75, "Critical"), (50, "High"), (25, "Medium"))
SR_COLUMNS = (
    "SupplierKey, SupplierID, SupplierName, Country, Region, SupplierCategory, ActiveStatus, "
    "TotalOrders, TotalPurchaseValue, PurchaseDependencyPct, TotalShipments, LateShipments, "
    "LateShipmentPct, AvgDelayDays, AvgLateDelayDays, OnTimeDeliveryPct, TotalInspections, "
    "AvgQualityScore, DefectRatePct, LateDeliveryRiskScore, DelaySeverityRiskScore, "
    "QualityRiskScore, DependencyRiskScore, RiskScore"
)
PARTS["Sr"] = (
    f"SELECT {SR_COLUMNS}, {grade('RiskScore', *_LEVELS, other='Low')} AS RiskCategory FROM SrSum"
)

# --- dependency ------------------------------------------------------------------

_VALUE = "CAST(OrderValue*100 AS BIGINT)"
PARTS["Bought"] = "SELECT * FROM FactOrders WHERE OrderStatus<>'Cancelled'"
PARTS["SdSpend"] = f"""
SELECT SupplierKey, COUNT(*) AS TotalOrders,
  CAST(SUM(OrderQuantity) AS BIGINT) AS TotalOrderQuantity,
  CAST(SUM(OrderValue) AS DECIMAL(28,2)) AS TotalPurchaseValue,
  {avg(cents("OrderValue"), "COUNT(OrderValue)", "DECIMAL(18,2)")} AS AvgOrderValue,
  COUNT(DISTINCT ProductKey) AS ProductsSupplied,
  COUNT(DISTINCT WarehouseKey) AS WarehousesSupported
FROM Bought GROUP BY ALL"""
PARTS["SdPair"] = """
SELECT SupplierKey, ProductKey, CAST(SUM(OrderValue) AS DECIMAL(28,2)) AS SupplierProductValue
FROM Bought GROUP BY ALL"""
PARTS["SdProduct"] = """
SELECT ProductKey, CAST(SUM(OrderValue) AS DECIMAL(28,2)) AS TotalProductSpend
FROM Bought GROUP BY ALL"""
_PART_OF = pct("CAST(SupplierProductValue*100 AS BIGINT)", "CAST(TotalProductSpend*100 AS BIGINT)")
PARTS["SdShare"] = f"""
SELECT SupplierKey, ProductKey, {_PART_OF} AS SupplierProductDependencyPct
FROM SdPair JOIN SdProduct USING (ProductKey)"""
_PART = "SupplierProductDependencyPct"
PARTS["SdExposure"] = f"""
SELECT SupplierKey, COUNT(*) FILTER (WHERE {_PART}>=50) AS HighlyDependentProducts,
  COUNT(*) FILTER (WHERE {_PART}>=30) AS ModerateDependentProducts,
  {avg(cents(_PART), f"COUNT({_PART})")} AS AvgProductDependencyPct,
  MAX({_PART}) AS MaxProductDependencyPct
FROM SdShare GROUP BY ALL"""
PARTS["SdAll"] = f"""
SELECT {_PROFILE}, {_or_zero("TotalOrders", "TotalOrderQuantity", "TotalPurchaseValue",
  "AvgOrderValue", "ProductsSupplied", "WarehousesSupported", "HighlyDependentProducts",
  "ModerateDependentProducts", "AvgProductDependencyPct", "MaxProductDependencyPct")}
FROM DimSupplier d LEFT JOIN SdSpend s ON d.SupplierKey=s.SupplierKey
LEFT JOIN SdExposure e ON d.SupplierKey=e.SupplierKey"""
PARTS["SdDep"] = f"SELECT *, {_SHARE} AS CompanyPurchaseDependencyPct FROM SdAll"
PARTS["SdScore"] = f"""
SELECT *, {score("TotalPurchaseValue NULLS FIRST")} AS PurchaseExposureScore,
  {score("ProductsSupplied NULLS FIRST")} AS ProductExposureScore,
  {score("WarehousesSupported NULLS FIRST")} AS WarehouseExposureScore,
  {score("HighlyDependentProducts NULLS FIRST")} AS ProductConcentrationScore FROM SdDep"""
PARTS["SdSum"] = (
    "SELECT *, "
    + weigh(
        ("PurchaseExposureScore", 40),
        ("ProductExposureScore", 25),
        ("WarehouseExposureScore", 20),
        ("ProductConcentrationScore", 15),
    )
    + " AS BusinessImpactScore FROM SdScore"
)
PARTS["Sd"] = (
    f"SELECT *, {grade('BusinessImpactScore', *_LEVELS, other='Low')} AS DependencyRiskCategory "
    "FROM SdSum"
)

# --- inventory -------------------------------------------------------------------

PARTS["IrLatest"] = """
SELECT MAX(FullDate) AS LatestInventoryDate, MAX(DateKey) AS LatestDateKey
FROM FactInventory JOIN DimDate USING (DateKey)"""
PARTS["IrNow"] = """
SELECT i.InventoryKey, i.InventoryRecordID, p.ProductKey, p.ProductID, p.ProductName, p.Category,
  p.SubCategory, p.UnitCost, w.WarehouseKey, w.WarehouseID, w.WarehouseName,
  w.Country AS WarehouseCountry, w.City AS WarehouseCity, d.FullDate AS SnapshotDate,
  i.CurrentStock, i.ReservedStock, i.AvailableStock, i.ReorderLevel, i.SafetyStockLevel,
  i.AvgDailyDemand, i.StockCoverageDays, i.InventoryValue, i.WarehouseUtilizationPct
FROM FactInventory i JOIN DimProduct p ON i.ProductKey=p.ProductKey
JOIN DimWarehouse w ON i.WarehouseKey=w.WarehouseKey JOIN DimDate d ON i.DateKey=d.DateKey
WHERE d.FullDate=(SELECT LatestInventoryDate FROM IrLatest)"""
_GAP = "CASE WHEN AvailableStock<ReorderLevel THEN ReorderLevel-AvailableStock ELSE 0 END"


def stock_label(empty: str = "AvailableStock<=0") -> str:
    return (
        f"CASE WHEN {empty} THEN 'Stockout' WHEN AvailableStock<SafetyStockLevel THEN 'Critical' "
        "WHEN AvailableStock<ReorderLevel THEN 'Reorder Required' "
        "WHEN AvailableStock>3*ReorderLevel THEN 'Overstock' ELSE 'Safe' END"
    )


PARTS["IrRow"] = f"""
SELECT *, {_GAP} AS StockGapQty,
  CASE WHEN AvailableStock<ReorderLevel THEN ReorderLevel+SafetyStockLevel-AvailableStock ELSE 0 END
    AS SuggestedReorderQty,
  {stock_label()} AS InventoryRiskStatus,
  CASE WHEN StockCoverageDays<=0 THEN 'Stockout' WHEN StockCoverageDays<7 THEN 'Critical'
    WHEN StockCoverageDays<15 THEN 'Low Coverage' WHEN StockCoverageDays>90 THEN 'Excess Coverage'
    ELSE 'Healthy' END AS CoverageStatus,
  CAST(CASE WHEN AvailableStock<ReorderLevel THEN (ReorderLevel-AvailableStock)*UnitCost ELSE 0 END
    AS DECIMAL(18,2)) AS InventoryRiskValue FROM IrNow"""
PARTS["IrBase"] = """
SELECT *, CAST(CASE InventoryRiskStatus WHEN 'Stockout' THEN 100 WHEN 'Critical' THEN 85
  WHEN 'Reorder Required' THEN 65 WHEN 'Overstock' THEN 45 ELSE 10 END AS DECIMAL(10,2))
  AS BaseRiskScore FROM IrRow"""
_RANKED = half_up(
    "3000*(RANK() OVER (ORDER BY InventoryRiskValue NULLS FIRST)-1)", "(COUNT(*) OVER ())-1"
)
PARTS["IrScore"] = (
    "SELECT *, "
    + hundredths(f"CAST(BaseRiskScore*70 AS BIGINT)+COALESCE({_RANKED},0)")
    + " AS InventoryRiskScore FROM IrBase"
)
IR_COLUMNS = (
    "InventoryKey, InventoryRecordID, ProductKey, ProductID, ProductName, Category, SubCategory, "
    "WarehouseKey, WarehouseID, WarehouseName, WarehouseCountry, WarehouseCity, SnapshotDate, "
    "CurrentStock, ReservedStock, AvailableStock, ReorderLevel, SafetyStockLevel, StockGapQty, "
    "SuggestedReorderQty, AvgDailyDemand, StockCoverageDays, InventoryValue, InventoryRiskValue, "
    "WarehouseUtilizationPct, InventoryRiskStatus, CoverageStatus, InventoryRiskScore"
)
PARTS["Ir"] = (
    f"SELECT {IR_COLUMNS}, "
    + grade(
        "InventoryRiskScore", (80, "Critical"), (60, "High"), (30, "Medium"), other="Low"
    )
    + " AS RiskPriority FROM IrScore"
)

# --- logistics -------------------------------------------------------------------

PARTS["LpSum"] = f"""
SELECT CarrierKey, COUNT(*) AS TotalShipments,
  COUNT(*) FILTER (WHERE DelayDays<=0) AS OnTimeShipments,
  COUNT(*) FILTER (WHERE DelayDays>0) AS LateShipments,
  {pct("COUNT(*) FILTER (WHERE DelayDays<=0)", "COUNT(*)")} AS OnTimeDeliveryPct,
  {pct("COUNT(*) FILTER (WHERE DelayDays>0)", "COUNT(*)")} AS DelayPct,
  {avg("100*SUM(DeliveryDays)", "COUNT(DeliveryDays)")} AS AvgDeliveryDays,
  {avg("100*COALESCE(SUM(DelayDays) FILTER (WHERE DelayDays>0),0)", "COUNT(*)")} AS AvgDelayDays,
  {avg(cents("ShippingCost"), "COUNT(ShippingCost)", "DECIMAL(18,2)")} AS AvgShippingCost,
  CAST(SUM(ShippingCost) AS DECIMAL(28,2)) AS TotalShippingCost,
  CAST(SUM(QuantityShipped) AS BIGINT) AS TotalQuantityShipped,
  CAST(SUM(DamagedQuantity) AS BIGINT) AS TotalDamagedQuantity,
  {pct("SUM(DamagedQuantity)", "SUM(QuantityShipped)")} AS DamageRatePct
FROM FactShipments GROUP BY ALL"""
PARTS["LpAll"] = "SELECT * FROM DimCarrier LEFT JOIN LpSum USING (CarrierKey)"
PARTS["LpCost"] = (
    "SELECT *, "
    + avg("CAST(TotalShippingCost*100 AS BIGINT)", "TotalQuantityShipped", "DECIMAL(18,2)")
    + " AS ShippingCostPerUnit FROM LpAll"
)
PARTS["LpScore"] = f"""
SELECT *, {score("OnTimeDeliveryPct NULLS FIRST")} AS DeliveryPerformanceScore,
  {score("AvgShippingCost DESC NULLS LAST")} AS CostEfficiencyScore,
  {score("DamageRatePct DESC NULLS LAST")} AS DamagePerformanceScore FROM LpCost"""
PARTS["LpTotal"] = (
    "SELECT *, "
    + weigh(
        ("DeliveryPerformanceScore", 50),
        ("CostEfficiencyScore", 30),
        ("DamagePerformanceScore", 20),
    )
    + " AS LogisticsPerformanceScore FROM LpScore"
)
PARTS["Lp"] = (
    "SELECT *, "
    + grade(
        "LogisticsPerformanceScore", (75, "Excellent"), (50, "Good"), (25, "Average"), other="Poor"
    )
    + " AS CarrierPerformanceCategory FROM LpTotal"
)

# --- dashboards ------------------------------------------------------------------

PARTS["DbSupplier"] = """
SELECT * EXCLUDE (LateDeliveryRiskScore, DelaySeverityRiskScore, QualityRiskScore,
    DependencyRiskScore),
  RANK() OVER (ORDER BY RiskScore DESC NULLS LAST) AS RiskRank,
  RANK() OVER (ORDER BY TotalPurchaseValue DESC NULLS LAST) AS PurchaseValueRank,
  RANK() OVER (ORDER BY LateShipmentPct DESC NULLS LAST) AS LateDeliveryRank,
  RANK() OVER (ORDER BY AvgQualityScore NULLS FIRST) AS QualityRiskRank FROM Sr"""
PARTS["DbDependency"] = """
SELECT * EXCLUDE (PurchaseExposureScore, ProductExposureScore, WarehouseExposureScore,
  ProductConcentrationScore) FROM Sd"""
PARTS["DbSummary"] = f"""
SELECT (SELECT COUNT(*) FROM DimSupplier WHERE ActiveStatus='Active') AS TotalActiveSuppliers,
  (SELECT COUNT(*) FROM Sr WHERE RiskScore>=50) AS HighRiskSuppliers,
  (SELECT COUNT(*) FROM FactOrders) AS TotalOrders,
  (SELECT CAST(SUM(OrderValue) AS DECIMAL(28,2)) FROM Bought) AS TotalPurchaseValue,
  (SELECT {pct("COUNT(*) FILTER (WHERE DelayDays<=0)", "COUNT(*)")} FROM FactShipments)
    AS OnTimeDeliveryPct,
  (SELECT COUNT(*) FROM IrNow WHERE AvailableStock<=0 OR AvailableStock<SafetyStockLevel
    OR AvailableStock<ReorderLevel) AS InventoryRiskItems,
  (SELECT COUNT(*) FROM IrNow WHERE AvailableStock<=0) AS StockoutItems,
  (SELECT CAST(SUM(ShippingCost) AS DECIMAL(28,2)) FROM FactShipments) AS TotalShippingCost"""

# --- facts from staged rows --------------------------------------------------------


def _joins(name: str) -> str:
    fact = FACTS[name]
    text = f"FROM Stg{fact.staged} r"
    for i, d in enumerate(fact.dimensions):
        dim = DIMENSIONS[d]
        text += f" JOIN {d} k{i} ON r.{dim.natural}=k{i}.{dim.natural}"
    for i, day in enumerate(fact.dates):
        text += f" JOIN DimDate c{i} ON r.{day}=c{i}.FullDate"
    return text


for _name, _fact in FACTS.items():
    _out = [f"r.{c}" for c in record_ids(_fact)]
    _out += [f"k{i}.{DIMENSIONS[d].key}" for i, d in enumerate(_fact.dimensions)]
    _out += [f"c{i}.DateKey AS {k}" for i, k in enumerate(_fact.dates.values())]
    _out += [f"r.{m}" for m in _fact.measures]
    PARTS[f"Built{_name}"] = f"SELECT {', '.join(_out)} {_joins(_name)}"

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


#: Parts that several others read.
SHARED = {"FactInventory", "IrLatest", "IrNow", "IrRow"}


def _kept(name: str) -> str:
    return "MATERIALIZED " if name in SHARED else ""


def with_parts(sql: str) -> str:
    """The query with every named part it needs in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(text)):
            if word in PARTS and word not in needed:
                visit(PARTS[word])
                needed.append(word)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ", ".join(f"{n} AS {_kept(n)}({PARTS[n]})" for n in needed) + " " + sql
