"""The test mart on rows of its own: what it writes, and that lazy tables hold the right rows."""

import datetime as dt
import re

import pytest

from riskmart.operators import quality
from riskmart.sources import files
from riskmart.sources.schemas import DIMENSIONS, FACTS
from riskmart.sources.workspace import work_root
from suite import catalog
from suite.mart import Mart
from tests.helpers import by

DAY = dt.datetime(1998, 3, 1)
TABLES = {
    "region": ("r_regionkey long, r_name string", [(0, "ASIA")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(k, f"N{k}", 0) for k in range(25)]),
    "customer": ("c_custkey long, c_nationkey long", [(1, 3), (2, 4), (2, 5), (None, 6)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey long", [(k, f"S{k}", k % 25) for k in range(1, 31)]),
    "part": (
        "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double",
        [(k, f"P{k}", "T", "B", 900.0 + k) for k in range(1, 13)] + [(None, "none", "T", "B", 1.0)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp",
        [(1, 1, "F", DAY), (2, 2, "O", DAY), (3, 9, "F", DAY), (4, None, "F", DAY), (None, 1, "F", DAY)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp",
        [(o, p, 5, i, 10.0, 1000.0, 0.05, "N", DAY) for o in (1, 2, 3, 4, None) for i, p in ((1, 1), (2, 2), (3, 4))],
    ),
}


@pytest.fixture
def mart(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Mart.open(spark, str(tmp_path))


def test_facts_come_from_lines_written_once(mart):
    found = {t: mart[t].count() for t in FACTS}
    found |= {f"raw {t}": df.count() for t, df in mart.raw_all().items() if t in {f.staged for f in FACTS.values()}}
    found |= {f"staged {t}": df.count() for t, df in mart.staged_all().items() if t in {f.staged for f in FACTS.values()}}
    # Order 1 has one customer, order 2 meets two rows of its customer, the others meet none.
    assert found["FactOrders"] == found["raw Orders"] == found["staged Orders"] == 9
    assert found["FactShipments"] == found["raw SupplierQuality"] == found["staged Shipments"] == 3
    assert found["FactInventory"] == found["staged Inventory"] == 12 * 5 * 3
    written = set(mart._paths)
    assert "lines" in written
    wide = {f"{kind}-{f.staged}" for f in FACTS.values() if f.staged != "Inventory" for kind in ("raw", "staged")}
    assert not written & wide


def test_lines_keep_their_own_values(mart):
    rows = by(mart["FactOrders"].where("WarehouseKey = 3"), "OrderID")
    assert sorted(rows) == ["ORD0000001-1", "ORD0000001-2", "ORD0000001-3"]
    row = rows["ORD0000001-2"]
    assert (row["SupplierKey"], row["ProductKey"], row["OrderQuantity"]) == (5, 2, 10)
    assert row["OrderDate"] == DAY.date() and str(row["UnitCost"]) == "100.00" and row["OrderStatus"] == "Completed"


def test_stock_is_spread_before_a_part_becomes_many_rows(mart):
    plan = mart._inventory()._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate explode") < plan.find("RepartitionByExpression [p_partkey")


def test_coverage_sums_rows_before_the_last_dimension(spark, mart):
    lost = {name: mart[name] for name in (*DIMENSIONS, "DimDate")}
    lost["DimSupplier"] = mart["DimSupplier"].unionByName(mart["DimSupplier"]).where("SupplierKey <> 1")
    lost["DimProduct"] = mart["DimProduct"].where("ProductKey <> 4")
    found = quality.mapping_coverage(spark, mart.staged_all(), lost)
    rows = by(found, "FactName")
    staged = mart.staged("Orders").collect()
    houses = {r["WarehouseID"] for r in mart["DimWarehouse"].collect()}
    days = {r["FullDate"] for r in mart["DimDate"].collect()}
    copies = {r["SupplierID"]: 2 for r in lost["DimSupplier"].collect()}
    products = {r["ProductID"] for r in lost["DimProduct"].collect()}
    fits = [
        copies.get(r["SupplierID"], 0)
        for r in staged
        if r["ProductID"] in products and r["WarehouseID"] in houses and {r["OrderDate"], r["ExpectedDeliveryDate"]} <= days
    ]
    assert (rows["FactOrders"]["StagingRows"], rows["FactOrders"]["MappedRows"]) == (len(staged), sum(fits))
    assert 0 < sum(fits)
    # Three facts have suppliers: their rows are summed up by it, beside the three counts of partners.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [SupplierID") == 6


def test_landing_writes_stock_once(mart):
    rows = {t: df.count() for t, df in catalog._landed_all(mart).items()}
    assert rows["Inventory"] == 12 * 5 * 3 and "raw-Inventory" not in mart._paths
    assert sorted(map(tuple, mart.raw_once("Inventory").collect())) == sorted(map(tuple, mart.raw("Inventory").collect()))
    assert "raw-Inventory" in mart._paths and mart.raw_once("Inventory").inputFiles()


def test_landed_files_are_compressed(mart, monkeypatch):
    seen = []
    write = files.write_table
    monkeypatch.setattr(files, "write_table", lambda df, path, **how: (seen.append(path), write(df, path, **how)))
    counts = by(catalog._landed_all(mart)["Orders"], "OrderID")
    assert len(seen) == 8 and all(x.startswith(work_root(mart.spark)) for x in seen)
    assert len(counts) == 6  # nine rows, of which three ids come twice
    for path in seen:
        names = mart.spark.read.format("binaryFile").load(path).select("path").collect()
        assert names and all(r["path"].endswith(".csv.gz") for r in names)


def test_tasks_hold_no_more_rows_when_tables_grow(mart, monkeypatch):
    """More partitions than the session has, where that many would hold too many rows; the rows are the same."""
    lines, stock = mart.sources._line(), mart.sources._inv()
    monkeypatch.setattr("suite.mart.TASK_ROWS", 1)
    dealt, spread = mart.sources._line(), mart.sources._inv()
    # 15 order lines, 180 stock rows.
    for df, key, parts in ((dealt, "l_orderkey", 15), (spread, "p_partkey", 12 * 3 * 25 // 5)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(rf"RepartitionByExpression \[{key}#\d+L?\], {parts}\b", plan), plan
    assert sorted(dealt.collect()) == sorted(lines.collect())
    assert sorted(spread.collect()) == sorted(stock.collect())
