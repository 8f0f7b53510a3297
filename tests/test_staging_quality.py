import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from riskmart.operators import quality as dq
from riskmart.operators.staging import parse, stage
from riskmart.sources.files import read_raw, write_table
from riskmart.sources.schemas import DIMENSIONS, FACTS, raw_schema


@pytest.mark.parametrize(
    "text,kind,want",
    [
        ("2024-01-05", "date", dt.date(2024, 1, 5)),
        ("2024-2-3", "date", dt.date(2024, 2, 3)),
        (" 2024-01-05 ", "date", dt.date(2024, 1, 5)),
        ("2024", "date", None),
        ("20240105", "date", None),
        ("01/05/2024", "date", None),
        ("2024-01-05 10:00:00", "date", None),
        ("2024-02-30", "date", None),
        ("", "date", None),
        (None, "date", None),
        ("12", "int", 12),
        (" 7 ", "int", 7),
        ("-3", "int", -3),
        ("12.5", "int", None),
        ("99999999999", "int", None),
        ("", "int", None),
        ("12.345", "decimal(5,2)", D("12.35")),
        ("1234.5", "decimal(5,2)", None),
        ("n/a", "decimal(18,2)", None),
    ],
)
def test_parse(spark, text, kind, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse(F.col("t"), kind).alias("v")).first().v == want


def raw_suppliers(spark):
    rows = [
        ("SUP1", "Acme, Inc", "India", "Asia", "X", "2020-01-01", "90.5", "Low", "Active"),
        ("SUP2", '"Broken', 'A" B', "Asia", "X", "soon", "1234.5", "Low", "Active"),
        ("SUP3", "Odd", "Atlantis", "Asia", "X", None, None, "Low", "Active"),
        ("SUP4", "None", None, "Asia", "X", "2020-1-9", "88", "Low", "Active"),
    ]
    return spark.createDataFrame(rows, raw_schema("Suppliers"))


def test_stage_keeps_every_row(spark):
    staged = {r.SupplierID: r for r in stage(raw_suppliers(spark), "Suppliers").collect()}
    assert len(staged) == 4
    assert staged["SUP2"].SupplierSince is None and staged["SUP2"].QualityRating is None
    assert staged["SUP4"].SupplierSince == dt.date(2020, 1, 9)
    assert staged["SUP1"].QualityRating == D("90.50")


def test_supplier_rejects_need_a_present_date(spark):
    got = dq.supplier_date_rejects(raw_suppliers(spark)).collect()
    assert [r.SupplierSince for r in got] == ["soon"]


def test_rejects_count_missing_values(spark):
    rows = [
        ("W1", "a", "b", "c", "10", "t"),
        ("W2", "a", "b", "c", None, "t"),
        ("W3", "a", "b", "c", "x", "t"),
    ]
    raw = spark.createDataFrame(rows, raw_schema("Warehouses"))
    got = dq.rejects(raw, "Warehouses")
    assert [(r.WarehouseID, r.Capacity) for r in got.collect()] == [("W2", None), ("W3", "x")]


def test_quotes_and_countries(spark):
    raw = raw_suppliers(spark)
    assert [r.SupplierID for r in dq.broken_quotes(raw).collect()] == ["SUP2"]
    assert [r.SupplierID for r in dq.unknown_countries(raw).collect()] == ["SUP2", "SUP3"]


def test_duplicates_and_surplus_with_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    assert {(r.k, r.DuplicateCount) for r in dq.duplicates(df, ["k"]).collect()} == {
        ("a", 2), (None, 2),
    }
    assert dq.surplus_rows(df, ["k"]).first().SurplusRows == 2
    assert dq.surplus_rows(df, ["k", "v"]).first().SurplusRows == 1
    assert dq.surplus_rows(df.limit(0), ["k"]).first().SurplusRows == 0


def test_null_profile_and_distribution(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), (None, 1)], "s string, v int")
    assert {tuple(r) for r in dq.null_profile(df).collect()} == {("s", 1), ("v", 1)}
    assert [tuple(r) for r in dq.distribution(df, "s").collect()] == [("a", 2)]


def test_orphans_include_missing_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "K int")
    dim = spark.createDataFrame([(1,)], "K int")
    got = [r.K for r in dq.orphans(fact, dim, "K").collect()]
    assert len(got) == 2 and set(got) == {2, None}


def test_delay_mismatch(spark):
    d = dt.date
    rows = [
        ("a", d(2022, 1, 5), d(2022, 1, 7), 2),
        ("b", d(2022, 1, 5), d(2022, 1, 7), -4),
        ("c", None, d(2022, 1, 7), 1),
    ]
    df = spark.createDataFrame(
        rows, "ShipmentID string, PromisedDate date, DeliveryDate date, DelayDays int"
    )
    assert [(r.ShipmentID, r.DateDelay) for r in dq.delay_mismatches(df).collect()] == [("b", 2)]


def test_require_rows(spark):
    df = spark.range(5)
    assert dq.require_rows(df, 5) is df
    assert dq.require_rows(df, 0) is df
    with pytest.raises(ValueError, match="wanted 6, found 5"):
        dq.require_rows(df, 6)


def test_csv_round_trip_with_quotes_and_commas(spark, tmp_path):
    raw = raw_suppliers(spark)
    path = str(tmp_path / "suppliers.csv")
    write_table(raw, path, fmt="csv")
    back = read_raw(spark, path, "Suppliers")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in raw.collect()}


def test_csv_header_must_match(spark, tmp_path):
    path = tmp_path / "carriers.csv"
    path.write_text("CarrierID,Wrong,CarrierType,Country,ServiceLevel\n1,a,b,c,d\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw(spark, str(path), "Carriers").collect()


def test_csv_quoted_comma_from_plain_file(spark, tmp_path):
    path = tmp_path / "carriers.csv"
    path.write_text(
        "CarrierID,CarrierName,CarrierType,Country,ServiceLevel\n"
        'C1,"One, Two and ""Three"" Ltd",Air,India,Express\n'
        "C2,Plain,,India,Express\n"
    )
    got = {r.CarrierID: r for r in read_raw(spark, str(path), "Carriers").collect()}
    assert got["C1"].CarrierName == 'One, Two and "Three" Ltd'
    assert got["C2"].CarrierType is None


def test_orphan_counts_list_every_key(spark):
    """Missing and unknown keys count, duplicates in a dimension do not; an empty fact is listed with zeros."""
    star = {name: spark.createDataFrame([(k,) for k in (1, 2, 2)], f"{d.key} int") for name, d in DIMENSIONS.items()}
    star["DimDate"] = spark.createDataFrame([(20220101,)], "DateKey int")
    for name, fact in FACTS.items():
        columns = [DIMENSIONS[d].key for d in fact.dimensions] + list(fact.dates.values())
        rows = [] if name == "FactInventory" else [tuple(1 if c in {d.key for d in DIMENSIONS.values()} else 20220101 for c in columns), (None,) * len(columns), (99,) * len(columns)]
        star[name] = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))
    got = {(r.FactName, r.KeyColumn): r.OrphanRows for r in dq.orphan_counts(star).collect()}
    assert len(got) == 18
    assert all(n == (0 if name == "FactInventory" else 2) for (name, _), n in got.items())
