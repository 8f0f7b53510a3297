"""Line breaks in quoted fields, read by several tasks, against the reader that takes a file in one."""

import random

import pytest
from pyspark.sql import functions as F

from riskmart.sources.files import malformed_rows, read_raw
from riskmart.sources.records import records
from riskmart.sources.schemas import raw_schema

HEAD = ",".join(raw_schema("Suppliers").names)


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "300")
    yield
    spark.conf.set(key, before)


def field(r):
    parts = ["a", "b", ",", "\n", '""', "\n\n", "é", " "]
    return r.choice(["", "plain", '"' + "".join(r.choice(parts) for _ in range(r.randrange(12))) + "x" + '"'])


def content(seed, lines, end="\n"):
    r = random.Random(seed)
    width = len(raw_schema("Suppliers"))
    rows = [",".join([f"SUP{i:04d}", *(field(r) for _ in range(width - 1))]) for i in range(lines)]
    rows.insert(lines // 2, "")
    return end.join([HEAD, *rows, ""])


def single(spark, path):
    return spark.read.csv(path, schema=raw_schema("Suppliers"), header=True, quote='"', escape='"', multiLine=True)


@pytest.mark.parametrize("seed", range(3))
def test_as_the_reader_of_whole_files(spark, tmp_path, small_ranges, seed):
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_text(content(10 * seed + k, 150), newline="")
    got, want = read_raw(spark, str(tmp_path), "Suppliers", multi_line=True), single(spark, str(tmp_path))
    assert got.schema == want.schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 300 and got.where(F.col("SupplierName").contains("\n")).count() > 50
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 20


def test_a_field_longer_than_many_ranges(spark, tmp_path, small_ranges):
    path = tmp_path / "suppliers.csv"
    long = "line\n" * 900 + "end"
    width = len(raw_schema("Suppliers"))
    rows = [f'SUP1,"{long}"' + "," * (width - 2), 'SUP2,"a ""b""\n"' + "," * (width - 2), "SUP3" + "," * (width - 1)]
    path.write_text("\n".join([HEAD, *rows]))
    got = {r.SupplierID: r.SupplierName for r in read_raw(spark, str(path), "Suppliers", multi_line=True).collect()}
    assert got == {"SUP1": long, "SUP2": 'a "b"\n', "SUP3": None}


def test_carriage_returns(spark, tmp_path, small_ranges):
    path = tmp_path / "suppliers.csv"
    path.write_text(content(5, 80).replace("\n", "\r\n"), newline="")
    got, want = read_raw(spark, str(path), "Suppliers", multi_line=True), single(spark, str(path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_wrong_header_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("A,B\n1,2\n")
    with pytest.raises(Exception, match="header does not name"):
        read_raw(spark, f"{tmp_path}/bad.csv", "Suppliers", multi_line=True).collect()
    (tmp_path / "head.csv").write_text(HEAD + "\n")
    (tmp_path / "none.csv").write_text("")
    for name in ("head.csv", "none.csv"):
        assert read_raw(spark, f"{tmp_path}/{name}", "Suppliers", multi_line=True).count() == 0
    assert records(spark, f"{tmp_path}/none.csv").count() == 0


def test_malformed_records(spark, tmp_path, small_ranges):
    path = tmp_path / "carriers.csv"
    header = "CarrierID,CarrierName,CarrierType,Country,ServiceLevel"
    path.write_text(f'{header}\nC1,"A,\nB",Air,India,Express\nC2,"A\n",Air\nC3,A,B,Air,India,Express\n')
    got = {r.CarrierID: r.MalformedRow for r in malformed_rows(spark, str(path), "Carriers", multi_line=True).collect()}
    assert got == {"C2": 'C2,"A\n",Air', "C3": "C3,A,B,Air,India,Express"}
