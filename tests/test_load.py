"""Raw CSV files to views, and the same again."""

import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from riskmart.operators import quality as dq
from riskmart.plans import dashboards as db
from riskmart.plans import inventory as ir
from riskmart.plans import load
from riskmart.plans.load import Star, correct_table, refresh, save
from riskmart.sources import versions, workspace
from riskmart.sources.files import malformed_rows, read_raw_folder, write_table
from riskmart.sources.schemas import DIMENSIONS, FACTS, RAW_FILES, STAGED
from suite import mapping
from suite.mart import Mart

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """The test tables as raw CSV files, spoiled rows included."""
    folder = tmp_path_factory.mktemp("landing")
    mart = Mart.open(spark, SF)
    for table, name in RAW_FILES.items():
        write_table(mart.raw(table), f"{folder}/{name}", fmt="csv")
    return str(folder)


def test_refresh_builds_the_whole_mart_and_can_be_repeated(spark, landing, tmp_path):
    folder = str(tmp_path / "mart")
    star = refresh(spark, landing, folder, mapping.CALENDAR, dense_fact_keys=True)
    assert len(star) == 9 and set(star) == {*DIMENSIONS, "DimDate", *FACTS}
    with pytest.raises(KeyError):
        star["stg"]

    counts = {r.TableName: r.RowCount for r in dq.table_counts(star).collect()}
    staged = {t: star[f"staged/{t}"] for t in RAW_FILES}
    cover = {r.FactName: r for r in dq.mapping_coverage(spark, staged, star).collect()}
    for fact in FACTS:
        assert counts[fact] == cover[fact].MappedRows
        assert 0 < cover[fact].MappedRows <= cover[fact].StagingRows
    assert cover["FactOrders"].MappedRows < cover["FactOrders"].StagingRows
    assert {r.OrphanRows for r in dq.orphan_counts(star).collect()} == {0}

    for fact, spec in FACTS.items():
        keys = star[fact].agg(
            F.min(spec.key).alias("a"), F.max(spec.key).alias("b"), F.count_distinct(spec.key).alias("c")
        ).first()
        assert (keys.a, keys.b, keys.c) == (1, counts[fact], counts[fact])

    def shown(star):
        views = db.build_views(star)
        summary = views["vw_supply_chain_executive_summary"].first()
        risk = {tuple(r) for r in views["vw_supplier_risk_dashboard"].collect()}
        return summary, risk

    first = shown(star)
    assert len(first[1]) == counts["DimSupplier"]
    again = refresh(spark, landing, folder, dense_fact_keys=True)
    assert again["DimDate"].count() > 365 * 5
    assert shown(refresh(spark, landing, folder, mapping.CALENDAR, dense_fact_keys=True)) == first
    report = {(r.Step, r.TableName): r.RowCount for r in Star(spark, folder)["LoadReport"].collect()}
    assert all(report["loaded", t] == n for t, n in counts.items())
    assert report["raw", "Orders"] == report["staged", "Orders"] == cover["FactOrders"].StagingRows
    assert report["rejected", "Orders"] > 0 and report["unmapped", "FactOrders"] > 0
    inventory = Star(spark, folder)["FactInventory"]
    assert inventory.inputFiles()[0].split("/")[-2].startswith("DateKey=")


def test_views_follow_a_later_load(spark, landing, tmp_path, monkeypatch):
    """The same view names show the new month, and the tables of the old views are gone."""
    folder, scratch = str(tmp_path / "mart"), tmp_path / "work"
    monkeypatch.setattr(workspace, "work_root", lambda spark: str(scratch))
    refresh(spark, landing, folder, mapping.CALENDAR)
    db.register_all(Star(spark, folder))
    one = spark.table("vw_inventory_risk").agg(F.max("SnapshotDate")).first()[0]
    before = len(list((scratch / "riskmart").iterdir()))
    later = str(tmp_path / "later")
    mart = Mart.open(spark, SF)
    for table, name in RAW_FILES.items():
        rows = mart.raw(table)
        if table == "Inventory":
            new = F.when(F.col("SnapshotDate") == "2001-10-31", "2001-11-30").otherwise(F.col("SnapshotDate"))
            rows = rows.withColumn("SnapshotDate", new)
        write_table(rows, f"{later}/{name}", fmt="csv")
    refresh(spark, later, folder, mapping.CALENDAR)
    for view in (*db.ANALYSES, *db.DASHBOARDS):
        assert spark.table(view).count() > 0
    assert (str(one), str(spark.table("vw_inventory_risk").agg(F.max("SnapshotDate")).first()[0])) == ("2001-10-31", "2001-11-30")
    assert len(list((scratch / "riskmart").iterdir())) == before


def test_scope_leaves_no_work_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "work_root", lambda spark: str(tmp_path))
    with workspace.scope(spark):
        assert workspace.materialize(spark.range(3), "t").count() == 3
    assert list((tmp_path / "riskmart").iterdir()) == []


def test_malformed_rows_are_reported(spark, tmp_path):
    path = tmp_path / "carriers.csv"
    header = "CarrierID,CarrierName,CarrierType,Country,ServiceLevel"
    path.write_text(f'{header}\nC1,A, B,Air,India,Express\nC2,"A, B",Air,India,Express\nC3,A,Air\n')
    got = {r.CarrierID: r.MalformedRow for r in malformed_rows(spark, str(path), "Carriers").collect()}
    assert got == {"C1": "C1,A, B,Air,India,Express", "C3": "C3,A,Air"}


def test_malformed_rows_are_the_lines_with_another_number_of_fields(spark, tmp_path):
    """Lines of every kind, against a count of the commas outside quotes one line at a time."""
    fields = len(STAGED["Carriers"])
    kinds = ["C{},A,B,India,Express", 'C{},"A, ""B""",Air,India,Express', 'C{},"A, B,Air,India,Express', "C{},A,Air", "C{},a,b,c,d,e",
             "C{},,,,", ",,,,", ',,"",,', "C{},,,", " ", "", '"{}"', 'C{},A"x,y",B,India,Express', "C{}, é,B,India,\u2028", '"C{},A,B,India,Express"']
    lines = [kind.format(i) for i, kind in enumerate(kinds)]
    path = tmp_path / "carriers.csv"
    path.write_text("\n".join(lines), encoding="utf-8")
    counted = [(x, re.sub('"([^"]|"")*"', "", x).count(",") + 1) for x in lines]
    want = sorted(x for x, n in counted if n != fields and x.strip(" "))
    got = malformed_rows(spark, str(path), "Carriers")
    assert 0 < len(want) < len(lines) - 4
    assert sorted(r.MalformedRow for r in got.collect()) == want
    assert "RLIKE" in got._jdf.queryExecution().optimizedPlan().toString()  # most lines are told by one match


def test_a_load_parses_each_text_once(spark, landing, tmp_path, monkeypatch):
    """The report's rejects are read from staged rows: CSV is read for it to be counted, without a column."""
    seen, store = {}, load.store
    monkeypatch.setattr(load, "store", lambda df, folder, name: (seen.update({name: df}), store(df, folder, name))[1])
    star = refresh(spark, landing, str(tmp_path / "mart"), mapping.CALENDAR)
    text = seen["LoadReport"]._jdf.queryExecution().optimizedPlan().toString()
    assert "OrderDate" in text and "RLIKE" not in text
    rejected = {r.TableName: r.RowCount for r in star["LoadReport"].where("Step = 'rejected'").collect()}
    raw = read_raw_folder(spark, landing)
    assert rejected == {t: dq.rejects(raw[t], t).count() for t in raw if t != "Carriers"}
    assert rejected["Suppliers"] > 0 and rejected["Orders"] > 0


def test_packed_text_is_spread_over_files(spark, tmp_path):
    rows = spark.range(10, numPartitions=1).selectExpr("CAST(id AS STRING) AS id")
    write_table(rows, f"{tmp_path}/t", fmt="csv", compression="gzip", file_rows=4)
    assert len(list((tmp_path / "t").glob("*.csv.gz"))) == 3
    assert sorted(int(r.id) for r in spark.read.csv(f"{tmp_path}/t", header=True).collect()) == list(range(10))


def test_corrections_are_written_back(spark, tmp_path):
    mart, folder = Mart.open(spark, SF), str(tmp_path)
    save(spark, mart["DimSupplier"], folder, "DimSupplier")
    before = {r.SupplierID: r.asDict() for r in Star(spark, folder)["DimSupplier"].collect()}
    changed = sorted(before)[:3]
    fixes = mart["DimSupplier"].drop("SupplierKey").where(F.col("SupplierID").isin(changed)).withColumn("Country", F.lit(None).cast("string"))
    correct_table(spark, folder, "DimSupplier", fixes)
    after = {r.SupplierID: r.asDict() for r in Star(spark, folder)["DimSupplier"].collect()}
    assert after == {k: v | ({"Country": None} if k in changed else {}) for k, v in before.items()}


def test_save_replaces_the_table(spark, tmp_path):
    for n in (10, 3):
        saved = save(spark, spark.range(n).withColumn("DateKey", F.lit(1)), str(tmp_path), "T")
        assert saved.count() == n


def test_readers_never_miss_a_table(spark, tmp_path):
    """One thread reads all along while a table is replaced: it sees whole versions only."""
    folder, seen, stop = str(tmp_path), [], threading.Event()
    save(spark, spark.range(100).withColumn("v", F.lit(0)), folder, "T")

    def read():
        while not stop.is_set():
            seen.append(tuple(Star(spark, folder)["T"].agg(F.count("*"), F.min("v"), F.max("v")).first()))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 9):
            save(spark, spark.range(100).withColumn("v", F.lit(v)), folder, "T")
    finally:
        stop.set()
        reader.join()
    assert seen and all(n == 100 and low == high for n, low, high in seen)
    assert [x[1] for x in seen] == sorted(x[1] for x in seen)


def test_a_load_that_stops_midway_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    save(spark, spark.range(5), folder, "T")
    old = Star(spark, folder)
    load.store(spark.range(9), folder, "T")  # written, never published
    assert Star(spark, folder)["T"].count() == 5
    (tmp_path / versions.LOG / "0000000002.json").write_text('{"T": {"pa')  # its writer was lost
    assert Star(spark, folder).manifest.version == 1 and Star(spark, folder)["T"].count() == 5
    assert save(spark, spark.range(7), folder, "T").count() == 7
    assert Star(spark, folder).manifest.version == 3
    assert old["T"].count() == 5  # a reader keeps the version it opened


def test_versions_expire(spark, tmp_path):
    folder = str(tmp_path)
    save(spark, spark.range(1), folder, "Other")
    for n in range(1, 5):
        save(spark, spark.range(n), folder, "T")
    versions.expire(spark, folder, keep=2)
    assert len(list((tmp_path / "T").iterdir())) == 2 and len(list((tmp_path / versions.LOG).glob("*.json"))) == 2
    star = Star(spark, folder)
    assert star["T"].count() == 4 and star["Other"].count() == 1


def test_loads_that_meet_take_turns(spark, tmp_path):
    folder = str(tmp_path)

    def load_one(name):
        versions.publish(spark, folder, {name: load.store(spark.range(3), folder, name)})

    threads = [threading.Thread(target=load_one, args=(f"T{i}",)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = versions.current(spark, folder)
    assert found.version == 6 and set(found.tables) == {f"T{i}" for i in range(6)}


def test_one_load_at_a_time_looks_up_and_adds_a_version(spark, tmp_path, monkeypatch):
    """None reads the last version while another adds one, so none leaves out what the other published."""
    looked_up, inside, most = versions.current, [], []

    def slow(*args):
        inside.append(1)
        most.append(len(inside))
        time.sleep(0.2)
        inside.pop()
        return looked_up(*args)

    monkeypatch.setattr(versions, "current", slow)
    stored = {f"T{i}": versions.Stored(f"T{i}/v", "{}") for i in range(4)}
    threads = [threading.Thread(target=versions.publish, args=(spark, str(tmp_path), {n: x})) for n, x in stored.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert max(most) == 1
    assert looked_up(spark, str(tmp_path)) == versions.Manifest(4, stored)


def test_views_follow_a_load_in_another_session(spark, landing, tmp_path):
    folder = str(tmp_path / "mart")
    refresh(spark, landing, folder, mapping.CALENDAR)
    views = db.Views(spark.newSession(), lambda session: Star(session, folder))
    count = "SELECT COUNT(*) AS n, COUNT(DISTINCT Country) AS c FROM vw_supplier_risk_analysis"
    before = views.sql(count).first()
    assert before.n == views["vw_supplier_dependency"].count() > 0 and before.c > 1
    fixes = Star(spark, folder)["DimSupplier"].drop("SupplierKey").withColumn("Country", F.lit("India"))
    correct_table(spark, folder, "DimSupplier", fixes)
    assert tuple(views.sql(count).first()) == (before.n, 1)
    assert views["vw_supplier_risk_dashboard"].select("Country").distinct().count() == 1
    assert len(views) == 9 and set(views) == {*db.ANALYSES, *db.DASHBOARDS}


def test_latest_snapshot_opens_no_older_file(spark, tmp_path):
    """Files of older snapshots are spoiled: the frame is built and run without touching them."""
    mart, folder = Mart.open(spark, SF), str(tmp_path)
    tables = {t: load.store(mart[t], folder, t) for t in (*mart, ir.SNAPSHOTS)}
    versions.publish(spark, folder, tables)
    star = Star(spark, folder)
    want = sorted(map(tuple, ir.current_inventory(star).collect()))
    latest = star["FactInventory"].agg(F.max("DateKey")).first()[0]
    files = list((tmp_path / tables["FactInventory"].path).glob("DateKey=*/part-*.parquet"))
    old = [f for f in files if f.parent.name != f"DateKey={latest}"]
    assert old and len(old) < len(files)
    for f in old:
        f.write_bytes(b"spoiled")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    assert sorted(map(tuple, ir.current_inventory(Star(spark, folder)).collect())) == want
    assert "FactInventory" not in ir.latest_snapshot(star[ir.SNAPSHOTS])._jdf.queryExecution().executedPlan().toString()


class FakeSession:
    """Just what the work folder is read from."""

    def __init__(self, folder, master, app="app-1"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": app})


def test_work_folder_comes_from_the_session(spark):
    assert workspace.work_root(FakeSession("hdfs://name/scratch/", "yarn")) == "hdfs://name/scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.work_root(FakeSession(None, "spark://host:7077"))
    local = FakeSession(None, "local[2]", "local-1")
    assert workspace.work_root(local) == workspace.work_root(local)
    assert workspace.materialize(spark.range(3), "t").count() == 3
