"""The test tables loaded as a star schema, as the mart's own load would leave it.

The star tables are written once per session and data folder below the shared work folder; queries then read
them as they do in production. So are the order lines with what orders and customers add to them: one join,
which the facts and the raw and staged tables of order lines all come from without another shuffle. Raw and
staged tables of order lines hold expressions over them, so that a query works out the columns it reads and
nothing is written for those it does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators.dimensions import date_dimension
from riskmart.operators.staging import stage
from riskmart.operators.transforms import utilization, with_utilization
from riskmart.plans.inventory import SNAPSHOTS, snapshots
from riskmart.plans.load import PARTITIONED
from riskmart.sources.files import write_table
from riskmart.sources.schemas import RAW_FILES
from riskmart.sources.workspace import work_path
from suite import mapping

STAR = (*mapping.SOURCE, "DimDate")

#: Rows of a task that joins order lines or makes stock rows, some 200 to 300 MB sorted.
TASK_ROWS = 1_000_000

#: Tables of order lines: as many tasks as the lines they are read from, so written without a shuffle.
LINES = ("FactOrders", "FactShipments", "FactSupplierQuality", "lines")


class Sources:
    """Row sources of the mapping, lazily, from the given tables.

    ``keep(label, build)`` gives the rows of a source that is written once, built when it is not there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep: Callable[..., DataFrame]):
        self.spark, self.sf_dir, self.keep = spark, sf_dir, keep

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, df: DataFrame, key: str, rows: int, fixed: bool = False) -> DataFrame:
        """``df`` by key, in more than the session's partitions where that many would make over TASK_ROWS rows each.

        What a task sorts stays the same when the tables grow. ``fixed``: small partitions are not put together.
        """
        usual = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        needed = -(-rows // TASK_ROWS)
        return df.repartition(max(usual, needed), key) if fixed or needed > usual else df.repartition(key)

    def rows(self, source: str) -> DataFrame:
        if source == "LINE":
            return self.keep("lines", self._line)
        if source == "INV":
            return self._inv()
        if source == "SUPPLIER_PLACE":
            nation, region = self.table("nation"), self.table("region")
            return (
                self.table("supplier")
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            )
        return self.table(source)

    def _line(self) -> DataFrame:
        """Order lines as the mapping reads them: only columns it names, narrow before they are shuffled.

        Lines are dealt by order number, which the join with orders needs, also where orders are broadcast:
        a file may hold one row group, and all that is derived from the lines would stay one task.
        """
        steps = dict(mapping.LINE_STEPS)
        early = {c: steps.pop(c) for c in ("q", "cents", "disc")}
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        orders = self.table("orders").selectExpr(
            "o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_orderdate AS DATE) AS o_orderdate"
        )
        placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
        kept = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate"]
        lines = self.table("lineitem").selectExpr(
            *kept[:-1], "CAST(l_shipdate AS DATE) AS l_shipdate", "l_suppkey", *[f"{e} AS {c}" for c, e in early.items()]
        )
        joined = (
            self.dealt(lines.where("l_orderkey IS NOT NULL"), "l_orderkey", self.table("lineitem").count())
            .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("n", self.table("supplier").agg(F.count(F.lit(1))).scalar())
        )
        worked_out = joined.selectExpr("*", *[f"{e} AS {c}" for c, e in steps.items()])
        return worked_out.select(*kept, "c_nationkey", "o_orderdate", *early, "lead", "sk", "st")

    def _inv(self) -> DataFrame:
        days = F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("sn"), F.lit(d).cast("date").alias("sd"))
                    for i, d in enumerate(mapping.SNAPSHOTS)
                ]
            )
        )
        # The two columns the mapping reads, spread before a part becomes some 15 rows.
        part = self.table("part").select("p_partkey", "p_retailprice").where("p_partkey IS NOT NULL")
        # A nation in five takes a part on a day.
        stock = part.count() * len(mapping.SNAPSHOTS) * self.table("nation").count() // 5
        part = self.dealt(part, "p_partkey", stock, fixed=True).withColumn("_day", days).select("*", "_day.*").drop("_day")
        # (part + nation + snapshot) divisible by 5, as an equi join on the rest.
        part = part.withColumn("_rest", F.pmod(-(F.col("p_partkey") + F.col("sn")), F.lit(5)))
        nation = self.table("nation").select(
            "n_nationkey", (F.col("n_nationkey") % 5).alias("_rest")
        )
        grid = part.join(nation, "_rest").drop("_rest")
        steps = grid.selectExpr("*", *[f"{e} AS {c}" for c, e in mapping.INV_STEPS.items()])
        return steps.selectExpr("*", f"{mapping.INV_STOCK} AS av")

    def mapped(self, source: tuple[str, str | None], columns: Mapping[str, str]) -> DataFrame:
        rows = self.rows(source[0])
        if source[1]:
            rows = rows.where(source[1])
        return rows.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


class Mart(Mapping[str, DataFrame]):
    """Star tables by name; also raw and staged tables of the same data."""

    _opened: dict[tuple[str, str], Mart] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sources = spark, Sources(spark, sf_dir, self._stored)
        self._paths: dict[str, tuple[str, object]] = {}

    @classmethod
    def open(cls, spark: SparkSession, sf_dir: str) -> Mart:
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._opened:
            cls._opened[key] = cls(spark, key[1])
        mart = cls._opened[key]
        mart.spark = mart.sources.spark = spark
        return mart

    def _stored(self, label: str, build) -> DataFrame:
        if label in self._paths:
            path, schema = self._paths[label]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:  # the work folder was emptied: load again
                pass
        df = build()
        path = work_path(self.spark, f"mart-{label}")
        # The test files hold one row group each, so a plain write would leave one big task; lines are spread.
        # Tables of stock come from spread parts.
        spread = label in LINES or label.endswith("Inventory")
        write_table(df if spread else df.hint("rebalance"), path, partition_by=PARTITIONED.get(label, ()))
        self._paths[label] = (path, df.schema)
        return self.spark.read.schema(df.schema).parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        if name == SNAPSHOTS:
            return self._stored(name, lambda: snapshots(self["FactInventory"], self["DimDate"]))
        if name not in STAR:
            raise KeyError(name)
        if name == "DimDate":
            return self._stored(name, lambda: date_dimension(self.spark, *mapping.CALENDAR))
        if name == "FactInventory":
            return self._stored(name, self._inventory)
        return self._stored(name, lambda: self.sources.mapped(mapping.SOURCE[name], mapping.COLUMNS[name]))

    def _table(self, label: str, source: tuple[str, str | None], build: Callable[[], DataFrame]) -> DataFrame:
        return build() if source[0] == "LINE" else self._stored(label, build)

    def _inventory(self) -> DataFrame:
        df = self.sources.mapped(mapping.SOURCE["FactInventory"], mapping.COLUMNS["FactInventory"])
        houses = self.sources.mapped(mapping.SOURCE["DimWarehouse"], mapping.COLUMNS["DimWarehouse"])
        number = F.lpad(F.col("WarehouseKey").cast("string"), 3, "0")
        stock = df.withColumn("WarehouseID", F.concat(F.lit("WH"), number))
        rates = self._stored("rates", lambda: utilization(stock, houses))
        return with_utilization(stock, houses, rates).select(*df.columns, "WarehouseUtilizationPct")

    def __iter__(self) -> Iterator[str]:
        return iter(STAR)

    def __len__(self) -> int:
        return len(STAR)

    def __contains__(self, name: object) -> bool:
        return name in (*STAR, SNAPSHOTS)

    def raw(self, table: str) -> DataFrame:
        """Landed text rows derived from the given tables, some of them spoiled."""
        source, columns = mapping.RAW_SOURCE[table], mapping.RAW_COLUMNS[table]
        return self._table(f"raw-{table}", source, lambda: self.sources.mapped(source, columns))

    def raw_once(self, table: str) -> DataFrame:
        """``raw`` for a single reader: rows of stock are worked out if they are not written yet."""
        source, columns = mapping.RAW_SOURCE[table], mapping.RAW_COLUMNS[table]
        worked_out = source[0] == "INV" and f"raw-{table}" not in self._paths
        return self.sources.mapped(source, columns) if worked_out else self.raw(table)

    def raw_all(self) -> dict[str, DataFrame]:
        return {t: self.raw(t) for t in RAW_FILES}

    def staged(self, table: str) -> DataFrame:
        source = mapping.RAW_SOURCE[table]
        return self._table(f"staged-{table}", source, lambda: stage(self.raw(table), table))

    def staged_all(self) -> dict[str, DataFrame]:
        return {t: self.staged(t) for t in RAW_FILES}
