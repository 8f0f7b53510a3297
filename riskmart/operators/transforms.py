"""Fixed business rules of the record sources, as operators on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.functions.domains import (
    CATEGORY_MAP,
    INSPECTION_BANDS,
    INSPECTION_FLOOR,
    RATING_BANDS,
    RATING_FLOOR,
    SNAPSHOTS,
)
from riskmart.functions.exprs import MONEY, bands, percent, ratio
from riskmart.functions.stock import stock_status
from riskmart.sources.workspace import materialize

# --- suppliers -------------------------------------------------------------------


def with_risk_tier(suppliers: DataFrame, out: str = "RiskTier") -> DataFrame:
    return suppliers.withColumn(out, bands(F.col("QualityRating"), RATING_BANDS, RATING_FLOOR))


def suppliers_per_category(suppliers: DataFrame) -> DataFrame:
    """Category and supplier id as rows, so that a category of any size fits."""
    return suppliers.select("SupplierCategory", "SupplierID")


def category_map(
    spark: SparkSession, mapping: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """The product category to supplier category map as a table."""
    pairs = [(p, s) for p, names in (mapping or CATEGORY_MAP).items() for s in names]
    return spark.createDataFrame(pairs, "Category string, SupplierCategory string")


def eligible_suppliers(suppliers: DataFrame, mapping: DataFrame, category: str) -> DataFrame:
    """Suppliers that can serve one product category; all of them if the map gives none."""
    wanted = mapping.where(F.col("Category") == category).select("SupplierCategory")
    fitting = suppliers.join(wanted, "SupplierCategory", "left_semi")
    found = fitting.agg(F.count(F.lit(1)) > 0).scalar()
    return (
        suppliers.join(
            wanted.distinct().withColumn("_fits", F.lit(True)), "SupplierCategory", "left"
        )
        .where(F.col("_fits") | ~found)
        .select("SupplierID", "SupplierCategory")
    )


def eligible_counts(products: DataFrame, suppliers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per product category: suppliers to choose from, and whether the map decided it."""
    categories = products.select("Category").distinct()
    sizes = suppliers.groupBy("SupplierCategory").agg(F.count(F.lit(1)).alias("_size"))
    mapped = (
        mapping.distinct()
        .join(sizes, "SupplierCategory")
        .groupBy("Category")
        .agg(F.sum("_size").alias("_found"))
    )
    everyone = suppliers.agg(F.count(F.lit(1))).scalar()
    return categories.join(mapped, "Category", "left").select(
        "Category",
        F.coalesce("_found", everyone).alias("EligibleSuppliers"),
        F.col("_found").isNull().alias("FellBack"),
    )


# --- orders ------------------------------------------------------------------------


def with_order_value(orders: DataFrame, out: str = "OrderValue") -> DataFrame:
    return orders.withColumn(out, (F.col("OrderQuantity") * F.col("UnitCost")).cast(MONEY))


def with_expected_delivery(
    orders: DataFrame, products: DataFrame, buffer_days: Column
) -> DataFrame:
    """Order date plus the product's lead time plus a buffer."""
    lead = products.select("ProductID", "LeadTimeDays")
    days = F.col("LeadTimeDays") + buffer_days
    return (
        orders.join(lead, "ProductID")
        .withColumn("ExpectedDeliveryDate", F.date_add("OrderDate", days.cast("int")))
        .drop("LeadTimeDays")
    )


def with_order_age(orders: DataFrame, cut_off: str, recent_days: int = 60) -> DataFrame:
    age = F.datediff(F.lit(cut_off).cast("date"), F.col("OrderDate"))
    return orders.withColumns(
        {"DaysFromEnd": age, "IsRecent": F.coalesce(age <= recent_days, F.lit(False))}
    )


def sort_on_write(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range partitions, each sorted: files in global order without one sorting task.

    A hash of the row follows the columns in the ranges, so that one value holding much of
    the table may span several partitions.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(*columns, tie).sortWithinPartitions(*columns)


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("OrderStatus") == "Completed")


# --- shipments ---------------------------------------------------------------------


def with_delivery(shipments: DataFrame) -> DataFrame:
    """Promised date plus delay, never before the ship date; days on the way."""
    due = F.date_add("PromisedDate", F.col("DelayDays"))
    held = F.when(due < F.col("ShipDate"), F.col("ShipDate")).otherwise(due)
    return shipments.withColumn("DeliveryDate", held).withColumn(
        "DeliveryDays", F.datediff("DeliveryDate", "ShipDate")
    )


def with_shipment_status(shipments: DataFrame, out: str = "ShipmentStatus") -> DataFrame:
    delay = F.col("DelayDays")
    return shipments.withColumn(
        out,
        F.when(delay <= 0, "On Time")
        .when(delay <= 3, "Minor Delay")
        .when(delay <= 7, "Moderate Delay")
        .otherwise("Severe Delay"),
    )


def capped(quantity: Column, limit: Column) -> Column:
    """A defect or damage count held to the quantity it belongs to."""
    return F.least(quantity, limit)


# --- inventory ---------------------------------------------------------------------


def daily_demand(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Demand per product as quantity and days, and rounded.

    A product without orders gets the overall demand divided by the number of products.
    """
    span = F.greatest(F.datediff(F.max("OrderDate"), F.min("OrderDate")), F.lit(1))
    overall = orders.agg(
        F.struct(F.sum("OrderQuantity").alias("quantity"), span.alias("days"))
    ).scalar()
    ordered = orders.groupBy("ProductID").agg(F.sum("OrderQuantity").alias("_quantity"))
    n_products = products.agg(F.count(F.lit(1))).scalar()
    days = overall.getField("days").cast("bigint")
    quantity = F.coalesce("_quantity", overall.getField("quantity"))
    span_days = F.when(F.col("_quantity").isNotNull(), days).otherwise(days * n_products)
    return (
        products.select("ProductID")
        .join(ordered, "ProductID", "left")
        .select("ProductID", quantity.alias("DemandQuantity"), span_days.alias("DemandDays"))
        .withColumn(
            "AvgDailyDemand", ratio(F.col("DemandQuantity"), F.col("DemandDays"), 2, MONEY)
        )
    )


def month_ends(
    spark: SparkSession, start: str | Column = SNAPSHOTS[0], end: str | Column = SNAPSHOTS[1]
) -> DataFrame:
    """Every last day of a month from ``start`` to ``end``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    months = spark.range(1).select(
        F.explode(
            F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month"))
        ).alias("_month")
    )
    return months.select(F.last_day("_month").alias("SnapshotDate")).where(
        F.col("SnapshotDate").between(first, last)
    )


def stock_cells(
    cells: DataFrame, products: DataFrame, warehouses: DataFrame, dates: DataFrame
) -> DataFrame:
    """Cell numbers of the product, warehouse and date grid, turned into their keys.

    Each input is numbered from 0 in ``Position``; a cell number counts warehouses
    fastest, then products, then dates. Three equi joins, and only the cells asked for.
    """
    n_products = products.agg(F.count(F.lit(1))).scalar()
    n_warehouses = warehouses.agg(F.count(F.lit(1))).scalar()
    cell = F.col("Cell")
    row = F.call_function("div", cell, n_warehouses)
    placed = cells.select(
        "Cell",
        (cell % n_warehouses).alias("_w"),
        (row % n_products).alias("_p"),
        F.call_function("div", row, n_products).alias("_d"),
    )
    return (
        placed.join(products.withColumnRenamed("Position", "_p"), "_p")
        .join(warehouses.withColumnRenamed("Position", "_w"), "_w")
        .join(dates.withColumnRenamed("Position", "_d"), "_d")
        .drop("_p", "_w", "_d")
    )


def _bucket_of(sizes: DataFrame, n: Column) -> DataFrame:
    """One row or none: the bucket (_b) in which the n-th row falls, and how many rows come before it."""
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = sizes.select("_b", "_rows", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return edges.where((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n))


def draw(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of their unique key: those with the smallest hashes.

    The choice depends on key and seed alone, so it is the same at any parallelism. ``df`` is read twice: rows
    are counted per hash bucket first, then those up to the bucket where the n-th falls are written, which are
    ``n`` and 1/2**16 of the rows. That bucket is cut in the same way by the next bits of the hash, from
    what was written, and only the bucket where the n-th row falls then, 1/2**32 of the rows, is sorted.
    """
    if n <= 0:
        return df.limit(0)
    bits = 16
    hashed = df.withColumn("_h", F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)))
    numbers = [F.shiftright("_h", 64 - bits), F.shiftright("_h", 64 - 2 * bits)]  # in the order of the hash
    counts = F.count(F.lit(1)).alias("_rows")
    wanted = F.lit(n).cast("bigint")
    cut = _bucket_of(hashed.groupBy(numbers[0].alias("_b")).agg(counts), wanted)
    last = F.coalesce(cut.select("_b").scalar(), F.lit(1 << bits).cast("bigint"))  # fewer rows than n: all
    near = materialize(hashed.where(numbers[0] <= last).withColumn("_last", numbers[0] == last), "drawn")
    whole = near.where("NOT _last").select(*df.columns)
    rest = near.where("_last")
    left = wanted - near.agg(F.count_if(~F.col("_last"))).scalar()
    inner = _bucket_of(rest.groupBy(numbers[1].alias("_b")).agg(counts), left)
    edge = F.coalesce(inner.select("_b").scalar(), F.lit(-(1 << 62)))
    before = F.coalesce(inner.select("_before").scalar(), F.lit(0))
    middle = rest.where(numbers[1] < edge).select(*df.columns)
    place = F.row_number().over(Window.partitionBy("_last").orderBy("_h", *keys))
    end = rest.where(numbers[1] == edge).withColumn("_place", place).where(F.col("_place") <= left - before)
    return whole.unionByName(middle).unionByName(end.select(*df.columns))


def with_available_stock(stock: DataFrame) -> DataFrame:
    left = F.col("CurrentStock") - F.col("ReservedStock")
    return stock.withColumn("AvailableStock", F.when(left < 0, 0).otherwise(left))


def with_inventory_value(stock: DataFrame, products: DataFrame) -> DataFrame:
    cost = products.select("ProductID", F.col("UnitCost").alias("_cost"))
    value = (F.col("CurrentStock") * F.col("_cost")).cast(MONEY)
    return stock.join(cost, "ProductID").withColumn("InventoryValue", value).drop("_cost")


def with_coverage(stock: DataFrame, demand: DataFrame) -> DataFrame:
    """Days the available stock lasts, to one digit; 999 without demand."""
    days = ratio(
        F.col("AvailableStock") * F.col("DemandDays"), F.col("DemandQuantity"), 1, MONEY
    )
    # Written first: the planner then knows how small it is and leaves the stock where it is.
    known = materialize(demand.select("ProductID", "DemandQuantity", "DemandDays"), "demand")
    return (
        stock.join(known, "ProductID")
        .withColumn(
            "StockCoverageDays",
            F.when(F.col("DemandQuantity") > 0, days).otherwise(F.lit(999).cast(MONEY)),
        )
        .drop("DemandQuantity", "DemandDays")
    )


def with_source_status(stock: DataFrame, out: str = "RiskStatus") -> DataFrame:
    """As in the inventory view, except that only exactly no stock is a stockout."""
    return stock.withColumn(out, stock_status(F.col("AvailableStock") == 0))


def utilization(stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Stock of a warehouse and day over its capacity, at most 100 %: a row per warehouse and day."""
    held = stock.groupBy("WarehouseID", "SnapshotDate").agg(
        F.coalesce(F.sum("CurrentStock"), F.lit(0)).alias("_held")
    )
    full = F.lit(100).cast("decimal(6,2)")
    share = percent(F.col("_held"), F.col("Capacity"), "decimal(28,2)")
    used = (
        F.when(F.col("Capacity").isNull(), None)
        .when(F.col("Capacity") == 0, F.when(F.col("_held") > 0, full))
        .otherwise(F.least(share, full))
    )
    return held.join(warehouses.select("WarehouseID", "Capacity"), "WarehouseID", "left").select(
        "WarehouseID",
        "SnapshotDate",
        used.cast("decimal(6,2)").alias("WarehouseUtilizationPct"),
    )


def with_utilization(stock: DataFrame, warehouses: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Stock rows with the rate of their warehouse and day, from ``rates`` if they are written already."""
    rates = materialize(utilization(stock, warehouses), "rates") if rates is None else rates
    return stock.join(rates, ["WarehouseID", "SnapshotDate"], "left")


# --- inspections -------------------------------------------------------------------


def with_inspection_outcome(inspections: DataFrame) -> DataFrame:
    """Accepted, rejected and score from inspected and defect quantity."""
    inspected = F.col("InspectedQuantity")
    accepted = inspected - F.col("DefectQuantity")
    score = percent(accepted, inspected, "decimal(5,2)")
    return inspections.withColumns(
        {
            "AcceptedQuantity": accepted,
            "RejectedQuantity": F.col("DefectQuantity"),
            "QualityScore": F.when(inspected > 0, score).otherwise(
                F.lit(0).cast("decimal(5,2)")
            ),
        }
    )


def with_inspection_result(inspections: DataFrame, out: str = "InspectionResult") -> DataFrame:
    return inspections.withColumn(
        out, bands(F.col("QualityScore"), INSPECTION_BANDS, INSPECTION_FLOOR)
    )
