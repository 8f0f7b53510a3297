"""Dimension tables, the calendar, and corrections in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.domains import CALENDAR
from riskmart.operators.ranks import ordered_keys
from riskmart.sources.schemas import DIMENSIONS, STAGED


def build_dimension(staged: DataFrame, name: str) -> DataFrame:
    """Staged columns plus an integer key in the order of the natural id."""
    dim = DIMENSIONS[name]
    return ordered_keys(staged.select(*STAGED[dim.staged]), dim.natural, dim.key)


def date_dimension(
    spark: SparkSession, start: str | Column = CALENDAR[0], end: str | Column = CALENDAR[1]
) -> DataFrame:
    """One row per day; the ends may be scalar subqueries. Week 1 holds January 1st and weeks start on Sunday."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("FullDate")
    )
    d = F.col("FullDate")
    lead_days = F.dayofweek(F.trunc(d, "year")) - 1
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("DateKey"),
        "FullDate",
        F.dayofmonth(d).alias("DayNumber"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.month(d).alias("MonthNumber"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.quarter(d).alias("QuarterNumber"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("QuarterName"),
        F.year(d).alias("YearNumber"),
        (F.floor((F.dayofyear(d) - 1 + lead_days) / 7) + 1).cast("int").alias("WeekNumber"),
        F.dayofweek(d).isin(1, 7).alias("IsWeekend"),
    )


def correct_dimension(
    dim: DataFrame, corrections: DataFrame, natural: str, key: str
) -> DataFrame:
    """Overwrite the attributes of matched rows, NULLs included; keep keys and the rest."""
    twice = corrections.groupBy(natural).count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError(f"corrections hold a {natural} more than once")
    attributes = [c for c in dim.columns if c not in (key, natural)]
    new = corrections.select(
        natural,
        F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_new_{c}") for c in attributes],
    )
    joined = dim.join(new, natural, "left")
    return joined.select(
        key,
        natural,
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in attributes
        ],
    )


def supplier_lookup(dim_supplier: DataFrame, supplier_id: str) -> DataFrame:
    return dim_supplier.where(F.col("SupplierID") == supplier_id).select(
        "SupplierKey", "SupplierID", "SupplierName", "Country", "Region"
    )


def first_days(dim_date: DataFrame, n: int = 10) -> DataFrame:
    return dim_date.orderBy("FullDate").limit(n)
