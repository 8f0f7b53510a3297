"""Typed projection of raw text. A value that does not convert becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.schemas import STAGED

# Fixed pattern: the one accepted date form, year-month-day.
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"


def parse(c: Column, kind: str) -> Column:
    if kind == "string":
        return c
    if kind == "date":
        # The cast alone would also take a bare year, or a date with a time.
        return F.when(c.rlike(ISO_DATE), c.try_cast("date"))
    return c.try_cast(kind)


def typed_columns(table: str) -> dict[str, str]:
    return {c: kind for c, kind in STAGED[table].items() if kind != "string"}


def stage(raw: DataFrame, table: str) -> DataFrame:
    return raw.select(*[parse(F.col(c), kind).alias(c) for c, kind in STAGED[table].items()])
