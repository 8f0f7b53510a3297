"""Fact tables: natural ids and dates replaced by dimension keys.

Joins carry no broadcast hints. Dimensions below the session's broadcast limit are
broadcast by their real size. Larger ones are hashed partition by partition, so that the
fact is not sorted, or take a sort-merge join where a partition of them is not small.
Adaptive execution splits a key that holds much of the fact in both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.ranks import dense_keys
from riskmart.sources.schemas import DIMENSIONS, FACTS, record_ids


#: Bytes of a shuffle partition of a table that is hashed, as it is stored; a task's hash table takes many times that.
HASHED_BYTES = 2 << 20


def stored_bytes(df: DataFrame) -> int:
    """What Spark expects ``df`` to take, by the files that it is read from."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def looked_up(dim: DataFrame) -> DataFrame:
    """``dim`` as the side of a join that is hashed, if it is too large to broadcast and its partitions are small."""
    conf = dim.sparkSession._jsparkSession.sessionState().conf()
    broadcast = conf.autoBroadcastJoinThreshold()
    small = min(broadcast, HASHED_BYTES) * conf.numShufflePartitions()
    return dim.hint("shuffle_hash") if broadcast < stored_bytes(dim) <= small else dim


def matched(staged: DataFrame, dims: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Staged rows that find every dimension and have every date in the calendar.

    The calendar comes first and the largest dimension last: fewer and narrower rows are shuffled.
    """
    fact = FACTS[name]
    out = staged
    for day, key in fact.dates.items():
        calendar = dims["DimDate"].select(F.col("FullDate").alias(day), F.col("DateKey").alias(key))
        out = out.join(calendar, day)
    partners = [dims[d].select(DIMENSIONS[d].natural, DIMENSIONS[d].key) for d in fact.dimensions]
    for partner in sorted(partners, key=stored_bytes):
        out = out.join(looked_up(partner), partner.columns[0])
    return out


def build_fact(staged: DataFrame, dims: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Fact rows without their own surrogate key."""
    fact = FACTS[name]
    return matched(staged, dims, name).select(
        *record_ids(fact),
        *[DIMENSIONS[d].key for d in fact.dimensions],
        *fact.dates.values(),
        *fact.measures,
    )


def with_fact_key(rows: DataFrame, name: str, dense: bool = True) -> DataFrame:
    """Number the rows 1..n, or with gaps, which saves writing the fact twice."""
    key = FACTS[name].key
    if dense:
        return dense_keys(rows, key)
    return rows.select((F.monotonically_increasing_id() + 1).alias(key), *rows.columns)
