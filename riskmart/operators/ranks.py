"""Ranks over a whole table, and dense keys, without one task holding the table.

A window without PARTITION BY moves every row to one task. Here ties collapse to one
row per key first. Keys that can only take few values (percentages, scores, counts) are
ranked among those values, all keys of a table in one pass. Other distinct keys are range-partitioned, and each partition
counts up from the number of rows in the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from riskmart.functions.exprs import ratio
from riskmart.sources.workspace import materialize


@dataclass(frozen=True)
class Ranking:
    """One rank column to add. NULL keys sort lowest.

    ``few`` says that the key takes few values however many rows there are: a percentage
    or score of two digits has some ten thousand, and counts that add up to N rows have at
    most the square root of 2 N.
    """

    key: str
    out: str
    ascending: bool = True
    mode: str = "rank"  # or "percent_rank": 0..100 with two digits
    few: bool = False


#: Values of a key that are broadcast at most; 2 ** 21 counts add up to over 10 ** 12 rows.
FEW_VALUES = 1 << 21


def _order(name: str, ascending: bool) -> Column:
    c = F.col(name)
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def _finish(rank: Column, rows: Column, mode: str) -> Column:
    if mode == "rank":
        return rank.cast("bigint")
    return F.coalesce(ratio((rank - 1) * 100, rows - 1), F.lit(0).cast("decimal(10,2)"))


def _ranges(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` range-partitioned and written, with the number of its range in _pid.

    The number is stored with the row, so that every later use sees the same one.
    """
    spread = df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id())
    return materialize(spread, "ranges")


def _range_starts(ranges: DataFrame, weight: Column) -> tuple[Column, int, int]:
    """Weight in the ranges before a row's own, total weight, and number of rows.

    Fetches two numbers per range, at most one for each shuffle partition.
    """
    sums = ranges.groupBy("_pid").agg(F.sum(weight).alias("w"), F.count(weight).alias("n"))
    found = {r["_pid"]: r for r in sums.collect()}
    starts, total = [], 0
    for pid in range(max(found, default=-1) + 1):
        starts.append(total)
        total += found[pid]["w"] if pid in found else 0
    listed = ",".join(f"{s}L" for s in starts) or "0L"
    start = F.expr(f"element_at(array({listed}), _pid + 1)")
    return start, total, sum(r["n"] for r in found.values())


def rank_keys(df: DataFrame, key: str, ascending: bool = True) -> tuple[DataFrame, int, int]:
    """One row per distinct key (_key, _n rows that hold it, _rank of those rows).

    Also the number of rows and of distinct keys.
    """
    order = _order("_key", ascending)
    ties = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    ranges = _ranges(ties, order)
    start, total, distinct = _range_starts(ranges, F.col("_n"))
    earlier = (
        Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return ranges.select("_key", "_n", (start + within + 1).alias("_rank")), total, distinct


def _attach(df: DataFrame, ranks: DataFrame, key: str, total: int) -> DataFrame:
    """Add _rank to every row of ``df`` by its key.

    A key held by more than 4/P of all rows is hot; there are fewer than P/4 such keys. They are
    broadcast, so their rows stay where they are, and only the other rows are shuffled by key.
    """
    same = F.col(key).eqNullSafe(F.col("_key"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col("_n") * parts > 4 * total
    hot = F.broadcast(ranks.where(is_hot).select("_key", "_rank"))
    cold = ranks.where(~is_hot).select("_key", "_rank")
    missing = F.raise_error(F.lit("a row came without a rank: the table changed while it was ranked"))
    spread = df.join(hot, same).drop("_key")
    rest = df.join(hot, same, "left_anti").join(cold, same, "left").drop("_key")
    return spread.unionByName(rest.withColumn("_rank", F.coalesce("_rank", missing.cast("bigint"))))


def attach_rank(df: DataFrame, key: str, ascending: bool = True) -> tuple[DataFrame, int]:
    """Rows with their _rank, and how many rows there are.

    ``df`` is evaluated for its keys and again for its rows: write it first if it is dear.
    """
    ranks, total, _ = rank_keys(df, key, ascending)
    return _attach(df, ranks, key, total), total


def with_global_rank(df: DataFrame, ranking: Ranking) -> DataFrame:
    """Add one rank over all rows, whatever their number and keys."""
    ranked, total = attach_rank(df, ranking.key, ranking.ascending)
    out = _finish(F.col("_rank"), F.lit(total), ranking.mode)
    return ranked.withColumn(ranking.out, out).drop("_rank")


def _comparable(df: DataFrame, rankings: Sequence[Ranking]) -> list[list[Ranking]]:
    """Rankings whose keys can share one column: numbers with numbers, others with their own type."""
    groups: dict[str, list[Ranking]] = {}
    for r in rankings:
        kind = df.schema[r.key].dataType
        groups.setdefault("number" if isinstance(kind, NumericType) else kind.simpleString(), []).append(r)
    return list(groups.values())


def _places(base: DataFrame, rankings: Sequence[Ranking], kind: DataType) -> DataFrame:
    """One row per value that a key takes (_key): its place in every ranking, then the number of rows (_places).

    All keys are counted in one aggregate and ordered by one window, partitioned by the ranking.
    """
    entries = [F.struct(F.lit(i).alias("_r"), F.col(r.key).cast(kind).alias("_key")) for i, r in enumerate(rankings)]
    counts = base.select(F.inline(F.array(*entries))).groupBy("_r", "_key").agg(F.count(F.lit(1)).alias("_n"))
    each = Window.partitionBy("_r")
    earlier = each.orderBy(_order("_key", True)).rowsBetween(Window.unboundedPreceding, -1)
    before, rows = F.coalesce(F.sum("_n").over(earlier), F.lit(0)), F.sum("_n").over(each)
    too_many = F.raise_error(F.lit("a key said to take few values takes too many to broadcast: rank it with few=False"))
    places = counts.select(
        "_r", "_key", "_n", before.alias("_before"), rows.alias("_rows"), F.count(F.lit(1)).over(each).alias("_values")
    ).withColumn("_before", F.when(F.col("_values") > FEW_VALUES, too_many.cast("bigint")).otherwise(F.col("_before")))
    up, down = F.col("_before") + 1, F.col("_rows") - F.col("_before") - F.col("_n") + 1
    found = [F.max(F.when(F.col("_r") == i, up if r.ascending else down)) for i, r in enumerate(rankings)]
    # One array, so that every lookup needs the same columns and the counts behind them are shared.
    return places.groupBy("_key").agg(F.array(*found, F.max("_rows")).alias("_places"))


def _with_ranks_of_few(df: DataFrame, base: DataFrame, rankings: Sequence[Ranking]) -> DataFrame:
    """Lazy: ``base`` is read once for the keys of all rankings, their places are looked up per row of ``df``."""
    out = df
    for group in _comparable(base, rankings):
        kind = base.select(F.coalesce(*[F.col(r.key) for r in group])).schema[0].dataType
        places = F.broadcast(_places(base, group, kind))
        for i, r in enumerate(group):
            same = F.col(r.key).cast(kind).eqNullSafe(F.col("_key"))
            rank = _finish(F.col("_places")[i], F.col("_places")[len(group)], r.mode)
            out = out.join(places, same, "left").withColumn(r.out, rank).drop("_key", "_places")
    return out


def with_ranks(df: DataFrame, rankings: Sequence[Ranking], written: bool = False) -> DataFrame:
    """Add several ranks, all of them taken from the same rows.

    ``df`` is evaluated for its rows and once for the keys of few values, however many rankings there are. With a
    key of many values it is written first, unless ``written`` says that reading it again is cheap.
    """
    few, many = ([r for r in rankings if r.few == kind] for kind in (True, False))
    base = df if written or not many else materialize(df, "ranked")
    out = base
    for r in many:
        ranks, total, _ = rank_keys(base, r.key, r.ascending)
        ranked = _attach(out, ranks, r.key, total)
        out = ranked.withColumn(r.out, _finish(F.col("_rank"), F.lit(total), r.mode)).drop("_rank")
    return _with_ranks_of_few(out, base, few).select(*df.columns, *[r.out for r in rankings])


def with_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add the grand total of a column, which is summed up before it meets the rows.

    ``df`` is evaluated for the total and for the rows: hand in sums that are written.
    """
    return df.withColumn(out, df.agg(F.sum(value)).scalar())


def ordered_keys(df: DataFrame, natural: str, out: str) -> DataFrame:
    """Integer keys 1..n in the order of a natural id, so that reruns agree."""
    # Equal ids are told apart by their content and may fall into different partitions.
    keyed = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    order = [F.col(natural).asc_nulls_first(), F.col("_tie")]
    ranges = _ranges(keyed, *order)
    start, _, _ = _range_starts(ranges, F.lit(1))
    place = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return ranges.select((start + place).cast("int").alias(out), *df.columns)


def dense_keys(df: DataFrame, out: str) -> DataFrame:
    """Keys 1..n for fact rows in storage order: one write, no shuffle, no sort."""
    local_bits = 33  # fixed layout of monotonically_increasing_id: partition, then row
    parts = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "keys")
    pid = F.shiftright("_at", local_bits)
    # One row per written partition: these stay in Spark, as a large load writes very many.
    counts = parts.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_pid", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << local_bits) - 1))
    return (
        parts.withColumn("_pid", pid)
        .join(F.broadcast(starts), "_pid")
        .select((F.col("_before") + local + 1).alias(out), *df.columns)
    )
