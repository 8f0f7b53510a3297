import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskmart.operators import ranks
from riskmart.operators.ranks import (
    Ranking,
    _attach,
    dense_keys,
    ordered_keys,
    rank_keys,
    with_global_rank,
    with_ranks,
)


def rows_with_ties(spark, n=4000):
    """A third of the rows share one key; some keys are missing."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 97 == 0, None).otherwise(i % 701 - 350)
    return spark.range(n).select(i, key.cast("decimal(18,2)").alias("k"))


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("mode", ["rank", "percent_rank"])
def test_global_rank_equals_window(spark, ascending, few, mode):
    df = rows_with_ties(spark)
    ranking = Ranking("k", "r", ascending, mode, few)
    got = with_ranks(df, [ranking]) if few else with_global_rank(df, ranking)
    order = F.col("k").asc_nulls_first() if ascending else F.col("k").desc_nulls_last()
    place = F.rank().over(Window.orderBy(order))
    if mode == "percent_rank":
        place = F.round(((place - 1) * 100).cast("decimal(20,0)") / (4000 - 1), 2)
    want = df.withColumn("w", place)
    wrong = got.join(want.select("id", "w"), "id").where(~F.col("r").eqNullSafe(F.col("w")))
    assert got.count() == 4000
    assert wrong.count() == 0


def test_rank_of_text_and_of_identical_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("b",), (None,)], "k string")
    got = with_global_rank(df, Ranking("k", "r"))
    assert sorted((r.k or "", r.r) for r in got.collect()) == [
        ("", 1), ("a", 2), ("b", 3), ("b", 3), ("b", 3),
    ]


@pytest.mark.parametrize("keys", [[1], [5, 5, 5]])
def test_percent_rank_of_one_row_or_equal_rows_is_zero(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    for few in (True, False):
        r = Ranking("k", "r", True, "percent_rank", few)
        assert {x.r for x in with_global_rank(df, r).collect()} == {0}
        assert {x.r for x in with_ranks(df, [r]).collect()} == {0}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int")
    assert with_global_rank(df, Ranking("k", "r")).count() == 0


def test_ranks_of_several_kinds_in_one_pass(spark):
    """Counts, decimals of two scales, floats and text: every rank is that of its own column."""
    i = F.col("id")
    df = spark.range(600).select(
        "id", (i % 7).alias("n"), F.when(i % 11 > 0, i % 13).cast("decimal(10,2)").alias("d"), (i % 3 / 4).cast("decimal(6,3)").alias("e"),
        (i % 5).cast("double").alias("f"), F.when(i % 4 > 0, F.format_string("t%d", i % 6)).alias("t"), (i % 97).cast("decimal(18,2)").alias("_n"),
    )
    specs = [("n", True, "rank"), ("d", False, "percent_rank"), ("e", True, "percent_rank"), ("f", False, "rank"), ("t", True, "rank")]
    got = with_ranks(df, [Ranking(k, f"r_{k}", up, mode, few=True) for k, up, mode in specs] + [Ranking("_n", "r_many", True)])
    for k, up, mode in [*specs, ("_n", True, "rank")]:
        out = "r_many" if k == "_n" else f"r_{k}"
        order = F.col(k).asc_nulls_first() if up else F.col(k).desc_nulls_last()
        place = F.rank().over(Window.orderBy(order))
        want = F.round(((place - 1) * 100).cast("decimal(20,0)") / 599, 2) if mode == "percent_rank" else place
        assert got.withColumn("w", want).where(~F.col(out).eqNullSafe(F.col("w"))).count() == 0, k
    assert got.columns == [*df.columns, *(f"r_{k}" for k, _, _ in specs), "r_many"]


def test_too_many_values_are_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW_VALUES", 100)
    assert with_ranks(spark.range(100), [Ranking("id", "r", few=True)]).count() == 100
    with pytest.raises(Exception, match="too many to broadcast"):
        with_ranks(spark.range(101), [Ranking("id", "r", few=True)]).collect()


def test_keys_of_all_ranks_are_counted_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS a", "id % 11 AS b", "id % 13 AS c")
    got = with_ranks(df, [Ranking(k, f"r_{k}", few=True) for k in "abc"])
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2 and final.count("Range (") == 2


def test_ranks_of_many_values_equal_those_of_few(spark):
    df = rows_with_ties(spark, 500)
    specs = [("k", "a", True, "rank"), ("k", "b", False, "percent_rank")]
    many, few = ({tuple(r) for r in with_ranks(df, [Ranking(*s, few) for s in specs]).collect()} for few in (False, True))
    assert many == few and len(many) == 500


@pytest.mark.parametrize("hot", [0, None])
def test_no_task_gets_the_rows_of_a_hot_key(spark, hot):
    """Half of the rows hold one key, nothing is broadcast on its own: shares stay near 4/P."""
    n, parts = 40_000, 32
    i = F.col("id")
    key = F.when(i % 2 == 0, F.lit(hot)).otherwise(i + 1).cast("bigint")
    settings = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, n, 1, parts).select("id", key.alias("k"))
        got = with_global_rank(df, Ranking("k", "r"))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == n and max(sizes) < 4 * n / parts
        order = Window.orderBy(F.col("k").asc_nulls_first())
        want = df.withColumn("w", F.rank().over(order)).select("id", "w")
        assert got.join(want, "id").where("r <> w").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_row_without_a_rank_is_an_error(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    found, total, _ = rank_keys(df.where("k < 4"), "k")
    with pytest.raises(Exception, match="without a rank"):
        _attach(df, found, "k", total).collect()


def test_ordered_keys(spark):
    df = spark.range(1000).select(F.format_string("ID%05d", 999 - F.col("id")).alias("n"), "id")
    got = ordered_keys(df, "n", "key")
    assert [(r.key, r.n) for r in got.orderBy("key").collect()] == [
        (i + 1, f"ID{i:05d}") for i in range(1000)
    ]


def test_ordered_keys_stay_unique_with_equal_ids(spark):
    df = spark.range(300).select(F.lit("same").alias("n"), (F.col("id") % 7).alias("x"))
    got = ordered_keys(df, "n", "key")
    assert sorted(r.key for r in got.collect()) == list(range(1, 301))


def test_dense_keys(spark):
    got = dense_keys(spark.range(0, 1234, 1, 7), "key")
    assert sorted(r.key for r in got.collect()) == list(range(1, 1235))
