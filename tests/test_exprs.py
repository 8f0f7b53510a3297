from decimal import ROUND_HALF_UP
from decimal import Decimal as D
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions.exprs import bands, mean, money_sum, percent, ratio, weighted


def half_up(num, den, digits):
    q = Fraction(num) / Fraction(den) * 10**digits
    whole = int(abs(q) + Fraction(1, 2))
    return D(whole if q >= 0 else -whole).scaleb(-digits)


def test_ratio_matches_exact_arithmetic(spark):
    pairs = st.lists(
        st.tuples(st.integers(-(10**9), 10**9), st.integers(1, 10**9)), min_size=30, max_size=60
    )

    @settings(max_examples=8, deadline=None)
    @given(pairs)
    def run(rows):
        df = spark.createDataFrame(rows, "n bigint, d bigint").select(
            "n", "d", ratio(F.col("n"), F.col("d"), 2, "decimal(18,2)").alias("r")
        )
        for r in df.collect():
            assert r.r == half_up(r.n, r.d, 2), r

    run()


@pytest.mark.parametrize(
    "num,den,want",
    [(1, 800, "0.13"), (-1, 800, "-0.13"), (1, 3, "33.33"), (2, 3, "66.67"), (0, 5, "0.00"),
     (5, 0, None), (None, 5, None), (1, 200, "0.50"), (201, 20000, "1.01")],
)
def test_percent_edges(spark, num, den, want):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    got = df.select(percent(F.col("n"), F.col("d")).alias("p")).first().p
    assert got == (None if want is None else D(want))


def test_ratio_with_negative_divisor(spark):
    df = spark.createDataFrame([(7, -2)], "n bigint, d bigint")
    assert df.select(ratio(F.col("n"), F.col("d"), 0).alias("r")).first().r == D("-4.00")


def test_money_sum_and_mean(spark):
    rows = [(D("0.01"),), (D("9999999999999.99"),), (None,), (D("-5.10"),)]
    df = spark.createDataFrame(rows, "v decimal(18,2)")
    got = df.agg(money_sum(F.col("v")).alias("s"), F.count("v").alias("n"))
    row = got.select("s", mean(F.col("s"), F.col("n"), "decimal(18,2)").alias("m")).first()
    total = D("9999999999994.90")
    assert row.s == total
    assert row.m == (total / 3).quantize(D("0.01"), ROUND_HALF_UP)
    assert df.where("v is null").agg(money_sum(F.col("v")).alias("s")).first().s is None


def test_bands_are_inclusive_and_null_falls_through(spark):
    df = spark.createDataFrame(
        [(D("75.00"),), (D("74.99"),), (D("50.00"),), (D("24.99"),), (None,)], "s decimal(10,2)"
    )
    label = bands(F.col("s"), [(75, "a"), (50, "b"), (25, "c")], "d")
    assert [r.x for r in df.select(label.alias("x")).collect()] == ["a", "b", "b", "d", "d"]


def test_weighted_rounds_once(spark):
    df = spark.createDataFrame([(D("33.33"), D("33.35"))], "a decimal(10,2), b decimal(10,2)")
    got = df.select(weighted([("a", "0.50"), ("b", "0.50")]).alias("w")).first().w
    assert got == D("33.34")
