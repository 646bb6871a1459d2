"""Golden values of the pricing rules, run through the real column functions on
one-row DataFrames (classification, range, confidence, yield, liquidity)."""

import math

import pytest
from pyspark.sql import functions as F

from pricelens.functions import exprs as X


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys()))
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("asked,expected", [
    (250_000, "FAIRLY_PRICED"), (200_000, "UNDERPRICED"), (300_000, "OVERPRICED"),
    (220_000, "FAIRLY_PRICED"), (258_500, "FAIRLY_PRICED"), (258_501, "OVERPRICED"),
    (0, "UNDERPRICED"),
])
def test_classification(spark, asked, expected):
    v = one(spark, X.verdict("a", "lo", "hi"), a=float(asked), lo=220_000.0, hi=258_500.0)
    assert v == expected


def test_fair_range_example(spark):
    df = spark.createDataFrame([(4000.0, 4700.0, 4300.0, 55.0)], ["q25", "q75", "med", "s"])
    r = df.select(X.fair_bound("q25", "s").alias("low"), X.fair_bound("q75", "s").alias("high"),
                  X.fair_bound("med", "s").alias("est")).first()
    assert (r.low, r.high, r.est) == (220_000.0, 258_500.0, 236_500.0)


def test_fair_range_zero_surface(spark):
    df = spark.createDataFrame([(4000.0, 4700.0, 4300.0, 0.0)], ["q25", "q75", "med", "s"])
    r = df.select(X.fair_bound("q25", "s").alias("low"), X.fair_bound("med", "s").alias("est")).first()
    assert r.low == 0 and r.est == 0


def test_fair_bound_half_even(spark):
    # Whole-euro rounding of the quote path is HALF_EVEN (as Python's round).
    assert one(spark, X.fair_bound("p", "s"), p=2.5, s=1.0) == 2.0
    assert one(spark, X.fair_bound("p", "s"), p=3.5, s=1.0) == 4.0


@pytest.mark.parametrize("n,tier", [(0, "LOW"), (29, "LOW"), (30, "MEDIUM"), (99, "MEDIUM"),
                                    (100, "HIGH"), (1250, "HIGH")])
def test_confidence(spark, n, tier):
    assert one(spark, X.confidence("n"), n=n) == tier


def test_yield_example(spark):
    v = one(spark, X.gross_yield("r", "m"), r=16.0, m=4300.0)
    assert abs(v - 0.0447) < 0.001 and v == round(16 * 12 / 4300, 4)


def test_yield_null_guards(spark):
    assert one(spark, X.gross_yield("r", "m"), r=16.0, m=0.0) is None
    df = spark.createDataFrame([(16.0, None), (None, 4300.0)], "r double, m double")
    assert [r.v for r in df.select(X.gross_yield("r", "m").alias("v")).collect()] == [None, None]


@pytest.mark.parametrize("n", [0, 999, 1250, 1_000_000])
def test_liquidity(spark, n):
    v = one(spark, X.liquidity_score("n"), n=n)
    assert v == round(min(1.0, math.log(n + 1) / math.log(1000)), 4)
    if n >= 999:
        assert 0.99 <= v <= 1.0


def test_rooms_bucket(spark):
    df = spark.createDataFrame([(r,) for r in [None, -1, 0, 1, 2, 3, 4, 5, 7]], "r int")
    got = [row.v for row in df.select(X.rooms_bucket("r").alias("v")).collect()]
    assert got == ["unknown", "unknown", "unknown", "1 room", "2 rooms", "3 rooms", "4 rooms",
                   "5+ rooms", "5+ rooms"]


def test_rent_for_type(spark):
    df = spark.createDataFrame([("Apartment",), ("House",), ("Other",)], ["t"])
    got = [r.v for r in df.select(X.rent_for_type("t", F.lit(15.8), F.lit(12.5)).alias("v")).collect()]
    assert got == [15.8, 12.5, 15.8]
