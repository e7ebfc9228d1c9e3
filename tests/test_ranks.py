"""Exact quantiles by rank selection against sorting."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest

from policypanel.operators import ranks

QS = [0.0, 0.01, 0.07, 0.25, 0.5, 0.75, 0.999, 1.0]


def sorted_value(values, q):
    xs = sorted(v for v in values if v is not None)
    return None if not xs else float(xs[max(1, math.ceil(Fraction(repr(q)) * len(xs))) - 1])


def columns():
    rng = random.Random(4)
    n = 3000
    return {
        "normal": [rng.gauss(0, 1) for _ in range(n)],
        "heavy": [rng.choice([0.0, -0.0, 5.0, 5.0, 5.0, rng.random()]) for _ in range(n)],
        "one": [3.5] * n,
        "two": [1.0 if i % 2 else 9.0 for i in range(n)],
        "nulls": [None if i % 3 else float(i) for i in range(n)],
        "none": [None] * n,
        "ends": [-1e300 if i % 5 == 0 else 1e300 if i % 5 == 1 else float(i) for i in range(n)],
    }


@pytest.mark.parametrize("accuracy, few", [(ranks.ACCURACY, ranks.FEW), (20, 10)])
def test_equal_to_sorting(spark, accuracy, few):
    cols = columns()
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(7)
    got = {(r["column"], r["q"]): (r["rows"], r["value"]) for r in ranks.exact_quantiles(df, list(cols), QS, accuracy, few).collect()}
    assert got == {(c, q): (sum(v is not None for v in vs), sorted_value(vs, q)) for c, vs in cols.items() for q in QS}


def test_whole_numbers_beyond_doubles_and_decimals_keep_their_order(spark):
    base = 2**60
    rows = [(base + i, Decimal(i) / 100) for i in range(200)]
    df = spark.createDataFrame(rows, "big bigint, price decimal(20,2)")
    search = {(r["column"], r["q"]): r["value"] for r in ranks.exact_quantiles(df, ["big", "price"], [0.5], 100, 5).collect()}
    assert search[("big", 0.5)] == float(base + 99) and search[("price", 0.5)] == 0.99


def test_empty_table_and_bad_quantiles(spark):
    df = spark.createDataFrame([], "x double, column string")
    assert [tuple(r) for r in ranks.exact_quantiles(df, ["x"], [0.5]).collect()] == [("x", 0.5, 0, None)]
    with pytest.raises(ValueError):
        ranks.exact_quantiles(df, ["x"], [1.5])


def test_median_at_the_larger_scale_equals_sorting(spark):
    import duckdb
    path = "/root/testdata/sf0.1/lineitem.parquet"
    got = {r["column"]: r["value"] for r in ranks.exact_quantiles(spark.read.parquet(path), ["l_quantity", "l_discount", "l_tax"]).collect()}
    want = duckdb.sql(f"SELECT quantile_disc(l_quantity, 0.5), quantile_disc(l_discount, 0.5), quantile_disc(l_tax, 0.5) FROM '{path}'").fetchall()[0]
    assert (got["l_quantity"], got["l_discount"], got["l_tax"]) == want
