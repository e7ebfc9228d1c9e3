"""Profiling statistics on the small fixtures of FIXTURES.md section 3."""

import pytest

from policypanel.operators.profiling import (
    describe_numeric,
    distinct_counts,
    key_counts_lexical,
    modes,
    null_counts,
    profile,
    row_audit,
    summary_stats,
    value_counts,
)
from pyspark.sql import functions as F


def test_median_is_an_element(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    r = summary_stats(df, ["x"]).first()
    assert r.median == 2.0 and r.mean == 2.5
    assert r.stddev == pytest.approx(1.2909944487358056)


def test_mode_null_group_is_eligible(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "x int")
    r = modes(df, ["x"]).first()
    assert r.mode is None and r.mode_count == 2


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,)], "x int")
    r = modes(df, ["x"]).first()
    assert r.mode == 1.0 and r.mode_count == 2


def test_distinct_counts_null_is_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None), (2, "b")], "x int, s string")
    got = {r.column: r.distinct_values for r in distinct_counts(df, ["x", "s"]).collect()}
    assert got == {"x": 3, "s": 3}


def test_lexical_key_order(spark):
    df = spark.createDataFrame([(2,), (10,), (1,), (None,)], "k int")
    got = [(r.k, r["count"]) for r in key_counts_lexical(df, "k").collect()]
    assert got == [(None, 1), ("1", 1), ("10", 1), ("2", 1)]


def test_null_and_blank_counts(spark):
    df = spark.createDataFrame([(None, "a"), (1, " "), (2, None)], "x int, s string")
    got = {r.column: (r.nulls, r.null_or_blank) for r in null_counts(df).collect()}
    assert got == {"x": (1, 1), "s": (1, 2)}


def test_row_audit_one_pass(spark):
    df = spark.range(10)
    out = row_audit(df, {"raw": F.lit(True), "even": F.col("id") % 2 == 0,
                         "small_even": (F.col("id") % 2 == 0) & (F.col("id") < 5)}).collect()
    assert [(r.stage, r.rows) for r in out] == [("raw", 10), ("even", 5), ("small_even", 3)]


def test_value_counts_and_describe(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, None)], "s string, x double")
    vc = {(r.column, r.value): r["count"] for r in value_counts(df, ["s"]).collect()}
    assert vc == {("s", "a"): 2, ("s", None): 1}
    d = describe_numeric(df, ["x"]).first()
    assert (d["count"], d.mean, d.min, d.max) == (2, 2.0, 1.0, 3.0)


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, "ab"), (None, "abcd"), (3, None)], "x int, s string")
    got = {r.column: r for r in profile(df).collect()}
    assert got["x"].nulls == 1 and got["x"].distinct_values == 3
    assert (got["x"].min_value, got["x"].max_value) == (1.0, 3.0)
    assert (got["s"].min_len, got["s"].max_len) == (2, 4) and got["s"].min_value is None


@pytest.mark.parametrize("accuracy", [100, 10000])
def test_approx_median_within_rank_error(spark, accuracy):
    """The sketch median is an element whose rank is within n / accuracy of n / 2."""
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_extendedprice")
    n = df.count()
    m = summary_stats(df, ["l_extendedprice"], accuracy=accuracy).first().median
    below = df.filter(F.col("l_extendedprice") < m).count()
    upto = df.filter(F.col("l_extendedprice") <= m).count()
    slack = n / accuracy + 1
    assert upto >= n / 2 - slack and below <= n / 2 + slack


def test_approx_distinct_counts_close_to_exact(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    cols = ["l_partkey", "l_returnflag", "l_quantity"]
    exact = {r.column: r.distinct_values for r in distinct_counts(df, cols).collect()}
    approx = {r.column: r.distinct_values for r in distinct_counts(df, cols, approx=True).collect()}
    for c in cols:
        assert abs(approx[c] - exact[c]) <= max(2, 0.05 * exact[c]), (c, approx[c], exact[c])
