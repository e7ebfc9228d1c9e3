"""Stored sketches: rank and set errors, merging, windows; frequent values."""

import bisect
import random
from collections import Counter

import pytest

from policypanel.operators import profiling as Pr
from policypanel.operators import sketches as Sk


def stored(spark, df, tmp_dir, name):
    df.write.parquet(f"{tmp_dir}/{name}")
    return spark.read.parquet(f"{tmp_dir}/{name}")


def test_merged_quantiles_keep_the_rank_error(spark, tmp_dir):
    path = "/root/testdata/sf0.1/lineitem.parquet"
    li = spark.read.parquet(path).selectExpr("year(l_shipdate) AS year", "l_extendedprice AS x")
    table = stored(spark, Sk.quantile_sketches(li, "year", ["x"]), tmp_dir, "q")
    windows = {"pre": (1995, 1997), "post": (1998, 2000)}
    got = Sk.window_quantiles(table, windows, [0.05, 0.5, 0.95]).collect()
    for name, (lo, hi) in windows.items():
        xs = sorted(r["x"] for r in li.where(f"year BETWEEN {lo} AND {hi}").collect())
        rows = {r["q"]: r for r in got if r["window"] == name}
        for q in (0.05, 0.5, 0.95):
            assert rows[q]["rows"] == len(xs)
            v = rows[q]["value"]
            assert bisect.bisect_left(xs, v) / len(xs) <= q + 0.001 and bisect.bisect_right(xs, v) / len(xs) >= q - 0.001
    plan = Sk.window_quantiles(table, windows, [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan


def test_quantiles_of_nulls_empty_windows_and_null_periods(spark, tmp_dir):
    rows = [(2000, 1.0, None), (2000, None, None), (2001, 3.0, None), (None, 99.0, None)]
    table = stored(spark, Sk.quantile_sketches(spark.createDataFrame(rows, "p int, x double, y double"), "p", ["x", "y"]), tmp_dir, "n")
    got = Sk.window_quantiles(table, {"both": (2000, 2001), "none": (2010, 2012)}, [0.0, 1.0]).collect()
    assert [(r["window"], r["column"], r["rows"], r["q"], r["value"]) for r in got] == [("both", "x", 2, 0.0, 1.0), ("both", "x", 2, 1.0, 3.0)]
    empty = Sk.quantile_sketches(spark.createDataFrame([], "p int, x double"), "p", ["x"])
    assert Sk.window_quantiles(empty, {"a": (0, 1)}, [0.5]).collect() == []


def test_sets_are_exact_below_the_sketch_size_with_null_as_a_value(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(40)]), rng.choice([0.0, -0.0, 1.5, None]), rng.choice(["a", "B", "", None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "p int, i int, d double, t string")
    got = {r["column"]: tuple(r)[1:] for r in Sk.distinct_sets(stored(spark, Sk.distinct_sketches(df, "p", ["i", "d", "t"]), tmp_dir, "d"), (1, 1), (2, 3)).collect()}
    for k, c in enumerate("idt", start=1):
        a, b = ({r[k] for r in rows if r[0] in w} for w in ((1,), (2, 3)))
        assert got[c] == (len(a), len(b), len(a | b), len(a & b), len(a - b), len(b - a))


def test_set_error_beyond_the_sketch_size(spark, tmp_dir):
    rows = spark.range(0, 90_000).selectExpr("id % 2 AS p", "id AS whole", "id DIV 2 AS pair")
    log = 12
    got = {r["column"]: r.asDict() for r in Sk.distinct_sets(stored(spark, Sk.distinct_sketches(rows, "p", ["whole", "pair"], log), tmp_dir, "e"), (0, 0), (1, 1), log).collect()}
    want = {"whole": dict(pre=45_000, post=45_000, either=90_000, both=0, pre_only=45_000, post_only=45_000),
            "pair": dict(pre=45_000, post=45_000, either=45_000, both=45_000, pre_only=0, post_only=0)}
    for c, sets in want.items():
        for name, n in sets.items():
            assert abs(got[c][name] - n) <= Sk.set_error(log) * sets["either"], (c, name)


@pytest.mark.parametrize("share", [0.001, 0.02, 0.3, 1.0])
def test_frequent_values_are_whole_and_counted_exactly(spark, share):
    rng = random.Random(7)
    rows = [(int(rng.paretovariate(0.7)) % 100_000, rng.choice(["x", "X", None, ""]), float(rng.choice([0.0, -0.0, 2.5])), i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "z bigint, t string, d double, id bigint").repartition(6)
    got = {(r["column"], r["value"]): r["count"] for r in Pr.frequent_values(df, ["z", "t", "d", "id"], share).collect()}
    want = {}
    for k, c in enumerate(["z", "t", "d", "id"]):
        counts = Counter(r[k] + 0.0 if c == "d" else r[k] for r in rows)
        want |= {(c, None if v is None else str(v)): n for v, n in counts.items() if n >= share * len(rows)}
    assert got == want


def test_modes_of_a_key_shuffle_candidates_only(spark):
    df = spark.range(0, 50_000).selectExpr("id", "id % 7 AS seven")
    out = Pr.frequent_modes(df, ["id", "seven"], 0.05)
    assert [tuple(r) for r in out.collect()] == [("id", None, None), ("seven", "0", 7143)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert Pr.frequent_values(df.where("id < 0"), ["id"], 0.5).collect() == []


def test_profile_reads_once_and_keeps_types(spark):
    rows = [(1, 2.5, "aa", None), (None, -0.0, "", None), (1, 0.0, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, t string, n string")
    got = {r["column"]: tuple(r)[1:] for r in Pr.profile(df).collect()}
    assert got == {"i": (3, 1, 2, 1.0, 1.0, None, None), "d": (3, 0, 2, 0.0, 2.5, None, None),
                   "t": (3, 1, 3, None, None, 0, 2), "n": (3, 3, 1, None, None, None, None)}
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    assert Pr.profile(part)._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 1
    assert {r["column"]: r["rows"] for r in Pr.profile(df.where("i > 5")).collect()} == dict.fromkeys("idtn", 0)
