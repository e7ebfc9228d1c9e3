"""Collapse-by-key then unpivot equals the direct aggregate, hot key included."""

from pyspark.sql import functions as F

from policypanel.functions.columns import clean_int
from policypanel.operators.aggregate import collapse_by_key, unpivot_periods
from policypanel.operators.prepost import segment_pre_post


def _events(spark):
    # key 7 holds a third of all rows (a hot key); keys map to two labels
    rows = [(7, 2013 + (i % 3), i % 2, i % 5) for i in range(300)]
    rows += [(k, 2013 + (k % 3), 1, k % 4) for k in range(600)]
    return spark.createDataFrame(rows, "k int, year int, killed int, injured int")


def test_collapse_then_unpivot_is_exact(spark):
    ev = _events(spark)
    labels = spark.createDataFrame([(k, "A" if k % 2 else "B") for k in range(600)],
                                   "k int, label string")
    wide = collapse_by_key(ev, "k", "year", [2013, 2014, 2015], {"killed": "killed"})
    facts = unpivot_periods(wide.join(labels, "k", "left"), ["label"], [2013, 2014, 2015],
                            ["killed"])
    got = {(r.label, r.year): (r.n, r.killed)
           for r in facts.groupBy("label", "year").agg(F.sum("n").alias("n"),
                                                       F.sum("killed").alias("killed")).collect()}
    direct = ev.join(labels, "k", "left").groupBy("label", "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("killed").alias("killed"))
    want = {(r.label, r.year): (r.n, r.killed) for r in direct.collect()}
    assert got == want


def test_operator_on_collapsed_facts_equals_raw(spark):
    ev = _events(spark).withColumn("era", F.when(F.col("year") >= 2014, "post").otherwise("pre"))
    ev = ev.withColumn("seg", F.when(F.col("k") % 3 == 0, "x").otherwise("y"))
    raw = segment_pre_post(ev, "seg", {"killed": "killed", "injured": "injured"})
    facts = (ev.groupBy("seg", "era", "year")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("killed").alias("killed"),
                  F.sum("injured").alias("injured")))
    agg = segment_pre_post(facts, "seg", {"killed": "killed", "injured": "injured"},
                           count_col="n")
    assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, agg.collect()))


def test_clean_int(spark):
    df = spark.createDataFrame([(" 12 ",), ("Unspecified",), ("3.5",), (None,)], "s string")
    assert [r[0] for r in df.select(clean_int("s")).collect()] == [12, None, None, None]


def test_cluster_settings_scale_partitions():
    from policypanel.session import cluster_settings
    big = cluster_settings(100 * 10**12, executors=1000)
    assert int(big["spark.sql.shuffle.partitions"]) >= 100 * 10**12 // (256 << 20)
    small = cluster_settings(10**6, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 80      # 2 x task slots
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_collapse_with_text_periods(spark):
    df = spark.createDataFrame([(1, "2014-01", 2), (1, "2014-01", 3), (2, "o'k", 5)],
                               "k int, month string, v int")
    wide = collapse_by_key(df, "k", "month", ["2014-01", "o'k"], {"v": "v"})
    long = unpivot_periods(wide, ["k"], ["2014-01", "o'k"], ["v"], period="month")
    assert sorted(map(tuple, long.collect())) == [(1, "2014-01", 2, 5), (2, "o'k", 1, 5)]


def test_year_masks_count_the_years_of_each_era(spark):
    from policypanel.operators.aggregate import collapse_by_era, unpivot_periods, years_from_masks
    rows = [(k, y, "pre" if y < 1998 else "post", v) for k, y, v in [
        ("a", 1995, 1), ("a", 1995, 2), ("a", 1999, 4), ("b", 1996, 8), (None, 1998, 16), (None, 2000, 32), ("c", 1999, None)]]
    df = spark.createDataFrame(rows, "k string, year int, era string, v int")
    wide = collapse_by_era(df, "k", "era", "year", 1995, 2000, {"v": "v"})
    assert {r["k"]: (r["n_pre"], r["n_post"], r["v_pre"], r["v_post"]) for r in wide.collect()} == {
        "a": (2, 1, 3, 4), "b": (1, 0, 8, None), None: (0, 2, None, 48), "c": (0, 1, None, None)}
    cells = unpivot_periods(wide, ["k"], ["pre", "post"], ["v", "years_mask"], period="era")
    assert {r["era"]: r["years_in_era"] for r in years_from_masks(cells).collect()} == {"pre": 2, "post": 3}
    # masks merge: the years of one key are those of all its rows
    per_key = {(r["k"], r["era"]): bin(r["years_mask"]).count("1") for r in cells.collect()}
    assert per_key == {("a", "pre"): 1, ("a", "post"): 1, ("b", "pre"): 1, (None, "post"): 2, ("c", "post"): 1}


def test_a_window_beyond_the_mask_raises(spark):
    import pytest

    from policypanel.operators.aggregate import collapse_by_era
    df = spark.createDataFrame([("a", 1900, "pre")], "k string, year int, era string")
    with pytest.raises(ValueError):
        collapse_by_era(df, "k", "era", "year", 1900, 1963, {})
    assert collapse_by_era(df, "k", "era", "year", 1900, 1962, {}).first()["years_mask_pre"] == 1
