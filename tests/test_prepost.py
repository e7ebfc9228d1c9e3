"""Within-unit pre/post operators on small hostile frames."""

import pytest
from pyspark.sql import functions as F

from policypanel import schemas
from policypanel.operators.prepost import (
    missing_share,
    pre_post_change,
    pre_post_summary,
    segment_pre_post,
    topk_shift,
    window_rate,
)
from policypanel.sources.tables import inline_table
from policypanel.functions.columns import era


def _events(spark, rows):
    """rows: (year, segment, factor, killed, injured)"""
    df = spark.createDataFrame(rows, "year int, seg string, factor string, killed int, injured int")
    return df.withColumn("era", era("year", 2014))


def test_topk_tie_at_the_cut_keeps_alphabetical_first(spark):
    rows = []
    # 14 clear leaders, then F15 and F16 tied (2 post rows each), then a pre-only factor
    for i in range(1, 15):
        rows += [(2015, "Q", f"F{i:02d}", 0, 0)] * (10 + i)
    rows += [(2015, "Q", "F16", 0, 0)] * 2 + [(2015, "Q", "F15", 0, 0)] * 2
    rows += [(2013, "Q", "PREONLY", 0, 0)] * 50 + [(2013, "Q", "F01", 1, 0)]
    rows += [(2015, "Q", f, 0, 0) for f in [None, "", " unspecified ", "Unspecified"]] * 30
    out = topk_shift(_events(spark, rows), "factor", {"killed": "killed"}, k=15).collect()
    factors = sorted({r.factor for r in out})
    assert "F15" in factors and "F16" not in factors and "PREONLY" not in factors
    assert "UNSPECIFIED" not in factors and "" not in factors
    assert len(factors) == 15
    eras = {(r.factor, r.era) for r in out}
    assert ("F01", "pre") in eras and ("F02", "pre") not in eras   # no pre rows: post only
    assert [(r.factor, r.era) for r in out] == sorted((r.factor, r.era) for r in out)


def test_no_pre_rows_gives_only_post(spark):
    df = _events(spark, [(2015, "Q", "x", 1, 2), (2016, "Q", "x", 0, 1)])
    out = pre_post_summary(df, {"killed_total": "killed"}).collect()
    assert [(r.era, r.crashes_total, r.years_in_era, r.crashes_per_year) for r in out] == [
        ("post", 2, 2, 1.0)]


def test_segment_years_are_global_and_unknown_segments_keep_null_rates(spark):
    rows = [(2013, "Brooklyn", "f", 1, 1), (2014, "BROOKLYN ", "f", 0, 2),
            (2015, "brooklyn", "f", 1, 0), (2016, "NULL", "f", 1, 1),
            (2016, None, "f", 1, 1), (2017, "  ", "f", 1, 1), (2018, "0", "f", 2, 0)]
    pop = inline_table(spark, schemas.BOROUGH_POPULATION, "segment string, population long")
    out = segment_pre_post(_events(spark, rows), "seg", {"killed": "killed", "injured": "injured"},
                           population=pop, pop_key="segment").collect()
    by = {(r.segment, r.era): r for r in out}
    assert set(by) == {("BROOKLYN", "pre"), ("BROOKLYN", "post"), ("NULL", "post"), ("0", "post")}
    # post years come from every row (2014-2018 = 5), not from Brooklyn's own rows
    assert by[("BROOKLYN", "post")].years_in_era == 5
    assert by[("BROOKLYN", "post")].killed_per_year == pytest.approx(1 / 5)
    assert by[("BROOKLYN", "post")].killed_per_100k_per_year == pytest.approx(
        (1 / 5) * 100000 / 2736074)
    assert by[("NULL", "post")].population is None
    assert by[("NULL", "post")].killed_per_100k_per_year is None


def test_missing_share(spark):
    rows = [(2014, "A", f, 0, 0) for f in [None, "", " unspecified ", "x", "y"]]
    rows += [(2014, "B", f, 0, 0) for f in ["x", "Unspecified"]]
    rows += [(2014, None, None, 0, 0)]
    out = missing_share(_events(spark, rows), "seg", "factor").collect()
    assert [(r.segment, r.total, r.unspecified) for r in out] == [("A", 5, 3), ("B", 2, 1)]
    assert out[0].unspecified_share == pytest.approx(0.6)


def test_window_rate_and_pre_post_change(spark):
    rows = [(y, "Q", "f", k, 0) for y, k in [(2017, 5), (2018, 1), (2018, 1), (2022, 3), (2023, 9)]]
    wr = window_rate(_events(spark, rows), "year", 2018, 2022, {"killed": "killed"},
                     "killed", "crashes", "rate").collect()
    assert [(r.year, r.crashes, r.killed, r.rate) for r in wr] == [
        (2018, 2, 2, 1000.0), (2022, 1, 3, 3000.0)]
    annual = spark.createDataFrame([(2013, 176), (2014, 133), (2015, 119)], "year int, ped int")
    ch = pre_post_change(annual, "year", ["ped"], 2014).first()
    assert ch.pre_mean == 176 and ch.post_mean == pytest.approx(126.0)
    assert ch.pct_drop == pytest.approx((176 - 126) / 176 * 100)
