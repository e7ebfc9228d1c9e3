"""The hostile entries have rows for every filter: without one of them the result differs from the SQL."""

import pytest
from pyspark.sql import functions as F

from policypanel.operators import clean as C
from policypanel.operators import prepost as P
from policypanel.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def result(spark, name):
    df = QUERIES[name](spark, SF)
    return sorted(map(str, df.collect()))


CASES = {
    "F1 blank dates": ("events_clean_hostile", C, "drop_blank", lambda df, *_: df),
    "F2 missing tokens": ("events_clean_hostile", C, "drop_missing", lambda df, *_: df),
    "P11 keys": ("events_clean_hostile", C, "normalise_key", lambda c: F.col(c)),
    "F8 critical nulls": ("panel_clean_hostile", type("Na", (), {}), "drop", None),
    "P6 flag": ("events_wide", C, "flag", lambda c: F.lit(1)),
    "P12 dates": ("events_prepare_hostile", C, "event_date", lambda c, *_: F.coalesce(F.try_to_date(F.col(c), "MM/dd/yyyy"), F.lit("1999-01-01").cast("date"))),
    "F1 blank segments": ("segment_pre_post_hostile", P, "is_present", lambda c: F.lit(True)),
    "F10 missing factors": ("topk_shift_hostile", P, "is_missing_token", lambda *_: F.lit(False)),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_without_the_filter_the_result_differs(spark, monkeypatch, case):
    name, module, function, instead = CASES[case]
    want = result(spark, name)
    if instead is None:
        from policypanel.plans import roles as R
        monkeypatch.setattr(R, "PANEL_CRITICAL", ["l_orderkey"])
    else:
        monkeypatch.setattr(module, function, instead)
    assert result(spark, name) != want


def test_years_bound_counts_and_null_keys_matter(spark):
    rows = QUERIES["events_prepare_hostile"](spark, SF)
    first = rows.agg(F.min("year")).first()[0]
    assert first == 1996 and rows.where("quantity = 0").count() > 0
    years = {r["era"]: r["years_in_era"] for r in QUERIES["segment_pre_post_hostile"](spark, SF).select("era", "years_in_era").distinct().collect()}
    assert years == {"pre": 3, "post": 3}
    # the year without keys is in no segment
    assert {r["column"] for r in QUERIES["frequent_modes"](spark, SF).collect()} >= {"l_orderkey"}


def test_artefact_rows_are_there_to_drop(spark):
    from policypanel.plans import etl_queries as E
    with_all = []

    def keep(spark, table, not_null=()):
        with_all.append(spark.table(table).count())
        return spark.table(table).where("l_orderkey IS NOT NULL")

    E_scan, E.scan_table = E.scan_table, keep
    try:
        n = E.table_artefact_scan(spark, SF).count()
    finally:
        E.scan_table = E_scan
    assert with_all[0] > n
