"""Hostile rows for the cleaning and preparation jobs (FIXTURES.md sections 1-2)."""

import datetime as dt

from pyspark.sql import functions as F

from policypanel import schemas
from policypanel.functions.columns import date_from_parts
from policypanel.operators.clean import clean_events, clean_panel, prepare_events, zero_fill


def _register_row(**kw):
    row = {c: 1 for c, _ in schemas.REGISTER_COLUMNS}
    row.update(LATITUDE=40.0, LONGITUD=-74.0, YEAR=2010, ST_CASE=1, STATE=36, CITY=4170)
    row.update(kw)
    return row


def _register_df(spark, rows):
    cols = [c for c, _ in schemas.REGISTER_COLUMNS]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schemas.register_schema())


def _clean(df):
    return clean_panel(df, "YEAR", schemas.REGISTER_WINDOW, schemas.REGISTER_CRITICAL,
                       schemas.REGISTER_SENTINELS, schemas.REGISTER_RANGES)


def test_sentinels_and_ranges(spark):
    rows = [_register_row(ST_CASE=i, HOUR=h, MINUTE=m, LATITUDE=lat, LONGITUD=lon)
            for i, (h, m, lat, lon) in enumerate([
                (99, 99, 0.0, 0.0), (5, 7, 16.9, 777.7777), (5, 7, 77.7777, -200.0),
                (5, 7, 17.0, -180.0), (5, 7, 77.0, 180.0), (5, 7, None, None)])]
    out = {r.ST_CASE: r for r in _clean(_register_df(spark, rows)).collect()}
    assert out[0].HOUR is None and out[0].MINUTE is None
    assert out[0].LATITUDE is None and out[0].LONGITUD is None
    assert out[1].HOUR == 5 and out[1].LATITUDE is None and out[1].LONGITUD is None
    assert out[2].LATITUDE is None and out[2].LONGITUD is None
    assert out[3].LATITUDE == 17.0 and out[3].LONGITUD == -180.0
    assert out[4].LATITUDE == 77.0 and out[4].LONGITUD == 180.0
    assert out[5].LATITUDE is None and out[5].LONGITUD is None


def test_critical_nulls_and_year_window(spark):
    rows = [_register_row(ST_CASE=1, YEAR=2004), _register_row(ST_CASE=2, YEAR=2025),
            _register_row(ST_CASE=3, YEAR=2005), _register_row(ST_CASE=4, YEAR=2024),
            _register_row(ST_CASE=5, FATALS=None), _register_row(ST_CASE=6, MONTH=None),
            _register_row(ST_CASE=7, CITY=None), _register_row(ST_CASE=None)]
    kept = sorted(r.ST_CASE for r in _clean(_register_df(spark, rows)).collect())
    assert kept == [3, 4, 7]
    assert _clean(_register_df(spark, rows)).columns == [c for c, _ in schemas.REGISTER_COLUMNS]


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2014, 5, 9), (2014, 5, 99), (2015, 2, 30), (2016, 2, 29),
                                (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(date_from_parts("y", "m", "d")).collect()]
    assert got == [dt.date(2014, 5, 9), None, None, dt.date(2016, 2, 29), None]


COLLISION_COLS = ["CRASH DATE", "BOROUGH", "CONTRIBUTING FACTOR VEHICLE 1",
                  "VEHICLE TYPE CODE 1", "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"]


def _collisions(spark, rows):
    ddl = ("`CRASH DATE` string, BOROUGH string, `CONTRIBUTING FACTOR VEHICLE 1` string, "
           "`VEHICLE TYPE CODE 1` string, `NUMBER OF PERSONS INJURED` int, "
           "`NUMBER OF PERSONS KILLED` int")
    return spark.createDataFrame(rows, ddl)


def test_clean_events_missing_tokens_and_normalisation(spark):
    rows = [("01/05/2014", b, "a, b", "SEDAN", None, 1) for b in
            [None, "", "  ", "NULL", "null", "0", "Brooklyn", "BROOKLYN ", "brooklyn"]]
    rows += [(None, "QUEENS", "x", "y", 1, 0), ("  ", "QUEENS", "x", "y", 1, 0),
             ("not a date", "QUEENS", "x", "y", 1, 0)]
    out = clean_events(_collisions(spark, rows), "CRASH DATE", "BOROUGH",
                       ["CONTRIBUTING FACTOR VEHICLE 1", "VEHICLE TYPE CODE 1"],
                       ["NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"])
    assert out.columns == ["crash_date", "borough", "contributing_factor_vehicle_1",
                           "vehicle_type_code_1", "number_of_persons_injured",
                           "number_of_persons_killed"]
    got = out.collect()
    assert sorted(r.borough for r in got) == ["BROOKLYN"] * 3 + ["QUEENS"]
    assert all(r.number_of_persons_injured is not None for r in got)
    # the cleaner keeps an unparsable date text
    assert any(r.crash_date == "not a date" for r in got)


def test_prepare_events_years_eras_and_zero_fill(spark):
    rows = [("12/31/2012", "Q", "f", "t", 1, 1), ("01/01/2013", "Q", "f", "t", None, None),
            ("06/15/2014", "Q", "f", "t", 2, 0), ("not a date", "Q", "f", "t", 1, 1),
            ("2014-01-05", "Q", "f", "t", 1, 1), (None, "Q", "f", "t", 1, 1)]
    out = prepare_events(_collisions(spark, rows), "CRASH DATE",
                         ["NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"],
                         cut=2014, year_min=2013)
    got = sorted((r.year, r.era, r.month, r["NUMBER OF PERSONS INJURED"]) for r in out.collect())
    assert got == [(2013, "pre", "2013-01", 0), (2014, "post", "2014-06", 2)]


def test_zero_fill_keeps_types(spark):
    df = spark.createDataFrame([(None, None)], "a int, b bigint")
    out = zero_fill(df, ["a", "b"])
    assert out.dtypes == [("a", "int"), ("b", "bigint")]
    assert out.first() == (0, 0)


def test_unparsable_date_with_ansi_does_not_fail(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("13/45/2014",), ("1/5/2014",)], "d string")
    from policypanel.functions.columns import event_date
    from pyspark.sql import types as T
    got = [r[0] for r in df.select(event_date("d", T.StringType())).collect()]
    assert got[0] is None
    assert df.select(F.count_if(F.lit(True))).first()[0] == 2


def test_clean_events_can_keep_a_parsed_date(spark):
    rows = [("01/05/2014", "QUEENS", "f", "t", 1, 0), ("not a date", "QUEENS", "f", "t", 1, 0)]
    out = clean_events(_collisions(spark, rows), "CRASH DATE", "BOROUGH",
                       ["CONTRIBUTING FACTOR VEHICLE 1"], ["NUMBER OF PERSONS INJURED"],
                       parsed_date="crash_day")
    got = sorted((r.crash_date, r.crash_day) for r in out.collect())
    assert got == [("01/05/2014", dt.date(2014, 1, 5)), ("not a date", None)]
