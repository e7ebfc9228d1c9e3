"""CSV sources with drifted headers, sinks and catalog registration round trips."""

import glob
import os

from pyspark.sql import functions as F

from policypanel import schemas, sinks
import pytest

from policypanel.sources.csv import normalise_header, read_csv, read_yearly, resolve_header

CANON = {"ST_CASE": "int", "STATE": "int", "LATITUDE": "double", "LONGITUD": "double"}


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def test_resolve_header_variants():
    assert resolve_header(["latitude", "x"], "LATITUDE") == "latitude"
    assert resolve_header(["\ufeffSTATE", "x"], "STATE") == "\ufeffSTATE"
    assert resolve_header(["\u00ef\u00bb\u00bfSTATE", "x"], "STATE") == "\u00ef\u00bb\u00bfSTATE"
    assert resolve_header(["x"], "STATE") is None


def test_read_yearly_drifted_headers(spark, tmp_dir):
    paths = {
        2005: f"{tmp_dir}/y2005.csv",   # lower-case coordinates, extra column
        2006: f"{tmp_dir}/y2006.csv",   # other column order
        2022: f"{tmp_dir}/y2022.csv",   # true UTF-8 byte-order mark before STATE
        2023: f"{tmp_dir}/y2023.csv",   # the mark mis-decoded as text
    }
    _write(paths[2005], "STATE,ST_CASE,latitude,longitud,SP_LIMIT\n36,1,40.5,-74.0,25\n")
    _write(paths[2006], "LONGITUD,LATITUDE,ST_CASE,STATE\n-87.6,41.8,2,17\n")
    _write(paths[2022], "\ufeffSTATE,ST_CASE,LATITUDE,LONGITUD\n6,3,34.0,-118.2\n")
    _write(paths[2023], "\u00ef\u00bb\u00bfSTATE,ST_CASE,LATITUDE,LONGITUD\n48,4,29.7,-95.3\n")
    out = read_yearly(spark, paths, CANON)
    assert out.columns == list(CANON)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, 36, 40.5, -74.0), (2, 17, 41.8, -87.6), (3, 6, 34.0, -118.2),
                   (4, 48, 29.7, -95.3)]


def test_normalise_header_try_cast_and_missing_column(spark):
    df = spark.createDataFrame([("12", "n/a")], "`ST_CASE` string, `LATITUDE` string")
    out = normalise_header(df, CANON).first()
    assert out.ST_CASE == 12 and out.LATITUDE is None and out.STATE is None


def test_permissive_bad_cell_becomes_null(spark, tmp_dir):
    p = f"{tmp_dir}/c.csv"
    _write(p, "CRASH DATE,BOROUGH,NUMBER OF PERSONS INJURED\n01/01/2014,QUEENS,Unspecified\n"
              "01/02/2014,BRONX,3\n")
    df = read_csv(spark, p, "`CRASH DATE` string, BOROUGH string, "
                            "`NUMBER OF PERSONS INJURED` int", corrupt_column="_bad")
    rows = sorted(df.collect(), key=lambda r: r.BOROUGH)
    assert rows[1]["NUMBER OF PERSONS INJURED"] is None and rows[1].BOROUGH == "QUEENS"
    assert rows[1]["_bad"] is not None and rows[0]["_bad"] is None
    assert rows[0]["NUMBER OF PERSONS INJURED"] == 3


def test_ctrl_a_roundtrip_keeps_commas(spark, tmp_dir):
    df = spark.createDataFrame([("01/05/2014", "QUEENS", "a, b", "SEDAN", 1, 0)],
                               "crash_date string, borough string, factor string, vtype string, "
                               "injured int, killed int")
    path = sinks.write_ctrl_a(df, f"{tmp_dir}/ctrl_a")
    back = sinks.read_ctrl_a(spark, path, ",".join(f"{n} {t}" for n, t in df.dtypes))
    assert back.collect() == df.collect()
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{path}/part-*"))
    assert "\x01a, b\x01" in text


def test_single_part_csv(spark, tmp_dir):
    df = spark.range(100).withColumn("y", F.col("id") * 2).repartition(4)
    path = sinks.write_single_csv(df.orderBy("id"), f"{tmp_dir}/one")
    parts = glob.glob(f"{path}/part-*")
    assert len(parts) == 1
    back = read_csv(spark, path, "id bigint, y bigint")
    assert [r.id for r in back.collect()] == list(range(100))


def test_register_table_replace_and_catalog_check(spark, tmp_dir):
    df = spark.createDataFrame([("d1", "QUEENS"), ("d2", "BRONX")], "crash_date string, borough string")
    data = sinks.write_ctrl_a(df, f"{tmp_dir}/tbl")
    name = "pp_test_db.crashes"
    sinks.register_csv_table(spark, name, "crash_date string, borough string", data,
                             header=False, sep=sinks.CTRL_A, replace=True,
                             database_location=f"{tmp_dir}/db")
    checks = sinks.catalog_check(spark, name)
    assert checks["count"].first().total == 2
    assert len(checks["sample"].collect()) == 2
    assert [r.col_name for r in checks["describe"].collect()][:2] == ["crash_date", "borough"]
    # replace=False keeps the existing definition
    sinks.register_csv_table(spark, name, "a int", data, header=False, sep=sinks.CTRL_A,
                             replace=False)
    assert spark.table(name).columns == ["crash_date", "borough"]


def test_verify_sink(spark, tmp_dir):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    path = sinks.write_parts(df, f"{tmp_dir}/parts", fmt="csv")
    r = sinks.verify_sink(spark, df, path, "id bigint, v bigint").first()
    assert (r.rows_written, r.rows_read, r.matches) == (1000, 1000, True)


def test_collision_schema_has_29_columns():
    assert len(schemas.collision_schema().fields) == 29
    assert len(schemas.register_schema().fields) == 23


def test_no_column_stands_for_another_and_a_lost_one_raises(spark, tmp_dir):
    assert resolve_header(["NOT_HOUR", "x"], "HOUR") is None
    assert resolve_header(["??STATE", "!STATE"], "STATE") is None
    p = f"{tmp_dir}/lost.csv"
    _write(p, "ST_CASE,LATITUDE,LONGITUD\n1,40.5,-74.0\n")
    with pytest.raises(ValueError, match="STATE"):
        read_yearly(spark, {2005: p}, CANON)
    assert read_yearly(spark, {2005: p}, CANON, optional=["STATE"]).first().STATE is None


def test_ctrl_a_is_lossless(spark, tmp_dir):
    from policypanel.sinks import read_ctrl_a, write_ctrl_a
    rows = [(1, "a,b"), (2, "two\nlines"), (3, "  blanks "), (4, ""), (5, None), (6, 'q"uote'), (7, "back\\slash")]
    df = spark.createDataFrame(rows, "id int, text string")
    path = write_ctrl_a(df, f"{tmp_dir}/ctrl_a")
    assert sorted(tuple(r) for r in read_ctrl_a(spark, path, "id int, text string").collect()) == rows


def test_read_yearly_is_one_scan_of_any_number_of_files(spark, tmp_dir):
    layouts = ["a,b,c", "c,b,a", "b,A ,x,c", "﻿a,c,b"]
    want = []
    for k in range(40):
        names = layouts[k % 4].split(",")
        cells = {"a": str(k), "b": f"t{k}", "c": "bad" if k % 7 == 0 else str(k / 2), "x": "?"}
        _write(f"{tmp_dir}/many files/f {k}%20.csv", layouts[k % 4] + "\n" + ",".join(cells[n.strip().strip("﻿").lower()] for n in names) + "\n")
        want.append((k, f"t{k}", None if k % 7 == 0 else k / 2))
    _write(f"{tmp_dir}/many files/empty.csv", "")
    out = read_yearly(spark, [f"{tmp_dir}/many files"], {"a": "int", "b": "string", "c": "double"})
    assert sorted(map(tuple, out.collect())) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 1 and "Union" not in plan


def test_read_yearly_of_nothing_short_rows_and_quoted_headers(spark, tmp_dir):
    assert read_yearly(spark, {}, {"a": "int"}).collect() == []
    _write(f"{tmp_dir}/q.csv", '"a","b, c"\n1,"x, y"\n2\n')
    out = read_yearly(spark, {1: f"{tmp_dir}/q.csv"}, {"a": "int", "b, c": "string"})
    assert sorted(map(tuple, out.collect())) == [(1, "x, y"), (2, None)]


def test_rejects_name_file_column_and_line(spark, tmp_dir):
    from policypanel.sources.csv import split_rejects
    _write(f"{tmp_dir}/in/a.csv", 'i,d,t\n1,2.5,"x, y"\nq,2.5,y\n3,,\n4,zz,"say ""hi"""\nr,s,t\n')
    _write(f"{tmp_dir}/in/b.csv", "i,d,t\n5,1.0\n6,1.0,u,extra\n7,1.0,v\n")
    good, rejects = split_rejects(spark, f"{tmp_dir}/in", "i int, d double, t string", f"{tmp_dir}/store")
    assert sorted(map(tuple, good.collect()), key=lambda r: r[0]) == [(1, 2.5, "x, y"), (3, None, None), (7, 1.0, "v")]
    got = sorted(((r["file"].rsplit("/", 1)[-1], r["column"] or "", r["value"] or "", r["line"]) for r in rejects.collect()))
    assert got == [("a.csv", "d", "s", "r,s,t"), ("a.csv", "d", "zz", '4,zz,"say ""hi"""'), ("a.csv", "i", "q", "q,2.5,y"), ("a.csv", "i", "r", "r,s,t"),
                   ("b.csv", "", "", "5,1.0"), ("b.csv", "", "", "6,1.0,u,extra")]
    for df in (good, rejects):
        assert "csv" not in df._jdf.queryExecution().executedPlan().toString().split("Location")[0]


def test_rejects_of_an_empty_source(spark, tmp_dir):
    from policypanel.sources.csv import split_rejects
    _write(f"{tmp_dir}/e/a.csv", "i,d\n")
    good, rejects = split_rejects(spark, f"{tmp_dir}/e", "i int, d double", f"{tmp_dir}/store")
    assert good.collect() == [] and rejects.collect() == []
