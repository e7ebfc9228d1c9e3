"""Versioned tables, observed writes, one-pass cells."""

import random

import pytest
from pyspark.sql import functions as F

from policypanel import schemas as SC
from policypanel import sinks
from policypanel.operators import clean as C
from policypanel.operators import prepost as P
from policypanel.plans import jobs


def rows(spark, table):
    return sorted(map(tuple, spark.table(table).select("k", "y").collect()))


def test_versions_switch_whole_and_back(spark, tmp_dir):
    df = spark.createDataFrame([(i, 2000 + i % 3) for i in range(30)], "k int, y int")
    one = sinks.publish(spark, df.where("k < 10"), "pp_versions.t", tmp_dir, ["y"])
    reading = spark.table("pp_versions.t")
    assert reading.count() == 10
    two = sinks.publish(spark, df, "pp_versions.t", tmp_dir, ["y"])
    assert len(rows(spark, "pp_versions.t")) == 30 and one != two
    # a reader that began with the first version still has its files
    assert spark.table(one).count() == 10
    sinks.switch_to(spark, "pp_versions.t", one)
    assert len(rows(spark, "pp_versions.t")) == 10
    pruned = spark.table(two).where("y = 2001")
    assert pruned.count() == 10 and "PartitionFilters: [isnotnull(y" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_crash_between_write_and_switch_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    df = spark.range(5).selectExpr("cast(id AS int) AS k", "2000 AS y")
    sinks.publish(spark, df, "pp_versions.c", tmp_dir)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "switch_to", die)
        with pytest.raises(RuntimeError):
            sinks.publish(spark, df.where("k > 3"), "pp_versions.c", tmp_dir)
    assert rows(spark, "pp_versions.c") == [(i, 2000) for i in range(5)]
    # a job that dies while it writes
    with pytest.raises(Exception):
        sinks.publish(spark, df.select(F.raise_error(F.lit("lost")).cast("int").alias("k"), "y"), "pp_versions.c", tmp_dir)
    assert rows(spark, "pp_versions.c") == [(i, 2000) for i in range(5)]


def test_create_if_absent_keeps_and_writes_nothing(spark, tmp_dir):
    import os
    df = spark.range(3).selectExpr("cast(id AS int) AS k", "2000 AS y")
    sinks.publish(spark, df, "pp_versions.k", tmp_dir, replace=False)
    before = sorted(os.listdir(tmp_dir))
    assert sinks.publish(spark, df.where("k = 9"), "pp_versions.k", tmp_dir, replace=False) == "pp_versions.k"
    assert sorted(os.listdir(tmp_dir)) == before and len(rows(spark, "pp_versions.k")) == 3
    sinks.publish(spark, df.where("k = 9"), "pp_versions.k", tmp_dir)
    assert rows(spark, "pp_versions.k") == []
    with pytest.raises(ValueError):
        sinks.publish(spark, df, "pp_versions.k; DROP", tmp_dir)


def test_a_hot_partition_value_is_split_by_size(spark, tmp_dir):
    import glob
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        df = spark.range(120_000).selectExpr("hash(id) AS k", "if(id % 100 = 0, cast(id % 7 AS int), 1) AS y").repartition(20)
        sinks.publish(spark, df, "pp_versions.h", tmp_dir, ["y"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {y: len(glob.glob(f"{tmp_dir}/*/y={y}/*.parquet")) for y in range(7)}
    # the hot value over several files, a value in its hash partition as well; 20 tasks x 7 values would be 140 files
    assert files[1] > 3 and sorted(files.values())[:5] == [1] * 5 and sum(files.values()) < 25, files


def test_metrics_of_a_write_need_no_scan(spark, tmp_dir):
    df = spark.createDataFrame([(i, None if i % 3 else i) for i in range(100)], "i int, v int")
    got = sinks.write_observed(df, f"{tmp_dir}/o", {"rows": F.count(F.lit(1)), "nulls": F.count_if(F.col("v").isNull()), "top": F.max("v")})
    assert got == {"rows": 100, "nulls": 66, "top": 99}
    assert sinks.write_observed(df.where("i < 0"), f"{tmp_dir}/e", {"rows": F.count(F.lit(1))}) == {"rows": 0}
    check = sinks.write_verified(spark, df, f"{tmp_dir}/v", "i int, v int").first()
    assert tuple(check) == (100, 100, True)


def test_observed_cleaning_equals_its_own_scans(spark, tmp_dir):
    from policypanel.operators import profiling as Pr
    rng = random.Random(2)
    data = [(rng.choice([None, 2004, 2005, 2024, 2025]), rng.choice([None, 1]), rng.choice([None, 99, 5]), rng.choice([0.0, 17.0, 90.0, None])) for _ in range(400)]
    df = spark.createDataFrame(data, "YEAR int, ST_CASE int, HOUR int, LATITUDE double").repartition(5)
    args = ("YEAR", (2005, 2024), ["ST_CASE"], {"HOUR": [99]}, {"LATITUDE": {"lo": 17, "hi": 77, "zero_is_missing": True}})
    found = C.clean_panel_observed(df, *args, nulls_of=["HOUR", "LATITUDE"])
    found.cleaned.write.parquet(f"{tmp_dir}/c")
    plain = C.clean_panel(df, *args)
    assert found.rows() == plain.count() == spark.read.parquet(f"{tmp_dir}/c").count()
    assert found.nulls() == {r["column"]: r["nulls"] for r in Pr.null_counts(plain, ["HOUR", "LATITUDE"]).collect()}
    inside = df.where("YEAR BETWEEN 2005 AND 2024")
    assert found.stages() == {"raw": 400, "year_window": inside.count(), "critical_not_null": inside.where("ST_CASE IS NOT NULL").count()}


def collisions(spark):
    rng = random.Random(6)
    data = []
    for _ in range(600):
        counts = [rng.choice([0, 0, 1, 2, None]) for _ in SC.COLLISION_COUNTS]
        data.append((f"{rng.randint(1, 12):02d}/{rng.randint(1, 28):02d}/{rng.randint(2012, 2017)}" if rng.random() > 0.05 else rng.choice([None, "x"]),
                     rng.choice(["Brooklyn", "BROOKLYN ", "QUEENS", "", None, "NULL"]), rng.choice(["Speeding", "speeding", "Unspecified", "", None, "Alcohol", "Glare"]), *counts))
    names = ["CRASH DATE", "BOROUGH", jobs.FACTOR, *SC.COLLISION_COUNTS]
    ddl = ", ".join(f"`{n}` {'string' if k < 3 else 'int'}" for k, n in enumerate(names))
    return spark.createDataFrame(data, ddl)


def test_cells_give_what_the_events_give(spark):
    raw = collisions(spark)
    out = jobs.prepost_job(spark, raw, top_k=2)
    events = C.prepare_events(raw, "CRASH DATE", SC.COLLISION_COUNTS, cut=SC.POLICY_YEAR, year_min=SC.COLLISION_YEAR_MIN)
    injured, killed = "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"
    both = {"killed": killed, "injured": injured}
    ped, cyc, mot = ("NUMBER OF PEDESTRIANS KILLED", "NUMBER OF CYCLIST KILLED", "NUMBER OF MOTORIST KILLED")
    pop = spark.createDataFrame(SC.BOROUGH_POPULATION, "segment string, population long")
    want = {
        "annual_summary": P.period_summary(events, "year", {"persons_killed": killed, "persons_injured": injured, "ped_killed": ped, "cyc_killed": cyc, "mot_killed": mot}),
        "pre_post_summary": P.pre_post_summary(events, {"killed_total": killed, "injured_total": injured, "ped_killed_total": ped, "cyc_killed_total": cyc, "mot_killed_total": mot}),
        "borough_pre_post": P.segment_pre_post(events, "BOROUGH", both, population=pop, pop_key="segment"),
        "factor_pre_post": P.topk_shift(events, jobs.FACTOR, {"killed": killed}, k=2),
        "monthly_time_series": P.period_summary(events, "month", both),
        "anomaly_window": P.window_rate(events, "year", *SC.ANOMALY_WINDOW, both, "killed", "crashes", "fatality_rate_per_1k_crashes"),
        "unspecified_rate": P.missing_share(events, "BOROUGH", jobs.FACTOR),
    }
    for name, df in want.items():
        assert out[name].columns == df.columns, name
        assert list(map(tuple, out[name].collect())) == list(map(tuple, df.collect())), name
    users = {r["era"]: r.asDict() for r in out["road_user_pre_post"].collect()}
    assert users["pre"]["cyc_injured"] == events.where("era = 'pre'").agg(F.sum("NUMBER OF CYCLIST INJURED")).first()[0]


def test_cells_are_one_scan_with_a_partial_aggregate(spark, tmp_dir):
    collisions(spark).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    cells = jobs.prepost_cells(C.prepare_events(raw, "CRASH DATE", SC.COLLISION_COUNTS, cut=SC.POLICY_YEAR, year_min=SC.COLLISION_YEAR_MIN))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "partial_sum" in plan
    assert {r["grain"] for r in cells.select("grain").distinct().collect()} == set(jobs.GRAINS)
