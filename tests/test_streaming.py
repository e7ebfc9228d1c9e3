"""The streaming refresh gives the batch annual summary."""

from policypanel.plans import facts as X
from policypanel.plans.queries import annual_summary
from policypanel.streaming.incremental import stream_period_summary

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/events"
    X.line_events(spark, SF).repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    measures = {m: m for m in ["persons_killed", "persons_injured", "ped_killed",
                               "cyc_killed", "mot_killed"]}
    # the batch summary reads every year from the first on
    out = stream_period_summary(spark, src, schema, "l_shipdate", X.LINE_MEASURES, measures,
                                cut=X.roles.EVENT_CUT, year_min=X.roles.EVENT_WINDOW[0],
                                max_files_per_trigger=1)
    batch = annual_summary(spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_rerun_reads_only_new_files(spark, tmp_dir):
    """A second refresh with the same checkpoint adds the new files' events; a
    refresh with nothing new keeps the published table."""
    src, out, ckpt = f"{tmp_dir}/ev", f"{tmp_dir}/summary", f"{tmp_dir}/ckpt"
    events = X.line_events(spark, SF)
    lo, hi = X.roles.EVENT_WINDOW
    first = events.filter("l_linenumber <= 3")
    second = events.filter("l_linenumber > 3")
    first.write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    measures = {"persons_killed": "persons_killed"}

    def refresh():
        return stream_period_summary(spark, f"{src}/*", schema, "l_shipdate", X.LINE_MEASURES,
                                     measures, cut=X.roles.EVENT_CUT, year_min=lo, year_max=hi,
                                     output=out, checkpoint=ckpt)

    def totals(df):
        return sorted((r.year, r.crashes, r.persons_killed) for r in df.collect())

    def expected(df):
        from policypanel.operators.clean import prepare_events
        from policypanel.operators.prepost import period_summary
        prep = prepare_events(df, "l_shipdate", X.LINE_MEASURES, cut=X.roles.EVENT_CUT,
                              year_min=lo, year_max=hi)
        return totals(period_summary(prep, "year", measures))

    assert totals(refresh()) == expected(first)
    second.write.parquet(f"{src}/b")
    assert totals(refresh()) == expected(events)
    assert totals(refresh()) == expected(events)        # nothing new: table kept


def test_stream_over_csv_extracts(spark, tmp_dir):
    """The collision-log CSV extract streamed: same annual counts as batch."""
    from policypanel import schemas as SC
    from tests.test_jobs import ROWS, _collision_csv
    _collision_csv(f"{tmp_dir}/in/part1.csv", ROWS)
    out = stream_period_summary(
        spark, f"{tmp_dir}/in", SC.collision_schema(), "CRASH DATE", SC.COLLISION_COUNTS,
        {"killed": "NUMBER OF PERSONS KILLED"}, cut=2014, year_min=2013, fmt="csv",
        options={"header": "true", "mode": "PERMISSIVE"})
    assert [(r.year, r.crashes, r.killed) for r in out.collect()] == [
        (2013, 2, 1), (2014, 2, 2), (2015, 1, 1)]
