"""Plan shape checks: no Python in any plan, pushdown, top-k, broadcast, one scan."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries
from policypanel.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF", "MapPartitions")


def plan_text(df, executed=False):
    if executed:
        df.collect()              # explain then shows the final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    text = plan_text(queries()[name](spark, SF))
    for node in PYTHON_NODES:
        assert node not in text, (name, node)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_did_reads_orders_once_with_pushdown_and_pruning(spark):
    text = plan_text(queries()["did_total"](spark, SF))
    scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*orders\.parquet\]", text)
    assert len(scans) == 1
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "o_comment" not in text and "o_orderstatus" not in text


def test_did_summary_reuses_the_fact_exchange(spark):
    text = plan_text(queries()["did_summary"](spark, SF), executed=True)
    assert "Reused" in text


def test_topk_uses_take_ordered_and_broadcast_semi_join(spark):
    text = plan_text(queries()["topk_shift"](spark, SF))
    assert "TakeOrderedAndProject" in text
    assert "LeftSemi" in text and "BroadcastExchange" in text


def test_segment_population_join_is_broadcast_at_runtime(spark):
    from tools.plan_report import _tree
    tree = _tree(plan_text(queries()["segment_pre_post"](spark, SF), executed=True))
    assert "BroadcastHashJoin LeftOuter" in tree
    assert "SortMergeJoin" not in tree


def test_profile_queries_are_single_aggregate_passes(spark):
    text = plan_text(queries()["null_counts"](spark, SF))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1


def _final_scans(spark, name):
    from tools.plan_report import _tree
    df = queries()[name](spark, SF)
    text = plan_text(df, executed=True)
    ids = {int(i) for i in re.findall(r"\((\d+)\)", _tree(text))}
    return [re.findall(r"Location: \w+ \[([^\]]*)\]", m.group(0))[0].rsplit("/", 1)[-1]
            for m in re.finditer(r"^\((\d+)\) Scan [^\n]*\n(?:[^\n]+\n)*", text, re.M)
            if int(m.group(1)) in ids]


@pytest.mark.parametrize("name", ["segment_pre_post", "topk_shift", "did_summary"])
def test_fact_table_scanned_once(spark, name):
    scans = _final_scans(spark, name)
    fact = "orders.parquet" if name.startswith("did") else "lineitem.parquet"
    assert scans.count(fact) == 1, scans
    if name == "topk_shift":          # the factor dimension is joined once too
        assert scans.count("part.parquet") == 1, scans


def test_fact_collapsed_before_shuffle(spark):
    """The first exchange over the fact table carries partial aggregates."""
    text = plan_text(queries()["segment_pre_post"](spark, SF))
    m = re.search(r"Functions \[\d+\]: \[partial_count", text)
    assert m is not None
    assert "hashpartitioning(l_suppkey" in text


def test_runtime_bloom_filter_prunes_orders_at_scale(spark):
    """With sizes that force shuffle joins (as at scale), Spark builds a Bloom
    filter from the selected customers and applies it to the orders scan below
    the per-customer aggregate."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        text = plan_text(queries()["did_total"](spark, SF))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    orders_filter = [blk for blk in text.split("\n\n") if "might_contain" in blk
                     and "o_custkey" in blk]
    assert orders_filter, "no runtime filter on the orders side"


def test_events_prepare_keeps_the_last_year(spark):
    from __spark_entry__ import queries
    from tests.conftest import SF001
    rows = spark.read.parquet(f"{SF001}/lineitem.parquet").where("year(l_shipdate) >= 1995").count()
    got = queries()["events_prepare"](spark, SF001)
    assert got.count() == rows and got.agg({"year": "max"}).first()[0] == 2001
