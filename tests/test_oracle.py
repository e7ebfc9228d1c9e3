"""Every registered query against its DuckDB oracle on sf0.01 (the driver's gate)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from policypanel.plans.queries import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) & set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from tests.conftest import SF001
    from tools.compare import compare
    res = compare(spark, SF001, [name])[name]
    assert res["cols"], res
    assert res["rows"] == res["oracle_rows"], res
    assert res["exact"], res


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert len(rows) == 1


def test_every_query_lists_its_inventory_ids():
    from policypanel.plans.queries import COVERS
    assert set(COVERS) == set(QUERIES)
