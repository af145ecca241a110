"""Every registered query equals its SQL twin on the small tables."""

from __future__ import annotations

import pytest

from checks import REGISTRY
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, sf_dir, connection, name):
    query, sql = REGISTRY[name]
    verdict, _ = compare(spark, connection, sf_dir, query, sql)
    assert verdict in ("ok", "rows only"), verdict


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0
