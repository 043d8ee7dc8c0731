"""Every registered query of the library against its SQL."""

import pytest
from oracle import connect, same

from geoframe.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["time", "channel", "path", "value", "scene_time"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
