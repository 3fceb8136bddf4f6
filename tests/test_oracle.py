"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import core
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert result.startswith(("OK", "ROWS")) and "TYPES" not in result, result


def test_entry(spark, monkeypatch):
    out = entry.entry(spark)
    assert out.columns == ["subreddit_nombre", "total_registros_limpios", "porcentaje"]
    assert out.count() > 0
