"""Every registered query against its check SQL."""

import pytest

from compare import connect, differences
from conftest import SMALL
from geotracks.catalog import QUERIES
from geotracks.checks import CHECKS


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, SMALL, name, QUERIES[name], CHECKS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["batch_no", "ogc_fid", "name", "hectares"]
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
