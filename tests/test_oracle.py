"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import canon_rows, duck

KEYS = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "driver_id", "total_tips"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL).toPandas()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        pytest.skip("no SQL oracle; covered by its own test")
    ddf = con.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert canon_rows(sdf) == canon_rows(ddf)
