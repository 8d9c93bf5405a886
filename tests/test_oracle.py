"""Every registered query equals its DuckDB oracle on sf0.001 (the driver
checks sf0.01 with the same strings)."""

import pytest

import __spark_entry__ as E
from kestrel.queries import QUERIES
from scripts.oracle_check import _digest, _rows, duck
from tests.conftest import SF0001

SQL = E.oracle_sql()
NAMES = sorted(QUERIES)           # those of kestrel.llm have tests of their own


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(SQL) and set(NAMES) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    a, b = _rows(df.columns, got), _rows(ocols, exp)
    assert len(a) == len(b)
    assert _digest(a) == _digest(b), (set(a) - set(b), set(b) - set(a))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["host", "browser_type", "device_type", "os_type", "page_hits", "ds",
                          "agg_level"]
