import duckdb
import pytest

from kestrel.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"select {', '.join(columns)} from ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == sorted(want, key=key)
    assert len(want) > 200
