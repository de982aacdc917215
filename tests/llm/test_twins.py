"""Registered queries with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from terrapop.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda rows: sorted(str([None if v is None or v != v else round(float(v), 9) if isinstance(v, (int, float)) else v for v in r]) for r in rows)
    assert plain(tuple(r) for r in got.select(*columns).collect()) == plain(want[columns].astype(object).where(want[columns].notna(), None).itertuples(index=False, name=None))
