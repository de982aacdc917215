"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = {k: v for k, v in entry.queries().items() if not k.startswith("op") and k != "pipeline"}
SQL = entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(frame):
    cols = sorted(frame.columns)
    value = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)[:10] if hasattr(v, "year") else bool(v) if "bool" in type(v).__name__ else v
    return cols, sorted(str([value(v) for v in row]) for row in frame[cols].astype(object).where(frame[cols].notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert plain(got) == plain(duck.sql(SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 25
