"""Quality flags of units from all their cells."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def test_zero_population_is_of_all_cells(spark, tmp_path):
    for t in TABLES:
        if t != "customer":
            os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    # Nations with thin cells, a crowded one, none that is valid, empty ones; others without cells.
    cells = [(1, 0, 100.0), (2, 0, -5.0), (3, 1, 9950.0), (97, 2, 800.0), (4, 2, -3.0), (5, 3, 0.0), (6, 4, 0.01), (7, 5, 9900.0)]
    values = ", ".join(f"({k}::BIGINT, 'c', {n}::INTEGER, {v}::DOUBLE, 'BUILDING')" for k, n, v in cells)
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * FROM (VALUES {values}) AS c(c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = entry.queries()["quality_flags_by_unit"](spark, str(tmp_path))
    rows = [tuple(r) for r in got.collect()]
    assert {r[0] for r in rows if not r[got.columns.index("flag_zero_population")]} == {1, 2, 5, 6}
    assert len(rows) == 25 and sorted(rows) == sorted(con.sql(entry.oracle_sql()["quality_flags_by_unit"]).fetchall())
