"""Discs and swaths beyond row 29."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrapop.operators import grid


def test_discs_at_the_grid_bounds(spark):
    points = spark.createDataFrame([(1, 32.05, 16.55), (2, 32.05, 17.05), (3, 29.0, 19.0), (4, 32.05, 21.0)], "point_id long, lon double, lat double")
    cells = lambda rows: {(r.point_id, r.row_no) for r in grid.disc_cells(points, 30.0, 20.0, 0.1, F.lit(12.0), rows, 50, touched_rule=False).collect()}
    assert cells(None) == {(1, 33), (1, 34), (1, 35), (2, 28), (2, 29), (2, 30)}
    assert cells(30) == {(2, 28), (2, 29)}


def test_swath_of_a_late_storm(spark, tmp_path):
    at = datetime.datetime(2024, 1, 2)
    rows = [(i, at + datetime.timedelta(hours=6 * i), user, "purchase", 300.0) for user in (5, 2005) for i in range(2)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {}
    for r in entry.queries()["quadrant_swath_cells"](spark, str(tmp_path)).collect():
        got.setdefault(r.sid, set()).add(r.row_no)
    assert 40 in got[2005] and max(got[2005]) > 40 and len(got[2005]) >= len(got[5]) > 1


@pytest.mark.parametrize("name", ["quadrant_swath_cells", "swath_across_dateline"])
def test_swaths_about_and_beyond_the_pole(spark, tmp_path, name):
    """Larger tables have latitudes down to -160: the cells are those of the SQL."""
    con = duckdb.connect()
    con.sql(f"copy (select * replace (event_id + i * 100000 as event_id, 54950 + 10 * i + user_id % 7 as user_id) from range(12) r(i), (select * from '/root/testdata/sf0.001/events.parquet' order by event_id limit 60)) to '{tmp_path}/events.parquet'")
    con.sql(f"create view events as select * from '{tmp_path}/events.parquet'")
    assert con.sql("select min(20 - floor(user_id / 50) * 0.1) < -90 from events").fetchall() == [(True,)]
    got = entry.queries()[name](spark, str(tmp_path)).collect()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted((r.sid, r.threshold, r.row_no, r.col_no) for r in got) == sorted(want[["sid", "threshold", "row_no", "col_no"]].itertuples(index=False, name=None))
