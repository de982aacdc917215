"""Alignment between grids of unlike origins, spacings and systems against plain loops."""

import math
import random

import pytest

from terrapop.operators import grids

TABLE = [(1, 10.0, 50.0, 0.1, 0.1, 40, 30, "EPSG:4326"), (2, 9.93, 50.2, 0.25, 0.25, 18, 12, "EPSG:4326"), (3, 10.3, 49.4, 0.7, 0.3, 5, 6, "EPSG:4326"), (4, 0.0, 0.0, 100.0, 100.0, 9, 9, "EPSG:32633"), (5, 10.0, 50.0, 0.1, 0.1, 40, 30, "EPSG:4326"), (6, 10.0, 50.0, 0.1, 0.2, 40, 15, "EPSG:4326")]
G = {r[0]: r[1:] for r in TABLE}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TABLE, "grid_id int, x0 double, y0 double, dx double, dy double, cols int, rows int, crs string")


def layer(spark, grid, seed, holes=0.1):
    rng = random.Random(seed)
    _, _, _, _, cols, rows, _ = G[grid]
    values = {(r, c): round(rng.uniform(0, 9), 3) for r in range(rows) for c in range(cols) if rng.random() > holes}
    return values, spark.createDataFrame([(grid, r, c, v) for (r, c), v in values.items()], "grid_id int, row_no long, col_no long, v double")


@pytest.mark.parametrize(("target", "source"), [(1, 2), (1, 3), (3, 1), (2, 2), (1, 4)])
def test_nearest(spark, table, target, source):
    values, coarse = layer(spark, source, 1)
    x0, y0, dx, dy, cols, rows, crs = G[target]
    sx, sy, sdx, sdy, scols, srows, scrs = G[source]
    fine = spark.createDataFrame([(r * cols + c, target, source, r, c) for r in range(rows) for c in range(cols)], "cell_id int, grid_id int, source_id int, row_no long, col_no long")
    got = {r.cell_id: r.v for r in grids.nearest(fine, coarse, table, ("cell_id",), "v").collect()}
    want = {}
    for r in range(rows):
        for c in range(cols):
            at = (math.floor(round((sy - (y0 - (r + 0.5) * dy)) / sdy, 9)), math.floor(round((x0 + (c + 0.5) * dx - sx) / sdx, 9)))
            want[r * cols + c] = values.get(at) if crs == scrs else None
    assert got == want


@pytest.mark.parametrize(("source", "target"), [(1, 2), (2, 1), (1, 3), (3, 2), (1, 4), (1, 1)])
def test_average(spark, table, source, target):
    """A ratio of 2.5 to 1 among them, both ways."""
    values, fine = layer(spark, source, 2)
    sx, sy, sdx, sdy, *_, scrs = G[source]
    x0, y0, dx, dy, cols, rows, crs = G[target]
    sums = {}
    for (r, c), v in values.items() if crs == scrs else ():
        for k in range(rows):
            h = min(sy - r * sdy, y0 - k * dy) - max(sy - (r + 1) * sdy, y0 - (k + 1) * dy)
            for j in range(cols) if h > 1e-10 else ():
                w = min(sx + (c + 1) * sdx, x0 + (j + 1) * dx) - max(sx + c * sdx, x0 + j * dx)
                if w > 1e-10:
                    t = sums.setdefault((k, j), [0.0, 0.0])
                    t[0], t[1] = t[0] + v * w * h, t[1] + w * h
    pairs = spark.createDataFrame([(source, target)], "grid_id int, target_id int")
    got = {(r.row_no, r.col_no): (r.v, r.share) for r in grids.average(fine, table, pairs, "v").collect()}
    assert got.keys() == sums.keys()
    for k, (a, b) in sums.items():
        assert got[k] == pytest.approx((a / b, b / (dx * dy)), abs=2e-6)


def test_match(spark, table):
    pairs = spark.createDataFrame([(1, 5), (1, 2), (1, 6), (1, 4), (1, 77)], "grid_id int, other_id int")
    got = {r.other_id: (r.same_corner, r.same_spacing, r.same_shape, r.same_crs, r.aligned) for r in grids.matched(table, pairs).collect()}
    assert got == {5: (True,) * 5, 2: (False, False, False, True, False), 6: (True, False, False, True, False), 4: (False,) * 5, 77: (False,) * 5}
