"""The cover index of polygons against plain crossing parity."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrapop.operators import grid


def inside(ring, px, py):
    """Even-odd rule with half-open borders."""
    n = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            n += 1
    return n % 2 == 1


def frames(spark, rings, points):
    r = spark.createDataFrame([(u, k, float(x), float(y)) for u, ring in rings.items() for k, (x, y) in enumerate(ring)], "admin_id long, seq int, x double, y double")
    p = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "point_id long, px double, py double")
    return r, p


def star(rng, cx, cy, n, reach, whole=False):
    place = (lambda v: float(round(v))) if whole else (lambda v: v)
    return [(place(cx + r * math.cos(a)), place(cy + r * math.sin(a))) for a in sorted(rng.uniform(0, 2 * math.pi) for _ in range(n)) for r in [rng.uniform(0.2, 1) * reach]]


@pytest.mark.parametrize("size", [1.0, 0.37, 4.0])
def test_random_polygons(spark, size):
    """Stars with crossing edges, whole-number corners on cell borders, places on borders."""
    rng = random.Random(int(size * 100))
    rings = {u: star(rng, rng.uniform(-6, 6), rng.uniform(-6, 6), rng.randint(3, 14), rng.uniform(1, 7), whole=u % 2 == 0) for u in range(16)}
    rings[90] = [(0, 0), (8, 0), (8, 5), (3, 5), (3, 2), (0, 2)]
    rings[91] = [(rng.randint(-4, 4), rng.randint(-4, 4)) for _ in range(9)]
    points = [(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(1500)] + [(rng.randint(-9, 9), rng.uniform(-9, 9)) for _ in range(400)] + [(rng.uniform(-9, 9), rng.randint(-9, 9)) for _ in range(400)] + [(x, y) for x in range(-9, 10) for y in range(-9, 10)]
    r, p = frames(spark, rings, points)
    got = {(x.point_id, x.admin_id) for x in grid.points_in_units(p, r, size=size).collect()}
    assert got == {(k, u) for u, ring in rings.items() for k, (x, y) in enumerate(points) if inside(ring, float(x), float(y))}


def test_points_meet_edges_of_their_own_cell_only(spark):
    ring = [(100 + 60 * math.cos(2 * math.pi * k / 4000), 100 + 60 * math.sin(2 * math.pi * k / 4000)) for k in range(4000)]
    r, _ = frames(spark, {1: ring}, [(0, 0)])
    index = grid.cover_index(r)
    boundary = index.where("edges is not null")
    far = boundary.select("row_no", "col_no", F.explode("edges").alias("g")).where("greatest(g.x1, g.x2) < col_no - 1e-6 or least(g.x1, g.x2) > col_no + 1 + 1e-6 or greatest(g.y1, g.y2) < row_no or least(g.y1, g.y2) > row_no + 1")
    assert far.count() == 0 and boundary.agg(F.max(F.size("edges"))).first()[0] < 40
    assert abs(index.where("edges is null").count() - math.pi * 60**2) < 2 * math.pi * 60 * 1.5


def test_no_rings_and_degenerate_ones(spark):
    r, p = frames(spark, {1: [(0, 0), (4, 0)], 2: [(1, 1)], 3: [(0, 0), (2, 2), (4, 4)]}, [(1, 0), (1, 1), (1.5, 1.2)])
    assert grid.points_in_units(p, r).count() == 0
    assert grid.points_in_units(p, r.limit(0)).count() == 0 and grid.points_in_units(p.limit(0), r).count() == 0
