"""Sets of cells as bits, and swaths across the date line, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrapop.operators import bits, tracks


def cells(df, *keys):
    return sorted(tuple(r) for r in df.select(*keys, "row_no", "col_no").collect())


@pytest.mark.parametrize(("cols", "period"), [(None, None), (200, None), (200, 360), (360, 360), (64, 128)])
def test_intervals(spark, cols, period):
    rng = random.Random(cols or 1)
    rows = [(rng.randint(0, 3), rng.randint(0, 5), c0, c0 + rng.choice([-1, 0, 1, 5, 63, 64, 130, 400])) for c0 in (rng.randint(-100 if cols else 0, 420) for _ in range(200))]
    df = spark.createDataFrame(rows, "k int, row_no long, c0 long, c1 long")
    want = set()
    for k, r, a, b in rows:
        for c in range(a, b + 1):
            c = c % period if period else c
            if c >= 0 and (cols is None or c < cols):
                want.add((k, r, c))
    words = bits.interval_bits(df, ("k",), cols, period)
    assert cells(bits.cells_of(words), "k") == sorted(want)
    again = bits.cell_bits(bits.cells_of(words), ("k",))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, words.collect()))


def test_several_sets_and_meeting(spark):
    a = spark.createDataFrame([(1, 0, 3), (1, 0, 70), (2, 1, 5)], "a int, row_no long, col_no long")
    b = spark.createDataFrame([(7, 0, 70), (8, 0, 4), (9, 1, 5), (9, 1, 6)], "b int, row_no long, col_no long")
    met = bits.meeting(bits.cell_bits(a, ("a",)), bits.cell_bits(b, ("b",)), ("a", "b"))
    assert sorted(map(tuple, met.collect())) == [(1, 7), (2, 9)]
    both = bits.cell_bits(a, ("a",)).select("row_no", "word", F.col("bits").alias("x"), F.lit(None).cast("long").alias("y"))
    assert {(r.row_no, r.col_no, r.x, r.y) for r in bits.cells_of(both, ("x", "y")).collect()} == {(0, 3, True, False), (0, 70, True, False), (1, 5, True, False)}
    assert bits.cells_of(bits.cell_bits(a.limit(0), ("a",))).count() == 0


def haversine(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1, a)))


def in_swath(px, py, lon, lat, q):
    """The polygon with a corner each five degrees, edges straight in distance and bearing."""
    d = haversine(lon, lat, px, py)
    y = math.sin(math.radians(px - lon)) * math.cos(math.radians(py))
    x = math.cos(math.radians(lat)) * math.sin(math.radians(py)) - math.sin(math.radians(lat)) * math.cos(math.radians(py)) * math.cos(math.radians(px - lon))
    b = math.degrees(math.atan2(y, x)) % 360
    corner = b // 5 * 5
    r1, r2 = (q[0] if t < 90 else q[1] if t < 180 else q[2] if t < 270 else q[3] for t in (corner, corner + 5))
    turn, five = math.radians(b - corner), math.radians(5)
    return round(d, 6) <= round(r1 * r2 * math.sin(five) / (r1 * math.sin(turn) + r2 * math.sin(five - turn)), 6)


@pytest.mark.parametrize(("x0", "cols", "step"), [(-180.0, 720, 0.5), (170.0, 40, 0.5), (-10.0, 41, 0.5), (179.3, 9, 0.7)])
def test_swaths_of_unlike_quadrants(spark, x0, cols, step):
    """Unlike radii, high latitudes, places on both sides of the date line and grids that
    begin there or go around the globe."""
    rng = random.Random(9)
    places = [(k % 3, 63, rng.choice([179.9, -179.95, 180.0, -180.0, 0.2, -9.7, 175.0]) + rng.uniform(-0.5, 0.5), rng.uniform(-75, 88), *(rng.choice([1.0, 40.0, 90.0, 400.0]) for _ in range(4))) for k in range(24)]
    df = spark.createDataFrame(places, "sid int, threshold int, lon double, lat double, ne double, se double, sw double, nw double")
    want = set()
    for sid, band, lon, lat, *q in places:
        for r in range(int(180 / step)):
            py = 90 - (r + 0.5) * step
            if abs(py - lat) < 4.2:
                want |= {(sid, band, r, c) for c in range(cols) if in_swath(x0 + (c + 0.5) * step, py, lon, lat, q)}
    assert cells(tracks.swath_cells(df, x0, 90.0, step, cols), "sid", "threshold") == sorted(want)


def test_one_unbroken_swath(spark):
    """From 179 E to 179 W: the columns of each row follow one another."""
    df = spark.createDataFrame([(1, 63, lon, 10.0, 80.0, 80.0, 80.0, 80.0) for lon in (179.0, 179.5, 180.0, -179.5, -179.0)], "sid int, threshold int, lon double, lat double, ne double, se double, sw double, nw double")
    rows = {}
    for _, r, c in cells(tracks.swath_cells(df, 170.0, 20.0, 0.1, 200), "sid"):
        rows.setdefault(r, []).append(c)
    assert max(map(len, rows.values())) > 30 and all(v == list(range(v[0], v[0] + len(v))) for v in rows.values())


def test_continuous_longitudes(spark):
    df = spark.createDataFrame([(1, k, lon) for k, lon in enumerate([178.0, 179.5, -179.0, -177.0])] + [(2, 0, -179.0), (2, 1, 179.0)], "sid int, event_id int, lon double").withColumn("iso_time", F.col("event_id"))
    got = {(r.sid, r.event_id): r.lon for r in tracks.continuous(df).collect()}
    assert got == {(1, 0): -182.0, (1, 1): -180.5, (1, 2): -179.0, (1, 3): -177.0, (2, 0): 181.0, (2, 1): 179.0}


@pytest.mark.parametrize("turns", [0, 1])
def test_swaths_in_the_rows_of_units(spark, turns):
    """Storms that can't reach some rows go before they are interpolated, and no cell of
    these rows goes with them: short and long ways, also to points given beyond a pole."""
    rng = random.Random(4 + turns)
    points = []
    for sid in range(120):
        lat, lon, jump = rng.uniform(-40, 60) - 360 * turns * (sid % 2), rng.uniform(-5, 15), rng.choice([0.1, 2.0, 30.0])
        points += [(sid, sid * 10 + k, k, lat + rng.uniform(-jump, jump), lon + rng.uniform(-jump, jump), *(rng.choice([5.0, 20.0, 60.0]) for _ in range(4))) for k in range(3)]
    names = [f"usa_r34_{q}" for q in tracks.QUADRANTS]
    df = spark.createDataFrame(points, "sid int, event_id int, h int, lat double, lon double, " + ", ".join(f"{n} double" for n in names)).withColumn("iso_time", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h, 0, 0)")).withColumn("wmo_agency", F.lit("usa"))
    rows = spark.createDataFrame([(20, 29)], "top long, bottom long")
    steps = lambda t: tracks.interpolated(tracks.next_observation(t))
    near = df.join(tracks.storms_reaching(df, rows, 20.0, 0.5), "sid", "left_semi")
    kept = near.select("sid").distinct().count()
    whole = bits.cells_of(tracks.swath_bits(steps(df), -5.0, 20.0, 0.5, 40, boxed=True))
    want = cells(whole.where("row_no between 20 and 29"), "sid", "threshold")
    got = bits.cells_of(tracks.swath_bits(steps(near), -5.0, 20.0, 0.5, 40, boxed=True, rows=rows))
    assert cells(got, "sid", "threshold") == want
    assert len({w[0] for w in want}) > 10 and kept < 100


def test_buffers_in_the_rows_of_units(spark):
    df = spark.createDataFrame([(k, 60, 3 * k, 10, 3.0) for k in range(20)], "ext_id int, label int, row_no long, col_no long, reach double")
    rows = spark.createDataFrame([(20, 29)], "top long, bottom long")
    want = cells(bits.cells_of(tracks.buffer_bits(df)).where("row_no between 20 and 29"), "ext_id", "threshold")
    assert cells(bits.cells_of(tracks.buffer_bits(df, rows)), "ext_id", "threshold") == want and want
