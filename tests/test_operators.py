"""Small inputs with known results."""

import datetime as dt
import random

from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import align, grid, temporal, tracks, zonal


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_labelled_sum_golden(spark):
    cells = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, None), (3, 4.0), (4, None), (5, 99.0)], "cell_id long, v double")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 1), (4, 2), (5, 0)], "cell_id long, admin_id long")
    units = spark.createDataFrame([(1,), (2,), (3,)], "admin_id long")
    out = zonal.labelled_sum(cells, labels, units, {"s": F.coalesce("v", F.lit(0.0))})
    assert rows(out) == [(1, 7.0), (2, 0.0), (3, 0.0)]


def test_zonal_golden(spark):
    ring = [(1, 0, 0.0, 0.0), (1, 1, 2.0, 0.0), (1, 2, 2.0, 2.0), (1, 3, 0.0, 2.0), (2, 0, 2.0, 2.0), (2, 1, 4.0, 2.0), (2, 2, 4.0, 4.0), (2, 3, 2.0, 4.0)]
    points = spark.createDataFrame(ring, "admin_id long, seq int, x double, y double")
    cells = spark.createDataFrame([(r, c, float(4 * r + c + 1)) for r in range(4) for c in range(4)], "row_no long, col_no long, v double")
    out = grid.fill(points).join(cells, ["row_no", "col_no"]).groupBy("admin_id").agg(F.sum("v"))
    assert rows(out) == [(1, 14.0), (2, 54.0)]


def test_fill_of_random_triangles_matches_parity(spark):
    rng = random.Random(5)
    tri = [(i, k, rng.uniform(0, 12), rng.uniform(0, 12)) for i in range(6) for k in range(3)]
    got = {tuple(r) for r in grid.fill(spark.createDataFrame(tri, "admin_id long, seq int, x double, y double")).collect()}
    want = set()
    for i in range(6):
        p = [(x, y) for j, _, x, y in tri if j == i]
        for r in range(12):
            for c in range(12):
                inside = False
                for (x1, y1), (x2, y2) in zip(p, p[1:] + p[:1]):
                    if (y1 > r + 0.5) != (y2 > r + 0.5) and c + 0.5 < x1 + (r + 0.5 - y1) * (x2 - x1) / (y2 - y1):
                        inside = not inside
                if inside:
                    want.add((i, r, c))
    assert got == want
    touched = {tuple(r) for r in grid.touched(spark.createDataFrame(tri, "admin_id long, seq int, x double, y double")).collect()}
    assert got <= touched


def test_flood_days_golden(spark):
    t = lambda d, h: dt.datetime(2025, 1, d, h)
    obs = [(1, t(1, 6), 1), (1, t(1, 18), 1), (1, t(2, 6), 255), (1, t(3, 6), 2), (2, t(1, 6), 0), (2, t(2, 6), 255)]
    df = spark.createDataFrame(obs, "c long, ts timestamp, pix int")
    assert rows(temporal.flood_days(df, "c", "ts", "pix")) == [(1, 2), (2, 0)]
    assert rows(temporal.flood_hits(df, "c", "pix")) == [(1, 3), (2, 0)]


def test_runs_are_positional(spark):
    d = lambda n: dt.date(2025, 1, n)
    hot = [(1, d(1), 40.0), (1, d(2), 40.0), (1, d(4), 40.0), (2, d(1), 40.0), (2, d(2), 1.0), (2, d(4), 40.0)]
    df = spark.createDataFrame(hot, "c long, day date, v double")
    assert rows(temporal.consecutive_k(df, "c", "day", F.col("v") > 32, 3)) == [(1,)]  # day 3 is missing everywhere
    assert rows(temporal.consecutive_k_rolling(df, "c", "day", F.col("v") > 32, 3)) == [(1,)]
    gap = df.union(spark.createDataFrame([(3, d(3), 40.0)], df.schema))
    assert rows(temporal.consecutive_k(gap, "c", "day", F.col("v") > 32, 3)) == []


def test_scalar_golden(spark):
    df = spark.createDataFrame([("Battles", 0), ("Explosions/Remote violence", 3), ("Violence against civilians", 0), ("Violence against civilians", 1), ("Riots", 0), ("Protests", 0), ("Other", 0)], "t string, f int")
    assert [r[0] for r in df.select(S.buffer_km(F.col("t"), F.col("f"))).collect()] == [5, 5, 2, 5, 2, 1, None]
    one = spark.range(1)
    assert one.select(S.window_start(F.lit("2026-06-30").cast("date"), 12)).first()[0] == dt.date(2025, 7, 1)
    assert one.select(S.norm_iso3(F.lit(" leb "), {"LEB": "LBN"})).first()[0] == "LBN"
    assert one.select(S.norm_storm_name(F.lit("test-26"))).first()[0] == "TEST"
    assert one.select(S.utm_epsg(F.lit(44.0), F.lit(15.0))).first()[0] == 32638
    assert abs(one.select(S.lon_unwrap(F.lit(-179.9), F.lit(179.9))).first()[0] - 180.1) < 1e-9


def test_box_coverage_and_union(spark):
    box = lambda *v: tuple(map(F.lit, v))
    assert spark.range(1).select(grid.bbox_coverage(box(0.0, 0.0, 2.0, 2.0), box(0.0, 0.0, 1.0, 2.0))).first()[0] == 50.0
    boxes = spark.createDataFrame([(0.0, 0.0, 2.0, 2.0), (1.0, 1.0, 3.0, 3.0), (1.0, 1.0, 3.0, 3.0)], "w double, s double, e double, n double")
    assert grid.union_coverage(boxes, (0.0, 0.0, 4.0, 4.0)).first()[0] == round(100 * 7 / 16, 6)
    assert grid.union_coverage(boxes.limit(0), (0.0, 0.0, 4.0, 4.0)).first()[0] == 0.0


def test_align(spark):
    grid_ = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (0, 1, None), (1, 1, 5.0)], "gx long, gy long, v double")
    pts = spark.createDataFrame([(1, 0.5, 0.0), (2, 0.5, 0.5)], "id long, fx double, fy double")
    assert rows(align.align_bilinear(pts, grid_, "v")) == [(1, 2.0), (2, 3.0)]


def test_affected_never_exceeds_total(spark):
    rng = random.Random(1)
    cells = spark.createDataFrame([(i, rng.choice([None, rng.uniform(0, 9)]), rng.choice([None, rng.randint(0, 9)])) for i in range(200)], "cell_id long, pop double, d int")
    labels = spark.createDataFrame([(i, i % 4 + 1) for i in range(200)], "cell_id long, admin_id long")
    units = spark.createDataFrame([(k,) for k in range(1, 6)], "admin_id long")
    loose = {r.admin_id: r for r in zonal.exposure(cells, labels, units, F.col("d") > 2).collect()}
    strict = {r.admin_id: r for r in zonal.exposure(cells, labels, units, F.col("d") > 5).collect()}
    for k, r in loose.items():
        assert strict[k].pop_affected <= r.pop_affected <= r.pop_total
    assert loose[5].pct_affected is None


QUADS = [f"usa_r34_{q}" for q in tracks.QUADRANTS]
TRACK = "event_id long, sid long, iso_time timestamp, lon double, lat double, wmo_agency string, usa_wind double, " + ", ".join(f"{c} double" for c in QUADS)


def test_track_completeness_and_interpolation(spark):
    t = lambda h: dt.datetime(2025, 1, 1, h)
    pts = [(1, 7, t(0), -0.55, 0.5, "x", 40.0, 2.0, 2.0, 2.0, 2.0), (2, 7, t(6), -0.45, 0.5, "x", 40.0, 4.0, 4.0, 4.0, 4.0), (3, 7, t(7), 2.0, 0.5, "x", 40.0, 20.0, None, 20.0, 20.0), (4, 7, t(23), 3.0, 0.5, "x", 40.0, 20.0, 20.0, 20.0, 20.0)]
    df = spark.createDataFrame(pts, TRACK)
    done = {r.threshold: (r.completeness, r.agencies) for r in tracks.completeness(df).collect()}
    assert done == {63: (0.75, "usa"), 93: (0.0, ""), 119: (0.0, "")}
    nxt = {r.event_id: (r.next_event_id, r.linked) for r in tracks.next_observation(df).collect()}
    assert nxt == {1: (2, True), 2: (4, False), 4: (None, False)}
    steps = rows(tracks.interpolated(tracks.next_observation(df)).where("event_id = 1").select("step", "lon", "ne"))
    # 11.12 km at steps of the least radius, 3.704 km, and radii in proportion
    assert steps[0] == (0, -0.55, 3.704) and len(steps) == 4 and all(a[1] < b[1] for a, b in zip(steps, steps[1:]))
    assert [round(s[2], 6) for s in steps] == [3.704, 4.63, 5.556, 6.482]


def test_radii_come_from_the_preferred_agency(spark):
    names = [f"{a}_r34_{q}" for a in ("usa", "bom", "abc", "xyz") for q in tracks.QUADRANTS]
    row = lambda i, wmo, *have: (i, 1, dt.datetime(2025, 1, 1), 0.0, 0.0, wmo, *[float(k + 1) if a in have else None for k, a in enumerate(("usa", "bom", "abc", "xyz")) for _ in range(4)])
    data = [row(1, "xyz", "usa", "xyz"), row(2, " XYZ", "bom", "xyz"), row(3, "bom", "bom", "xyz"), row(4, "q", "abc", "xyz"), row(5, None)]
    df = spark.createDataFrame(data, "event_id long, sid long, iso_time timestamp, lon double, lat double, wmo_agency string, " + ", ".join(f"{c} double" for c in names))
    got = {r.event_id: r.agency for r in tracks.families(df).where("threshold = 63").collect()}
    assert got == {1: "usa", 2: "xyz", 3: "bom", 4: "abc", 5: None}


def test_swath_of_unlike_quadrants_has_straight_edges(spark):
    """Against a polygon with a corner every five degrees, by crossing parity in a plane."""
    import math

    radii = (60.0, 20.0, 45.0, 30.0)
    step = spark.createDataFrame([(1, 63, 32.5, 0.0, *radii)], "sid long, threshold int, lon double, lat double, ne double, se double, sw double, nw double")
    got = {(r.row_no, r.col_no) for r in tracks.swath_cells(step, 30.0, 1.0, 0.1, 50).collect()}
    km = 111.19492664455873
    ring = [(radii[min(a // 90, 3)] * math.sin(math.radians(a)), radii[min(a // 90, 3)] * math.cos(math.radians(a))) for a in range(0, 361, 5)]
    want = set()
    for r in range(20):
        for c in range(50):
            x, y = (30 + (c + 0.5) * 0.1 - 32.5) * km, (1 - (r + 0.5) * 0.1) * km
            odd = sum((y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) % 2
            if odd:
                want.add((r, c))
    assert got == want


def test_near_units(spark):
    ring = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.0), (1, 2, 1.0, 1.0), (1, 3, 0.0, 1.0)], "admin_id long, seq int, x double, y double")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.08, 0.5), (3, 1.1, 0.5), (4, -0.06, -0.06), (5, -0.07, -0.07), (6, 0.5, 40.0)], "point_id long, lon double, lat double")
    assert rows(grid.near_units(points, ring, 10.0)) == [(1,), (2,), (4,)]


def test_spur_tracks_by_ending(spark):
    df = spark.createDataFrame([(1, "main"), (2, "Merge-SPUR"), (3, "spur-merge"), (4, None)], "event_id long, track_type string").selectExpr("event_id", "track_type", "timestamp '2025-01-01' as iso_time", "1d as lon", "1d as lat", "-999d as usa_wind")
    got = tracks.clean_tracks(df).collect()
    assert sorted(r.event_id for r in got) == [1, 3, 4] and all(r.usa_wind is None for r in got)


def test_run_floor_gives_all_thresholds(spark):
    rng = random.Random(8)
    d = lambda n: dt.date(2025, 1, n)
    data = [(c, d(day), float(rng.randrange(5))) for c in range(6) for day in range(1, 25) if rng.random() < 0.9]
    df = spark.createDataFrame(data, "c long, day date, v double")
    floor = {r.c: r.floor for r in temporal.run_floor(df, "c", "day", "v", 3).collect()}
    for t in (-1, 0, 1, 2, 3):
        assert {c for c, f in floor.items() if f > t} == {r.c for r in temporal.consecutive_k(df, "c", "day", F.col("v") > t, 3).collect()}


def test_kelvin_by_file(spark):
    d = lambda n: dt.date(2025, 1, n)
    df = spark.createDataFrame([("a", d(1), 300.0), ("a", d(1), 280.0), ("a", d(2), 10.0), ("b", d(1), 20.0), ("b", d(2), 300.0)], "file string, day date, v double")
    assert [round(r[2], 2) for r in rows(temporal.to_celsius_by_file(df, "v", "day", "file").select("file", "day", "v"))] == [6.85, 26.85, -263.15, 20.0, 300.0]


def test_utm_zone_beyond_the_poles_is_the_zone(spark):
    """As the query's SQL has it; the polar projection is a rule of buffers only."""
    places = spark.createDataFrame([(44.0, 85.0), (44.0, -81.0), (44.0, -160.2), (180.0, 0.0)], "lon double, lat double")
    assert [r[0] for r in places.select(S.utm_epsg(F.col("lon"), F.col("lat"))).collect()] == [32638, 32738, 32738, 32660]
    assert [r[0] for r in places.select(S.buffer_epsg(F.col("lon"), F.col("lat"))).collect()] == [3413, 3031, 3031, 32660]
