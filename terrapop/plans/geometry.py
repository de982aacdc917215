"""Queries of grids, polygons, boxes, discs and swaths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import align, grid, grids
from terrapop.sources.fixtures import Fixtures

from .basic import BUFFER, WINDOW_EVENTS, dec, window_events
from .registry import query

EDGES = "SELECT admin_id, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM admin_points WINDOW w AS (PARTITION BY admin_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
#: Centres inside by crossing parity, over each polygon's box: another way than scanlines.
FILL = f"SELECT b.admin_id, b.row_no, b.col_no FROM (SELECT admin_id, unnest(range(CAST(min(x) AS BIGINT), CAST(max(x) AS BIGINT))) AS col_no, r AS row_no FROM (SELECT admin_id, x, unnest(range(CAST(min(y) OVER (PARTITION BY admin_id) AS BIGINT), CAST(max(y) OVER (PARTITION BY admin_id) AS BIGINT))) AS r FROM admin_points) GROUP BY admin_id, r) b JOIN ({EDGES}) e ON e.admin_id = b.admin_id AND (e.y1 > b.row_no + 0.5) <> (e.y2 > b.row_no + 0.5) AND b.col_no + 0.5 < e.x1 + (b.row_no + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY b.admin_id, b.row_no, b.col_no HAVING count(*) % 2 = 1"
CROSSED = f"SELECT admin_id, row_no, unnest(range(CAST(floor(least(xa, xb)) AS BIGINT), greatest(CAST(floor(least(xa, xb)) AS BIGINT) + 1, CAST(ceil(greatest(xa, xb)) AS BIGINT)))) AS col_no FROM (SELECT admin_id, row_no, CASE WHEN y1 = y2 THEN x1 ELSE x1 + (greatest(row_no, least(y1, y2)) - y1) * (x2 - x1) / (y2 - y1) END AS xa, CASE WHEN y1 = y2 THEN x2 ELSE x1 + (least(row_no + 1, greatest(y1, y2)) - y1) * (x2 - x1) / (y2 - y1) END AS xb FROM (SELECT *, unnest(range(CAST(floor(least(y1, y2)) AS BIGINT), greatest(CAST(floor(least(y1, y2)) AS BIGINT) + 1, CAST(ceil(greatest(y1, y2)) AS BIGINT)))) AS row_no FROM ({EDGES})))"


@query("cell_from_lonlat", "SELECT cell_id, CAST(floor((20 - lat) / 0.1e0) AS BIGINT) AS row_idx, CAST(floor((lon - 30) / 0.1e0) AS BIGINT) AS col_idx, round(30 + (col_no + 0.5e0) * 0.1e0, 6) AS centre_lon FROM population_cells")
def _(fx: Fixtures) -> DataFrame:
    r, c = align.grid_index(F.col("lon"), F.col("lat"), 30.0, 20.0, 0.1, 0.1)
    return fx.population_cells.select("cell_id", r.alias("row_idx"), c.alias("col_idx"), F.round(30 + (F.col("col_no") + 0.5) * 0.1, 6).alias("centre_lon"))


@query("polygon_rasterize_center", f"SELECT row_no, col_no, max(admin_id) AS admin_id FROM ({FILL}) GROUP BY row_no, col_no")
def _(fx: Fixtures) -> DataFrame:
    return grid.last_unit(grid.fill(fx.admin_points))


@query("polygon_rasterize_touched", f"SELECT admin_id, row_no, col_no FROM ({FILL}) UNION SELECT admin_id, row_no, col_no FROM ({CROSSED})")
def _(fx: Fixtures) -> DataFrame:
    return grid.touched(fx.admin_points)


@query("multi_label_cells", FILL)
def _(fx: Fixtures) -> DataFrame:
    return grid.fill(fx.admin_points)


EVENT_XY = "SELECT event_id AS point_id, (longitude - 30) / 0.1e0 AS px, (20 - latitude) / 0.1e0 AS py FROM conflict_events"


def event_xy(fx: Fixtures) -> DataFrame:
    return fx.conflict_events.select(F.col("event_id").alias("point_id"), ((F.col("longitude") - 30) / 0.1).alias("px"), ((20 - F.col("latitude")) / 0.1).alias("py"))


INSIDE = f"SELECT point_id, admin_id FROM ({EVENT_XY}) p JOIN ({EDGES}) e ON (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) GROUP BY point_id, admin_id HAVING count(*) % 2 = 1"


@query("point_in_polygon", INSIDE)
def _(fx: Fixtures) -> DataFrame:
    return grid.points_in_units(event_xy(fx), fx.admin_points)


@query("point_in_admin", f"SELECT admin_id, count(*) AS events FROM ({INSIDE}) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return grid.points_in_units(event_xy(fx), fx.admin_points).groupBy("admin_id").agg(F.count("*").alias("events"))


@query("bbox_coverage", "SELECT item_id, round(100 * greatest(0, least(east, 32e0) - greatest(west, 31e0)) * greatest(0, least(north, 20e0) - greatest(south, 19e0)), 6) AS pct FROM stac_items")
def _(fx: Fixtures) -> DataFrame:
    target = tuple(F.lit(v) for v in (31.0, 19.0, 32.0, 20.0))
    layer = tuple(F.col(c) for c in ("west", "south", "east", "north"))
    return fx.stac_items.select("item_id", F.round(grid.bbox_coverage(target, layer), 6).alias("pct"))


UNION = """WITH b AS (SELECT DISTINCT greatest(west, 30e0) AS w, greatest(south, 18e0) AS s, least(east, 34e0) AS e, least(north, 20e0) AS n FROM stac_items WHERE {where}),
 xs AS (SELECT x, lead(x) OVER (ORDER BY x) AS x2 FROM (SELECT w AS x FROM b WHERE w < e AND s < n UNION SELECT e FROM b WHERE w < e AND s < n)),
 ys AS (SELECT y, lead(y) OVER (ORDER BY y) AS y2 FROM (SELECT s AS y FROM b WHERE w < e AND s < n UNION SELECT n FROM b WHERE w < e AND s < n))
 SELECT round(100 * coalesce(sum((x2 - x) * (y2 - y)), 0) / 8, 6) AS coverage_pct FROM xs, ys WHERE x2 IS NOT NULL AND y2 IS NOT NULL AND EXISTS (SELECT 1 FROM b WHERE w <= x AND e >= x2 AND s <= y AND n >= y2)"""


@query("union_bbox_coverage", UNION.format(where="href IS NOT NULL"))
def _(fx: Fixtures) -> DataFrame:
    boxes = fx.stac_items.where("href is not null").select(F.col("west").alias("w"), F.col("south").alias("s"), F.col("east").alias("e"), F.col("north").alias("n"))
    return grid.union_coverage(boxes, (30.0, 18.0, 34.0, 20.0))


_LAT, _KLON = "50 / 111.32e0", "50 / (111.32e0 * cos(radians((s + n) / 2)))"


@query("aoi_bounds_buffer", f"SELECT admin_id, round(greatest(-180, w - 0.5e0), 6) AS w, round(greatest(-90, s - 0.5e0), 6) AS s, round(least(180, e + 0.5e0), 6) AS e, round(least(90, n + 0.5e0), 6) AS n, round(greatest(-180, w - {_KLON}), 6) AS km_w, round(greatest(-90, s - {_LAT}), 6) AS km_s, round(least(180, e + {_KLON}), 6) AS km_e, round(least(90, n + {_LAT}), 6) AS km_n FROM (SELECT admin_id, 30 + min(x) * 0.1e0 AS w, 30 + max(x) * 0.1e0 AS e, 20 - max(y) * 0.1e0 AS s, 20 - min(y) * 0.1e0 AS n FROM admin_points GROUP BY admin_id)")
def _(fx: Fixtures) -> DataFrame:
    """Bounds of each unit padded by half a degree, and by 50 km at its middle latitude; both
    stay on the globe."""
    box = fx.admin_points.groupBy("admin_id").agg((30 + F.min("x") * 0.1).alias("w"), (20 - F.max("y") * 0.1).alias("s"), (30 + F.max("x") * 0.1).alias("e"), (20 - F.min("y") * 0.1).alias("n"))
    degrees, km = grid.padded_box(F.lit(0.5), F.lit(0.5)), grid.padded_box(50 / (111.32 * F.cos(F.radians((F.col("s") + F.col("n")) / 2))), F.lit(50 / 111.32))
    return box.select("admin_id", *[F.round(c, 6).alias(n) for n, c in degrees.items()], *[F.round(c, 6).alias(f"km_{n}") for n, c in km.items()])


@query("utm_zone", "SELECT event_id, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + least(CAST(floor((lon + 180) / 6) AS INTEGER) + 1, 60) AS INTEGER) AS epsg FROM track_points")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.select("event_id", S.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


HAV = "2 * 6371.0088e0 * asin(sqrt(least(1.0, pow(sin(radians({la2} - {la1}) / 2), 2) + cos(radians({la1})) * cos(radians({la2})) * pow(sin(radians({lo2} - {lo1}) / 2), 2))))"
NEAREST = HAV.format(la1="latitude", lo1="longitude", la2="greatest(least(latitude, 20 - row_no * 0.1e0), 20 - row_no * 0.1e0 - 0.1e0)", lo2="least(greatest(longitude, 30 + col_no * 0.1e0), 30 + col_no * 0.1e0 + 0.1e0)")


def discs_sql(events: str) -> str:
    """(point_id, event_ts, row_no, col_no) of the cells that events' buffers touch."""
    return f"SELECT event_id AS point_id, event_ts, row_no, col_no FROM (SELECT event_id, event_ts, longitude, latitude, {BUFFER} AS r FROM ({events})) e JOIN (SELECT row_no, col_no FROM (SELECT unnest(range(0, 30)) AS row_no), (SELECT unnest(range(0, 50)) AS col_no)) c ON abs(20 - (row_no + 0.5e0) * 0.1e0 - latitude) < 0.2 AND abs(30 + (col_no + 0.5e0) * 0.1e0 - longitude) < 0.2 WHERE round({NEAREST}, 6) <= r"


DISCS = f"SELECT point_id, row_no, col_no FROM ({discs_sql(WINDOW_EVENTS)})"
ALL_DISCS = discs_sql("SELECT * FROM conflict_events WHERE event_type <> 'Protests'")


def event_discs(fx: Fixtures) -> DataFrame:
    points = window_events(fx).select(F.col("event_id").alias("point_id"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), S.buffer_km(F.col("event_type"), F.col("fatalities"), strict=True).alias("radius"))
    return grid.disc_cells(points, 30.0, 20.0, 0.1, F.col("radius"), 30, 50)


@query("buffer_cells", DISCS)
def _(fx: Fixtures) -> DataFrame:
    return event_discs(fx)


@query("event_count_add", f"SELECT row_no, col_no, count(*) AS events FROM ({DISCS}) GROUP BY row_no, col_no")
def _(fx: Fixtures) -> DataFrame:
    return event_discs(fx).groupBy("row_no", "col_no").agg(F.count("*").alias("events"))


@query("footprint_union", f"SELECT DISTINCT row_no, col_no FROM ({DISCS})")
def _(fx: Fixtures) -> DataFrame:
    return event_discs(fx).select("row_no", "col_no").distinct()


@query("bbox_area_km2", "SELECT item_id, round(6371.0088e0 * 6371.0088e0 * radians(east - west) * (sin(radians(north)) - sin(radians(south))), 4) AS km2 FROM stac_items")
def _(fx: Fixtures) -> DataFrame:
    return fx.stac_items.select("item_id", F.round(S.bbox_area_km2(F.col("west"), F.col("south"), F.col("east"), F.col("north")), 4).alias("km2"))


@query("geometry_validity", f"SELECT admin_id, abs(sum(x1 * y2 - x2 * y1) / 2) AS area, count(*) + 1 >= 4 AND sum(x1 * y2 - x2 * y1) <> 0 AS valid FROM ({EDGES}) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return grid.valid_rings(fx.admin_points)


@query("clip_bbox_half_cell", "SELECT cell_id FROM population_cells WHERE lon BETWEEN 31 - 0.05e0 AND 32 + 0.05e0 AND lat BETWEEN 18 - 0.05e0 AND 19 + 0.05e0")
def _(fx: Fixtures) -> DataFrame:
    return fx.population_cells.where(F.col("lon").between(31 - 0.05, 32 + 0.05) & F.col("lat").between(18 - 0.05, 19 + 0.05)).select("cell_id")


@query("clip_cube_to_country", f"SELECT hcell_id, day FROM hazard_daily WHERE hcell_id IN (SELECT CAST(floor(row_no / 2) * 10 + floor(col_no / 5) AS BIGINT) FROM (SELECT admin_id, row_no, col_no FROM ({FILL}) UNION SELECT admin_id, row_no, col_no FROM ({CROSSED})) WHERE admin_id IN (1, 7, 13))")
def _(fx: Fixtures) -> DataFrame:
    cells = grid.touched(fx.admin_points.where("admin_id in (1, 7, 13)"))
    native = cells.select(align.hazard_cell(F.col("row_no"), F.col("col_no"), 2, 5, 10).alias("hcell_id")).distinct()
    return fx.hazard_daily.join(native, "hcell_id", "left_semi").select("hcell_id", "day")


@query("zonal_sum", f"SELECT admin_id, {dec('pop')} AS pop FROM ({FILL}) f JOIN population_cells p ON p.row_no = f.row_no AND p.col_no = f.col_no GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return grid.fill(fx.admin_points).join(fx.population_cells, ["row_no", "col_no"]).groupBy("admin_id").agg(S.dsum(F.col("pop")).alias("pop"))


@query("severity_max_band", "SELECT hcell_id, coalesce(max(CASE WHEN mmi >= t THEN t END), 0) AS severity FROM (SELECT hcell_id, max(mmi) AS mmi FROM shake_cells GROUP BY hcell_id), (VALUES (5), (6), (7)) AS x(t) GROUP BY hcell_id")
def _(fx: Fixtures) -> DataFrame:
    m = fx.shake_cells.groupBy("hcell_id").agg(F.max("mmi").alias("mmi")).withColumn("t", F.explode(F.array(*map(F.lit, (5, 6, 7)))))
    return m.groupBy("hcell_id").agg(F.coalesce(F.max(F.when(F.col("mmi") >= F.col("t"), F.col("t"))), F.lit(0)).alias("severity"))


# Layers on grids of their own


@query("grid_align_affine", """SELECT cell_id, source_id, value FROM (SELECT p.cell_id, s.grid_id AS source_id, CASE WHEN s.crs = t.crs AND gx >= 0 AND gx < s.cols AND gy >= 0 AND gy < s.rows THEN gx END AS gx, gy
  FROM (SELECT p.cell_id, s.grid_id AS source_id, floor(round((t.x0 + (col_no + 0.5e0) * t.dx - s.x0) / s.dx, 9)) AS gx, floor(round((s.y0 - (t.y0 - (row_no + 0.5e0) * t.dy)) / s.dy, 9)) AS gy FROM population_cells p, grid_table t, grid_table s WHERE t.grid_id = 0 AND s.grid_id > 0) p JOIN grid_table s ON s.grid_id = p.source_id JOIN grid_table t ON t.grid_id = 0)
 LEFT JOIN layer_cells l ON l.grid_id = source_id AND l.row_no = gy AND l.col_no = gx""")
def _(fx: Fixtures) -> DataFrame:
    """Population cells with the value of each of four layers, whose grids have origins and
    spacings of their own; one is in another reference system and gives nothing."""
    sources = fx.grid_table.where("grid_id > 0").select(F.col("grid_id").alias("source_id"))
    fine = fx.population_cells.select("cell_id", "row_no", "col_no", F.lit(0).alias("grid_id")).join(F.broadcast(sources), F.col("source_id") != F.col("grid_id"))
    return grids.nearest(fine, fx.layer_cells, fx.grid_table, ("cell_id", "source_id"), "value").select("cell_id", "source_id", "value")


@query("grid_average_affine", """WITH b AS (SELECT p.pop, t.grid_id AS target_id, t.cols, t.rows, (s.x0 + p.col_no * s.dx - t.x0) / t.dx AS c0, s.dx / t.dx AS w, (t.y0 - (s.y0 - p.row_no * s.dy)) / t.dy AS r0, s.dy / t.dy AS h FROM population_cells p, grid_table s, grid_table t WHERE s.grid_id = 0 AND t.grid_id > 0 AND s.crs = t.crs AND pop IS NOT NULL),
 o AS (SELECT target_id, r AS row_no, c AS col_no, pop, CAST(greatest(0e0, least(c0 + w, c + 1) - greatest(c0, c)) * greatest(0e0, least(r0 + h, r + 1) - greatest(r0, r)) AS DECIMAL(20, 12)) AS a FROM b, (SELECT unnest(range(0, 90)) AS c), (SELECT unnest(range(0, 200)) AS r) WHERE c < cols AND r < rows AND c < c0 + w AND c + 1 > c0 AND r < r0 + h AND r + 1 > r0)
 SELECT target_id, row_no, col_no, round(CAST(sum(CAST(pop * CAST(a AS DOUBLE) AS DECIMAL(28, 12))) AS DOUBLE) / CAST(sum(a) AS DOUBLE), 4) AS pop, round(CAST(sum(a) AS DOUBLE), 6) AS share FROM o WHERE a > 0 GROUP BY ALL""")
def _(fx: Fixtures) -> DataFrame:
    """Population averaged to other grids by the area in common: ratios of 2.5, of 7 by 3, and
    of a half by one and a half."""
    targets = fx.grid_table.where("grid_id > 0").select(F.lit(0).alias("grid_id"), F.col("grid_id").alias("target_id"))
    cells = fx.population_cells.select(F.lit(0).alias("grid_id"), "row_no", "col_no", "pop")
    return grids.average(cells, fx.grid_table, targets, "pop").withColumn("pop", F.round("pop", 4))


@query("grid_match_affine", "SELECT a.grid_id, b.grid_id AS other_id, abs(a.x0 - b.x0) <= 1e-9 AND abs(a.y0 - b.y0) <= 1e-9 AS same_corner, abs(a.dx - b.dx) <= 1e-9 AND abs(a.dy - b.dy) <= 1e-9 AS same_spacing, a.cols = b.cols AND a.rows = b.rows AS same_shape, a.crs = b.crs AS same_crs, a.grid_id = b.grid_id AS aligned FROM grid_table a, grid_table b WHERE a.grid_id <= b.grid_id")
def _(fx: Fixtures) -> DataFrame:
    """Every two grids by origin, spacing, shape and reference system."""
    ids = fx.grid_table.select("grid_id")
    pairs = ids.join(F.broadcast(ids.withColumnRenamed("grid_id", "other_id")), F.col("grid_id") <= F.col("other_id"))
    return grids.matched(fx.grid_table, pairs)


STOPS = "SELECT c_custkey AS admin_id, o_orderkey AS seq, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey % 7 AS DOUBLE) END AS x, CASE o_orderstatus WHEN 'F' THEN 1e0 ELSE CAST(o_orderkey % 5 AS DOUBLE) END AS y FROM orders JOIN customer ON c_custkey = o_custkey"


@query("ring_defects", f"""WITH p AS (SELECT * FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM ({STOPS}) WHERE x IS NOT NULL WINDOW w AS (PARTITION BY admin_id ORDER BY seq)) WHERE px IS NULL OR x <> px OR y <> py),
 o AS (SELECT * FROM (SELECT *, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy, row_number() OVER (PARTITION BY admin_id ORDER BY seq) AS r, count(*) OVER (PARTITION BY admin_id) AS n FROM p WINDOW w AS (PARTITION BY admin_id ORDER BY seq)) WHERE r < n OR r = 1 OR x <> fx OR y <> fy),
 e AS (SELECT admin_id, x, y, coalesce(lead(x) OVER w, fx) AS x2, coalesce(lead(y) OVER w, fy) AS y2 FROM o WINDOW w AS (PARTITION BY admin_id ORDER BY seq)),
 a AS (SELECT admin_id, count(*) AS places, abs(sum(x * y2 - x2 * y) / 2) AS area FROM e GROUP BY admin_id)
SELECT c_custkey AS admin_id, coalesce(places, 0) AS places, coalesce(area, 0) AS area, CASE WHEN places IS NULL THEN 'empty' WHEN places < 3 THEN 'too_few' WHEN area <= 1e-12 THEN 'zero_area' END AS defect FROM customer LEFT JOIN a ON admin_id = c_custkey""")
def _(fx: Fixtures) -> DataFrame:
    """Rings of any number of places, some of them without a place, closed or without area."""
    o = fx.table("orders")
    stops = o.select(F.col("o_custkey").alias("admin_id"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_orderkey") % 7).cast("double")).alias("x"), F.when(F.col("o_orderstatus") == "F", 1.0).otherwise((F.col("o_orderkey") % 5).cast("double")).alias("y"))
    return grid.ring_defects(fx.table("customer").select(F.col("c_custkey").alias("admin_id")), stops)
