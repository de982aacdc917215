"""Polygons, boxes, points and discs on cell grids, as joins and Column arithmetic.

Rings are rows (unit, seq, x, y) in grid units: column centres at col + 0.5, row centres
at row + 0.5, rows counting down. Only the rows that an edge spans are made, so the work is
proportional to boundary length and filled area, never to edges times rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapop.functions.scalar import haversine_km


def edges(points: DataFrame, unit: str = "admin_id") -> DataFrame:
    """Edges (x1, y1)-(x2, y2) of each unit's ring; the last point joins the first."""
    w = Window.partitionBy(unit).orderBy("seq")
    every = Window.partitionBy(unit)
    nx, ny = F.lead("x").over(w), F.lead("y").over(w)
    first = F.min_by(F.struct("x", "y"), "seq").over(every)
    return points.select(unit, "seq", F.col("x").alias("x1"), F.col("y").alias("y1"), F.coalesce(nx, first["x"]).alias("x2"), F.coalesce(ny, first["y"]).alias("y2"))


def crossings(edge: DataFrame, unit: str = "admin_id") -> DataFrame:
    """Where edges cross the centre lines of rows; half open, so that a vertex counts once."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    r0, r1 = F.ceil(low - 0.5), F.ceil(high - 0.5) - 1
    spans = edge.where("y1 <> y2").withColumn("row_no", F.explode(F.when(r1 >= r0, F.sequence(r0, r1)).otherwise(F.array().cast("array<bigint>"))))
    return spans.select(unit, "row_no", (F.col("x1") + (F.col("row_no") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"))


def fill(points: DataFrame, unit: str = "admin_id") -> DataFrame:
    """(unit, row_no, col_no) of cells whose centre is inside: even-odd pairs of crossings
    along each row. Overlapping units each keep the cell."""
    w = Window.partitionBy(unit, "row_no").orderBy("x")
    paired = crossings(edges(points, unit), unit).withColumns({"x2": F.lead("x").over(w), "n": F.row_number().over(w)}).where("n % 2 = 1 and x2 is not null")
    c0, c1 = F.ceil(F.col("x") - 0.5), F.ceil(F.col("x2") - 0.5) - 1
    return paired.where(c1 >= c0).select(unit, "row_no", F.explode(F.sequence(c0, c1)).alias("col_no"))


def last_unit(cells: DataFrame, unit: str = "admin_id") -> DataFrame:
    """One unit for each cell: the largest, in place of drawing order."""
    return cells.groupBy("row_no", "col_no").agg(F.max(unit).alias(unit))


def touched(points: DataFrame, unit: str = "admin_id") -> DataFrame:
    """Cells that the unit's area or boundary touches: the fill and the cells on edges.

    Cells are half open, so a boundary that runs along a grid line touches one side.
    """
    e = edges(points, unit)
    lo, hi = F.floor(F.least("y1", "y2")), F.ceil(F.greatest("y1", "y2")) - 1
    spans = e.withColumn("row_no", F.explode(F.sequence(lo, F.greatest(lo, hi))))
    dy = F.col("y2") - F.col("y1")
    at = lambda y: F.when(dy == 0, F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.when(dy == 0, 1.0).otherwise(dy))
    top = at(F.greatest(F.col("row_no").cast("double"), F.least("y1", "y2")))
    bottom = F.when(dy == 0, F.col("x2")).otherwise(at(F.least(F.col("row_no") + 1.0, F.greatest("y1", "y2"))))
    c0, c1 = F.floor(F.least(top, bottom)), F.greatest(F.floor(F.least(top, bottom)), F.ceil(F.greatest(top, bottom)) - 1)
    return fill(points, unit).unionByName(spans.select(unit, "row_no", F.explode(F.sequence(c0, c1)).alias("col_no"))).distinct()


def row_span(points: DataFrame) -> DataFrame:
    """One row (top, bottom): the rows of the grid that hold all cells of ``touched`` units."""
    return points.agg((F.floor(F.min("y")) - 1).alias("top"), (F.ceil(F.max("y")) + 1).alias("bottom"))


def cover_index(rings: DataFrame, unit: str = "admin_id", size: float = 1.0) -> DataFrame:
    """Cells (row_no, col_no) of ``size`` that units cover: (unit, row_no, col_no, corner,
    edges). An interior cell has ``edges`` null: all of it is inside. A boundary cell has
    the edges that touch it, and whether the place just beyond its upper right corner
    (column + 1, row) is inside.

    Where no edge comes, being inside doesn't change: the corner of a boundary cell answers
    for all cells up to the next boundary cell of the row, so interior cells are runs
    between two of them, and areas cost nothing before they are cells.
    """
    e = edges(rings, unit)
    lo, hi, dy = F.least("y1", "y2"), F.greatest("y1", "y2"), F.col("y2") - F.col("y1")
    at = lambda y: F.when(dy == 0, F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.when(dy == 0, 1.0).otherwise(dy))
    spans = e.withColumn("row_no", F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))))
    top = at(F.greatest(F.col("row_no") * F.lit(size), lo))
    bottom = F.when(dy == 0, F.col("x2")).otherwise(at(F.least((F.col("row_no") + 1) * F.lit(size), hi)))
    c0, c1 = F.ceil(F.least(top, bottom) / size - 1e-9) - 1, F.floor(F.greatest(top, bottom) / size + 1e-9)
    cells = spans.withColumn("col_no", F.explode(F.sequence(c0, c1))).groupBy(unit, "row_no", "col_no").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    # How many edges cross the line y = row beyond each corner.
    first, last = F.ceil(lo / size), F.ceil(hi / size) - 1
    lines = e.where("y1 <> y2").withColumn("row_no", F.explode(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    crossed = lines.select(unit, "row_no", F.lit(None).cast("long").alias("col_no"), at(F.col("row_no") * F.lit(size)).alias("x"), F.lit(1).alias("n"))
    asked = cells.select(unit, "row_no", "col_no", ((F.col("col_no") + 1) * F.lit(size)).alias("x"), F.lit(0).alias("n"))
    beyond = Window.partitionBy(unit, "row_no").orderBy(F.desc("x"), "n").rowsBetween(Window.unboundedPreceding, 0)
    corners = crossed.unionByName(asked).withColumn("corner", F.sum("n").over(beyond) % 2 == 1).where("col_no is not null").select(unit, "row_no", "col_no", "corner")
    nxt = F.lead("col_no").over(Window.partitionBy(unit, "row_no").orderBy("col_no"))
    runs = corners.withColumn("next", nxt).where(F.col("corner") & (F.col("next") > F.col("col_no") + 1))
    inside = runs.select(unit, "row_no", F.explode(F.sequence(F.col("col_no") + 1, F.col("next") - 1)).alias("col_no"), F.lit(True).alias("corner"), F.lit(None).cast(cells.schema["edges"].dataType).alias("edges"))
    return cells.join(corners, [unit, "row_no", "col_no"]).select(unit, "row_no", "col_no", "corner", "edges").unionByName(inside)


def points_in_units(points: DataFrame, rings: DataFrame, unit: str = "admin_id", size: float = 1.0) -> DataFrame:
    """(point_id, unit) of points (point_id, px, py) inside a unit, by a cover index.

    A point meets the units of its own cell: an interior cell answers alone; in a boundary
    cell the way from the point right to the cell's border and up to its corner is followed,
    and each edge that it crosses changes the corner's answer. A border is left of the
    points on it and above them.
    """
    index = cover_index(rings, unit, size)
    met = points.select("point_id", "px", "py", F.floor(F.col("py") / size).alias("row_no"), F.floor(F.col("px") / size).alias("col_no")).join(index, ["row_no", "col_no"])
    px, py, border, line = F.col("px"), F.col("py"), (F.col("col_no") + 1) * F.lit(size), F.col("row_no") * F.lit(size)

    def crossings_of(g: Column) -> Column:
        dx, dy = g["x2"] - g["x1"], g["y2"] - g["y1"]
        x = g["x1"] + (py - g["y1"]) * dx / F.when(dy == 0, 1.0).otherwise(dy)
        across = ((g["y1"] > py) != (g["y2"] > py)) & (px < x) & (x <= border)
        y = g["y1"] + (border - g["x1"]) * dy / F.when(dx == 0, 1.0).otherwise(dx)
        rising = (dx > 0) == (dy > 0)
        below = lambda t: (y > t) | ((y == t) & rising & (dy != 0))
        along = ((g["x1"] > border) != (g["x2"] > border)) & below(line) & ~below(py)
        return across.cast("int") + along.cast("int")

    n = F.aggregate("edges", F.lit(0), lambda total, g: total + crossings_of(g))
    return met.where(F.when(F.col("edges").isNull(), True).otherwise((n % 2 == 1) != F.col("corner"))).select("point_id", unit)


def overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(hi1, hi2) - F.greatest(lo1, lo2))


def padded_box(lon: Column, lat: Column) -> dict[str, Column]:
    """The box (w, s, e, n) wider by ``lon`` and ``lat`` degrees on each side, on the globe."""
    return {"w": F.greatest(F.lit(-180.0), F.col("w") - lon), "s": F.greatest(F.lit(-90.0), F.col("s") - lat), "e": F.least(F.lit(180.0), F.col("e") + lon), "n": F.least(F.lit(90.0), F.col("n") + lat)}


def bbox_coverage(target: tuple[Column, ...], layer: tuple[Column, ...]) -> Column:
    """Share of the target box (w, s, e, n) that the layer box covers, in percent."""
    area = (target[2] - target[0]) * (target[3] - target[1])
    shared = overlap(target[0], target[2], layer[0], layer[2]) * overlap(target[1], target[3], layer[1], layer[3])
    return F.when(area > 0, 100 * shared / area)


def union_coverage(boxes: DataFrame, target: tuple[float, float, float, float], per_tile: int = 32) -> DataFrame:
    """Share of the target box covered by the union of boxes (w, s, e, n).

    Vertical tiles, as many as keep about ``per_tile`` distinct boxes' edges in each, cut
    boxes and target. Within a tile distinct edges make strips, and in each strip boxes
    merge by a running maximum: no window spans the whole table, and no product of all x
    and all y edges is made.
    """
    w, s, e, n = target
    b = boxes.select(F.greatest("w", F.lit(w)).alias("w"), F.greatest("s", F.lit(s)).alias("s"), F.least("e", F.lit(e)).alias("e"), F.least("n", F.lit(n)).alias("n")).where("w < e and s < n").distinct()
    tiles = F.greatest(F.lit(1), F.ceil(F.lit(2.0) * b.agg(F.count("*")).scalar() / per_tile)).cast("long")
    size = F.lit(e - w) / F.col("tiles")
    tile = lambda c: F.least(F.floor((F.col(c) - w) / size), F.col("tiles") - 1)
    cut = b.withColumn("tiles", tiles).withColumn("tile", F.explode(F.sequence(tile("w"), tile("e"))))
    left, right = w + F.col("tile") * size, w + (F.col("tile") + 1) * size
    cut = cut.withColumns({"w": F.greatest("w", left), "e": F.least("e", right)}).where("w < e").select("tile", "w", "s", "e", "n")
    edge = cut.select("tile", F.explode(F.array("w", "e")).alias("x")).distinct()
    strip = edge.withColumn("x2", F.lead("x").over(Window.partitionBy("tile").orderBy("x"))).where("x2 is not null")
    met = strip.join(cut, "tile").where("w <= x and e >= x2")
    run = Window.partitionBy("tile", "x").orderBy("s", "n").rowsBetween(Window.unboundedPreceding, -1)
    length = met.withColumn("top", F.max("n").over(run)).groupBy("tile", "x", "x2").agg(F.sum(F.greatest(F.lit(0.0), F.col("n") - F.greatest(F.coalesce("top", F.col("s")), F.col("s")))).alias("len"))
    return length.agg(F.round(100 * F.coalesce(F.sum(F.col("len") * (F.col("x2") - F.col("x"))), F.lit(0.0)) / ((e - w) * (n - s)), 6).alias("coverage_pct"))


def near_units(points: DataFrame, rings: DataFrame, km: float, tile: float = 0.5, unit: str = "admin_id") -> DataFrame:
    """(point_id) of points (point_id, lon, lat) inside a ring or within ``km`` of its
    boundary; rings are (unit, seq, x, y) in degrees.

    Distances to edges are taken in a plane that touches the sphere at the point, good to
    some metres in a hundred kilometres. Points meet only the edges of their tile, which
    take in the padded box of an edge.
    """
    per = 111.19492664455873
    lat_pad, lon_pad = km / per, F.lit(km / per) / F.cos(F.radians(F.least(F.lit(85.0), F.greatest(F.abs("y1"), F.abs("y2")) + km / per)))
    at = lambda c: F.floor(c / tile)
    e = edges(rings, unit)
    tiled = e.withColumn("tx", F.explode(F.sequence(at(F.least("x1", "x2") - lon_pad), at(F.greatest("x1", "x2") + lon_pad)))).withColumn("ty", F.explode(F.sequence(at(F.least("y1", "y2") - lat_pad), at(F.greatest("y1", "y2") + lat_pad))))
    met = points.withColumns({"tx": at(F.col("lon")), "ty": at(F.col("lat"))}).join(tiled, ["tx", "ty"])
    close = met.where(F.round(segment_km(F.col("lon"), F.col("lat"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), 6) <= km).select("point_id")
    inside = points_in_units(points.select("point_id", F.col("lon").alias("px"), F.col("lat").alias("py")), rings, unit, tile).select("point_id")
    return close.unionByName(inside).distinct()


def segment_km(lon: Column, lat: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a place to a segment, in the plane that touches the sphere at the place."""
    per = F.lit(111.19492664455873)
    k = F.cos(F.radians(lat)) * per
    ax, ay, bx, by = (x1 - lon) * k, (y1 - lat) * per, (x2 - lon) * k, (y2 - lat) * per
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / length))).otherwise(0.0)
    return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))


def disc_cells(points: DataFrame, x0: float, y0: float, step: float, radius_km: Column, rows: int | None, cols: int, touched_rule: bool = True) -> DataFrame:
    """(point_id, row_no, col_no) of cells within ``radius_km`` of a point (point_id, lon,
    lat): of the cell's nearest place (touched), else of its centre. Only cells in the
    disc's box are looked at. ``rows`` None: the grid has no last row."""
    km_lat = 111.19492664455873
    dlat, dlon = radius_km / km_lat, radius_km / (km_lat * F.cos(F.radians("lat")))
    r0, r1 = F.floor((y0 - F.col("lat") - dlat) / step), F.floor((y0 - F.col("lat") + dlat) / step)
    c0, c1 = F.floor((F.col("lon") - dlon - x0) / step), F.floor((F.col("lon") + dlon - x0) / step)
    r0, c0, c1 = F.greatest(r0, F.lit(0)), F.greatest(c0, F.lit(0)), F.least(c1, F.lit(cols - 1))
    r1 = r1 if rows is None else F.least(r1, F.lit(rows - 1))
    none = F.array().cast("array<bigint>")
    span = lambda lo, hi: F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none))
    box = points.withColumn("_r", radius_km).where(F.col("_r").isNotNull()).withColumn("row_no", span(r0, r1)).withColumn("col_no", span(c0, c1))
    left, top = x0 + F.col("col_no") * step, y0 - F.col("row_no") * step
    if touched_rule:
        near_lon, near_lat = F.least(F.greatest(F.col("lon"), left), left + step), F.greatest(F.least(F.col("lat"), top), top - step)
    else:
        near_lon, near_lat = left + step / 2, top - step / 2
    within = F.round(haversine_km(F.col("lon"), F.col("lat"), near_lon, near_lat), 6) <= F.col("_r")
    return box.where(within).select("point_id", F.col("row_no").cast("long").alias("row_no"), F.col("col_no").cast("long").alias("col_no"))


def valid_rings(points: DataFrame, unit: str = "admin_id") -> DataFrame:
    """Units with four or more ring places (the closing one counted) and a non-zero area."""
    e = edges(points, unit).groupBy(unit).agg(F.count("*").alias("n"), (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))
    return e.select(unit, F.abs("area").alias("area"), ((F.col("n") + 1 >= 4) & (F.col("area") != 0)).alias("valid"))


def ring_defects(units: DataFrame, points: DataFrame, unit: str = "admin_id") -> DataFrame:
    """(``unit``, places, area, defect) of every one of ``units``: places of its ring without
    null coordinates and without repeats of the one before, the ring's area, and empty,
    too_few or zero_area, or null for a sound ring. A ring needs not be closed; one that is
    has its first place once."""
    w = Window.partitionBy(unit).orderBy("seq")
    some = points.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    before = F.lag(F.struct("x", "y")).over(w)
    apart = some.withColumn("before", before).where("before is null or x <> before.x or y <> before.y").drop("before")
    first = F.min_by(F.struct("seq", "x", "y"), "seq").over(Window.partitionBy(unit))
    last = F.max("seq").over(Window.partitionBy(unit))
    opened = apart.withColumns({"first": first, "last": last}).where("seq < last or seq = first.seq or x <> first.x or y <> first.y").drop("first", "last")
    ring = edges(opened, unit).groupBy(unit).agg(F.count("*").alias("places"), F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))
    every = units.select(unit).join(ring, unit, "left").withColumns({"places": F.coalesce("places", F.lit(0)), "area": F.coalesce("area", F.lit(0.0))})
    return every.withColumn("defect", F.when(F.col("places") == 0, "empty").when(F.col("places") < 3, "too_few").when(F.col("area") <= 1e-12, "zero_area"))


def units_of_codes(units: DataFrame, codes: DataFrame) -> DataFrame:
    """Units (iso3, ...) beside the codes (``code``) that ask for them: those of the code
    itself; if there are none, those whose code has the same first three letters."""
    met = units.withColumn("_three", F.substring("iso3", 1, 3)).join(codes.withColumn("_three", F.substring("code", 1, 3)), "_three").drop("_three")
    exact = F.col("iso3") == F.col("code")
    found = met.where(exact).select("code").distinct().withColumn("_exact", F.lit(True))
    return met.join(F.broadcast(found), "code", "left").where(F.coalesce(exact, F.lit(False)) | F.col("_exact").isNull()).drop("_exact")


def required(rows: DataFrame, what: str) -> DataFrame:
    """``rows``, or ValueError if there are none."""
    if not rows.limit(1).count():
        raise ValueError(f"no rows of {what}")
    return rows
