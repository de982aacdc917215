"""Grids of any origin, spacing and shape, and the alignment of layers between them.

A grid is a row (grid_id, x0, y0, dx, dy, cols, rows, crs): the north-west corner, the size of
a cell, how many there are, and the reference system. Layers are long tables (grid_id,
row_no, col_no, value). A target cell finds its source by arithmetic on both transforms; what
lies outside of the source has no value. Grids of unlike systems are not aligned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("x0", "y0", "dx", "dy", "cols", "rows", "crs")


def _of(grids: DataFrame, tail: str, key: str) -> DataFrame:
    return F.broadcast(grids.select(F.col("grid_id").alias(key), *[F.col(c).alias(c + tail) for c in FIELDS]))


def placed(cells: DataFrame, grids: DataFrame, targets: DataFrame) -> DataFrame:
    """``cells`` (grid_id, row_no, col_no, ...) beside each target grid of the table ``targets``
    (grid_id, target_id; grids are few) that has the same reference system, with both grids'
    fields (``_s`` and ``_t``)."""
    pairs = targets.join(_of(grids, "_s", "grid_id"), "grid_id").join(_of(grids, "_t", "target_id"), "target_id").where("crs_s = crs_t")
    return cells.join(F.broadcast(pairs), "grid_id")


def nearest(fine: DataFrame, coarse: DataFrame, grids: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """``fine`` (``keys``, grid_id, source_id, row_no, col_no) with ``value`` of the cell of the
    layer ``coarse`` (grid_id, row_no, col_no, ``value``) on grid source_id that holds the
    fine cell's centre; null outside of it, where it has none, and if the systems differ."""
    met = fine.join(_of(grids, "_t", "grid_id"), "grid_id").join(_of(grids, "_s", "source_id"), "source_id")
    x, y = F.col("x0_t") + (F.col("col_no") + 0.5) * F.col("dx_t"), F.col("y0_t") - (F.col("row_no") + 0.5) * F.col("dy_t")
    col, row = F.floor(F.round((x - F.col("x0_s")) / F.col("dx_s"), 9)), F.floor(F.round((F.col("y0_s") - y) / F.col("dy_s"), 9))
    inside = (F.col("crs_s") == F.col("crs_t")) & (col >= 0) & (col < F.col("cols_s")) & (row >= 0) & (row < F.col("rows_s"))
    placed_ = met.select(*keys, "source_id", F.when(inside, row).alias("s_row"), F.when(inside, col).alias("s_col"))
    layer = coarse.select(F.col("grid_id").alias("source_id"), F.col("row_no").alias("s_row"), F.col("col_no").alias("s_col"), value)
    return placed_.join(layer, ["source_id", "s_row", "s_col"], "left").select(*keys, value)


def bilinear_points(fine: DataFrame, grids: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The fine cells with ``fx`` and ``fy``, their centres in units of the grid source_id from
    the centre of its first cell, for the weights of four neighbours."""
    met = fine.join(_of(grids, "_t", "grid_id"), "grid_id").join(_of(grids, "_s", "source_id"), "source_id").where("crs_s = crs_t")
    x, y = F.col("x0_t") + (F.col("col_no") + 0.5) * F.col("dx_t"), F.col("y0_t") - (F.col("row_no") + 0.5) * F.col("dy_t")
    return met.select(*keys, "source_id", ((x - F.col("x0_s")) / F.col("dx_s") - 0.5).alias("fx"), ((F.col("y0_s") - y) / F.col("dy_s") - 0.5).alias("fy"))


def _span(low: Column, high: Column, count: Column) -> Column:
    """Numbers of the target cells that the interval (in units of cells) overlaps."""
    a, b = F.greatest(F.floor(F.round(low, 9)), F.lit(0)), F.least(F.ceil(F.round(high, 9)) - 1, count - 1)
    return F.when(a <= b, F.sequence(a.cast("long"), b.cast("long"))).otherwise(F.array().cast("array<bigint>"))


def average(cells: DataFrame, grids: DataFrame, targets: DataFrame, value: str) -> DataFrame:
    """(target_id, row_no, col_no, ``value``, ``share``): the mean of the source cells that a
    target cell overlaps, weighted by the area in common, for any ratio and offset of the
    two grids. ``share`` is the part of the target cell that has values. A source cell goes
    to the few target cells that its rectangle meets; there is no join of rectangles."""
    met = placed(cells.where(F.col(value).isNotNull()), grids, targets)
    west, north = F.col("x0_s") + F.col("col_no") * F.col("dx_s"), F.col("y0_s") - F.col("row_no") * F.col("dy_s")
    c0, c1 = (west - F.col("x0_t")) / F.col("dx_t"), (west + F.col("dx_s") - F.col("x0_t")) / F.col("dx_t")
    r0, r1 = (F.col("y0_t") - north) / F.col("dy_t"), (F.col("y0_t") - north + F.col("dy_s")) / F.col("dy_t")
    each = met.select("target_id", value, c0.alias("c0"), c1.alias("c1"), r0.alias("r0"), r1.alias("r1"), F.explode(_span(c0, c1, F.col("cols_t"))).alias("t_col"), "rows_t").select("*", F.explode(_span(F.col("r0"), F.col("r1"), F.col("rows_t"))).alias("t_row"))
    part = lambda lo, hi, k: F.greatest(F.lit(0.0), F.least(F.col(hi), F.col(k) + 1) - F.greatest(F.col(lo), F.col(k)))
    weight = (part("c0", "c1", "t_col") * part("r0", "r1", "t_row")).cast("decimal(20,12)")
    weighed = each.select("target_id", F.col("t_row").alias("row_no"), F.col("t_col").alias("col_no"), value, weight.alias("w")).where("w > 0")
    total = F.sum("w").cast("double")
    return weighed.groupBy("target_id", "row_no", "col_no").agg(F.round(F.sum((F.col(value) * F.col("w")).cast("decimal(28,12)")).cast("double") / total, 6).alias(value), F.round(total, 6).alias("share"))


def matched(grids: DataFrame, pairs: DataFrame, precision: float = 1e-9) -> DataFrame:
    """(grid_id, other_id, same_corner, same_spacing, same_shape, same_crs, aligned) of the
    pairs (grid_id, other_id); a grid that isn't there matches nothing."""
    both = pairs.join(_of(grids, "_s", "grid_id"), "grid_id", "left").join(_of(grids, "_t", "other_id"), "other_id", "left")
    near = lambda c: F.abs(F.col(f"{c}_s") - F.col(f"{c}_t")) <= precision
    equal = lambda c: F.col(f"{c}_s") == F.col(f"{c}_t")
    found = {"same_corner": near("x0") & near("y0"), "same_spacing": near("dx") & near("dy"), "same_shape": equal("cols") & equal("rows"), "same_crs": equal("crs")}
    flags = both.select("grid_id", "other_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in found.items()])
    return flags.withColumn("aligned", F.col("same_corner") & F.col("same_spacing") & F.col("same_shape") & F.col("same_crs"))
