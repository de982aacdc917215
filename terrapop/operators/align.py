"""Alignment of a coarse grid to a finer one by equi joins on grid indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hazard_cell(row: Column, col: Column, rows_per: int, cols_per: int, width: int) -> Column:
    """Number of the coarse cell that holds a fine cell; ``width`` coarse cells a row."""
    return (F.floor(row / rows_per) * width + F.floor(col / cols_per)).cast("long")


def grid_index(lon: Column, lat: Column, x0: float, y0: float, dx: float, dy: float) -> tuple[Column, Column]:
    """(row, col) of a point; rows count down from ``y0``."""
    return F.floor((y0 - lat) / dy).cast("long"), F.floor((lon - x0) / dx).cast("long")


def align_nearest(fine: DataFrame, coarse: DataFrame, rows_per: int, cols_per: int, width: int, key: str = "hcell_id") -> DataFrame:
    """Fine cells (row_no, col_no) with the values of their coarse cell, null where none."""
    return fine.withColumn(key, hazard_cell(F.col("row_no"), F.col("col_no"), rows_per, cols_per, width)).join(coarse, key, "left")


def align_bilinear(points: DataFrame, grid: DataFrame, value: str, by: tuple[str, ...] = (), exact: bool = True) -> DataFrame:
    """``points`` (id, fx, fy: fractional centre coordinates) get the weighted mean of the
    four neighbours in ``grid`` (gx, gy, value, and the columns ``by`` that tell several
    grids apart); missing ones drop out and the weights are rescaled. ``exact`` sums are
    decimals, which don't depend on the order of the four."""
    x0, y0 = F.floor("fx").cast("long"), F.floor("fy").cast("long")
    ax, ay = F.col("fx") - x0, F.col("fy") - y0
    corners = F.array(*[F.struct((x0 + i).alias("gx"), (y0 + j).alias("gy"), ((ax if i else 1 - ax) * (ay if j else 1 - ay)).alias("w")) for i in (0, 1) for j in (0, 1)])
    spread = points.select("id", F.explode(corners).alias("c")).select("id", "c.gx", "c.gy", "c.w").where("w > 0")
    met = spread.join(grid.where(F.col(value).isNotNull()), ["gx", "gy"])
    total = (lambda x: F.sum(x.cast("decimal(28,12)")).cast("double")) if exact else F.sum
    return met.groupBy("id", *by).agg(F.round(total(F.col("w") * F.col(value)) / total(F.col("w")), 6).alias(value))


def align_average(fine: DataFrame, value: str, rows_per: int, cols_per: int, width: int) -> DataFrame:
    """Mean of the fine cells in each coarse cell, equal weights (the ratio is whole)."""
    cell = hazard_cell(F.col("row_no"), F.col("col_no"), rows_per, cols_per, width)
    return fine.groupBy(cell.alias("hcell_id")).agg(F.round(F.sum(F.col(value).cast("decimal(18,4)")).cast("double") / F.count(value), 6).alias(value), F.count(value).alias("n"))
