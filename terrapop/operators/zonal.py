"""Sums by administrative unit and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapop.functions.scalar import dsum, pct


def labelled_sum(cells: DataFrame, labels: DataFrame, units: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Sums of cell values by unit; units without cells have 0. Labels below 1 are none.

    ``values`` may name columns of the cells. One shuffle by unit after map-side sums.
    """
    joined = cells.join(labels.where("admin_id > 0").select("cell_id", "admin_id"), "cell_id")
    sums = joined.groupBy("admin_id").agg(*[dsum(c).alias(n) for n, c in values.items()])
    return units.select("admin_id").join(sums, "admin_id", "left").na.fill(0.0, list(values))


def exposure(cells: DataFrame, labels: DataFrame, units: DataFrame, affected: Column) -> DataFrame:
    """admin_id, pop_total, pop_affected, pct_affected; ``cells`` has a clean ``pop``."""
    hit = F.when(F.coalesce(affected, F.lit(False)), F.col("pop")).otherwise(F.when(F.col("pop").isNotNull(), 0.0))
    out = labelled_sum(cells, labels, units, {"pop_total": F.col("pop"), "pop_affected": hit})
    return out.withColumn("pct_affected", pct(F.col("pop_affected"), F.col("pop_total")))


def exposure_bands(cells: DataFrame, labels: DataFrame, units: DataFrame, bands: dict[tuple[str, str], Column]) -> DataFrame:
    """admin_id, hazard, threshold, pop_total, pop_affected, pct_affected: a row for each
    unit and band (hazard, threshold), all from one pass over the cells with a conditional
    sum for each band."""
    return exposure_bands_of(cells.join(labels.where("admin_id > 0").select("cell_id", "admin_id"), "cell_id"), units, bands)


def exposure_bands_of(labelled: DataFrame, units: DataFrame, bands: dict[tuple[str, str], Column]) -> DataFrame:
    """The same for cells that carry their ``admin_id``."""
    name = [f"band_{k}" for k in range(len(bands))]
    hit = lambda c: F.when(F.coalesce(c, F.lit(False)), F.col("pop")).otherwise(F.when(F.col("pop").isNotNull(), 0.0))
    sums = labelled.groupBy("admin_id").agg(dsum(F.col("pop")).alias("pop_total"), *[dsum(hit(c)).alias(n) for n, c in zip(name, bands.values(), strict=True)])
    sums = units.select("admin_id").join(sums, "admin_id", "left").na.fill(0.0, ["pop_total", *name])
    rows = F.array(*[F.struct(F.lit(h).alias("hazard"), F.lit(t).alias("threshold"), F.col(n).alias("pop_affected")) for n, (h, t) in zip(name, bands, strict=True)])
    long = sums.select("admin_id", "pop_total", F.explode(rows).alias("b")).select("admin_id", "b.hazard", "b.threshold", "pop_total", "b.pop_affected")
    return long.withColumn("pct_affected", pct(F.col("pop_affected"), F.col("pop_total")))


def with_national(units: DataFrame) -> DataFrame:
    """Unit rows and country rows (admin_id null) in one pass of grouping sets."""
    rows = units.groupingSets([["iso3", "admin_id"], ["iso3"]], "iso3", "admin_id").agg(dsum(F.col("pop_total")).alias("pop_total"), dsum(F.col("pop_affected")).alias("pop_affected"))
    return rows.withColumn("pct_affected", pct(F.col("pop_affected"), F.col("pop_total")))


def above_national(units: DataFrame, by: tuple[str, ...] = ("iso3",)) -> DataFrame:
    """Flags units whose percentage exceeds their country's; false where it is missing.
    ``by`` names the country and what else tells tables apart, such as a threshold."""
    national = units.groupBy(*by).agg(dsum(F.col("pop_total")).alias("t"), dsum(F.col("pop_affected")).alias("a")).select(*by, pct(F.col("a"), F.col("t")).alias("national_pct"))
    return units.join(F.broadcast(national), list(by)).withColumn("deprived", F.coalesce(F.col("pct_affected") > F.col("national_pct"), F.lit(False)))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.round(F.try_divide(dsum(value * weight), dsum(weight)), 6)
