"""Rules over time: any, maximum, days, runs of days, first and preferred rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a given, total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def any_over_time(df: DataFrame, cell: str, condition: Column) -> DataFrame:
    """Whether the condition ever holds in a cell; null values don't fulfil it."""
    return df.groupBy(cell).agg(F.bool_or(F.coalesce(condition, F.lit(False))).alias("affected"))


def max_over_events(df: DataFrame, cell: str, value: str) -> DataFrame:
    return df.groupBy(cell).agg(F.max(F.when(~F.isnan(value), F.col(value))).alias(value))


def flood_days(obs: DataFrame, cell: str, ts: str, pix: str, nodata: int = 255) -> DataFrame:
    """Days with at least one hit per cell; acquisitions of a day count once.

    Days are bits: each 64 days of a cell are one number, joined bitwise before the shuffle,
    so that what is shuffled is a few numbers a cell and not its days.
    """
    hit = (F.col(pix) > 0) & (F.col(pix) != nodata)
    day = F.unix_date(F.to_date(ts))
    bit = F.when(hit, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(64)).cast("int")))
    words = obs.groupBy(cell, F.floor(day / 64).alias("days_word")).agg(F.bit_or(bit).alias("days"))
    return words.groupBy(cell).agg(F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("long").alias("flood_days"))


def flood_hits(obs: DataFrame, cell: str, pix: str, nodata: int = 255) -> DataFrame:
    """The variant in which every acquisition counts."""
    return obs.groupBy(cell).agg(F.count_if((F.col(pix) > 0) & (F.col(pix) != nodata)).alias("flood_hits"))


def axis(df: DataFrame, t: str) -> DataFrame:
    """Position of each time on the shared axis. As many rows as there are steps."""
    return df.select(t).distinct().withColumn("axis_idx", F.row_number().over(Window.orderBy(t)))


def runs_of_exceedance(df: DataFrame, cell: str, t: str, condition: Column) -> DataFrame:
    """Runs of consecutive positions on the shared axis: (cell, first, last, length).

    Only exceeding rows are windowed (sparse form), so a day missing from every cell does
    not break a run, and one missing from a cell does.
    """
    hits = df.where(condition).select(cell, t).distinct().join(axis(df, t), t)
    w = Window.partitionBy(cell).orderBy("axis_idx")
    return hits.withColumn("island", F.col("axis_idx") - F.row_number().over(w)).groupBy(cell, "island").agg(F.min(t).alias("first"), F.max(t).alias("last"), F.count("*").alias("length")).drop("island")


def consecutive_k(df: DataFrame, cell: str, t: str, condition: Column, k: int) -> DataFrame:
    """Cells with a run of ``k`` or more."""
    return runs_of_exceedance(df, cell, t, condition).where(F.col("length") >= k).select(cell).distinct()


def run_floor(df: DataFrame, cell: str, t: str, value: str, k: int) -> DataFrame:
    """(cell, floor): the greatest value that is exceeded on ``k`` consecutive positions of
    the shared axis, or just not. One pass serves all thresholds: a run of ``k`` above a
    threshold is there if and only if the floor is above it."""
    w = Window.partitionBy(cell).orderBy("axis_idx")
    on_axis = df.where(F.col(value).isNotNull()).select(cell, t, value).join(axis(df, t), t)
    last = on_axis.withColumns({"first_idx": F.lag("axis_idx", k - 1).over(w), "least": F.min(value).over(w.rowsBetween(1 - k, 0))})
    return last.where(F.col("axis_idx") - F.col("first_idx") == k - 1).groupBy(cell).agg(F.max("least").alias("floor"))


def consecutive_k_rolling(df: DataFrame, cell: str, t: str, condition: Column, k: int) -> DataFrame:
    """The same by a rolling sum over a dense cell by step table."""
    steps = axis(df, t).agg(F.sort_array(F.collect_list(F.struct("axis_idx", t)))).scalar()
    dense = df.select(cell).distinct().select(cell, F.explode(steps).alias("s")).select(cell, "s.*").join(df.select(cell, t, F.coalesce(condition, F.lit(False)).cast("int").alias("x")), [cell, t], "left")
    w = Window.partitionBy(cell).orderBy("axis_idx").rowsBetween(1 - k, 0)
    return dense.withColumn("s", F.sum(F.coalesce("x", F.lit(0))).over(w)).where(F.col("s") == k).select(cell).distinct()


def to_celsius_by_file(df: DataFrame, value: str, t: str, file: str) -> DataFrame:
    """Subtracts 273.15 in files whose first time step has a mean above 100. Means are taken
    by file and step with partial sums; a file's rows never meet in one task."""
    steps = df.groupBy(file, t).agg(F.avg(value).alias("mean"))
    kelvin = steps.groupBy(file).agg((F.min_by("mean", t) > 100).alias("kelvin"))
    return df.join(kelvin, file).withColumn(value, F.when(F.col("kelvin"), F.col(value) - 273.15).otherwise(F.col(value))).drop("kelvin")
