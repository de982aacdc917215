"""Sets of cells as bits: a row of the grid is words of 64 columns, (row_no, word, bits).

An interval of columns is one number a word, however wide; the union of sets is a bitwise
sum that is combined before the shuffle, their intersection a join on words. Cells are made
last, once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 64


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def interval_bits(intervals: DataFrame, keys: tuple[str, ...], cols: int | None = None, period: int | None = None, only: str | None = None) -> DataFrame:
    """(``keys``, row_no, word, bits) of rows (keys, row_no, c0, c1): the union of all
    intervals of columns, ends included, by key and row. Columns outside of 0 to ``cols`` - 1
    are cut off. ``period`` is the number of columns of a whole turn: an interval that goes
    over the end of it goes on at its start. Of rows with a boolean column ``only`` those count
    that have it true; it is looked at last, when the sets are joined."""
    c0, c1 = F.col("c0").cast("long"), F.col("c1").cast("long")
    last = F.lit(cols - 1).cast("long") if cols is not None else None
    kept = (*keys, "row_no") if only is None else (*keys, "row_no", only)
    if period is None:
        cut = intervals.select(*kept, F.greatest(c0, F.lit(0).cast("long")).alias("a"), (F.least(c1, last) if last is not None else c1).alias("b")).where("a <= b")
    else:
        start, width = F.pmod(c0, F.lit(period)), F.least(c1 - c0, F.lit(period - 1).cast("long"))
        end = start + width
        parts = F.array(F.struct(start.alias("a"), F.least(end, F.lit(period - 1).cast("long")).alias("b")), F.struct(F.lit(0).cast("long").alias("a"), (end - period).alias("b")))
        cut = intervals.where("c0 <= c1").select(*kept, F.explode(parts).alias("p")).select(*kept, "p.a", (F.least("p.b", last) if last is not None else F.col("p.b")).alias("b")).where("a <= b")
    words = cut.withColumn("word", F.explode(F.sequence(F.floor(F.col("a") / SIZE), F.floor(F.col("b") / SIZE))))
    lo = F.greatest(F.col("a") - F.col("word") * SIZE, F.lit(0))
    n = F.least(F.col("b") - F.col("word") * SIZE, F.lit(SIZE - 1)) - lo + 1
    mask = _shift("shiftleft", _shift("shiftrightunsigned", F.lit(-1).cast("long"), SIZE - n), lo)
    if only is None:
        return words.groupBy(*keys, "row_no", "word").agg(F.bit_or(mask).alias("bits"))
    return words.groupBy(*keys, "row_no", "word").agg(F.bit_or(F.when(F.col(only), mask)).alias("bits")).where("bits is not null")


def cell_bits(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The same of single cells (keys, row_no, col_no)."""
    bit = _shift("shiftleft", F.lit(1).cast("long"), F.pmod("col_no", F.lit(SIZE)))
    return cells.groupBy(*keys, "row_no", F.floor(F.col("col_no") / SIZE).alias("word")).agg(F.bit_or(bit).alias("bits"))


def has(bits: str | Column, place: Column) -> Column:
    return _shift("shiftright", F.col(bits) if isinstance(bits, str) else bits, place).bitwiseAND(F.lit(1).cast("long")) == 1


def cells_of(words: DataFrame, sets: tuple[str, ...] = ("bits",)) -> DataFrame:
    """The words' other columns with ``col_no``: a row for each column in any of the sets,
    which come as booleans if they are several."""
    rest = [c for c in words.columns if c not in ("word", *sets)]
    each = words.withColumn("place", F.explode(F.array(*map(F.lit, range(SIZE)))))
    flags = {c: has(c, F.col("place")) for c in sets}
    some = F.lit(False)
    for f in flags.values():
        some = some | F.coalesce(f, F.lit(False))
    named = [F.coalesce(f, F.lit(False)).alias(c) for c, f in flags.items()] if len(sets) > 1 else []
    return each.where(some).select(*rest, (F.col("word") * SIZE + F.col("place")).alias("col_no"), *named)


def meeting(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Distinct ``keys`` (columns of either) of sets that have a cell in common."""
    return a.join(b.withColumnRenamed("bits", "other_bits"), ["row_no", "word"]).where(F.col("bits").bitwiseAND(F.col("other_bits")) != 0).select(*keys).distinct()
