"""Greatest shaking of fine cells from the coarse grids of many events, bounded and pruned.

A bilinear mean lies between the least and the greatest of the corners that it has. Fine
cells with the same corners (a quad: upper left coarse cell, and whether a corner's weight is
zero on either axis) share these bounds, so that events are compared by (event, quad), and
only what the bounds leave open comes down to fine cells:

* an event counts in a country where its greatest lower bound reaches the threshold, doesn't
  where its greatest upper bound stays under it, and is worked out only in between;
* in a quad only events whose upper bound reaches the greatest lower bound of all can set a
  cell's maximum; of an event's quads only those can hold its greatest value.

Means are rounded to six decimals; bounds leave ``SLACK`` for that.

Quads are many times the coarse values, so they are made only around values (``seeds``) that
can decide something: those that reach the threshold, those that can exceed what an event
surely has, and those that can exceed what a quad's cells surely have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 1e-6
QUAD = ("qx", "qy", "on_x", "on_y")
CORNERS = ((0, 0), (0, 1), (1, 0), (1, 1))


def fine_cells(cells: DataFrame) -> DataFrame:
    """cell_id, iso3, ``ax``, ``ay`` and the quad of cells (cell_id, iso3, fx, fy: fractional
    centre coordinates on the coarse grid)."""
    x0, y0 = F.floor("fx").cast("long"), F.floor("fy").cast("long")
    ax, ay = F.col("fx") - x0, F.col("fy") - y0
    return cells.select("cell_id", "iso3", ax.alias("ax"), ay.alias("ay"), x0.alias("qx"), y0.alias("qy"), (ax == 0).alias("on_x"), (ay == 0).alias("on_y"))


def corners_of(fine: DataFrame) -> DataFrame:
    """quad, k, gx, gy: the corners of nonzero weight of the quads that have cells."""
    used = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(2 * i + j).alias("k")) for i, j in CORNERS]), lambda c: ~((c["i"] == 1) & F.col("on_x")) & ~((c["j"] == 1) & F.col("on_y")))
    return fine.select(*QUAD).distinct().withColumn("c", F.explode(used)).select(*QUAD, "c.k", (F.col("qx") + F.col("c.i")).alias("gx"), (F.col("qy") + F.col("c.j")).alias("gy"))


def sound(shake: DataFrame) -> DataFrame:
    return shake.where("mmi is not null and not isnan(mmi)")


def event_quads(shake: DataFrame, fine: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """event_id, iso3, quad, the corners' values ``v00`` to ``v11`` (x, then y) and their
    bounds ``low`` and ``high``: one row for each event, quad and country that meet.
    ``shake`` is (event_id, gx, gy, mmi). With ``seeds`` (event_id, gx, gy) only quads that
    have one of them as a corner, with all their corners."""
    corners = corners_of(fine)
    if seeds is None:
        met = sound(shake).join(corners, ["gx", "gy"])
    else:
        around = seeds.select("event_id", "gx", "gy").join(corners.select("gx", "gy", *QUAD), ["gx", "gy"]).select("event_id", *QUAD).distinct()
        met = around.join(corners, list(QUAD)).join(sound(shake), ["event_id", "gx", "gy"])
    values = [F.max(F.when(F.col("k") == k, F.col("mmi"))).alias(f"v{i}{j}") for k, (i, j) in enumerate(CORNERS)]
    quads = met.groupBy("event_id", *QUAD).agg(*values, F.min("mmi").alias("low"), F.max("mmi").alias("high"))
    return quads.join(fine.select("iso3", *QUAD).distinct(), list(QUAD))


def reaching(shake: DataFrame, least: float) -> DataFrame:
    """Seeds of the quads that ``counted_events`` needs: values that reach ``least``."""
    return sound(shake).where(F.col("mmi") >= least - SLACK)


def exceeding(shake: DataFrame, quads: DataFrame, fine: DataFrame) -> DataFrame:
    """Seeds of the quads that ``greatest_by_cell`` needs beside ``quads``, some of those of
    events that count: values that reach what all cells around them surely have."""
    some = quads.groupBy("iso3", *QUAD).agg(F.max("low").alias("best"))
    every = fine.select("iso3", *QUAD).distinct().join(some, ["iso3", *QUAD], "left")
    least = every.groupBy(*QUAD).agg(F.min(F.coalesce("best", F.lit(float("-inf")))).alias("need"))
    need = corners_of(fine).join(least, list(QUAD)).groupBy("gx", "gy").agg(F.min("need").alias("need"))
    return sound(shake).join(need, ["gx", "gy"]).where(F.col("mmi") >= F.col("need") - SLACK)


def most_by_event(shake: DataFrame, fine: DataFrame) -> DataFrame:
    """(event_id, max_mmi): the maximum over the fine cells. A fine cell in the centre of a
    coarse one has its value, and no mean exceeds its corners: only values greater than all
    that an event has at such centres are followed to quads."""
    centres = fine.where("on_x and on_y").select(F.col("qx").alias("gx"), F.col("qy").alias("gy")).distinct().withColumn("centre", F.lit(True))
    placed = sound(shake).join(centres, ["gx", "gy"], "left")
    best = placed.groupBy("event_id").agg(F.max(F.when(F.col("centre"), F.col("mmi"))).alias("best"), F.max(F.when(F.col("centre").isNull(), F.col("mmi"))).alias("other"))
    sure = best.where("best is not null").select("event_id", F.round("best", 6).alias("max_mmi"))
    open_ = best.where("other is not null and (best is null or other > best)").select("event_id", "best")
    seeds = placed.where("centre is null").join(open_, "event_id").where("best is null or mmi > best")
    found = greatest_by_event(event_quads(shake, fine, seeds), fine)
    return sure.unionByName(found).groupBy("event_id").agg(F.max("max_mmi").alias("max_mmi"))


def mean_at() -> Column:
    """The bilinear mean of the corners that are there, rescaled, of six decimals."""
    weight = lambda i, j: (F.col("ax") if i else 1 - F.col("ax")) * (F.col("ay") if j else 1 - F.col("ay"))
    total = share = F.lit(0.0)
    for i, j in CORNERS:
        w = F.when(F.col(f"v{i}{j}").isNull(), 0.0).otherwise(weight(i, j))
        share, total = share + w, total + w * F.coalesce(f"v{i}{j}", F.lit(0.0))
    return F.round(total / share, 6)


def at_cells(quads: DataFrame, fine: DataFrame) -> DataFrame:
    """event_id, cell_id, iso3, mmi of all fine cells of the quads."""
    return quads.join(fine, ["iso3", *QUAD]).select("event_id", "cell_id", "iso3", mean_at().alias("mmi"))


def counted_events(quads: DataFrame, fine: DataFrame, least: float) -> DataFrame:
    """(event_id, iso3) of events that reach ``least`` in a fine cell of the country."""
    bounds = quads.where(F.col("high") >= least - SLACK).groupBy("event_id", "iso3").agg(F.max("low").alias("low"))
    sure = bounds.where(F.col("low") >= least).select("event_id", "iso3")
    open_ = quads.where(F.col("high") >= least - SLACK).join(bounds.where(F.col("low") < least).select("event_id", "iso3"), ["event_id", "iso3"], "left_semi")
    reached = at_cells(open_, fine).where(F.col("mmi") >= least).select("event_id", "iso3").distinct()
    return sure.unionByName(reached)


def greatest_by_cell(quads: DataFrame, fine: DataFrame) -> DataFrame:
    """(cell_id, mmi): the maximum over the events of ``quads``."""
    best = quads.groupBy("iso3", *QUAD).agg(F.max("low").alias("best"))
    able = quads.join(best, ["iso3", *QUAD]).where(F.col("high") >= F.col("best") - SLACK)
    return at_cells(able.drop("best"), fine).groupBy("cell_id").agg(F.max("mmi").alias("mmi"))


def greatest_by_event(quads: DataFrame, fine: DataFrame) -> DataFrame:
    """(event_id, max_mmi): the maximum over the fine cells. A quad with equal corners is its
    own value; others come down to cells if they can hold more than the event surely has."""
    best = quads.groupBy("event_id").agg(F.max("low").alias("best"))
    open_ = quads.where("low < high").join(best, "event_id").where("high > best").drop("best")
    found = at_cells(open_, fine).groupBy("event_id").agg(F.max("mmi").alias("most"))
    flat = quads.where("low = high").groupBy("event_id").agg(F.max(F.round("low", 6)).alias("flat"))
    every = best.join(found, "event_id", "left").join(flat, "event_id", "left")
    # Where nothing is above ``best``, the quad that has it as its least corner is flat or open.
    return every.select("event_id", F.greatest("most", "flat").alias("max_mmi"))
