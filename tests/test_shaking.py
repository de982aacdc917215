"""Bounded shaking against the whole alignment of every event."""

import random

import pytest
from pyspark.sql import functions as F

from terrapop.operators import align, shaking


def tables(spark, seed, ratio):
    """Cells of three countries under coarse grids with holes, values near the threshold."""
    rng = random.Random(seed)
    cells = [(r * 24 + c, "ABC"[(r // 7 + c // 9) % 3], (c + 0.5) / ratio - 0.5, (r + 0.5) / 3 - 0.5) for r in range(20) for c in range(24)]
    shake = [(e, x, y, rng.choice([rng.uniform(3, 8), 6.0, 5.9999996, 5.9999994, 6.2, 5.0])) for e in range(60) for x in range(-1, 9) for y in range(-1, 8) if rng.random() < rng.choice([0.05, 0.3, 0.9])]
    shake += [(99, 0, 0, float("nan")), (99, 1, 0, None), (98, 40, 40, 9.0)]
    return spark.createDataFrame(cells, "cell_id long, iso3 string, fx double, fy double"), spark.createDataFrame(shake, "event_id long, gx long, gy long, mmi double")


@pytest.mark.parametrize(("seed", "ratio"), [(1, 5), (2, 4), (3, 2.5)])
def test_against_whole_alignment(spark, seed, ratio):
    cells, shake = tables(spark, seed, ratio)
    fine = shaking.fine_cells(cells)
    quads = shaking.event_quads(shake, fine).persist()
    every = align.align_bilinear(cells.withColumnRenamed("cell_id", "id"), shake.where("not isnan(mmi)"), "mmi", by=("event_id",), exact=False).withColumnRenamed("id", "cell_id").join(cells.select("cell_id", "iso3"), "cell_id").persist()
    rows = lambda df: {tuple(r[:-1]): round(r[-1], 6) for r in df.collect()}
    assert rows(shaking.greatest_by_event(quads, fine)) == rows(every.groupBy("event_id").agg(F.max("mmi")))
    assert rows(shaking.greatest_by_cell(quads, fine)) == rows(every.groupBy("cell_id").agg(F.max("mmi")))
    counted = every.groupBy("event_id", "iso3").agg(F.max("mmi").alias("m")).where("m >= 6").select("event_id", "iso3")
    got = shaking.counted_events(quads, fine, 6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, counted.collect()))
    quads.unpersist()
    every.unpersist()


def test_no_events(spark):
    cells, shake = tables(spark, 4, 5)
    fine = shaking.fine_cells(cells)
    quads = shaking.event_quads(shake.limit(0), fine)
    assert shaking.greatest_by_event(quads, fine).count() == 0 and shaking.counted_events(quads, fine, 6).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_quads_around_seeds_suffice(spark, seed):
    """Few quads are made, and they hold the same maxima; some coarse cells have no fine cell
    in their centre, and some events reach the threshold in one country only."""
    cells, shake = tables(spark, seed, 5)
    holes = cells.where("not (cell_id % 24 in (2, 12) or cell_id % 7 = 3)")
    fine = shaking.fine_cells(holes).persist()
    every = shaking.event_quads(shake, fine).persist()
    rows = lambda df: {tuple(r[:-1]): r[-1] for r in df.collect()}
    assert rows(shaking.most_by_event(shake, fine)) == rows(shaking.greatest_by_event(every, fine))
    strong = shaking.event_quads(shake, fine, shaking.reaching(shake, 6)).persist()
    counts = shaking.counted_events(strong, fine, 6).persist()
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, shaking.counted_events(every, fine, 6).collect()))
    counted = lambda quads: quads.join(counts, ["event_id", "iso3"], "left_semi")
    seeds = shaking.exceeding(shake, counted(strong), fine)
    few = shaking.event_quads(shake, fine, seeds)
    assert few.count() < every.count()
    assert rows(shaking.greatest_by_cell(counted(few), fine)) == rows(shaking.greatest_by_cell(counted(every), fine))
    for df in (fine, every, strong, counts):
        df.unpersist()
