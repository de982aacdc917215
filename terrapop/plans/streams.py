"""Queries of the streaming folds over the table ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import align, grid
from terrapop.sources.fixtures import Fixtures
from terrapop.streaming import folds

from .geometry import ALL_DISCS
from .registry import query

CLOSED = "CAST(ts AS DATE) < (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM events)"


def events(fx: Fixtures) -> DataFrame:
    return folds.source(fx.spark, fx.sf_dir, "events").withColumn("acq_ts", F.col("ts").cast("timestamp"))


@query("stream_flood_days", f"SELECT user_id AS hcell_id, count(DISTINCT CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(ts AS DATE) END) AS flood_days FROM events WHERE {CLOSED} GROUP BY user_id")
def _(fx: Fixtures) -> DataFrame:
    pix = F.when(F.col("event_type") == "error", 255).when(F.col("event_type") == "view", 0).otherwise(1)
    obs = events(fx).select(F.col("user_id").alias("hcell_id"), "acq_ts", pix.alias("pix"))
    return folds.drain(folds.flood_days(obs), "append").groupBy("hcell_id").agg(F.count_if("hit").alias("flood_days"))


@query("stream_flood_report", "SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS failed, 0 AS late FROM events")
def _(fx: Fixtures) -> DataFrame:
    """What the job above read, could not use and dropped as late: all files come in one
    trigger, so nothing is late."""
    pix = F.when(F.col("event_type") == "error", None).when(F.col("event_type") == "view", 0).otherwise(1)
    obs = events(fx).select(F.col("user_id").alias("hcell_id"), "acq_ts", pix.alias("pix"))
    base = folds.work_dir(fx.spark)
    folds.drain(folds.flood_days(folds.counted(obs, F.col("acq_ts").isNull() | F.col("pix").isNull())), "append", base, report=True)
    return folds.report_of(fx.spark, base).agg(*[F.sum(c).alias(c) for c in ("rows", "failed", "late")])


COUNTRY_CELLS = "SELECT DISTINCT CAST(floor(row_no / 3) * 10 + floor(col_no / 5) AS BIGINT) AS hcell_id FROM population_cells JOIN admin_cells USING (cell_id)"
REAL = "SELECT event_id FROM quake_catalog WHERE event_type = 'earthquake' AND NOT regexp_matches(lower(title), 'scenario|exercise|test event')"
GATED = f"SELECT event_id FROM shake_cells WHERE event_id IN ({REAL}) AND hcell_id IN ({COUNTRY_CELLS}) GROUP BY event_id HAVING max(mmi) >= 6"


@query("stream_max_mmi", f"SELECT hcell_id, max(mmi) AS mmi FROM shake_cells WHERE event_id IN ({GATED}) GROUP BY hcell_id")
def _(fx: Fixtures) -> DataFrame:
    """Running maximum of shaking; the gate, which keeps events that reach the primary
    threshold in the country, is applied to each micro-batch."""
    rows = folds.source(fx.spark, fx.sf_dir, "lineitem").select(F.col("l_partkey").alias("event_id"), F.col("l_suppkey").alias("hcell_id"), (F.col("l_quantity") * F.col("l_discount") * 1.6).alias("mmi"))
    country = fx.population_cells.join(fx.admin_cells, "cell_id").select(align.hazard_cell(F.col("row_no"), F.col("col_no"), 3, 5, 10).alias("hcell_id")).distinct()
    real = fx.quake_catalog.where(S.actual_event_reason(F.col("event_type"), F.col("title")).isNull())
    strong = fx.shake_cells.join(real, "event_id", "left_semi").join(country, "hcell_id", "left_semi").groupBy("event_id").agg(F.max("mmi").alias("most")).where("most >= 6").select("event_id")
    return folds.max_by_cell(rows, "hcell_id", "mmi", gate=lambda batch: batch.join(strong, "event_id", "left_semi"))


ENDS = "SELECT CAST(unnest(range(DATE '2024-01-02', CAST((SELECT max(ts) - INTERVAL 1 DAY FROM events) AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS until"
SLIDING = f"SELECT row_no, col_no, until, count(*) AS n FROM ({ALL_DISCS}) d JOIN ({ENDS}) e ON event_ts < until AND event_ts >= until - INTERVAL 30 DAY GROUP BY row_no, col_no, until"


@query("stream_event_count", SLIDING)
def _(fx: Fixtures) -> DataFrame:
    """Each event, Protests left out, goes to the cells of its buffer; counts add up in
    sliding windows of thirty days."""
    e = events(fx)
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in (("click", "Battles"), ("purchase", "Explosions/Remote violence"), ("error", "Violence against civilians"), ("signup", "Riots"))], F.lit("Protests"))
    placed = e.select(F.struct("event_id", F.col("acq_ts").alias("event_ts")).alias("point_id"), kind.alias("kind"), F.floor(F.col("value") / 100).alias("fatalities"), (30 + ((F.col("event_id") * 7919) % 5000) / 1000).alias("lon"), (20 - ((F.col("event_id") * 104729) % 3000) / 1000).alias("lat")).where("kind <> 'Protests'")
    cells = grid.disc_cells(placed, 30.0, 20.0, 0.1, S.buffer_km(F.col("kind"), F.col("fatalities")), 30, 50).select(F.col("point_id.event_ts").alias("event_ts"), "row_no", "col_no")
    return folds.drain(folds.sliding_counts(cells, ("row_no", "col_no"), "event_ts"), "append")


HOT = "SELECT DISTINCT user_id AS hcell_id, CAST(ts AS DATE) AS d FROM events WHERE value > 64"
RUNS = f"SELECT hcell_id, min(d) AS first_day, count(*) AS days FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY hcell_id ORDER BY d) AS INTEGER) AS g FROM ({HOT})) GROUP BY hcell_id, g HAVING count(*) >= 3 AND CAST(max(d) AS TIMESTAMP) + INTERVAL 36 HOUR <= (SELECT CAST(max(d) AS TIMESTAMP) - INTERVAL 2 DAY FROM ({HOT}))"


@query("stream_heat_runs", RUNS)
def _(fx: Fixtures) -> DataFrame:
    hot = events(fx).where("value > 64").select(F.col("user_id").alias("hcell_id"), F.date_trunc("day", "acq_ts").alias("day_ts"))
    return folds.drain(folds.heat_runs(hot, "hcell_id", "day_ts"), "append")
