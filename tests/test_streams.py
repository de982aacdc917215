"""The streaming queries over a folder of files in no order of time."""

import datetime
import random
from collections import defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrapop.operators import grid
from terrapop.streaming import folds


def test_files_in_no_order_of_time(spark, tmp_path):
    rng = random.Random(31)
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=rng.randrange(20 * 1440)), rng.randrange(6), rng.choice(["click", "view", "error"]), rng.random() * 100) for i in range(1500)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    df.withColumn("part", F.xxhash64("event_id") % 5).repartition(5, "part").drop("part").write.parquet(f"{tmp_path}/events.parquet")
    assert len(list((tmp_path / "events.parquet").glob("*.parquet"))) > 1
    got = {n: {tuple(r) for r in entry.queries()[n](spark, str(tmp_path)).collect()} for n in ("stream_flood_days", "stream_event_count", "stream_heat_runs")}

    last = (max(r[1] for r in rows) - datetime.timedelta(days=1)).date()
    flooded, hot = defaultdict(set), defaultdict(set)
    for _, ts, user, kind, value in rows:
        if ts.date() < last:
            if kind == "click":
                flooded[user].add(ts.date())
        if value > 64:
            hot[user].add(ts.date())
    assert got["stream_flood_days"] == {(u, len(d)) for u, d in flooded.items()}
    radius = F.when(F.col("event_type") == "click", 5).otherwise(2)
    placed = df.where("event_type <> 'view'").select(F.struct("event_id", "ts").alias("point_id"), (30 + F.col("event_id") * 7919 % 5000 / 1000).alias("lon"), (20 - F.col("event_id") * 104729 % 3000 / 1000).alias("lat"), radius.alias("radius"))
    cells = grid.disc_cells(placed, 30.0, 20.0, 0.1, F.col("radius"), 30, 50).select("row_no", "col_no", F.col("point_id.ts").alias("ts")).collect()
    sums = defaultdict(int)
    for c in cells:
        for k in range(1, 31):
            until = c.ts.date() + datetime.timedelta(days=k)
            if until <= last:
                sums[c.row_no, c.col_no, until] += 1
    assert got["stream_event_count"] == {(*k, n) for k, n in sums.items()}
    runs = set()
    for user, days in hot.items():
        for day in sorted(days):
            if day - datetime.timedelta(days=1) not in days:
                n = next(k for k in range(1, 99) if day + datetime.timedelta(days=k) not in days)
                if n >= 3:
                    runs.add((user, day, n))
    assert got["stream_heat_runs"] <= runs
    # only runs that were open at the end, two days before the last hot day, may be absent
    closed = max(max(d) for d in hot.values()) - datetime.timedelta(days=4)
    assert {r for r in runs if r[1] + datetime.timedelta(days=r[2]) < closed} <= got["stream_heat_runs"]


def test_maxima_survive_a_restart(spark, tmp_path):
    """Files that come later, and a second start on the same folder, go on from the state."""
    rows = [(1, 5.0), (2, 1.0)], [(1, 3.0), (3, 9.0)], [(2, 4.0)]
    base = f"file://{tmp_path}/job"
    want = {}
    for k, part in enumerate(rows):
        spark.createDataFrame(part, "cell long, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in.parquet")
        stream = spark.readStream.schema("cell long, v double").parquet(f"{tmp_path}/in.parquet")
        found = folds.max_by_cell(stream, "cell", "v", base=base, merge_every=2)
        for c, v in part:
            want[c] = max(v, want.get(c, v))
        assert {r.cell: r.v for r in found.collect()} == want, k


def test_late_and_failed_rows_are_reported(spark, tmp_path):
    """Three files, a trigger each: the last one's days are closed already. Its rows, and those
    without a value, are in the report, and a second run adds its own."""
    import datetime
    import os
    import time

    schema = "hcell_id long, acq_ts timestamp, pix int"
    day = lambda d: datetime.datetime(2024, 1, d, 12)
    for k, rows in enumerate(([(1, day(1), 1), (2, day(2), None), (1, day(10), 1)], [(1, day(20), 1), (3, None, 1)], [(1, day(3), 1), (2, day(4), 1), (2, day(21), 1)])):
        path = f"{tmp_path}/in/{k}.parquet"
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        spark.createDataFrame(rows, schema).toPandas().astype({"pix": "Int32"}).to_parquet(path, coerce_timestamps="us")
        os.utime(path, (time.time() - 100 + k, time.time() - 100 + k))
    base = f"file://{tmp_path}/job"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        obs = folds.counted(stream, F.col("acq_ts").isNull() | F.col("pix").isNull())
        return folds.drain(folds.flood_days(obs), "append", base, report=True)

    days = sorted((r.hcell_id, r.day.day, r.hit) for r in run().collect())
    assert days == [(1, 1, True), (1, 10, True), (2, 2, None)]
    report = folds.report_of(spark, base)
    assert tuple(report.agg(F.sum("rows"), F.sum("failed"), F.sum("late")).first()) == (8, 2, 2)
    run()
    assert tuple(report.agg(F.sum("rows"), F.sum("failed"), F.sum("late")).first()) == (8, 2, 2)
