"""The incremental folds as Structured Streaming jobs.

Each job reads a folder of Parquet files, runs what is there (``availableNow``) and
leaves a table that grows on the next run; its checkpoint holds what was read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from terrapop.sources.files import shared_dir


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder; a job that is to go on where it
    stopped gives the folder of its earlier run instead."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stream of the table's files; the schema is the table's own. All files that are
    there come in one trigger: they are in no order of time, and a watermark that moved
    between them would drop the rows of later ones."""
    path = f"{sf_dir}/{table}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")  # a pattern, as the table may be one file


#: The name of what ``counted`` observes.
SEEN = "seen"
REPORT = "batch_id long, rows long, failed long, late long"


def counted(stream: DataFrame, failed: Column) -> DataFrame:
    """The stream, with its rows and those that ``failed`` counted in every trigger."""
    return stream.observe(SEEN, F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(failed, F.lit(True))).alias("failed"))


class _Progress(StreamingQueryListener):
    """Progress of every trigger; what a query keeps of it by itself is bounded."""

    def __init__(self):
        self.by_run: dict[str, list] = {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.by_run.setdefault(str(event.runId), [])

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        self.by_run.setdefault(str(event.progress.runId), []).append(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.by_run.setdefault(str(event.runId), []).append(None)


def drain(stream: DataFrame, mode: str, base: str | None = None, report: bool = False) -> DataFrame:
    """Runs the stream over what is there into a Parquet table (append).

    With ``report`` a second table beside it (``report_of``) gets a row for each trigger: rows
    read and failed, as ``counted`` observes them, and rows of the state's input that the
    watermark dropped (those of a key, day and task are one).
    """
    spark = stream.sparkSession
    base = base or work_dir(spark)
    listener = _Progress()
    if report:
        spark.streams.addListener(listener)
    try:
        q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        if report:
            run, until = str(q.runId), time.monotonic() + 60
            while (listener.by_run.get(run) or [1])[-1] is not None and time.monotonic() < until:
                time.sleep(0.05)
            rows = []
            for p in listener.by_run.get(run, []):
                if p is not None:
                    seen = p.observedMetrics.get(SEEN)
                    rows.append((p.batchId, (seen["rows"] if seen else p.numInputRows) or 0, (seen["failed"] if seen else 0) or 0, sum(o.numRowsDroppedByWatermark for o in p.stateOperators)))
            spark.createDataFrame(rows, REPORT).write.mode("append").parquet(f"{base}/report")
    finally:
        if report:
            spark.streams.removeListener(listener)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def report_of(spark: SparkSession, base: str) -> DataFrame:
    """(batch_id, rows, failed, late) of all runs on ``base``."""
    return spark.read.schema(REPORT).parquet(f"{base}/report")


def flood_days(obs: DataFrame, cell: str = "hcell_id", ts: str = "acq_ts", pix: str = "pix", late: str = "1 day") -> DataFrame:
    """(cell, day, hit): one row for each closed day; later rows than ``late`` are dropped.
    The last open day comes when the watermark passes it."""
    hit = (F.col(pix) > 0) & (F.col(pix) != 255)
    days = obs.withWatermark(ts, late).groupBy(cell, F.window(ts, "1 day")).agg(F.bool_or(hit).alias("hit"))
    return days.select(cell, F.to_date("window.start").alias("day"), "hit")


def _versions(spark: SparkSession, base: str) -> dict[str, list[int]]:
    """Epochs of the finished parts in a folder, by kind (``base`` and ``delta``)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {"base": [], "delta": []}
    for status in fs.listStatus(path) if fs.exists(path) else []:
        kind, _, epoch = status.getPath().getName().partition("-")
        if kind in found and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[kind].append(int(epoch))
    return found


def state_of(spark: SparkSession, base: str, cell: str, value: str) -> DataFrame | None:
    """The running maxima that a folder holds: its last base and the deltas after it."""
    v = _versions(spark, base)
    start = max(v["base"], default=-1)
    paths = [f"{base}/base-{start}"] * (start >= 0) + [f"{base}/delta-{k}" for k in v["delta"] if k > start]
    return spark.read.parquet(*paths).groupBy(cell).agg(F.max(value).alias(value)) if paths else None


def max_by_cell(stream: DataFrame, cell: str, value: str, gate: Callable[[DataFrame], DataFrame] = lambda batch: batch, base: str | None = None, merge_every: int = 32) -> DataFrame:
    """Running maximum by ``foreachBatch``. Each micro-batch, after its ``gate``, leaves the
    maxima of its own cells as a delta named by its epoch: a replayed batch overwrites its
    own delta, and a restart on the same ``base`` goes on from what is there. Every
    ``merge_every`` epochs the deltas are merged, so that no batch rewrites all cells."""
    spark = stream.sparkSession
    base = base or work_dir(spark)
    held = f"{base}/maxima"

    def fold(batch: DataFrame, epoch: int) -> None:
        gate(batch).groupBy(cell).agg(F.max(value).alias(value)).write.mode("overwrite").parquet(f"{held}/delta-{epoch}")
        if epoch % merge_every == merge_every - 1:
            state_of(spark, held, cell, value).write.mode("overwrite").parquet(f"{held}/base-{epoch}")

    stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    found = state_of(spark, held, cell, value)
    return found if found is not None else spark.createDataFrame([], stream.select(cell, value).schema)


def daily_counts(cells: DataFrame, keys: tuple[str, ...], ts: str, late: str = "1 day") -> DataFrame:
    """Counts by key and day, closed days only; look-backs of months are sums of these."""
    days = cells.withWatermark(ts, late).groupBy(*keys, F.window(ts, "1 day")).agg(F.count("*").alias("n"))
    return days.select(*keys, F.to_date("window.start").alias("day"), "n")


def sliding_counts(cells: DataFrame, keys: tuple[str, ...], ts: str, length: str = "30 days", late: str = "1 day") -> DataFrame:
    """Counts by key in every window of ``length`` that ends at a day's start, closed windows
    only: keys, ``until`` (first day after the window), ``n``."""
    windows = cells.withWatermark(ts, late).groupBy(*keys, F.window(ts, length, "1 day")).agg(F.count("*").alias("n"))
    return windows.select(*keys, F.to_date("window.end").alias("until"), "n")


def look_back(daily: DataFrame, keys: tuple[str, ...], first: Column, last: Column) -> DataFrame:
    """Sum of daily counts from ``first`` to ``last``, both included."""
    return daily.where(F.col("day").between(first, last)).groupBy(*keys).agg(F.sum("n").alias("n"))


def heat_runs(hot_days: DataFrame, cell: str, day_ts: str, k: int = 3, late: str = "2 days") -> DataFrame:
    """Runs of ``k`` or more consecutive calendar days by a 36-hour session gap. Times are
    midnights, so a session holds every day from its first to its last."""
    runs = hot_days.withWatermark(day_ts, late).groupBy(cell, F.session_window(day_ts, "36 hours")).agg(F.min(day_ts).alias("first"), F.max(day_ts).alias("last"))
    return runs.select(cell, F.to_date("first").alias("first_day"), (F.datediff("last", "first") + 1).cast("long").alias("days")).where(F.col("days") >= k)
