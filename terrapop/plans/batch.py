"""Batch planning as tables: manifest, readiness, preflight, issues, steps and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import grid, temporal
from terrapop.sources.fixtures import Fixtures

from .basic import CAPPED_TOTALS, ERRORS, PARSED, TOLERANCE_SQL, UNIT_PCT, assigned_fractions, dec, flood_units, parsed_manifest
from .geometry import INSIDE, event_xy
from .registry import query

TASKS = f"SELECT row_number() OVER (ORDER BY file_order) AS task_id, file_order, iso3, as_of, lookback, level, errors, errors = '' AS is_valid FROM (SELECT *, {ERRORS} AS errors FROM ({PARSED}))"


def tasks(fx: Fixtures) -> DataFrame:
    """Numbered by file order: a range sort and per-partition counts, no single task.

    The offset of each block of file order comes from a small count table.
    """
    block = F.floor(F.col("file_order") / 1000)
    m = parsed_manifest(fx).withColumn("block", block)
    sizes = m.groupBy("block").agg(F.count("*").alias("n"))
    before = sizes.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = m.join(before.select("block", "offset"), "block").withColumn("task_id", F.col("offset") + F.row_number().over(Window.partitionBy("block").orderBy("file_order")))
    return numbered.select("task_id", "file_order", "iso3", "as_of", "lookback", "level", "errors", (F.col("errors") == "").alias("is_valid"))


@query("normalize_manifest", TASKS)
def _(fx: Fixtures) -> DataFrame:
    return tasks(fx)


PIPELINES = ("spei", "utci", "flood", "violence", "earthquake", "cyclone")
#: What a pipeline needs beside the common gates, by name of the inventory column.
NEEDS = {"violence": "ev", "earthquake": "cat", "cyclone": "trk"}
READY = f"""SELECT task_id, file_order, iso3, is_valid, {', '.join(f"coalesce(is_valid AND pop IS NOT NULL AND features IS NOT NULL{f' AND {NEEDS[p]} IS NOT NULL' if p in NEEDS else ''}, false) AS can_{p}" for p in PIPELINES)},
 CASE WHEN NOT is_valid THEN 'invalid_manifest:' || errors ELSE concat_ws('; ', CASE WHEN pop IS NULL THEN 'missing_population' END, CASE WHEN NOT has_layer THEN 'missing_admin_layer:' || CAST(level AS VARCHAR) WHEN features IS NULL THEN 'iso3_not_found:' || iso3 END, CASE WHEN ev IS NULL THEN 'missing_events' END, CASE WHEN cat IS NULL THEN 'missing_catalog' END, CASE WHEN trk IS NULL THEN 'missing_tracks' END) END AS issues
 FROM (SELECT t.*, p.pop, e.ev, c.cat, k.trk, l.features, t.level IN (SELECT x.level FROM admin_layers x) AS has_layer FROM ({TASKS}) t LEFT JOIN (SELECT DISTINCT c_custkey AS file_order, 1 AS pop FROM customer WHERE c_acctbal > 0) p USING (file_order) LEFT JOIN (SELECT DISTINCT o_custkey AS file_order, 1 AS ev FROM orders) e USING (file_order)
 LEFT JOIN (SELECT DISTINCT event_id AS file_order, 1 AS cat FROM quake_catalog WHERE event_type = 'earthquake') c USING (file_order) LEFT JOIN (SELECT DISTINCT sid AS file_order, 1 AS trk FROM track_points) k USING (file_order) LEFT JOIN admin_layers l ON l.iso3 = t.iso3 AND l.level = t.level)"""


def readiness(fx: Fixtures) -> DataFrame:
    """Each task's gates for the six pipelines and its issues. Common gates: a valid manifest
    row, a population file, an administrative layer of the level with features of the
    country; some pipelines need an inventory of their own."""
    have = lambda df, c, name: df.select(F.col(c).alias("file_order"), F.lit(1).alias(name)).distinct()
    layers = fx.admin_layers
    j = tasks(fx).join(have(fx.table("customer").where("c_acctbal > 0"), "c_custkey", "pop"), "file_order", "left").join(have(fx.table("orders"), "o_custkey", "ev"), "file_order", "left")
    j = j.join(have(fx.quake_catalog.where("event_type = 'earthquake'"), "event_id", "cat"), "file_order", "left").join(have(fx.track_points, "sid", "trk"), "file_order", "left")
    j = j.join(F.broadcast(layers.select("level").distinct().withColumn("has_layer", F.lit(True))), "level", "left").join(F.broadcast(layers), ["level", "iso3"], "left")
    common = F.col("is_valid") & F.col("pop").isNotNull() & F.col("features").isNotNull()
    gates = [(common & F.col(NEEDS[p]).isNotNull() if p in NEEDS else common).alias(f"can_{p}") for p in PIPELINES]
    layer = F.when(F.col("has_layer").isNull(), F.concat(F.lit("missing_admin_layer:"), F.col("level").cast("string"))).when(F.col("features").isNull(), F.concat(F.lit("iso3_not_found:"), "iso3"))
    found = F.concat_ws("; ", F.when(F.col("pop").isNull(), "missing_population"), layer, *[F.when(F.col(c).isNull(), t) for c, t in (("ev", "missing_events"), ("cat", "missing_catalog"), ("trk", "missing_tracks"))])
    issues = F.when(~F.col("is_valid"), F.concat(F.lit("invalid_manifest:"), "errors")).otherwise(found)
    return j.select("task_id", "file_order", "iso3", "is_valid", *gates, issues.alias("issues"))


@query("evaluate_readiness", READY)
def _(fx: Fixtures) -> DataFrame:
    return readiness(fx)


#: Box of each task's unit, and what share of it the task's layer covers (G5); events and
#: storms inside the unit (J6).
UNIT_BOX = "SELECT admin_id, 30 + min(x) * 0.1e0 AS w, 30 + max(x) * 0.1e0 AS e, 20 - max(y) * 0.1e0 AS s, 20 - min(y) * 0.1e0 AS n FROM admin_points GROUP BY admin_id"
TASK_LAYER = "SELECT o_custkey AS file_order, min(west) AS lw, min(south) AS ls, max(east) AS le, max(north) AS ln FROM stac_items JOIN orders ON o_orderkey = item_id WHERE href IS NOT NULL GROUP BY o_custkey"
SEEN_UNITS = f"SELECT u.admin_id, coalesce(events, 0) AS events, coalesce(quakes, 0) AS quakes FROM admin_units u LEFT JOIN (SELECT admin_id, count(*) AS events FROM ({INSIDE}) GROUP BY admin_id) i USING (admin_id) LEFT JOIN (SELECT c_nationkey + 1 AS admin_id, count(*) AS quakes FROM shake_cells JOIN customer ON c_custkey = hcell_id WHERE mmi >= 6 GROUP BY c_nationkey) q USING (admin_id)"
PREFLIGHT = f"""SELECT task_id, pipeline, CASE WHEN NOT can THEN 'SKIP' WHEN pipeline IN ('spei', 'utci', 'flood') THEN CASE WHEN cov IS NULL THEN 'FAIL' WHEN cov >= 99.999 THEN 'PASS' ELSE 'WARN' END WHEN n > 0 THEN 'PASS' ELSE 'WARN' END AS status
 FROM (SELECT task_id, unnest(['spei', 'utci', 'flood', 'violence', 'earthquake', 'cyclone']) AS pipeline, unnest([can_spei, can_utci, can_flood, can_violence, can_earthquake, can_cyclone]) AS can, CASE WHEN lw IS NOT NULL THEN round(100 * greatest(0, least(le, e) - greatest(lw, w)) * greatest(0, least(ln, n) - greatest(ls, s)) / ((e - w) * (n - s)), 6) END AS cov, unnest([0, 0, 0, events, quakes, points]) AS n
 FROM ({READY}) r JOIN customer ON c_custkey = file_order JOIN ({UNIT_BOX}) b ON b.admin_id = c_nationkey + 1 JOIN ({SEEN_UNITS}) v ON v.admin_id = b.admin_id LEFT JOIN ({TASK_LAYER}) l USING (file_order) LEFT JOIN (SELECT sid AS file_order, count(*) AS points FROM track_points WHERE usa_wind >= 34 GROUP BY sid) p USING (file_order))"""


def preflight(fx: Fixtures) -> DataFrame:
    """PASS, WARN, FAIL or SKIP of each task and pipeline: for gridded layers by how much of
    the unit's box the task's layer covers, for the others by what lies in the unit."""
    box = fx.admin_points.groupBy("admin_id").agg((30 + F.min("x") * 0.1).alias("w"), (30 + F.max("x") * 0.1).alias("e"), (20 - F.max("y") * 0.1).alias("s"), (20 - F.min("y") * 0.1).alias("n"))
    events = grid.points_in_units(event_xy(fx), fx.admin_points).groupBy("admin_id").agg(F.count("*").alias("events"))
    unit = fx.table("customer").select(F.col("c_custkey").alias("file_order"), (F.col("c_nationkey") + 1).cast("long").alias("admin_id"))
    quakes = fx.shake_cells.where("mmi >= 6").join(unit.withColumnRenamed("file_order", "hcell_id"), "hcell_id").groupBy("admin_id").agg(F.count("*").alias("quakes"))
    units = F.broadcast(box.join(events, "admin_id", "left").join(quakes, "admin_id", "left"))
    items = fx.stac_items.where("href is not null").join(fx.table("orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("file_order")), "item_id")
    layers = items.groupBy("file_order").agg(F.min("west").alias("lw"), F.min("south").alias("ls"), F.max("east").alias("le"), F.max("north").alias("ln"))
    storms = fx.track_points.where("usa_wind >= 34").groupBy(F.col("sid").alias("file_order")).agg(F.count("*").alias("points"))
    r = readiness(fx).join(unit, "file_order").join(units, "admin_id").join(layers, "file_order", "left").join(storms, "file_order", "left")
    cov = F.round(grid.bbox_coverage(tuple(F.col(c) for c in ("w", "s", "e", "n")), tuple(F.col(c) for c in ("lw", "ls", "le", "ln"))), 6)
    covered = F.when(F.col("lw").isNull(), "FAIL").when(cov >= 99.999, "PASS").otherwise("WARN")
    counted = lambda c: F.when(F.coalesce(c, F.lit(0)) > 0, "PASS").otherwise("WARN")
    status = {"violence": counted("events"), "earthquake": counted("quakes"), "cyclone": counted("points")}
    each = F.array(*[F.struct(F.lit(p).alias("pipeline"), F.when(~F.col(f"can_{p}"), "SKIP").otherwise(status.get(p, covered)).alias("status")) for p in PIPELINES])
    return r.select("task_id", F.explode(each).alias("p")).select("task_id", "p.*")


@query("preflight_status", PREFLIGHT)
def _(fx: Fixtures) -> DataFrame:
    return preflight(fx)


#: Tasks for which a preflight ran; the others are an issue of their own.
RAN = "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'"
ISSUES = f"SELECT DISTINCT task_id, code, severity FROM (SELECT task_id, split_part(trim(unnest(string_split(issues, '; '))), ':', 1) AS code, 'error' AS severity FROM ({READY}) WHERE issues <> '' UNION ALL SELECT task_id, 'missing_preflight_row', 'error' FROM ({TASKS}) WHERE file_order NOT IN ({RAN}) UNION ALL SELECT task_id, pipeline || '_preflight_' || lower(status), CASE status WHEN 'FAIL' THEN 'error' ELSE 'warning' END FROM ({PREFLIGHT}) JOIN ({TASKS}) USING (task_id) WHERE status IN ('FAIL', 'WARN') AND file_order IN ({RAN})) WHERE code NOT LIKE 'bad %' ORDER BY severity, task_id, code"


def issue_rows(fx: Fixtures) -> DataFrame:
    """Issues of readiness; then of the preflight where it ran, else that it didn't."""
    tok = readiness(fx).where("issues <> ''").select("task_id", F.explode(F.split("issues", "; ")).alias("tok"))
    a = tok.select("task_id", F.trim(F.substring_index("tok", ":", 1)).alias("code"), F.lit("error").alias("severity"))
    ran = fx.table("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("file_order")).distinct()
    numbered = tasks(fx).select("task_id", "file_order")
    b = numbered.join(ran, "file_order", "left_anti").select("task_id", F.lit("missing_preflight_row").alias("code"), F.lit("error").alias("severity"))
    p = preflight(fx).where(F.col("status").isin("FAIL", "WARN")).join(numbered.join(ran, "file_order", "left_semi").select("task_id"), "task_id", "left_semi")
    c = p.select("task_id", F.concat("pipeline", F.lit("_preflight_"), F.lower("status")).alias("code"), F.when(F.col("status") == "FAIL", "error").otherwise("warning").alias("severity"))
    return a.unionByName(b).unionByName(c).where("code not like 'bad %'").dropDuplicates(["task_id", "code", "severity"])


@query("issue_report", ISSUES)
def _(fx: Fixtures) -> DataFrame:
    return issue_rows(fx).orderBy("severity", "task_id", "code")


STEPS = " UNION ALL ".join(f"SELECT task_id, '{p}' AS pipeline, can_{p} AS eligible, CASE WHEN NOT is_valid THEN 'invalid_manifest' WHEN NOT can_{p} THEN 'not_ready' END AS reason FROM ({READY})" for p in PIPELINES)


def steps(fx: Fixtures) -> DataFrame:
    r = readiness(fx).unpivot(["task_id", "is_valid"], [f"can_{p}" for p in PIPELINES], "gate", "eligible")
    return r.select("task_id", F.regexp_replace("gate", "^can_", "").alias("pipeline"), "eligible", F.when(~F.col("is_valid"), "invalid_manifest").when(~F.col("eligible"), "not_ready").alias("reason"))


@query("step_eligibility", STEPS)
def _(fx: Fixtures) -> DataFrame:
    return steps(fx)


@query("resume_remaining", f"SELECT task_id, pipeline FROM ({STEPS}) WHERE eligible AND (task_id, pipeline) NOT IN (SELECT (task_id, pipeline) FROM (SELECT o_custkey AS task_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'flood' ELSE 'violence' END AS pipeline, arg_max(o_orderstatus, o_orderkey) AS last FROM orders GROUP BY 1, 2) WHERE last IN ('F', 'P'))")
def _(fx: Fixtures) -> DataFrame:
    log = fx.table("orders").select(F.col("o_custkey").alias("task_id"), F.when(F.col("o_orderpriority") == "1-URGENT", "flood").otherwise("violence").alias("pipeline"), "o_orderstatus", "o_orderkey")
    done = temporal.first_per(log, ["task_id", "pipeline"], [F.desc("o_orderkey")]).where(F.col("o_orderstatus").isin("F", "P"))
    return steps(fx).where("eligible").join(done, ["task_id", "pipeline"], "left_anti").select("task_id", "pipeline")


@query("bulk_summary", f"SELECT iso3, substr(iso3, 1, 3) AS alias, units, pop_total, pop_affected, zero_units, round(assigned / total, 6) AS assigned_fraction, {TOLERANCE_SQL} AS tolerance, coalesce(assigned / total BETWEEN 1 - {TOLERANCE_SQL} AND 1 + {TOLERANCE_SQL}, false) AS within, CASE WHEN NOT coalesce(assigned / total BETWEEN 1 - {TOLERANCE_SQL} AND 1 + {TOLERANCE_SQL}, false) THEN 'denominator_mismatch' WHEN zero_units > 0 THEN 'zero_population' ELSE 'ok' END AS flag FROM (SELECT iso3, count(*) AS units, {dec('t')} AS pop_total, {dec('a')} AS pop_affected, count(*) FILTER (WHERE t <= 0) AS zero_units FROM ({UNIT_PCT}) GROUP BY iso3) JOIN ({CAPPED_TOTALS}) USING (iso3)")
def _(fx: Fixtures) -> DataFrame:
    """One row for each country: its sums, the part of its population that found a unit
    against the country's tolerance, and the first flag."""
    u = flood_units(fx).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    sums = u.groupBy("iso3").agg(F.count("*").alias("units"), S.dsum(F.col("pop_total")).alias("pop_total"), S.dsum(F.col("pop_affected")).alias("pop_affected"), F.count_if(F.col("pop_total") <= 0).alias("zero_units"))
    cells = fx.population_cells.where("pop <= 9800").join(fx.admin_cells.select("cell_id", "iso3"), "cell_id")
    shares = assigned_fractions(fx, cells.groupBy("iso3").agg(S.dsum(F.col("pop")).alias("assigned"))).select("iso3", F.col("fraction").alias("assigned_fraction"), "tolerance", "within")
    flag = F.when(~F.col("within"), "denominator_mismatch").when(F.col("zero_units") > 0, "zero_population").otherwise("ok")
    return sums.join(shares, "iso3").select("iso3", F.substring("iso3", 1, 3).alias("alias"), "units", "pop_total", "pop_affected", "zero_units", "assigned_fraction", "tolerance", "within", flag.alias("flag"))


@query("download_manifest_ok", "SELECT o_custkey AS kind, count(*) FILTER (WHERE o_orderstatus <> 'F') > 0 AS ok, arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS first_error FROM orders GROUP BY o_custkey")
def _(fx: Fixtures) -> DataFrame:
    bad = F.col("o_orderstatus") == "F"
    return fx.table("orders").groupBy(F.col("o_custkey").alias("kind")).agg((F.count_if(~bad) > 0).alias("ok"), F.min_by(F.when(bad, F.col("o_orderpriority")), F.when(bad, F.col("o_orderkey"))).alias("first_error"))
