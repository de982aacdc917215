"""Queries of scans, filters, scalar rules, joins, aggregates, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import align, grid, quantiles, temporal, tracks, zonal
from terrapop.sources import files
from terrapop.sources.fixtures import Fixtures

from .registry import query

DEC = "CAST(SUM(CAST({} AS DECIMAL(18,4))) AS DOUBLE)"


def dec(x: str) -> str:
    return DEC.format(x)


EV = "SELECT event_id, event_date, event_type, fatalities, latitude, longitude FROM conflict_events"


def window_events(fx: Fixtures) -> DataFrame:
    """Conflict events of the window, Protests left out."""
    e = fx.conflict_events
    return e.where(F.col("event_ts").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-11 23:59:59.999999").cast("timestamp_ntz")) & (F.col("event_type") != "Protests"))


WINDOW_EVENTS = "SELECT * FROM conflict_events WHERE event_ts >= TIMESTAMP '2024-01-10' AND event_ts < TIMESTAMP '2024-01-12' AND event_type <> 'Protests'"


@query("scan_events_clean", EV + " WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND event_date IS NOT NULL AND longitude >= 30.05")
def _(fx: Fixtures) -> DataFrame:
    """The events as CSV files, some of them with a date that is none, read and cleaned."""
    date = F.when(F.col("longitude") < 30.05, "no date").otherwise(F.col("event_date").cast("string"))
    text = fx.conflict_events.withColumn("event_date", date).select(*files.EVENT_FIELDS)
    return files.read_events_csv(fx.spark, files.write_csv(text, "events"))


@query("scan_tracks_clean", "SELECT event_id, sid, iso_time, lon, lat, usa_wind, usa_r34_nw FROM track_points WHERE NOT coalesce(ends_with(lower(track_type), 'spur'), false) AND iso_time >= TIMESTAMP '2024-01-05' AND iso_time < TIMESTAMP '2024-01-26'")
def _(fx: Fixtures) -> DataFrame:
    path = files.write_tracks_csv(fx.track_points)
    return files.read_tracks_csv(fx.spark, path, "2024-01-05", "2024-01-25").select("event_id", "sid", "iso_time", "lon", "lat", "usa_wind", "usa_r34_nw")


@query("scan_catalog_features", "SELECT event_id, title, magnitude, types, detail, CAST(event_id % 7 AS DOUBLE) AS depth FROM quake_catalog")
def _(fx: Fixtures) -> DataFrame:
    path = files.write_catalog_json(fx.quake_catalog.withColumn("depth", (F.col("event_id") % 7).cast("double")))
    return files.read_catalog_json(fx.spark, path).withColumn("event_id", F.col("event_id").cast("long"))


def grid_files(fx: Fixtures) -> str:
    """Grid documents of one row of cells. Weak events declare a second row that isn't there;
    those of no shaking at all have a field of another name."""
    size = fx.shake_cells.groupBy("event_id").agg(F.count("*").cast("int").alias("nlon"), F.when(F.max("mmi") >= 4, 1).otherwise(2).alias("nlat"), F.when(F.max("mmi") >= 1, "mmi").otherwise("PGA").alias("shaking"))
    return files.write_grid_xml(fx.shake_cells.join(size, "event_id").withColumnRenamed("hcell_id", "cell"))


@query("shake_grid_cells", "SELECT event_id, hcell_id, round(mmi, 6) AS mmi, round(30 + i * 0.5e0, 6) AS lon, 20e0 AS lat FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY hcell_id) - 1 AS i, max(mmi) OVER (PARTITION BY event_id) AS most FROM shake_cells) WHERE most >= 4")
def _(fx: Fixtures) -> DataFrame:
    """Cells of the documents of the right size."""
    cells = files.read_grid_xml(fx.spark, grid_files(fx), ("CELL", "MMI"))
    return cells.select(F.col("event_id").cast("long").alias("event_id"), F.col("cell").cast("long").alias("hcell_id"), F.round("mmi", 6).alias("mmi"), F.round("lon", 6).alias("lon"), "lat")


@query("shake_grid_rejects", "SELECT event_id, CASE WHEN most < 1 THEN 'no_mmi_field' ELSE 'wrong_size' END AS reason FROM (SELECT event_id, max(mmi) AS most FROM shake_cells GROUP BY event_id) WHERE most < 4")
def _(fx: Fixtures) -> DataFrame:
    """Documents that can't be used, and why."""
    return files.grid_documents(fx.spark, grid_files(fx)).where("reason is not null").select(F.col("event_id").cast("long").alias("event_id"), "reason")


@query("scan_stac_items", "SELECT item_id, CAST(date_trunc('second', item_ts) AS TIMESTAMP) AS item_ts, west, south, east, north, href FROM stac_items WHERE href IS NOT NULL")
def _(fx: Fixtures) -> DataFrame:
    """Item documents read again; items without the asset go."""
    path = files.write_items_json(fx.stac_items, "water")
    return files.item_documents(fx.spark, path, "water").where("reason is null").drop("reason").withColumn("item_id", F.col("item_id").cast("long"))


LOOKUP = "SELECT upper(substr(c_mktsegment, 1, 3)) AS iso3, CAST(arg_max(c_nationkey, c_custkey) AS VARCHAR) AS m49, arg_max(n_name, c_custkey) AS country FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1"


def iso_lookup(fx: Fixtures) -> DataFrame:
    """Codes, numbers and names in the file form of the lookup, read again."""
    rows = fx.table("customer").join(F.broadcast(fx.table("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lower(F.substring("c_mktsegment", 1, 3)), F.lit(" ")).alias("iso3"), F.col("n_nationkey").cast("string").alias("m49"), F.col("n_name").alias("country"))
    return files.read_iso_lookup(fx.spark, files.write_iso_lookup(rows, "c_custkey"))


@query("scan_iso_lookup", LOOKUP)
def _(fx: Fixtures) -> DataFrame:
    """The last row of a code in the files' order wins."""
    return iso_lookup(fx)


@query("scan_population_cells", "SELECT cell_id, row_no, col_no, lon, lat, CASE WHEN pop_raw <> -9999 AND pop_raw >= 0 THEN pop_raw END AS pop FROM population_cells")
def _(fx: Fixtures) -> DataFrame:
    return fx.population_cells.select("cell_id", "row_no", "col_no", "lon", "lat", S.clean(F.col("pop_raw"), -9999.0).alias("pop"))


@query("scan_hazard_cube", "SELECT hcell_id, day, round(value, 6) AS value FROM hazard_daily")
def _(fx: Fixtures) -> DataFrame:
    """Files of two makers, whose coordinates have other names and which hold more than the
    wanted variable, read to the same columns."""
    d = fx.hazard_daily.select((F.col("hcell_id") % 10).cast("double").alias("lon"), F.floor(F.col("hcell_id") / 10).cast("double").alias("lat"), "day", "value")
    early = d.where("day(day) < 16").select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("day").alias("valid_time"), (F.col("value") * 2).alias("mrt"), F.col("value").alias("utci"))
    late = d.where("day(day) >= 16").select(F.col("lon").alias("X"), F.col("lat").alias("Y"), F.col("day").cast("timestamp_ntz").alias("time"), F.col("value").alias("unnamed"))
    cubes = [files.read_cube(fx.spark, files.write_parquet(x, "cube"), ("utci", "t2m")) for x in (early, late)]
    return cubes[0].unionByName(cubes[1]).select((F.col("lat") * 10 + F.col("lon")).cast("long").alias("hcell_id"), F.col("time").cast("date").alias("day"), F.round("value", 6).alias("value"))


@query("sink_mask_bands", "SELECT hcell_id, max(CASE WHEN t = 5 THEN m END) AS m5, max(CASE WHEN t = 6 THEN m END) AS m6, max(CASE WHEN t = 7 THEN m END) AS m7 FROM (SELECT hcell_id, t, CAST(max(mmi) >= t AS INTEGER) AS m FROM shake_cells, (VALUES (5), (6), (7)) AS x(t) GROUP BY hcell_id, t) GROUP BY hcell_id")
def _(fx: Fixtures) -> DataFrame:
    """The long mask table as files by threshold; the wide form is a pivot of what is read."""
    m = temporal.max_over_events(fx.shake_cells, "hcell_id", "mmi")
    long = m.withColumn("t", F.explode(F.array(*map(F.lit, (5, 6, 7))))).select("hcell_id", "t", (F.col("mmi") >= F.col("t")).cast("int").alias("m"))
    masks = fx.spark.read.parquet(files.write_parquet(long, "masks", "t"))
    return masks.groupBy("hcell_id").pivot("t", [5, 6, 7]).agg(F.max("m")).toDF("hcell_id", "m5", "m6", "m7")


SPLIT = "SELECT r_name AS iso3, e.event_id, e.event_date FROM events x JOIN conflict_events e ON e.event_id = x.event_id JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE e.event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-28' AND r_regionkey <> 4"


def bulk_events(fx: Fixtures) -> DataFrame:
    """Events of the bulk file by country of the task list, those of its window only; codes
    are compared as numbers, else as text."""
    code = fx.table("customer").join(F.broadcast(fx.table("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("user_id"), F.lpad(F.col("n_regionkey").cast("string"), 3, "0").alias("code"))
    bulk = fx.conflict_events.join(fx.table("events").select("event_id", "user_id"), "event_id").join(code, "user_id")
    tasks = fx.table("region").where("r_regionkey <> 4").select(F.col("r_name").alias("iso3"), F.col("r_regionkey").cast("string").alias("task_code"), F.lit("2024-01-28").cast("date").alias("as_of"), F.lit(19).alias("days"))
    same = F.coalesce(F.expr("try_cast(code AS int) = try_cast(task_code AS int)"), F.col("code") == F.col("task_code"))
    window = F.col("event_date").between(F.date_sub("as_of", F.col("days") - 1), F.col("as_of"))
    return bulk.join(F.broadcast(tasks), same & window).select("iso3", "event_id", "event_date")


@query("split_bulk_by_country", SPLIT)
def _(fx: Fixtures) -> DataFrame:
    """One pass over the bulk file makes a folder for each country of the task list."""
    base = files.new_path(fx.spark, "by_country")
    files.write_changed(bulk_events(fx), "iso3", base)
    return fx.spark.read.parquet(f"{base}/data").select("iso3", "event_id", "event_date")


@query("split_bulk_again", f"SELECT iso3, count(*) AS events, CASE iso3 WHEN 'ASIA' THEN 2 ELSE 1 END AS writes FROM ({SPLIT}) WHERE iso3 <> 'ASIA' OR event_date <> DATE '2024-01-12' GROUP BY iso3")
def _(fx: Fixtures) -> DataFrame:
    """Three runs over one folder: the second finds nothing to write, the third, in which a
    country has lost a day, only that country. How often each folder was written, and the
    events that it holds."""
    base, events = files.new_path(fx.spark, "by_country"), bulk_events(fx)
    for df in (events, events, events.where("iso3 <> 'ASIA' or event_date <> date'2024-01-12'")):
        files.write_changed(df, "iso3", base)
    held = fx.spark.read.parquet(f"{base}/data").groupBy("iso3").agg(F.count("*").alias("events"))
    return held.join(files.ledger(fx.spark, base).select(F.col("key").alias("iso3"), F.col("writes").cast("int").alias("writes")), "iso3")


RUN_ROWS = "SELECT r_name AS iso3, CASE r_regionkey WHEN 4 THEN 0 ELSE 12 END AS months, DATE '2001-08-01' AS period_end FROM region"


RUN_RULES = ("iso3_pattern", "as_of_required", "months_minimum", "level_enum", "run_id_pattern")


@query("run_metadata_table", "SELECT file_order, rule FROM (SELECT file_order, unnest(['iso3_pattern', 'as_of_required', 'months_minimum', 'level_enum', 'run_id_pattern']) AS rule, unnest([coalesce(regexp_matches(upper(iso3_text), '^[A-Z]{3}$'), false), TRY_CAST(as_of_text AS DATE) IS NOT NULL, coalesce(TRY_CAST(lookback_text AS INTEGER) >= 1, false), coalesce(TRY_CAST(level_text AS INTEGER) IN (0, 1, 2, 3), false), regexp_matches(concat(upper(iso3_text), '_', as_of_text, '_m', lookback_text), '^[A-Z]{3}_[0-9]{4}-[0-9]{2}-[0-9]{2}_m[1-9][0-9]*$')]) AS ok FROM manifest) WHERE NOT ok")
def _(fx: Fixtures) -> DataFrame:
    """Metadata of every run of the manifest against the rules: required keys, patterns,
    enums, minimums. A row for each rule that a run breaks."""
    months, level = F.expr("try_cast(lookback_text AS int)"), F.expr("try_cast(level_text AS int)")
    code = F.upper("iso3_text")
    checks = (code.rlike("^[A-Z]{3}$"), F.expr("try_to_date(as_of_text, 'yyyy-MM-dd')").isNotNull(), months >= 1, level.isin(0, 1, 2, 3), F.concat(code, F.lit("_"), "as_of_text", F.lit("_m"), "lookback_text").rlike("^[A-Z]{3}_[0-9]{4}-[0-9]{2}-[0-9]{2}_m[1-9][0-9]*$"))
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(c, F.lit(False)).alias("ok")) for r, c in zip(RUN_RULES, checks, strict=True)])
    return fx.manifest.select("file_order", F.explode(rows).alias("x")).where("not x.ok").select("file_order", "x.rule")


def runs(fx: Fixtures) -> DataFrame:
    return fx.sql(RUN_ROWS)


def run_id(hazard):  # noqa: ANN001, ANN201
    start = F.date_add(F.add_months("period_end", -F.col("months")), 1)
    return F.concat(F.col("iso3"), F.lit("_"), start.cast("string"), F.lit("_"), F.col("period_end").cast("string"), F.lit("_m"), F.col("months").cast("string"), F.lit("_"), hazard)


@query("artifact_register", "SELECT file_order AS run, kind, concat('/runs/', lower(iso3_text), '/', CAST(file_order AS VARCHAR), '/', kind, '.parquet') AS path FROM manifest, (VALUES ('mask'), ('summary'), ('metadata')) AS k(kind)")
def _(fx: Fixtures) -> DataFrame:
    """Runs append the paths of what they made; one form gives them as columns, one as rows."""
    path = lambda kind: F.concat(F.lit("/runs/"), F.lower("iso3_text"), F.lit("/"), F.col("file_order").cast("string"), F.lit(f"/{kind}.parquet"))
    wide = fx.manifest.select(F.col("file_order").alias("run"), path("mask").alias("mask"), path("summary").alias("summary")).unpivot("run", ["mask", "summary"], "kind", "path")
    at = files.write_parquet(wide, "artifacts")
    files.write_parquet(fx.manifest.select(F.col("file_order").alias("run"), F.lit("metadata").alias("kind"), path("metadata").alias("path")), "artifacts", path=at)
    return fx.spark.read.parquet(at)


@query("filter_admin_country", "SELECT admin_id, pcode FROM admin_units WHERE upper(iso3) = 'ASIA' AND admin_level = 1 AND admin_id IN (SELECT admin_id FROM admin_points GROUP BY admin_id HAVING count(*) >= 3)")
def _(fx: Fixtures) -> DataFrame:
    """Units of a country and level that have a sound ring; none at all is an error."""
    sound = grid.valid_rings(fx.admin_points).where("valid").select("admin_id")
    units = fx.admin_units.where((F.upper("iso3") == "ASIA") & (F.col("admin_level") == 1)).join(sound, "admin_id", "left_semi")
    return grid.required(units, "units of ASIA").select("admin_id", "pcode")


@query("filter_admin_prefix", "SELECT code, admin_id, adm0 FROM (SELECT code, admin_id, iso3 AS adm0, iso3 = code AS exact, bool_or(iso3 = code) OVER (PARTITION BY code) AS any_exact FROM admin_units, (SELECT DISTINCT upper(r_name) AS code FROM region WHERE r_regionkey < 2 UNION ALL SELECT DISTINCT substr(r_name, 1, 3) FROM region WHERE r_regionkey > 2) WHERE iso3 = code OR substr(iso3, 1, 3) = substr(code, 1, 3)) WHERE exact OR NOT any_exact")
def _(fx: Fixtures) -> DataFrame:
    """Units of each code: those of the code itself, else those that share its first three
    letters."""
    r = fx.table("region")
    codes = r.where("r_regionkey < 2").select(F.upper("r_name").alias("code")).unionByName(r.where("r_regionkey > 2").select(F.substring("r_name", 1, 3).alias("code"))).distinct()
    return grid.units_of_codes(fx.admin_units, F.broadcast(codes)).select("code", "admin_id", F.col("iso3").alias("adm0"))


@query("unique_key_guard", "SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IS NULL")
def _(fx: Fixtures) -> DataFrame:
    return fx.table("orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n")).where("n > 1 or key is null")


@query("valid_population", "SELECT count(*) AS cells, count(pop) AS valid FROM population_cells")
def _(fx: Fixtures) -> DataFrame:
    return fx.population_cells.agg(F.count("*").alias("cells"), F.count(S.clean(F.col("pop_raw"), -9999.0)).alias("valid"))


@query("window_filter", "SELECT event_id, event_date FROM conflict_events WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _(fx: Fixtures) -> DataFrame:
    return fx.conflict_events.where(F.col("event_date").between("2024-01-05", "2024-01-20")).select("event_id", "event_date")


MONTHS = "SELECT CAST(unnest(range(DATE '2000-09-01', DATE '2001-08-02', INTERVAL 1 MONTH)) AS DATE) AS month_start"


def months_of(fx: Fixtures, as_of: str, n: int) -> DataFrame:
    """The last n calendar months, ascending."""
    last = F.trunc(F.lit(as_of).cast("date"), "month")
    return fx.spark.range(1).select(F.explode(F.sequence(F.add_months(last, 1 - n), last, F.expr("interval 1 month"))).alias("month_start"))


@query("month_membership", f"SELECT hcell_id, month_start FROM hazard_monthly WHERE month_start IN ({MONTHS})")
def _(fx: Fixtures) -> DataFrame:
    return fx.hazard_monthly.join(F.broadcast(months_of(fx, "2001-08-01", 12)), "month_start", "left_semi").select("hcell_id", "month_start")


@query("event_type_filter", "SELECT event_id, event_type FROM conflict_events WHERE event_type <> 'Protests'")
def _(fx: Fixtures) -> DataFrame:
    return fx.conflict_events.where(F.col("event_type").isin(*[t for t in S.EVENT_TYPES if t != "Protests"])).select("event_id", "event_type")


@query("threshold_mask", "SELECT hcell_id, t AS threshold, CAST(max(mmi) >= t AS INTEGER) AS mask FROM shake_cells, (VALUES (5e0), (6e0), (7e0)) AS x(t) GROUP BY hcell_id, t")
def _(fx: Fixtures) -> DataFrame:
    m = temporal.max_over_events(fx.shake_cells, "hcell_id", "mmi")
    return m.withColumn("threshold", F.explode(F.array(*map(F.lit, (5.0, 6.0, 7.0))))).select("hcell_id", "threshold", (F.col("mmi") >= F.col("threshold")).cast("int").alias("mask"))


@query("pop_affected_cell", "SELECT cell_id, CASE WHEN flood_days > 20 AND pop IS NOT NULL THEN pop ELSE 0 END AS pop_affected FROM population_cells LEFT JOIN (SELECT hcell_id, count(DISTINCT CASE WHEN pix > 0 AND pix <> 255 THEN CAST(acq_ts AS DATE) END) AS flood_days FROM flood_obs GROUP BY hcell_id) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5)")
def _(fx: Fixtures) -> DataFrame:
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    cells = align.align_nearest(fx.population_cells, days, 2, 5, 10)
    return cells.select("cell_id", F.when((F.col("flood_days") > 20) & F.col("pop").isNotNull(), F.col("pop")).otherwise(0.0).alias("pop_affected"))


@query("actual_earthquake", "SELECT event_id, CASE WHEN event_type <> 'earthquake' THEN 'not_earthquake' WHEN regexp_matches(lower(title), 'scenario|exercise|test event') THEN 'scenario_or_test' END AS reason FROM quake_catalog")
def _(fx: Fixtures) -> DataFrame:
    return fx.quake_catalog.select("event_id", S.actual_event_reason(F.col("event_type"), F.col("title")).alias("reason"))


@query("hard_soft_threshold", "SELECT admin_id, coverage, CASE WHEN coverage >= 90 THEN 'PASS' WHEN coverage >= 50 THEN 'WARN' ELSE 'FAIL' END AS status FROM (SELECT admin_id, round(100.0 * count(*) FILTER (WHERE row_no * 50 + col_no IN (SELECT user_id FROM events WHERE event_type = 'error')) / count(*), 6) AS coverage FROM population_cells JOIN admin_cells USING (cell_id) GROUP BY admin_id)")
def _(fx: Fixtures) -> DataFrame:
    """The share of each unit's cells that a layer has seen, against a target and a minimum."""
    seen = fx.table("events").where("event_type = 'error'").select(F.col("user_id").alias("cell_id"), F.lit(1).alias("seen")).distinct()
    c = fx.population_cells.select("cell_id").join(fx.admin_cells.select("cell_id", "admin_id"), "cell_id").join(seen, "cell_id", "left").groupBy("admin_id").agg(F.round(100.0 * F.count("seen") / F.count("*"), 6).alias("coverage"))
    return c.withColumn("status", F.when(F.col("coverage") >= 90, "PASS").when(F.col("coverage") >= 50, "WARN").otherwise("FAIL"))


@query("fallback_footprint_guard", "SELECT o_orderkey AS footprint_id, CASE WHEN o_orderstatus = 'P' THEN 'no_sid' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not_numeric' WHEN floor(o_totalprice / 1000) NOT IN (63, 93, 119) THEN 'unknown_band' WHEN o_orderpriority = '5-LOW' THEN 'not_a_polygon' END AS violation FROM orders")
def _(fx: Fixtures) -> DataFrame:
    """Supplied footprints with what is wrong with each."""
    o = fx.table("orders")
    threshold = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority")).otherwise(F.concat(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit(".0")))
    supplied = o.select(F.col("o_orderkey").alias("footprint_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("sid"), threshold.alias("threshold"), F.when(F.col("o_orderpriority") == "5-LOW", "LineString").otherwise("Polygon").alias("geometry_type"))
    return tracks.footprint_violations(supplied).select("footprint_id", "violation")


# Scalar rules


@query("norm_iso3", "SELECT file_order, CASE WHEN upper(iso3_text) = 'HOU' THEN 'HSE' WHEN regexp_matches(upper(iso3_text), '^[A-Z]{3}$') THEN upper(iso3_text) END AS iso3 FROM manifest")
def _(fx: Fixtures) -> DataFrame:
    return fx.manifest.select("file_order", S.norm_iso3(F.col("iso3_text"), {"HOU": "HSE"}).alias("iso3"))


@query("norm_storm_name", "SELECT DISTINCT name, regexp_replace(regexp_replace(upper(trim(name)), '-[0-9]+$', ''), '[^A-Z0-9]', '', 'g') AS norm FROM track_points")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.select("name").distinct().withColumn("norm", S.norm_storm_name(F.col("name")))


@query("window_start", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH + INTERVAL 1 DAY AS DATE) AS start_12m, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH + INTERVAL 1 DAY AS DATE) AS start_1m FROM orders")
def _(fx: Fixtures) -> DataFrame:
    d = F.to_date("o_orderdate")
    return fx.table("orders").select("o_orderkey", S.window_start(d, 12).alias("start_12m"), S.window_start(d, 1).alias("start_1m"))


@query("months_for_last_n", "SELECT o_orderdate, CAST(unnest(range(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH, date_trunc('month', o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM (SELECT DISTINCT o_orderdate FROM orders)")
def _(fx: Fixtures) -> DataFrame:
    m = F.trunc(F.to_date("o_orderdate"), "month")
    return fx.table("orders").select("o_orderdate").distinct().select("o_orderdate", F.explode(F.sequence(F.add_months(m, -2), m, F.expr("interval 1 month"))).alias("month_start"))


@query("days_in_month", "SELECT DISTINCT m, lpad(CAST(unnest(range(1, day(last_day(m)) + 1)) AS VARCHAR), 2, '0') AS d FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)")
def _(fx: Fixtures) -> DataFrame:
    m = fx.table("orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("m")).distinct()
    return m.select("m", F.explode(F.transform(F.sequence(F.lit(1), F.day(F.last_day("m"))), lambda d: F.lpad(d.cast("string"), 2, "0"))).alias("d"))


@query("run_id", f"SELECT concat(iso3, '_', CAST(CAST(period_end - INTERVAL (months) MONTH + INTERVAL 1 DAY AS DATE) AS VARCHAR), '_', CAST(period_end AS VARCHAR), '_m', CAST(months AS VARCHAR), '_', hazard) AS run_id FROM ({RUN_ROWS}), (VALUES ('flood'), ('heat')) AS h(hazard)")
def _(fx: Fixtures) -> DataFrame:
    return runs(fx).withColumn("hazard", F.explode(F.array(F.lit("flood"), F.lit("heat")))).select(run_id(F.col("hazard")).alias("run_id"))


@query("bounds_hash", "SELECT iso3, sha256(concat(iso3, '|', CAST(min(admin_id) AS VARCHAR), '.000000|', CAST(max(admin_id) AS VARCHAR), '.000000')) AS hash FROM admin_units GROUP BY iso3")
def _(fx: Fixtures) -> DataFrame:
    b = fx.admin_units.groupBy("iso3").agg(F.min("admin_id").cast("double").alias("lo"), F.max("admin_id").cast("double").alias("hi"))
    return b.select("iso3", F.sha2(F.format_string("%s|%.6f|%.6f", "iso3", "lo", "hi"), 256).alias("hash"))


BUFFER = "CASE WHEN event_type IN ('Battles', 'Explosions/Remote violence') THEN 5 WHEN event_type = 'Violence against civilians' THEN CASE WHEN fatalities > 0 THEN 5 ELSE 2 END WHEN event_type = 'Riots' THEN 2 WHEN event_type = 'Protests' THEN 1 END"


@query("buffer_km_rule", f"SELECT event_id, {BUFFER} AS buffer_km FROM conflict_events")
def _(fx: Fixtures) -> DataFrame:
    return fx.conflict_events.select("event_id", S.buffer_km(F.col("event_type"), F.col("fatalities"), strict=True).alias("buffer_km"))


@query("admin_level_resolve", "SELECT iso3, level, concat('admin', CAST(level AS VARCHAR)) AS label, concat('adm', CAST(level AS VARCHAR), '_pcode') AS pcode_label FROM admin_layers")
def _(fx: Fixtures) -> DataFrame:
    """The level that is given, else the first digits of the layer's name."""
    layer = fx.admin_layers.select("iso3", F.concat(F.lit("bounds_ADM"), F.col("level").cast("string"), F.lit("_v24")).alias("layer"), F.when(F.col("features") % 2 == 0, F.col("level")).alias("given"))
    level = S.admin_level(F.col("given"), F.col("layer"))
    return layer.select("iso3", level.alias("level"), F.concat(F.lit("admin"), level.cast("string")).alias("label"), F.concat(F.lit("adm"), level.cast("string"), F.lit("_pcode")).alias("pcode_label"))


PARSED = "SELECT file_order, CASE WHEN upper(iso3_text) = 'HOU' THEN 'HSE' WHEN regexp_matches(upper(iso3_text), '^[A-Z]{3}$') THEN upper(iso3_text) END AS iso3, TRY_CAST(as_of_text AS DATE) AS as_of, CASE WHEN TRY_CAST(lookback_text AS INTEGER) > 0 THEN TRY_CAST(lookback_text AS INTEGER) END AS lookback, CASE WHEN TRY_CAST(level_text AS INTEGER) BETWEEN 0 AND 3 THEN TRY_CAST(level_text AS INTEGER) END AS level FROM manifest"
ERRORS = "concat_ws('; ', CASE WHEN iso3 IS NULL THEN 'bad iso3' END, CASE WHEN as_of IS NULL THEN 'bad date' END, CASE WHEN lookback IS NULL THEN 'bad lookback' END, CASE WHEN level IS NULL THEN 'bad level' END)"


def parsed_manifest(fx: Fixtures) -> DataFrame:
    n, lvl = F.expr("try_cast(lookback_text AS int)"), F.expr("try_cast(level_text AS int)")
    m = fx.manifest.select("file_order", S.norm_iso3(F.col("iso3_text"), {"HOU": "HSE"}).alias("iso3"), F.expr("try_to_date(as_of_text, 'yyyy-MM-dd')").alias("as_of"), F.when(n > 0, n).alias("lookback"), F.when(lvl.between(0, 3), lvl).alias("level"))
    bad = [F.when(F.col(c).isNull(), F.lit(f"bad {t}")) for c, t in (("iso3", "iso3"), ("as_of", "date"), ("lookback", "lookback"), ("level", "level"))]
    return m.withColumn("errors", F.concat_ws("; ", *bad))


@query("manifest_parse", f"SELECT *, {ERRORS} AS errors FROM ({PARSED})")
def _(fx: Fixtures) -> DataFrame:
    return parsed_manifest(fx)


@query("issue_token_split", f"SELECT file_order, trim(split_part(tok, ' ', 1)) AS severity, trim(split_part(tok, ' ', 2)) AS field FROM (SELECT file_order, unnest(string_split(errors, ';')) AS tok0, trim(tok0) AS tok FROM (SELECT *, {ERRORS} AS errors FROM ({PARSED})) WHERE errors <> '')")
def _(fx: Fixtures) -> DataFrame:
    tok = parsed_manifest(fx).where("errors <> ''").select("file_order", F.explode(F.split("errors", ";")).alias("tok")).withColumn("tok", F.trim("tok"))
    return tok.select("file_order", F.trim(F.substring_index("tok", " ", 1)).alias("severity"), F.trim(F.substring_index("tok", " ", -1)).alias("field"))


@query("close_enough", "SELECT l_orderkey, l_linenumber, abs(l_extendedprice - 900 * l_quantity) <= greatest(0.5e0 * greatest(abs(l_extendedprice), abs(900 * l_quantity)), 1e-6) AS close FROM lineitem")
def _(fx: Fixtures) -> DataFrame:
    return fx.table("lineitem").select("l_orderkey", "l_linenumber", S.close_enough(F.col("l_extendedprice"), 900 * F.col("l_quantity"), 1e-6, 0.5).alias("close"))


@query("json_properties", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'none' AS missing FROM events")
def _(fx: Fixtures) -> DataFrame:
    p = F.from_json("props", "k bigint, m string")
    return fx.table("events").select("event_id", p["k"].alias("k"), F.coalesce(p["m"], F.lit("none")).alias("missing"))


@query("polygon_label_class", "SELECT ext_id, label, CASE label WHEN 60 THEN 63 WHEN 90 THEN 93 WHEN 120 THEN 119 END AS threshold, (label = 60 AND o_orderpriority <> '5-LOW') OR (label = 90 AND o_orderpriority = '2-HIGH') OR (label = 120 AND o_orderpriority = '1-URGENT') AS usable FROM external_buffers JOIN orders ON o_orderkey = ext_id")
def _(fx: Fixtures) -> DataFrame:
    """Buffers by the text of their label, and whether their class is the label's."""
    kind = F.col("o_orderpriority")
    given = F.when(kind == "5-LOW", None).when(kind == "2-HIGH", F.when(F.col("label") == 90, "Poly_Orange").otherwise("Poly_Green")).when(kind == "1-URGENT", F.when(F.col("label") == 120, "Poly_Red").otherwise("Poly_Green")).otherwise("Poly_Green")
    b = fx.external_buffers.join(fx.table("orders").select(F.col("o_orderkey").alias("ext_id"), "o_orderpriority"), "ext_id").select("ext_id", "label", F.concat("label", F.lit(" km/h")).alias("polygonlabel"), given.alias("Class"))
    return tracks.labelled_buffers(b).select("ext_id", "label", "threshold", "usable")


@query("asset_filename", "SELECT admin_id, concat(lower(substr(iso3, 1, 3)), '_ppp_2025_100m.tif') AS file_name, substr(sha256(concat('https://host.invalid/', lower(substr(iso3, 1, 3)))), 1, 20) AS cache_key FROM admin_units")
def _(fx: Fixtures) -> DataFrame:
    code = F.lower(F.substring("iso3", 1, 3))
    return fx.admin_units.select("admin_id", F.format_string("%s_ppp_%d_100m.tif", code, F.lit(2025)).alias("file_name"), F.substring(F.sha2(F.concat(F.lit("https://host.invalid/"), code), 256), 1, 20).alias("cache_key"))


@query("lon_unwrap", "SELECT event_id, round(170 + ((lon + 160 - 170 + 180) - floor((lon + 160 - 170 + 180) / 360) * 360) - 180, 6) AS lon FROM track_points")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.select("event_id", F.round(S.lon_unwrap(F.col("lon") + 160, F.lit(170.0)), 6).alias("lon"))


@query("thresholds_label", "SELECT DISTINCT t, CASE WHEN t = floor(t) THEN CAST(CAST(t AS INTEGER) AS VARCHAR) ELSE replace(CAST(t AS VARCHAR), '.', 'p') END AS label FROM (SELECT (hcell_id % 5) / 2e0 + 5 AS t FROM shake_cells)")
def _(fx: Fixtures) -> DataFrame:
    t = F.col("t")
    return fx.shake_cells.select(((F.col("hcell_id") % 5) / 2 + 5).alias("t")).distinct().withColumn("label", F.when(t == F.floor(t), t.cast("int").cast("string")).otherwise(F.replace(t.cast("string"), F.lit("."), F.lit("p"))))


# Joins


@query("join_pop_admin", "SELECT cell_id, admin_id, pop FROM population_cells JOIN admin_cells USING (cell_id)")
def _(fx: Fixtures) -> DataFrame:
    return fx.population_cells.join(fx.admin_cells, "cell_id").select("cell_id", "admin_id", "pop")


DROUGHT_MASK = f"SELECT hcell_id, bool_or(value <= -1.5) AS affected FROM hazard_monthly WHERE month_start IN ({MONTHS}) GROUP BY hcell_id"


def drought_floor(fx: Fixtures) -> DataFrame:
    """(drought_id, spei): the least value of the window; any month is at or below a
    threshold if and only if the least one is."""
    h = fx.hazard_monthly.join(F.broadcast(months_of(fx, "2001-08-01", 12)), "month_start", "left_semi")
    return h.groupBy(F.col("hcell_id").alias("drought_id")).agg(F.min(F.when(~F.isnan("value"), F.col("value"))).alias("spei"))


def drought_mask(fx: Fixtures, t: float = -1.5) -> DataFrame:
    h = fx.hazard_monthly.join(F.broadcast(months_of(fx, "2001-08-01", 12)), "month_start", "left_semi")
    return temporal.any_over_time(h, "hcell_id", F.col("value") <= t)


@query("join_mask_pop", f"SELECT cell_id, CAST(coalesce(affected, false) AS INTEGER) AS mask FROM population_cells LEFT JOIN ({DROUGHT_MASK}) m ON m.hcell_id = floor(row_no / 3) * 10 + floor(col_no / 5)")
def _(fx: Fixtures) -> DataFrame:
    return align.align_nearest(fx.population_cells, drought_mask(fx), 3, 5, 10).select("cell_id", F.coalesce("affected", F.lit(False)).cast("int").alias("mask"))


@query("grid_align_nearest", "SELECT cell_id, h.value FROM population_cells LEFT JOIN (SELECT hcell_id, max(value) AS value FROM hazard_daily GROUP BY hcell_id) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5)")
def _(fx: Fixtures) -> DataFrame:
    return align.align_nearest(fx.population_cells, temporal.max_over_events(fx.hazard_daily, "hcell_id", "value"), 2, 5, 10).select("cell_id", "value")


@query("grid_align_bilinear", """WITH g AS (SELECT hcell_id % 10 AS gx, CAST(floor(hcell_id / 10) AS BIGINT) AS gy, max(mmi) AS mmi FROM shake_cells GROUP BY hcell_id),
 p AS (SELECT cell_id AS id, (col_no + 0.5e0) / 5 - 0.5e0 AS fx, (row_no + 0.5e0) / 3 - 0.5e0 AS fy FROM population_cells),
 c AS (SELECT id, floor(fx) + i AS gx, floor(fy) + j AS gy, (CASE i WHEN 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) * (CASE j WHEN 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) AS w FROM p, (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j))
 SELECT id, round(CAST(sum(CAST(w * mmi AS DECIMAL(28,12))) AS DOUBLE) / CAST(sum(CAST(w AS DECIMAL(28,12))) AS DOUBLE), 6) AS mmi FROM c JOIN g ON c.gx = g.gx AND c.gy = g.gy WHERE w > 0 GROUP BY id""")
def _(fx: Fixtures) -> DataFrame:
    grid = temporal.max_over_events(fx.shake_cells, "hcell_id", "mmi").select((F.col("hcell_id") % 10).alias("gx"), F.floor(F.col("hcell_id") / 10).alias("gy"), "mmi")
    points = fx.population_cells.select(F.col("cell_id").alias("id"), ((F.col("col_no") + 0.5) / 5 - 0.5).alias("fx"), ((F.col("row_no") + 0.5) / 3 - 0.5).alias("fy"))
    return align.align_bilinear(points, grid, "mmi")


@query("grid_align_average", f"SELECT CAST(floor(row_no / 2) * 10 + floor(col_no / 5) AS BIGINT) AS hcell_id, round({dec('pop')} / count(pop), 6) AS pop, count(pop) AS n FROM population_cells GROUP BY 1")
def _(fx: Fixtures) -> DataFrame:
    return align.align_average(fx.population_cells, "pop", 2, 5, 10)


@query("range_bbox_overlap", "SELECT item_id, u.admin_id FROM stac_items s JOIN (SELECT admin_id, 30 + min(x) * 0.1e0 AS w, 30 + max(x) * 0.1e0 AS e, 20 - max(y) * 0.1e0 AS s, 20 - min(y) * 0.1e0 AS n FROM admin_points GROUP BY admin_id) u ON s.west < u.e AND s.east > u.w AND s.south < u.n AND s.north > u.s")
def _(fx: Fixtures) -> DataFrame:
    """The theta join made equi by one-degree tiles; a pair counts in its first tile."""
    u = fx.admin_points.groupBy("admin_id").agg((30 + F.min("x") * 0.1).alias("w"), (30 + F.max("x") * 0.1).alias("e"), (20 - F.max("y") * 0.1).alias("s"), (20 - F.min("y") * 0.1).alias("n"))
    tiles = lambda df, a, b, c, d: df.withColumn("tx", F.explode(F.sequence(F.floor(a), F.floor(b)))).withColumn("ty", F.explode(F.sequence(F.floor(c), F.floor(d))))
    left, right = tiles(fx.stac_items, "west", "east", "south", "north"), tiles(u, "w", "e", "s", "n")
    first = (F.col("tx") == F.greatest(F.floor("west"), F.floor("w"))) & (F.col("ty") == F.greatest(F.floor("south"), F.floor("s")))
    return left.join(right, ["tx", "ty"]).where("west < e and east > w and south < n and north > s").where(first).select("item_id", "admin_id")



@query("readiness_preflight_join", "SELECT c_custkey AS task_id, CASE WHEN o_custkey IS NULL THEN 'MISSING' ELSE 'PASS' END AS preflight FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey")
def _(fx: Fixtures) -> DataFrame:
    pre = fx.table("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("task_id"), F.lit("PASS").alias("preflight")).distinct()
    return fx.table("customer").select(F.col("c_custkey").alias("task_id")).join(pre, "task_id", "left").na.fill("MISSING", ["preflight"])


@query("join_admin_stats_back", f"SELECT u.admin_id, coalesce(t, 0) AS total FROM admin_units u LEFT JOIN (SELECT admin_id, {dec('pop')} AS t FROM population_cells JOIN admin_cells USING (cell_id) WHERE pop > 9500 AND lon < 32 GROUP BY admin_id) s USING (admin_id)")
def _(fx: Fixtures) -> DataFrame:
    """Sums of crowded cells of the west by unit; units without such cells have 0."""
    crowded = fx.population_cells.where("pop > 9500 and lon < 32")
    return zonal.labelled_sum(crowded, fx.admin_cells, fx.admin_units, {"total": F.col("pop")})


@query("missing_months_anti", "SELECT month_start FROM (SELECT CAST(unnest(range(DATE '2001-05-01', DATE '2002-04-02', INTERVAL 1 MONTH)) AS DATE) AS month_start) WHERE month_start NOT IN (SELECT month_start FROM hazard_monthly)")
def _(fx: Fixtures) -> DataFrame:
    return months_of(fx, "2002-04-01", 12).join(fx.hazard_monthly.select("month_start").distinct(), "month_start", "left_anti")


@query("missing_parent_anti", "SELECT c_custkey AS task_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(fx: Fixtures) -> DataFrame:
    """Tasks without a preflight row."""
    pre = fx.table("orders").where("o_orderstatus = 'P'")
    return fx.table("customer").select(F.col("c_custkey").alias("task_id")).join(pre, F.col("task_id") == F.col("o_custkey"), "left_anti")


@query("combine_first", "SELECT coalesce(a.hcell_id, b.hcell_id) AS hcell_id, coalesce(a.day, b.day) AS day, coalesce(a.value, b.value) AS value FROM (SELECT * FROM hazard_daily WHERE day(day) < 20) a FULL JOIN (SELECT hcell_id, day, value + 1 AS value FROM hazard_daily WHERE day(day) >= 10) b ON a.hcell_id = b.hcell_id AND a.day = b.day")
def _(fx: Fixtures) -> DataFrame:
    d = fx.hazard_daily
    a, b = d.where("day(day) < 20"), d.where("day(day) >= 10").select("hcell_id", "day", (F.col("value") + 1).alias("second"))
    return a.join(b, ["hcell_id", "day"], "full").select("hcell_id", "day", F.coalesce("value", "second").alias("value"))


@query("lookup_country_name", f"SELECT file_order, CASE WHEN c_acctbal < 0 THEN c_name ELSE country END AS country FROM manifest JOIN customer ON c_custkey = file_order LEFT JOIN ({LOOKUP}) l ON l.iso3 = upper(trim(iso3_text))")
def _(fx: Fixtures) -> DataFrame:
    """The name that a row gives, else the lookup's for its code, else none."""
    given = fx.table("customer").select(F.col("c_custkey").alias("file_order"), F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise("").alias("given"))
    m = fx.manifest.select("file_order", F.upper(F.trim("iso3_text")).alias("iso3")).join(given, "file_order")
    return m.join(F.broadcast(iso_lookup(fx)), "iso3", "left").select("file_order", F.coalesce(F.nullif(F.col("given"), F.lit("")), F.col("country")).alias("country"))


# Aggregates


@query("labelled_sum", f"SELECT admin_id, coalesce({dec('pop')}, 0) AS pop FROM admin_units LEFT JOIN (SELECT admin_id, pop FROM population_cells JOIN admin_cells USING (cell_id)) USING (admin_id) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return zonal.labelled_sum(fx.population_cells, fx.admin_cells, fx.admin_units, {"pop": F.col("pop")})


@query("any_over_time", DROUGHT_MASK)
def _(fx: Fixtures) -> DataFrame:
    return drought_mask(fx)


FLOOD_DAYS = "SELECT hcell_id, count(DISTINCT CASE WHEN pix > 0 AND pix <> 255 THEN CAST(acq_ts AS DATE) END) AS flood_days FROM flood_obs GROUP BY hcell_id"


@query("flood_days", FLOOD_DAYS)
def _(fx: Fixtures) -> DataFrame:
    return temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")


@query("flood_hits_per_item", "SELECT hcell_id, count(*) FILTER (WHERE pix > 0 AND pix <> 255) AS flood_hits FROM flood_obs GROUP BY hcell_id")
def _(fx: Fixtures) -> DataFrame:
    return temporal.flood_hits(fx.flood_obs, "hcell_id", "pix")


@query("max_over_events", "SELECT hcell_id, max(mmi) AS mmi FROM shake_cells GROUP BY hcell_id")
def _(fx: Fixtures) -> DataFrame:
    return temporal.max_over_events(fx.shake_cells, "hcell_id", "mmi")


POP_FLOOD = f"SELECT admin_id, pop, flood_days FROM population_cells JOIN admin_cells USING (cell_id) LEFT JOIN ({FLOOD_DAYS}) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5)"


def pop_flood(fx: Fixtures) -> DataFrame:
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    return align.align_nearest(fx.population_cells, days, 2, 5, 10).join(fx.admin_cells, "cell_id")


@query("pct_affected", f"SELECT admin_id, CASE WHEN {dec('pop')} > 0 THEN round(100 * {dec('CASE WHEN flood_days > 20 THEN pop ELSE 0 END')} / {dec('pop')}, 6) END AS pct_affected FROM ({POP_FLOOD}) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    hit = F.when(F.col("flood_days") > 20, F.col("pop")).otherwise(0.0)
    return pop_flood(fx).groupBy("admin_id").agg(S.pct(S.dsum(hit), S.dsum(F.col("pop"))).alias("pct_affected"))


@query("pop_weighted_mean", f"SELECT admin_id, round({dec('pop * flood_days')} / {dec('pop')}, 6) AS mean_days FROM (SELECT * FROM ({POP_FLOOD}) WHERE flood_days IS NOT NULL) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return pop_flood(fx).where("flood_days is not null").groupBy("admin_id").agg(zonal.weighted_mean(F.col("flood_days"), F.col("pop")).alias("mean_days"))


@query("pop_weighted_days", f"SELECT admin_id, {dec('pop * flood_days')} AS person_days FROM ({POP_FLOOD}) GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return pop_flood(fx).groupBy("admin_id").agg(S.dsum(F.col("pop") * F.col("flood_days")).alias("person_days"))


@query("zonal_mean_max", f"SELECT admin_id, round(avg(CAST(flood_days AS DOUBLE)), 6) AS mean_days, max(flood_days) AS max_days FROM ({POP_FLOOD}) WHERE pop IS NOT NULL GROUP BY admin_id")
def _(fx: Fixtures) -> DataFrame:
    return pop_flood(fx).where("pop is not null").groupBy("admin_id").agg(F.round(F.avg("flood_days"), 6).alias("mean_days"), F.max("flood_days").alias("max_days"))


@query("national_summary", f"SELECT iso3, admin_id, t AS pop_total, a AS pop_affected, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS pct_affected FROM (SELECT iso3, admin_id, {dec('pop')} AS t, {dec('CASE WHEN pop IS NOT NULL THEN CASE WHEN flood_days > 20 THEN pop ELSE 0 END END')} AS a FROM ({POP_FLOOD}) JOIN admin_units USING (admin_id) GROUP BY GROUPING SETS ((iso3, admin_id), (iso3)))")
def _(fx: Fixtures) -> DataFrame:
    u = flood_units(fx)
    return zonal.with_national(u.join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id"))


def flood_units(fx: Fixtures) -> DataFrame:
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    cells = align.align_nearest(fx.population_cells, days, 2, 5, 10)
    return zonal.exposure(cells, fx.admin_cells, fx.admin_units, F.col("flood_days") > 20)


#: How far the assigned population may be from the whole, and countries with
#: a tolerance of their own.
TOLERANCE, TOLERANCES = 0.02, {"ASIA": 0.05, "AFRICA": 0.025}
TOLERANCE_SQL = "CASE iso3 " + " ".join(f"WHEN '{c}' THEN {t}e0" for c, t in TOLERANCES.items()) + f" ELSE {TOLERANCE}e0 END"


def assigned_fractions(fx: Fixtures, assigned: DataFrame) -> DataFrame:
    """iso3, assigned, total, fraction, tolerance, within: the people that ``assigned``
    (iso3, assigned) found in a country's units, of all that the country has."""
    total = fx.population_cells.join(fx.admin_cells.select("cell_id", "iso3"), "cell_id").groupBy("iso3").agg(S.dsum(F.col("pop")).alias("total"))
    own = fx.spark.createDataFrame(list(TOLERANCES.items()), "iso3 string, own double")
    t = total.join(assigned, "iso3", "left").join(F.broadcast(own), "iso3", "left").withColumns({"assigned": F.coalesce("assigned", F.lit(0.0)), "tolerance": F.coalesce("own", F.lit(TOLERANCE))})
    share = F.try_divide("assigned", "total")
    return t.select("iso3", "assigned", "total", F.round(share, 6).alias("fraction"), "tolerance", F.coalesce((share >= 1 - F.col("tolerance")) & (share <= 1 + F.col("tolerance")), F.lit(False)).alias("within"))


CAPPED_TOTALS = f"SELECT iso3, coalesce({dec('CASE WHEN pop <= 9800 THEN pop END')}, 0) AS assigned, {dec('pop')} AS total FROM population_cells JOIN admin_cells USING (cell_id) GROUP BY iso3"


@query("assigned_fraction", f"SELECT iso3, assigned, total, round(assigned / total, 6) AS fraction, {TOLERANCE_SQL} AS tolerance, coalesce(assigned / total BETWEEN 1 - {TOLERANCE_SQL} AND 1 + {TOLERANCE_SQL}, false) AS within FROM ({CAPPED_TOTALS})")
def _(fx: Fixtures) -> DataFrame:
    """Population that found a unit by country; the most crowded cells found none."""
    cells = fx.population_cells.where("pop <= 9800").join(fx.admin_cells.select("cell_id", "iso3"), "cell_id")
    return assigned_fractions(fx, cells.groupBy("iso3").agg(S.dsum(F.col("pop")).alias("assigned")))


@query("first_text", "SELECT sid, arg_min(name, event_id) AS first_name FROM track_points WHERE name IS NOT NULL GROUP BY sid")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.where("name is not null").groupBy("sid").agg(F.min_by("name", F.struct("iso_time", "event_id")).alias("first_name"))


@query("distinct_storms", "SELECT count(DISTINCT sid) AS storms, count(*) AS points FROM track_points")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.agg(F.count_distinct("sid").alias("storms"), F.count("*").alias("points"))


@query("value_counts", f"SELECT event_type, {BUFFER} AS buffer_km, count(*) AS n FROM conflict_events GROUP BY ALL")
def _(fx: Fixtures) -> DataFrame:
    """Events by type and the radius that they get."""
    return fx.conflict_events.groupBy("event_type", S.buffer_km(F.col("event_type"), F.col("fatalities"), strict=True).alias("buffer_km")).agg(F.count("*").alias("n"))


LABELLED_DAYS = "SELECT iso3, value FROM hazard_daily JOIN (SELECT DISTINCT CAST(floor(row_no / 2) * 10 + floor(col_no / 5) AS BIGINT) AS hcell_id, iso3 FROM population_cells JOIN admin_cells USING (cell_id)) USING (hcell_id)"


def baseline(fx: Fixtures) -> DataFrame:
    """Percentiles of all cell-days of each country, exact ones by rounds of counting."""
    cells = fx.population_cells.join(fx.admin_cells.select("cell_id", "iso3"), "cell_id").select(align.hazard_cell(F.col("row_no"), F.col("col_no"), 2, 5, 10).alias("hcell_id"), "iso3").distinct()
    return quantiles.exact_percentiles(files.stored(fx.hazard_daily.join(cells, "hcell_id").select("iso3", "value")), "iso3", "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("baseline_percentiles", f"SELECT iso3, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM ({LABELLED_DAYS}) GROUP BY iso3")
def _(fx: Fixtures) -> DataFrame:
    return baseline(fx)


@query("pct_distribution", f"SELECT round(min(p), 6) AS lo, round(quantile_cont(p, 0.05), 6) AS p5, round(quantile_cont(p, 0.95), 6) AS p95, round(quantile_cont(p, 0.25), 6) AS p25, round(quantile_cont(p, 0.5), 6) AS median, round(quantile_cont(p, 0.75), 6) AS p75, round(max(p), 6) AS hi FROM (SELECT CASE WHEN {dec('pop')} > 0 THEN round(100 * {dec('CASE WHEN flood_days > 20 THEN pop ELSE 0 END')} / {dec('pop')}, 6) END AS p FROM ({POP_FLOOD}) GROUP BY admin_id)")
def _(fx: Fixtures) -> DataFrame:
    return flood_units(fx).agg(F.round(F.min("pct_affected"), 6).alias("lo"), *[F.round(F.percentile("pct_affected", p), 6).alias(n) for n, p in (("p5", 0.05), ("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))], F.round(F.max("pct_affected"), 6).alias("hi"))


@query("finite_by_month", "SELECT month_start, count(*) FILTER (WHERE isfinite(x)) AS finite, count(*) FILTER (WHERE NOT isfinite(x)) AS missing, round(min(x) FILTER (WHERE isfinite(x)), 6) AS least, round(median(x) FILTER (WHERE isfinite(x)), 6) AS median, round(max(x) FILTER (WHERE isfinite(x)), 6) AS most FROM (SELECT month_start, CASE WHEN value > 1.2 THEN CAST('NaN' AS DOUBLE) ELSE value END AS x FROM hazard_monthly) GROUP BY month_start")
def _(fx: Fixtures) -> DataFrame:
    """Finite and missing values of each month; values out of range are held as NaN."""
    x = F.when(F.col("value") > 1.2, F.lit(float("nan"))).otherwise(F.col("value"))
    h = fx.hazard_monthly.select("month_start", F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x).alias("x"))
    return h.groupBy("month_start").agg(F.count("x").alias("finite"), F.count_if(F.col("x").isNull()).alias("missing"), F.round(F.min("x"), 6).alias("least"), F.round(F.percentile("x", 0.5), 6).alias("median"), F.round(F.max("x"), 6).alias("most"))


@query("total_bounds", "SELECT min(longitude) AS w, min(latitude) AS s, max(longitude) AS e, max(latitude) AS n FROM conflict_events")
def _(fx: Fixtures) -> DataFrame:
    return fx.conflict_events.agg(F.min("longitude").alias("w"), F.min("latitude").alias("s"), F.max("longitude").alias("e"), F.max("latitude").alias("n"))


@query("mask_stats", f"SELECT count(*) FILTER (WHERE flood_days > 20) AS affected, count(*) AS cells, max(flood_days) AS max_days, round(avg(CASE WHEN flood_days > 20 THEN CAST(flood_days AS DOUBLE) END), 6) AS mean_affected FROM ({FLOOD_DAYS})")
def _(fx: Fixtures) -> DataFrame:
    hit = F.col("flood_days") > 20
    return temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix").agg(F.count_if(hit).alias("affected"), F.count("*").alias("cells"), F.max("flood_days").alias("max_days"), F.round(F.avg(F.when(hit, F.col("flood_days"))), 6).alias("mean_affected"))


@query("batch_status_counts", "SELECT o_orderpriority AS step, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, count(*) FILTER (WHERE o_orderstatus = 'P') AS passed FROM orders GROUP BY o_orderpriority")
def _(fx: Fixtures) -> DataFrame:
    out = fx.table("orders").groupBy(F.col("o_orderpriority").alias("step")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return out.toDF("step", "failed", "open", "passed").na.fill(0)


@query("iso_feature_counts", "SELECT admin_level, upper(iso3) AS iso3, count(*) AS features FROM admin_units GROUP BY ALL")
def _(fx: Fixtures) -> DataFrame:
    return fx.admin_units.groupBy("admin_level", F.upper("iso3").alias("iso3")).agg(F.count("*").alias("features"))


UNIT_PCT = f"SELECT u.iso3, u.admin_id, coalesce(t, 0) AS t, coalesce(a, 0) AS a, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS p FROM admin_units u LEFT JOIN (SELECT admin_id, {dec('pop')} AS t, {dec('CASE WHEN pop IS NOT NULL THEN CASE WHEN flood_days > 20 THEN pop ELSE 0 END END')} AS a FROM ({POP_FLOOD}) GROUP BY admin_id) x USING (admin_id)"
NATIONAL = f"SELECT admin_id, p AS pct_affected, national_pct, coalesce(p > national_pct, false) AS deprived FROM ({UNIT_PCT}) JOIN (SELECT iso3, CASE WHEN sum(t) > 0 THEN round(100 * {dec('a')} / {dec('t')}, 6) END AS national_pct FROM ({UNIT_PCT}) GROUP BY iso3) USING (iso3)"


@query("deprivation_flag", NATIONAL)
def _(fx: Fixtures) -> DataFrame:
    u = flood_units(fx).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    return zonal.above_national(u).select("admin_id", "pct_affected", "national_pct", "deprived")


@query("national_share", f"SELECT admin_id, CASE WHEN sum(t) OVER (PARTITION BY iso3) > 0 THEN round(t / CAST(sum(CAST(t AS DECIMAL(18,4))) OVER (PARTITION BY iso3) AS DOUBLE), 6) END AS share FROM ({UNIT_PCT})")
def _(fx: Fixtures) -> DataFrame:
    u = flood_units(fx).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    total = F.sum(F.col("pop_total").cast("decimal(18,4)")).over(Window.partitionBy("iso3")).cast("double")
    return u.select("admin_id", F.when(total > 0, F.round(F.col("pop_total") / total, 6)).alias("share"))


# Windows

ISLANDS = "SELECT DISTINCT hcell_id FROM (SELECT hcell_id, axis_idx - row_number() OVER (PARTITION BY hcell_id ORDER BY axis_idx) AS g FROM (SELECT hcell_id, day FROM hazard_daily WHERE value > {t}) JOIN (SELECT day, row_number() OVER (ORDER BY day) AS axis_idx FROM (SELECT DISTINCT day FROM hazard_daily)) USING (day)) GROUP BY hcell_id, g HAVING count(*) >= 3"


@query("consecutive_k_rolling", ISLANDS.format(t=38))
def _(fx: Fixtures) -> DataFrame:
    return temporal.consecutive_k_rolling(fx.hazard_daily, "hcell_id", "day", F.col("value") > 38, 3)


@query("consecutive_k_islands", "SELECT DISTINCT hcell_id FROM (SELECT hcell_id, sum(x) OVER (PARTITION BY hcell_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s FROM (SELECT c.hcell_id, a.day, CASE WHEN h.value > 38 THEN 1 ELSE 0 END AS x FROM (SELECT DISTINCT hcell_id FROM hazard_daily) c CROSS JOIN (SELECT DISTINCT day FROM hazard_daily) a LEFT JOIN hazard_daily h ON h.hcell_id = c.hcell_id AND h.day = a.day)) WHERE s = 3")
def _(fx: Fixtures) -> DataFrame:
    return temporal.consecutive_k(fx.hazard_daily, "hcell_id", "day", F.col("value") > 38, 3)


@query("dedupe_first_timestamp", "SELECT user_id, day, arg_min(event_id, event_id) AS event_id FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events) GROUP BY user_id, day")
def _(fx: Fixtures) -> DataFrame:
    e = fx.table("events").select("user_id", F.to_date("ts").alias("day"), "event_id")
    return temporal.first_per(e, ["user_id", "day"], [F.col("event_id")])


@query("prefer_consolidated", "SELECT y, m, min(dataset_type) AS dataset_type, arg_min(file, dataset_type || lpad(CAST(file AS VARCHAR), 20, '0')) AS file FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey AS file, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 495000 THEN 'consolidated' ELSE 'intermediate' END AS dataset_type FROM orders) GROUP BY y, m")
def _(fx: Fixtures) -> DataFrame:
    """The best file of each month: consolidated before intermediate, then the first. A
    minimum, so that partial results are merged and no month is one task's sort."""
    f = fx.table("orders").select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"), F.struct(F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 495000), "consolidated").otherwise("intermediate").alias("dataset_type"), F.col("o_orderkey").alias("file")).alias("best"))
    return f.groupBy("y", "m").agg(F.min("best").alias("best")).select("y", "m", "best.*")


@query("latest_product", "SELECT l_orderkey, arg_max(l_linenumber, l_quantity * 1000 + l_linenumber) AS line FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey")
def _(fx: Fixtures) -> DataFrame:
    p = fx.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").alias("weight"), F.col("l_linenumber").alias("updated"), F.col("l_returnflag").alias("status"))).alias("products"))
    live = F.filter("products", lambda x: x["status"] != "R")
    best = F.array_max(F.transform(live, lambda x: F.struct(x["weight"], x["updated"])))
    return p.select("l_orderkey", best["updated"].alias("line")).where("line is not null")


@query("grid_content_preference", "SELECT event_id, arg_min(content, CASE WHEN ends_with(content, 'grid.xml') THEN 1 WHEN ends_with(content, 'grid.xml.zip') THEN 2 ELSE 3 END) AS content FROM quake_products GROUP BY event_id")
def _(fx: Fixtures) -> DataFrame:
    """Of all contents of an event's products the first by preference of suffix."""
    c = F.col("content")
    rank = F.when(F.lower(c).endswith("download/grid.xml"), 1).when(F.lower(c).endswith("download/grid.xml.zip"), 2).when(F.lower(c).endswith("download/shape.zip"), 3)
    return fx.quake_products.where(rank.isNotNull()).groupBy("event_id").agg(F.min_by("content", rank).alias("content"))


@query("latest_step_status", "SELECT o_custkey AS task_id, o_orderpriority AS step, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_orderstatus, o_orderkey) IN ('F', 'P') AS done FROM orders GROUP BY o_custkey, o_orderpriority")
def _(fx: Fixtures) -> DataFrame:
    rows = fx.table("orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderpriority").alias("step"), F.col("o_orderstatus").alias("status"), "o_orderkey")
    return temporal.first_per(rows, ["task_id", "step"], [F.desc("o_orderkey")]).select("task_id", "step", "status", F.col("status").isin("F", "P").alias("done"))


@query("track_gap_hours", "SELECT event_id, round((epoch_us(lead(iso_time) OVER w) - epoch_us(iso_time)) / 3.6e9, 6) AS gap_hours FROM track_points WINDOW w AS (PARTITION BY sid ORDER BY iso_time, event_id)")
def _(fx: Fixtures) -> DataFrame:
    w = Window.partitionBy("sid").orderBy("iso_time", "event_id")
    us = F.unix_micros(F.col("iso_time").cast("timestamp"))
    return fx.track_points.select("event_id", F.round((F.lead(us).over(w) - us) / 3.6e9, 6).alias("gap_hours"))


@query("dedupe_event_last", "SELECT o_custkey AS ext_id, max(o_orderkey) AS page FROM orders GROUP BY o_custkey")
def _(fx: Fixtures) -> DataFrame:
    rows = fx.table("orders").select(F.col("o_custkey").alias("ext_id"), F.col("o_orderkey").alias("page"))
    return temporal.first_per(rows, ["ext_id"], [F.desc("page")])


@query("storm_middle_point", "SELECT sid, lon FROM (SELECT sid, lon, row_number() OVER (PARTITION BY sid ORDER BY iso_time, event_id) AS r, count(*) OVER (PARTITION BY sid) AS n FROM track_points) WHERE r = n // 2 + 1")
def _(fx: Fixtures) -> DataFrame:
    w = Window.partitionBy("sid")
    t = fx.track_points.withColumns({"r": F.row_number().over(w.orderBy("iso_time", "event_id")), "n": F.count("*").over(w)})
    return t.where("r = n div 2 + 1").select("sid", "lon")


@query("kelvin_detect", "SELECT hcell_id, day, round(CASE WHEN f = 0 THEN value + 273.15 - 273.15 ELSE value END, 6) AS value FROM (SELECT *, hcell_id % 2 AS f FROM hazard_daily)")
def _(fx: Fixtures) -> DataFrame:
    d = fx.hazard_daily.withColumn("source_file", F.col("hcell_id") % 2).withColumn("value", F.when(F.col("source_file") == 0, F.col("value") + 273.15).otherwise(F.col("value")))
    return temporal.to_celsius_by_file(d, "value", "day", "source_file").select("hcell_id", "day", F.round("value", 6).alias("value"))


# Sorts and sets


@query("top_units_by_pct", f"SELECT admin_id, p AS pct_affected FROM ({UNIT_PCT}) WHERE p IS NOT NULL ORDER BY p DESC, admin_id LIMIT 10")
def _(fx: Fixtures) -> DataFrame:
    return flood_units(fx).where("pct_affected is not null").orderBy(F.desc("pct_affected"), "admin_id").limit(10).select("admin_id", "pct_affected")


@query("best_item", "SELECT task, item_id FROM (SELECT o_custkey AS task, item_id, row_number() OVER (PARTITION BY o_custkey ORDER BY round(greatest(0, least(east, 33e0) - greatest(west, 31e0)) * greatest(0, least(north, 19.5e0) - greatest(south, 18e0)), 9) DESC, item_id) AS r FROM stac_items JOIN orders ON o_orderkey = item_id WHERE href IS NOT NULL) WHERE r = 1")
def _(fx: Fixtures) -> DataFrame:
    """Of each task's items the one that covers most of the target's area, then the first."""
    target, box = tuple(F.lit(v) for v in (31.0, 18.0, 33.0, 19.5)), tuple(F.col(c) for c in ("west", "south", "east", "north"))
    area = F.round(grid.overlap(target[0], target[2], box[0], box[2]) * grid.overlap(target[1], target[3], box[1], box[3]), 9)
    items = fx.stac_items.where("href is not null").join(fx.table("orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("task")), "item_id")
    return items.groupBy("task").agg(F.min_by("item_id", F.struct(-area, F.col("item_id"))).alias("item_id"))


@query("sort_tracks", "SELECT sid, event_id, row_number() OVER (PARTITION BY sid ORDER BY iso_time, event_id) AS seq FROM track_points")
def _(fx: Fixtures) -> DataFrame:
    return fx.track_points.select("sid", "event_id", F.row_number().over(Window.partitionBy("sid").orderBy("iso_time", "event_id")).cast("long").alias("seq"))


@query("sort_issues", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderpriority, o_custkey, o_orderkey")
def _(fx: Fixtures) -> DataFrame:
    return fx.table("orders").where("o_orderstatus = 'F'").orderBy("o_orderpriority", "o_custkey", "o_orderkey").select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("failures_preview", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey DESC LIMIT 10")
def _(fx: Fixtures) -> DataFrame:
    return fx.table("orders").where("o_orderstatus = 'F'").orderBy(F.desc("o_orderkey")).limit(10).select("o_orderkey")


@query("union_monthly_files", "SELECT hcell_id, month_start, value, CASE WHEN month_start >= DATE '1996-01-01' THEN 'late' END AS edition FROM hazard_monthly")
def _(fx: Fixtures) -> DataFrame:
    """Files by month in two editions, the later with one more column, read as one table."""
    h = fx.hazard_monthly.withColumn("month", F.date_format("month_start", "yyyyMM"))
    early = files.write_parquet(h.where("month_start < date'1996-01-01'"), "monthly", "month")
    late = files.write_parquet(h.where("month_start >= date'1996-01-01'").withColumn("edition", F.lit("late")), "monthly", "month")
    tables = [fx.spark.read.parquet(p) for p in (early, late)]
    return tables[0].unionByName(tables[1], allowMissingColumns=True).select("hcell_id", "month_start", "value", "edition")


@query("distinct_issues", "SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders")
def _(fx: Fixtures) -> DataFrame:
    return fx.table("orders").select("o_custkey", "o_orderpriority", "o_orderstatus").dropDuplicates(["o_custkey", "o_orderpriority", "o_orderstatus"])


@query("distinct_isos", f"SELECT DISTINCT iso3, concat('https://host.invalid/', iso3, '/', lower(iso3), '.tif') AS url FROM ({PARSED}) WHERE iso3 IS NOT NULL ORDER BY iso3")
def _(fx: Fixtures) -> DataFrame:
    isos = parsed_manifest(fx).where("iso3 is not null").select("iso3").distinct()
    return isos.withColumn("url", F.concat(F.concat_ws("/", F.lit("https://host.invalid"), "iso3", F.lower("iso3")), F.lit(".tif"))).orderBy("iso3")


@query("unknown_types_except", "SELECT DISTINCT event_type FROM events EXCEPT SELECT unnest(['click', 'view', 'purchase'])")
def _(fx: Fixtures) -> DataFrame:
    types = fx.table("events").select("event_type").distinct()
    return types.where(~F.array_contains(F.array(*map(F.lit, ("click", "view", "purchase"))), F.col("event_type")))


@query("stac_filter_dedup_counts", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN href IS NULL THEN 'no_asset' WHEN west IS NULL THEN 'no_bbox' WHEN east <= 32 THEN 'no_overlap' WHEN row_number() OVER (PARTITION BY href, href IS NULL, east <= 32 ORDER BY item_id) > 1 THEN 'duplicate' ELSE 'kept' END AS reason FROM stac_items) GROUP BY reason")
def _(fx: Fixtures) -> DataFrame:
    early = F.when(F.col("href").isNull(), "no_asset").when(F.col("west").isNull(), "no_bbox").when(F.col("east") <= 32, "no_overlap")
    items = fx.stac_items.withColumn("early", early)
    first = items.where("early is null").groupBy("href").agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.count("*").alias("kept"))
    late = first.select(F.explode(F.array(F.struct(F.lit("kept").alias("reason"), F.col("kept").alias("n")), F.struct(F.lit("duplicate").alias("reason"), (F.col("rows") - F.col("kept")).alias("n")))).alias("x")).select("x.reason", "x.n").where("n > 0")
    return items.where("early is not null").groupBy(F.col("early").alias("reason")).agg(F.count("*").alias("n")).unionByName(late)
