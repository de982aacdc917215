"""Composite indicators: exposed population by unit, and the audits beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapop.functions import scalar as S
from terrapop.operators import align, checks, contract, grid, shaking, temporal, zonal
from terrapop.sources import files
from terrapop.sources.fixtures import Fixtures

from .basic import FLOOD_DAYS, ISLANDS, LABELLED_DAYS, MONTHS, PARSED, UNIT_PCT, baseline, dec, drought_floor, flood_units, parsed_manifest
from .cyclone import CELL_BANDS, CYCLONE, METHODS, PROVISIONAL, band_methods, cell_bands, cyclone_table, footprints, provisional
from .geometry import DISCS, EDGES, FILL, event_discs
from .registry import query


def exposure_sql(mask: str, rows_per: int, condition: str) -> str:
    """Unit totals where ``condition`` on the aligned ``mask`` (alias h) holds."""
    return f"""SELECT u.admin_id, coalesce(t, 0) AS pop_total, coalesce(a, 0) AS pop_affected, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS pct_affected
        FROM admin_units u LEFT JOIN (SELECT admin_id, {dec('pop')} AS t, {dec(f'CASE WHEN pop IS NOT NULL THEN CASE WHEN coalesce({condition}, false) THEN pop ELSE 0 END END')} AS a
        FROM population_cells JOIN admin_cells USING (cell_id) LEFT JOIN ({mask}) h ON h.hcell_id = floor(row_no / {rows_per}) * 10 + floor(col_no / 5) GROUP BY admin_id) x USING (admin_id)"""


def bands_sql(hazard: str, parts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT admin_id, '{hazard}' AS hazard, '{t}' AS threshold, pop_total, pop_affected, pct_affected FROM ({q})" for t, q in parts.items())


#: Reporting thresholds of each hazard; the canonical one first.
DROUGHT_AT, HEAT_AT, FLOOD_AT, QUAKE_AT = (-1.5, -1.0, -2.0), (32, 38, 46), 0, (6, 5, 7)
DROUGHT = bands_sql("drought", {str(t): exposure_sql(f"SELECT hcell_id, bool_or(value <= {t}) AS affected FROM hazard_monthly WHERE month_start IN ({MONTHS}) GROUP BY hcell_id", 3, "h.affected") for t in DROUGHT_AT})
P95 = f"SELECT iso3, round(quantile_cont(value, 0.95), 6) AS p95 FROM ({LABELLED_DAYS}) GROUP BY iso3"
RELATIVE = f"SELECT DISTINCT iso3, hcell_id FROM (SELECT iso3, hcell_id, axis_idx - row_number() OVER (PARTITION BY iso3, hcell_id ORDER BY axis_idx) AS g FROM (SELECT p.iso3, hcell_id, day FROM hazard_daily, ({P95}) p WHERE value > p95) JOIN (SELECT day, row_number() OVER (ORDER BY day) AS axis_idx FROM (SELECT DISTINCT day FROM hazard_daily)) USING (day)) GROUP BY iso3, hcell_id, g HAVING count(*) >= 3"
HEAT_REL = f"""SELECT u.admin_id, coalesce(t, 0) AS pop_total, coalesce(a, 0) AS pop_affected, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS pct_affected FROM admin_units u LEFT JOIN (SELECT admin_id, {dec('pop')} AS t, {dec('CASE WHEN pop IS NOT NULL THEN CASE WHEN h.hcell_id IS NOT NULL THEN pop ELSE 0 END END')} AS a
 FROM population_cells JOIN admin_cells c USING (cell_id) LEFT JOIN ({RELATIVE}) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5) AND h.iso3 = c.iso3 GROUP BY admin_id) x USING (admin_id)"""
HEAT = bands_sql("heat", {**{str(t): exposure_sql("SELECT hcell_id, true AS affected FROM (" + ISLANDS.format(t=t) + ")", 2, "h.affected") for t in HEAT_AT}, "p95": HEAT_REL})
FLOOD_ANY = exposure_sql(FLOOD_DAYS, 2, f"h.flood_days > {FLOOD_AT}")
FLOOD = exposure_sql(FLOOD_DAYS, 2, "h.flood_days > 20")

# Earthquakes

PRODUCT = "SELECT event_id, content, url, status, update_time FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY preferred_weight DESC, update_time DESC, content DESC, coalesce(url, '') DESC, status DESC) AS rn FROM quake_products WHERE status <> 'DELETE') WHERE rn = 1"
CATALOG = f"SELECT c.event_id, p.content, p.url, p.status AS product_status, p.update_time, CASE WHEN event_type <> 'earthquake' THEN 'not_earthquake' WHEN regexp_matches(lower(title), 'scenario|exercise|test event') THEN 'scenario_or_test' WHEN NOT contains(lower(types), 'shakemap') THEN 'no_catalog_shakemap_reference' WHEN detail IS NULL THEN 'missing_event_detail_url' WHEN p.content IS NULL OR NOT ends_with(lower(p.content), 'grid.xml') THEN 'no_supported_grid_xml' WHEN p.url IS NULL THEN 'grid_missing_url' END AS gate FROM quake_catalog c LEFT JOIN ({PRODUCT}) p USING (event_id)"
CORNERS = "SELECT cell_id, floor(fx) + i AS gx, floor(fy) + j AS gy, (CASE i WHEN 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) * (CASE j WHEN 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) AS w FROM (SELECT cell_id, (col_no + 0.5e0) / 5 - 0.5e0 AS fx, (row_no + 0.5e0) / 3 - 0.5e0 AS fy FROM population_cells), (VALUES (0), (1)) AS a(i), (VALUES (0), (1)) AS b(j)"
ALIGNED = f"SELECT event_id, cell_id, round(sum(w * mmi) / sum(w), 6) AS mmi FROM ({CORNERS}) k JOIN shake_cells s ON k.gx = s.hcell_id % 10 AND k.gy = floor(s.hcell_id / 10) WHERE w > 0 GROUP BY event_id, cell_id"
SHAKEN = f"SELECT a.event_id, a.cell_id, a.mmi, u.iso3 FROM ({ALIGNED}) a JOIN admin_cells u USING (cell_id) JOIN (SELECT event_id FROM ({CATALOG}) WHERE gate IS NULL) g USING (event_id)"
QUAKE_CELLS = f"SELECT cell_id, max(mmi) AS mmi FROM ({SHAKEN}) JOIN (SELECT event_id, iso3 FROM ({SHAKEN}) GROUP BY event_id, iso3 HAVING max(mmi) >= {QUAKE_AT[0]}) USING (event_id, iso3) GROUP BY cell_id"


def quake_sql(t: int) -> str:
    return f"""SELECT u.admin_id, coalesce(t, 0) AS pop_total, coalesce(a, 0) AS pop_affected, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS pct_affected FROM admin_units u LEFT JOIN (SELECT admin_id, {dec('pop')} AS t, {dec(f'CASE WHEN pop IS NOT NULL THEN CASE WHEN coalesce(mmi >= {t}, false) THEN pop ELSE 0 END END')} AS a
 FROM population_cells JOIN admin_cells USING (cell_id) LEFT JOIN ({QUAKE_CELLS}) q USING (cell_id) GROUP BY admin_id) x USING (admin_id)"""


QUAKE = bands_sql("earthquake", {str(t): quake_sql(t) for t in QUAKE_AT})


def chosen_products(fx: Fixtures) -> DataFrame:
    """Of each event's products that aren't deleted the one of greatest weight, then latest."""
    live = fx.quake_products.where("status <> 'DELETE'")
    best = F.max(F.struct("preferred_weight", "update_time", "content", F.coalesce("url", F.lit("")).alias("url"), "status", F.col("url").isNotNull().alias("linked")))
    p = F.col("p")
    return live.groupBy("event_id").agg(best.alias("p")).select("event_id", p["content"].alias("content"), F.when(p["linked"], p["url"]).alias("url"), p["status"].alias("product_status"), p["update_time"].alias("update_time"))


def gated_catalog(fx: Fixtures) -> DataFrame:
    """Catalogue events with their chosen product and the first gate that they fail before
    any grid is read (``gate``)."""
    both = fx.quake_catalog.join(chosen_products(fx), "event_id", "left")
    gates = (
        S.actual_event_reason(F.col("event_type"), F.col("title")),
        F.when(~F.contains(F.lower("types"), F.lit("shakemap")), "no_catalog_shakemap_reference"),
        F.when(F.col("detail").isNull(), "missing_event_detail_url"),
        F.when(F.col("content").isNull() | ~F.lower("content").endswith("grid.xml"), "no_supported_grid_xml"),
        F.when(F.col("url").isNull(), "grid_missing_url"),
    )
    return both.withColumn("gate", F.coalesce(*gates))


def shaken_cells(fx: Fixtures, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shake, fine cells): the shaking of the events whose grids would be read, and the
    population cells that have a label, on its grid."""
    read = catalog.where("gate is null").select("event_id")
    shake = fx.shake_cells.join(read, "event_id", "left_semi").select("event_id", (F.col("hcell_id") % 10).alias("gx"), F.floor(F.col("hcell_id") / 10).alias("gy"), "mmi")
    fine = shaking.fine_cells(fx.population_cells.join(fx.admin_cells.select("cell_id", "iso3"), "cell_id").select("cell_id", "iso3", ((F.col("col_no") + 0.5) / 5 - 0.5).alias("fx"), ((F.col("row_no") + 0.5) / 3 - 0.5).alias("fy")))
    return files.stored(shake), files.stored(fine)


def counted_quakes(shake: DataFrame, fine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quads, counts): the quads around values that reach the primary threshold, and the
    events (event_id, iso3) that reach it in a country."""
    quads = files.stored(shaking.event_quads(shake, fine, shaking.reaching(shake, QUAKE_AT[0])))
    return quads, shaking.counted_events(quads, fine, QUAKE_AT[0])


def quake_cells(fx: Fixtures) -> DataFrame:
    """(cell_id, mmi): the maximum over the events that reach the primary threshold in the
    cell's country; others don't count at any threshold."""
    shake, fine = shaken_cells(fx, gated_catalog(fx))
    strong, found = counted_quakes(shake, fine)
    counts = files.stored(found)
    seeds = shaking.exceeding(shake.join(counts.select("event_id").distinct(), "event_id", "left_semi"), strong.join(counts, ["event_id", "iso3"], "left_semi"), fine)
    quads = shaking.event_quads(shake, fine, seeds).join(counts, ["event_id", "iso3"], "left_semi")
    return shaking.greatest_by_cell(files.stored(quads), fine)


# All hazards over one population


def hazard_cells(fx: Fixtures, hazards: tuple[str, ...]) -> tuple[DataFrame, dict[tuple[str, str], Column]]:
    """Population cells with one number for each hazard, reduced on its own grid first, and
    the condition of each band (hazard, threshold) on them."""
    cells = fx.population_cells
    bands: dict[tuple[str, str], Column] = {}
    if "drought" in hazards:
        cells = align.align_nearest(cells, drought_floor(fx), 3, 5, 10, key="drought_id")
        bands |= {("drought", str(t)): F.col("spei") <= t for t in DROUGHT_AT}
    if "heat" in hazards:
        floor = temporal.run_floor(fx.hazard_daily, "hcell_id", "day", "value", 3).select(F.col("hcell_id").alias("heat_id"), F.col("floor").alias("utci"))
        limits = F.broadcast(baseline(fx).select("iso3", "p95"))
        cells = align.align_nearest(cells, floor, 2, 5, 10, key="heat_id").join(fx.admin_cells.select("cell_id", "iso3"), "cell_id", "left").join(limits, "iso3", "left")
        bands |= {("heat", str(t)): F.col("utci") > t for t in HEAT_AT} | {("heat", "p95"): F.col("utci") > F.col("p95")}
    if "flood" in hazards:
        days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix").withColumnRenamed("hcell_id", "flood_id")
        cells = align.align_nearest(cells, days, 2, 5, 10, key="flood_id")
        bands |= {("flood", str(FLOOD_AT)): F.col("flood_days") > FLOOD_AT}
    if "earthquake" in hazards:
        cells = cells.join(quake_cells(fx), "cell_id", "left")
        bands |= {("earthquake", str(t)): F.col("mmi") >= t for t in QUAKE_AT}
    return cells, bands


def label_bands(fx: Fixtures, hazards: tuple[str, ...]) -> DataFrame:
    """admin_id, hazard, threshold, pop_total, pop_affected, pct_affected of the hazards that
    labels of cells sum up: all meet one aligned population, and one pass sums every band."""
    cells, bands = hazard_cells(fx, hazards)
    return zonal.exposure_bands(cells, fx.admin_cells, fx.admin_units, bands)


def polygon_bands(fx: Fixtures, found: DataFrame | None = None) -> DataFrame:
    """The same for the hazards that polygons of units sum up; overlaps count twice."""
    counts = event_discs(fx).groupBy("row_no", "col_no").agg(F.count("*").alias("events"))
    cells = grid.fill(fx.admin_points).join(fx.population_cells, ["row_no", "col_no"]).join(cell_bands(footprints(fx) if found is None else found), ["row_no", "col_no"], "left").join(counts, ["row_no", "col_no"], "left")
    bands = {**{("cyclone", str(t)): F.col(f"b{t}") for t in S.KMH_TO_KNOTS}, ("violence", "1"): F.col("events") >= 1}
    labelled = cells.select(F.monotonically_increasing_id().alias("cell_id"), "admin_id", "pop", *[f"b{t}" for t in S.KMH_TO_KNOTS], "events")
    return zonal.exposure_bands_of(labelled, fx.admin_units, bands)


@query("drought_exposure", DROUGHT)
def _(fx: Fixtures) -> DataFrame:
    return label_bands(fx, ("drought",))


@query("heat_exposure", HEAT)
def _(fx: Fixtures) -> DataFrame:
    return label_bands(fx, ("heat",))


FLOOD_DETAIL = f"""SELECT e.*, round(mean_days, 6) AS mean_days, max_days, person_days, round(CASE WHEN pop_total > 0 THEN person_days / pop_total END, 6) AS popwtd_days FROM ({FLOOD_ANY}) e LEFT JOIN
 (SELECT admin_id, avg(coalesce(CAST(flood_days AS DOUBLE), 0)) AS mean_days, max(coalesce(flood_days, 0)) AS max_days, coalesce({dec('pop * coalesce(flood_days, 0)')}, 0) AS person_days FROM population_cells JOIN admin_cells USING (cell_id) LEFT JOIN ({FLOOD_DAYS}) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5) GROUP BY admin_id) d USING (admin_id)"""


def flood_detail(fx: Fixtures) -> DataFrame:
    """Flooded on more days than the default threshold, with mean, greatest and weighted days;
    cells that were never seen have none."""
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    cells = align.align_nearest(fx.population_cells, days, 2, 5, 10).join(fx.admin_cells.select("cell_id", "admin_id"), "cell_id")
    d = F.coalesce("flood_days", F.lit(0))
    hit = F.when(F.col("pop").isNotNull(), F.when(d > FLOOD_AT, F.col("pop")).otherwise(0.0))
    sums = cells.groupBy("admin_id").agg(S.dsum(F.col("pop")).alias("t"), S.dsum(hit).alias("a"), F.round(F.avg(d), 6).alias("mean_days"), F.max(d).alias("max_days"), F.coalesce(S.dsum(F.col("pop") * d), F.lit(0.0)).alias("person_days"))
    every = fx.admin_units.select("admin_id").join(sums, "admin_id", "left")
    total = F.coalesce("t", F.lit(0.0))
    return every.select("admin_id", total.alias("pop_total"), F.coalesce("a", F.lit(0.0)).alias("pop_affected"), S.pct(F.col("a"), F.col("t")).alias("pct_affected"), "mean_days", "max_days", "person_days", F.when(total > 0, F.round(F.col("person_days") / total, 6)).alias("popwtd_days"))


@query("flood_exposure", FLOOD_DETAIL)
def _(fx: Fixtures) -> DataFrame:
    return flood_detail(fx)


DEPRIVED = f"SELECT e.*, national_pct, coalesce(pct_affected > national_pct, false) AS deprived FROM ({QUAKE}) e JOIN admin_units USING (admin_id) JOIN (SELECT iso3, threshold, CASE WHEN sum(pop_total) > 0 THEN round(100 * {dec('pop_affected')} / {dec('pop_total')}, 6) END AS national_pct FROM ({QUAKE}) JOIN admin_units USING (admin_id) GROUP BY iso3, threshold) n USING (iso3, threshold)"


@query("earthquake_exposure", f"SELECT admin_id, hazard, threshold, pop_total, pop_affected, pct_affected, national_pct, deprived FROM ({DEPRIVED})")
def _(fx: Fixtures) -> DataFrame:
    named = label_bands(fx, ("earthquake",)).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    return zonal.above_national(named, ("iso3", "threshold")).select("admin_id", "hazard", "threshold", "pop_total", "pop_affected", "pct_affected", "national_pct", "deprived")


VIOLENCE = f"""SELECT u.admin_id, coalesce(t, 0) AS pop_total, coalesce(a, 0) AS pop_affected, coalesce(w, 0) AS weighted, CASE WHEN t > 0 THEN round(100 * a / t, 6) END AS pct_affected FROM admin_units u LEFT JOIN
 (SELECT admin_id, {dec('pop')} AS t, {dec('CASE WHEN pop IS NOT NULL THEN CASE WHEN n >= 1 THEN pop ELSE 0 END END')} AS a, {dec('pop * coalesce(n, 0)')} AS w FROM ({FILL}) f JOIN population_cells USING (row_no, col_no) LEFT JOIN (SELECT row_no, col_no, count(*) AS n FROM ({DISCS}) GROUP BY row_no, col_no) d USING (row_no, col_no) GROUP BY admin_id) x USING (admin_id)"""


@query("violence_exposure", VIOLENCE)
def _(fx: Fixtures) -> DataFrame:
    counts = event_discs(fx).groupBy("row_no", "col_no").agg(F.count("*").alias("weight"))
    cells = grid.fill(fx.admin_points).join(fx.population_cells, ["row_no", "col_no"]).join(counts, ["row_no", "col_no"], "left")
    hit = F.when(F.col("pop").isNotNull(), F.when(F.col("weight") >= 1, F.col("pop")).otherwise(0.0))
    out = cells.groupBy("admin_id").agg(S.dsum(F.col("pop")).alias("pop_total"), S.dsum(hit).alias("pop_affected"), S.dsum(F.col("pop") * F.coalesce("weight", F.lit(0))).alias("weighted"))
    out = fx.admin_units.select("admin_id").join(out, "admin_id", "left").na.fill(0.0, ["pop_total", "pop_affected", "weighted"])
    return out.withColumn("pct_affected", S.pct(F.col("pop_affected"), F.col("pop_total")))


CYCLONE_BANDS = " UNION ALL ".join(f"SELECT admin_id, 'cyclone' AS hazard, '{t}' AS threshold, pop_total, coalesce({dec_free}, 0) AS pop_affected, pct_affected_{t} AS pct_affected FROM ({{q}})" for t, dec_free in ((t, f"a{t}") for t in S.KMH_TO_KNOTS))
CYCLONE_SUMS = CYCLONE.replace("SELECT u.admin_id,", "SELECT u.admin_id, a63, a93, a119,", 1)
ALL_BANDS = f"{DROUGHT} UNION ALL {HEAT} UNION ALL {bands_sql('flood', {str(FLOOD_AT): FLOOD_ANY})} UNION ALL {QUAKE} UNION ALL {CYCLONE_BANDS.format(q=CYCLONE_SUMS)} UNION ALL {bands_sql('violence', {'1': VIOLENCE})}"
RULES = {h: r for h, _, r in contract.METHODS}
RULE_CASE = "CASE hazard " + " ".join(f"WHEN '{h}' THEN '{r}'" for h, r in RULES.items()) + " END"
CONTRACT_SQL = "SELECT concat_ws('_', iso3, '2000-08-02', '2001-08-01', hazard) AS run_id, hazard, iso3, DATE '2000-08-02' AS period_start, DATE '2001-08-01' AS period_end, admin_level, admin_id, pcode, pop_total, pop_affected, pct_affected, {rule} AS rule{more} FROM ({q}) JOIN admin_units USING (admin_id)"
ALL_SQL = CONTRACT_SQL.format(rule=RULE_CASE, more=", threshold", q=ALL_BANDS)
FLOOD_SUMMARY = CONTRACT_SQL.format(rule=RULE_CASE, more="", q=f"SELECT *, 'flood' AS hazard FROM ({FLOOD})")


def all_bands(fx: Fixtures, found: DataFrame | None = None) -> DataFrame:
    """Units of six hazards and all their thresholds, from two passes: one over labelled
    cells, one over cells in polygons. ``found`` are footprints that are there already."""
    return label_bands(fx, ("drought", "heat", "flood", "earthquake")).unionByName(polygon_bands(fx, found))


def all_hazards(fx: Fixtures) -> DataFrame:
    """The contract table of the same."""
    return contract.standardize_bands(all_bands(fx).join(F.broadcast(fx.admin_units), "admin_id"), "2000-08-02", "2001-08-01")


def contract_units(fx: Fixtures, units: DataFrame, hazard: str) -> DataFrame:
    named = units.join(F.broadcast(fx.admin_units), "admin_id")
    return contract.standardize(named.select("iso3", "admin_level", "admin_id", "pcode", "pop_total", "pop_affected", "pct_affected"), hazard, "2000-08-02", "2001-08-01")


@query("adm_contract_projection", FLOOD_SUMMARY)
def _(fx: Fixtures) -> DataFrame:
    return contract_units(fx, flood_units(fx), "flood")


@query("all_hazards_summary", ALL_SQL)
def _(fx: Fixtures) -> DataFrame:
    return all_hazards(fx)


UNITED = f"SELECT 'flood' AS hazard, NULL AS threshold, admin_id, pop_total, pop_affected, max_days, person_days, NULL AS storm_count FROM ({FLOOD_DETAIL}) UNION ALL SELECT 'cyclone', NULL, admin_id, pop_total, pop_affected, NULL, NULL, storm_count FROM ({CYCLONE}) UNION ALL SELECT hazard, threshold, admin_id, pop_total, pop_affected, NULL, NULL, NULL FROM ({ALL_BANDS})"


@query("union_hazard_summaries", f"SELECT hazard, threshold, iso3, count(*) AS units, {dec('pop_total')} AS pop_total, {dec('pop_affected')} AS pop_affected, max(max_days) AS max_days, {dec('person_days')} AS person_days, CAST(sum(storm_count) AS BIGINT) AS storm_count FROM ({UNITED}) JOIN admin_units USING (admin_id) GROUP BY hazard, threshold, iso3")
def _(fx: Fixtures) -> DataFrame:
    """The union of the tables of six hazards and all their thresholds with the flood and
    cyclone tables, whose extra columns differ and which have no threshold, summed by
    country: what a table doesn't have is null."""
    found = files.stored(footprints(fx))
    flood, cyclone = flood_detail(fx).withColumn("hazard", F.lit("flood")), cyclone_table(fx, found).withColumn("hazard", F.lit("cyclone"))
    bands = all_bands(fx, found)
    every = flood.unionByName(cyclone, allowMissingColumns=True).unionByName(bands, allowMissingColumns=True)
    named = every.join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    return named.groupBy("hazard", "threshold", "iso3").agg(F.count("*").alias("units"), S.dsum(F.col("pop_total")).alias("pop_total"), S.dsum(F.col("pop_affected")).alias("pop_affected"), F.max("max_days").alias("max_days"), S.dsum(F.col("person_days")).alias("person_days"), F.sum("storm_count").alias("storm_count"))


@query("hazard_method_registry", f"SELECT hazard, CASE hazard " + " ".join(f"WHEN '{h}' THEN '{p}'" for h, p, _ in contract.METHODS) + f" END AS pipeline_id, rule, count(*) AS units FROM ({ALL_SQL}) GROUP BY hazard, rule")
def _(fx: Fixtures) -> DataFrame:
    """Each hazard's pipeline and rule with the rows that its table has: one for each unit and
    reported band."""
    bands = {"drought": len(DROUGHT_AT), "heat": len(HEAT_AT) + 1, "flood": 1, "earthquake": len(QUAKE_AT), "cyclone": len(S.KMH_TO_KNOTS), "violence": 1}
    m = contract.methods(fx.spark).join(fx.spark.createDataFrame(list(bands.items()), "hazard string, bands int"), "hazard")
    return fx.admin_units.join(F.broadcast(m), F.lit(True)).groupBy("hazard", "pipeline_id", "rule").agg(F.sum("bands").cast("long").alias("units"))


@query("sink_admin_summary", f"SELECT run_id, hazard, iso3, admin_id, pop_total, pop_affected, pct_affected FROM ({FLOOD_SUMMARY})")
def _(fx: Fixtures) -> DataFrame:
    """The contract table written as text files of six decimals, by hazard and country, and
    read again."""
    table = contract_units(fx, flood_units(fx), "flood")
    return files.read_summary_csv(fx.spark, files.write_summary_csv(table)).select("run_id", "hazard", "iso3", "admin_id", "pop_total", "pop_affected", "pct_affected")


IN_COUNTRY = f"SELECT event_id, max(mmi) AS max_mmi FROM ({SHAKEN}) GROUP BY event_id"
REASONS = f"SELECT c.*, max_mmi, coalesce(gate, CASE WHEN max_mmi IS NULL THEN 'shakemap_does_not_intersect_country' WHEN max_mmi < {QUAKE_AT[0]} THEN 'no_primary_threshold_shaking_in_country' END) AS reason FROM ({CATALOG}) c LEFT JOIN ({IN_COUNTRY}) m USING (event_id)"


def exclusion_reasons(fx: Fixtures) -> DataFrame:
    """The first failing gate of each event, in order: eight of them."""
    catalog = files.stored(gated_catalog(fx))
    most = shaking.most_by_event(*shaken_cells(fx, catalog))
    late = F.when(F.col("max_mmi").isNull(), "shakemap_does_not_intersect_country").when(F.col("max_mmi") < QUAKE_AT[0], "no_primary_threshold_shaking_in_country")
    return catalog.join(most, "event_id", "left").withColumn("reason", F.coalesce("gate", late))


@query("event_exclusion_reason", f"SELECT event_id, reason, max_mmi FROM ({REASONS})")
def _(fx: Fixtures) -> DataFrame:
    return exclusion_reasons(fx).select("event_id", "reason", "max_mmi")


@query("event_register", f"SELECT event_id, reason, CASE WHEN reason IS NULL THEN 'included' ELSE 'excluded' END AS status, max_mmi, CASE WHEN reason IS NULL THEN content END AS product_content, CASE WHEN reason IS NULL THEN url END AS product_url, CASE WHEN reason IS NULL THEN product_status END AS product_status, CASE WHEN reason IS NULL THEN update_time END AS product_update_time FROM ({REASONS})")
def _(fx: Fixtures) -> DataFrame:
    """Every catalogue event with status and reason; product fields of included ones."""
    kept = F.col("reason").isNull()
    product = {"product_content": "content", "product_url": "url", "product_status": "product_status", "product_update_time": "update_time"}
    r = exclusion_reasons(fx)
    return r.select("event_id", "reason", F.when(kept, "included").otherwise("excluded").alias("status"), "max_mmi", *[F.when(kept, F.col(c)).alias(n) for n, c in product.items()])


@query("quality_flags", f"SELECT iso3, bool_or(t = 0) AS zero_population, bool_or(p IS NULL) AS pct_missing, bool_or(a > 0) AS any_exposed, CASE WHEN bool_or(t = 0) THEN 'zero_population' WHEN NOT bool_or(a > 0) THEN 'no_exposure' ELSE 'ok' END AS flag FROM ({UNIT_PCT}) GROUP BY iso3")
def _(fx: Fixtures) -> DataFrame:
    u = flood_units(fx).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    zero, some = F.bool_or(F.col("pop_total") == 0), F.bool_or(F.col("pop_affected") > 0)
    return u.groupBy("iso3").agg(zero.alias("zero_population"), F.bool_or(F.col("pct_affected").isNull()).alias("pct_missing"), some.alias("any_exposed"), F.when(zero, "zero_population").when(~some, "no_exposure").otherwise("ok").alias("flag"))


# Quality and parity

FLOOD_T = "SELECT * FROM (" + FLOOD + ")"


@query("check_non_negative", f"SELECT count(*) FILTER (WHERE pop_affected < -1e-6) AS violations, count(*) FILTER (WHERE pop_affected < -1e-6) = 0 AS passed FROM ({FLOOD_T})")
def _(fx: Fixtures) -> DataFrame:
    n = F.count_if(F.col("pop_affected") < -1e-6)
    return flood_units(fx).agg(n.alias("violations"), (n == 0).alias("passed"))


@query("check_pct_bounds", f"SELECT count(*) FILTER (WHERE NOT coalesce(pct_affected BETWEEN -1e-6 AND 100.0001, false)) AS violations FROM ({FLOOD_T})")
def _(fx: Fixtures) -> DataFrame:
    return flood_units(fx).agg(F.count_if(~F.coalesce(F.col("pct_affected").between(-1e-6, 100.0001), F.lit(False))).alias("violations"))


TIERS = "CASE WHEN abs(a - b) <= greatest(1e-9 * greatest(abs(a), abs(b)), 1e-6) THEN 'PASS' WHEN abs(a - b) <= 0.05 * abs(b) THEN 'WARN' ELSE 'FAIL' END"


def tiers(a, b):  # noqa: ANN001, ANN201
    """PASS within tolerance, WARN within 5 %, else FAIL."""
    return F.when(S.close_enough(a, b, 1e-6, 1e-9), "PASS").when(F.abs(a - b) <= 0.05 * F.abs(b), "WARN").otherwise("FAIL")


@query("check_table_vs_total", f"SELECT a AS table_sum, b AS recorded, {TIERS} AS status FROM (SELECT {dec('pop_total')} AS a FROM ({FLOOD_T})), (SELECT {dec('pop')} AS b FROM population_cells)")
def _(fx: Fixtures) -> DataFrame:
    t = flood_units(fx).agg(S.dsum(F.col("pop_total")).alias("table_sum"))
    r = fx.population_cells.agg(S.dsum(F.col("pop")).alias("recorded"))
    return t.join(r, F.lit(True)).withColumn("status", tiers(F.col("table_sum"), F.col("recorded")))


@query("check_monotonic", f"SELECT count(*) FILTER (WHERE loose < strict) AS violations FROM (SELECT admin_id, a.pop_affected AS loose, b.pop_affected AS strict FROM ({exposure_sql(FLOOD_DAYS, 2, 'h.flood_days > 10')}) a JOIN ({FLOOD}) b USING (admin_id))")
def _(fx: Fixtures) -> DataFrame:
    """One pass with a conditional sum for each threshold, then neighbours compared."""
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    cells = align.align_nearest(fx.population_cells, days, 2, 5, 10)
    at = lambda t: F.when(F.col("flood_days") > t, F.col("pop")).otherwise(F.when(F.col("pop").isNotNull(), 0.0))
    sums = zonal.labelled_sum(cells, fx.admin_cells, fx.admin_units, {"t10": at(10), "t20": at(20)})
    return sums.agg(F.count_if(F.col("t10") < F.col("t20")).alias("violations"))


@query("check_cells_vs_total", f"SELECT round(a, 4) AS cells, round(b, 4) AS units, {TIERS} AS status FROM (SELECT {dec('CASE WHEN h.flood_days > 20 THEN pop END')} AS a FROM population_cells LEFT JOIN ({FLOOD_DAYS}) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5)), (SELECT {dec('pop_affected')} AS b FROM ({FLOOD_T}))")
def _(fx: Fixtures) -> DataFrame:
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    a = align.align_nearest(fx.population_cells, days, 2, 5, 10).agg(S.dsum(F.when(F.col("flood_days") > 20, F.col("pop"))).alias("a"))
    b = flood_units(fx).agg(S.dsum(F.col("pop_affected")).alias("b"))
    return a.join(b, F.lit(True)).select(F.round("a", 4).alias("cells"), F.round("b", 4).alias("units"), tiers(F.col("a"), F.col("b")).alias("status"))


@query("check_weighted_mean", f"SELECT round(a, 6) AS table_mean, round(b, 6) AS cell_mean, CASE WHEN abs(a - b) <= 1e-3 THEN 'PASS' WHEN abs(a - b) <= 0.05 * abs(b) THEN 'WARN' ELSE 'FAIL' END AS status FROM (SELECT {dec('pop_affected')} / {dec('pop_total')} AS a FROM ({FLOOD_T})), (SELECT {dec('CASE WHEN h.flood_days > 20 THEN pop ELSE 0 END')} / {dec('pop')} AS b FROM population_cells LEFT JOIN ({FLOOD_DAYS}) h ON h.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5))")
def _(fx: Fixtures) -> DataFrame:
    days = temporal.flood_days(fx.flood_obs, "hcell_id", "acq_ts", "pix")
    b = align.align_nearest(fx.population_cells, days, 2, 5, 10).agg((S.dsum(F.when(F.col("flood_days") > 20, F.col("pop")).otherwise(0.0)) / S.dsum(F.col("pop"))).alias("b"))
    a = flood_units(fx).agg((S.dsum(F.col("pop_affected")) / S.dsum(F.col("pop_total"))).alias("a"))
    gap = F.abs(F.col("a") - F.col("b"))
    return a.join(b, F.lit(True)).select(F.round("a", 6).alias("table_mean"), F.round("b", 6).alias("cell_mean"), F.when(gap <= 1e-3, "PASS").when(gap <= 0.05 * F.abs("b"), "WARN").otherwise("FAIL").alias("status"))


CHECKS = f"SELECT iso3, 'non_negative' AS name, bool_and(a >= 0) AS ok, 'FAIL' AS level FROM ({UNIT_PCT}) GROUP BY iso3 UNION ALL SELECT iso3, 'pct_present', bool_and(p IS NOT NULL), 'FAIL' FROM ({UNIT_PCT}) GROUP BY iso3 UNION ALL SELECT iso3, 'exposed', bool_and(a > 0), 'WARN' FROM ({UNIT_PCT}) GROUP BY iso3"


def run_checks(fx: Fixtures) -> DataFrame:
    u = flood_units(fx).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    wide = u.groupBy("iso3").agg(F.bool_and(F.col("pop_affected") >= 0).alias("non_negative"), F.bool_and(F.col("pct_affected").isNotNull()).alias("pct_present"), F.bool_and(F.col("pop_affected") > 0).alias("exposed"))
    return wide.unpivot("iso3", ["non_negative", "pct_present", "exposed"], "name", "ok").withColumn("level", F.when(F.col("name") == "exposed", "WARN").otherwise("FAIL"))


RUNS = f"SELECT m.file_order, concat(p.iso3, '_', CAST(p.as_of AS VARCHAR), '_m', CAST(p.lookback AS VARCHAR), '_flood') AS run_id, concat(upper(m.iso3_text), '_', m.as_of_text, '_m', m.lookback_text, '_flood') AS run_dir FROM manifest m JOIN ({PARSED}) p USING (file_order) WHERE p.iso3 IS NOT NULL AND p.as_of IS NOT NULL AND p.lookback IS NOT NULL"
RUN_LAYERS = "SELECT o_custkey AS file_order, 100 * max(greatest(0, least(east, 31.5e0) - greatest(west, 31e0)) * greatest(0, least(north, 19.5e0) - greatest(south, 19e0))) / 0.25e0 AS flood_pct FROM stac_items JOIN orders ON o_orderkey = item_id WHERE href IS NOT NULL GROUP BY o_custkey"
RUN_FACTS = f"SELECT r.file_order, r.run_id, r.run_dir, 100 * valid / cells AS pop_pct, coalesce(flood_pct, 0) AS flood_pct, coalesce(missing, 3) AS missing FROM ({RUNS}) r JOIN (SELECT admin_id, CAST(count(pop) AS DOUBLE) AS valid, count(*) AS cells FROM population_cells JOIN admin_cells USING (cell_id) GROUP BY admin_id) w ON w.admin_id = (SELECT c_nationkey + 1 FROM customer WHERE c_custkey = r.file_order) LEFT JOIN ({RUN_LAYERS}) l ON l.file_order = r.file_order LEFT JOIN (SELECT o_custkey AS file_order, greatest(0, 3 - count(DISTINCT o_orderpriority)) AS missing FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) a ON a.file_order = r.file_order"


@query("check_run_id", f"SELECT file_order, name, status FROM (SELECT file_order, unnest(['run_id_matches_dir', 'preflight_population_threshold', 'preflight_flood_threshold', 'metadata_artifacts_exist']) AS name, unnest([CASE WHEN run_id = run_dir THEN 'PASS' ELSE 'FAIL' END, CASE WHEN pop_pct >= 98 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN flood_pct >= 99.999 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN missing = 0 THEN 'PASS' ELSE 'WARN' END]) AS status FROM ({RUN_FACTS}))")
def _(fx: Fixtures) -> DataFrame:
    """Every run of the manifest: its id against its folder's name, population and layer
    coverage against their thresholds, listed artifacts (three kinds) against the inventory."""
    m = parsed_manifest(fx).where("iso3 is not null and as_of is not null and lookback is not null").join(fx.manifest.select("file_order", "iso3_text", "as_of_text", "lookback_text"), "file_order")
    name = lambda iso, day, n: F.concat(iso, F.lit("_"), day.cast("string"), F.lit("_m"), n.cast("string"), F.lit("_flood"))
    ids = m.select("file_order", name(F.col("iso3"), F.col("as_of"), F.col("lookback")).alias("run_id"), name(F.upper("iso3_text"), F.col("as_of_text"), F.col("lookback_text")).alias("run_dir"))
    share = fx.population_cells.join(fx.admin_cells, "cell_id").groupBy("admin_id").agg((100 * F.count("pop") / F.count("*")).alias("pop_pct"))
    unit = fx.table("customer").select(F.col("c_custkey").alias("file_order"), (F.col("c_nationkey") + 1).cast("long").alias("admin_id"))
    items = fx.stac_items.where("href is not null").join(fx.table("orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("file_order")), "item_id")
    layers = items.groupBy("file_order").agg(F.max(grid.bbox_coverage(tuple(map(F.lit, (31.0, 19.0, 31.5, 19.5))), tuple(F.col(c) for c in ("west", "south", "east", "north")))).alias("flood_pct"))
    made = fx.table("orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("file_order")).agg(F.count_distinct("o_orderpriority").alias("made"))
    facts = ids.join(unit, "file_order").join(F.broadcast(share), "admin_id").join(layers, "file_order", "left").join(made, "file_order", "left")
    verdict = lambda name, ok, bad: F.struct(F.lit(name).alias("name"), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(bad).alias("status"))
    checks = F.array(verdict("run_id_matches_dir", F.col("run_id") == F.col("run_dir"), "FAIL"), verdict("preflight_population_threshold", F.col("pop_pct") >= 98, "FAIL"), verdict("preflight_flood_threshold", F.col("flood_pct") >= 99.999, "FAIL"), verdict("metadata_artifacts_exist", F.col("made") >= 3, "WARN"))
    return facts.select("file_order", F.explode(checks).alias("c")).select("file_order", "c.*")


@query("check_rollup_status", f"SELECT iso3, count(*) FILTER (WHERE NOT ok AND level = 'FAIL') AS failures, count(*) FILTER (WHERE NOT ok AND level = 'WARN') AS warnings, CASE WHEN count(*) FILTER (WHERE NOT ok AND level = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (WHERE NOT ok) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM ({CHECKS}) GROUP BY iso3")
def _(fx: Fixtures) -> DataFrame:
    bad = ~F.col("ok")
    f, w = F.count_if(bad & (F.col("level") == "FAIL")), F.count_if(bad & (F.col("level") == "WARN"))
    return run_checks(fx).groupBy("iso3").agg(f.alias("failures"), w.alias("warnings"), F.when(f > 0, "FAIL").when(w > 0, "WARN").otherwise("PASS").alias("status"))


@query("admin_row_flags", f"SELECT admin_id, pop_total = 0 AS zero, pct_affected IS NULL AS missing, coalesce(pct_affected > 100, false) AS above, pop_affected > pop_total AS exceeds, pop_total = 0 OR pct_affected IS NULL OR coalesce(pct_affected > 100, false) OR pop_affected > pop_total AS any_flag FROM ({FLOOD_T})")
def _(fx: Fixtures) -> DataFrame:
    flags = {"zero": F.col("pop_total") == 0, "missing": F.col("pct_affected").isNull(), "above": F.coalesce(F.col("pct_affected") > 100, F.lit(False)), "exceeds": F.col("pop_affected") > F.col("pop_total")}
    u = flood_units(fx).withColumns(flags)
    return u.select("admin_id", *flags, F.exists(F.array(*flags), lambda x: x).alias("any_flag"))


@query("qc_summary_row", f"SELECT count(*) AS units, {dec('pop_total')} AS total, {dec('pop_affected')} AS affected, round(min(pct_affected), 6) AS min_pct, round(max(pct_affected), 6) AS max_pct FROM ({FLOOD_T})")
def _(fx: Fixtures) -> DataFrame:
    return flood_units(fx).agg(F.count("*").alias("units"), S.dsum(F.col("pop_total")).alias("total"), S.dsum(F.col("pop_affected")).alias("affected"), F.round(F.min("pct_affected"), 6).alias("min_pct"), F.round(F.max("pct_affected"), 6).alias("max_pct"))


UNIT_BOXES = "SELECT admin_id, 30 + min(x) * 0.1e0 AS tw, 30 + max(x) * 0.1e0 AS te, 20 - max(y) * 0.1e0 AS ts, 20 - min(y) * 0.1e0 AS tn FROM admin_points GROUP BY admin_id"
LAYER = "SELECT o_custkey AS layer, max(west) AS w, max(south) AS s, min(east) AS e, min(north) AS n FROM stac_items JOIN orders ON o_orderkey = item_id WHERE href IS NOT NULL GROUP BY o_custkey"
LAYER_AUDIT = f"SELECT c_custkey AS layer, iso3, CASE WHEN l.layer IS NULL THEN 'missing_file' WHEN w >= e OR s >= n THEN 'error: no bounds' ELSE 'ok' END AS status, CASE WHEN w < e AND s < n THEN round(100 * greatest(0, least(e, te) - greatest(w, tw)) * greatest(0, least(n, tn) - greatest(s, ts)) / ((te - tw) * (tn - ts)), 3) ELSE 0 END AS pct FROM customer JOIN admin_units u ON u.admin_id = c_nationkey + 1 JOIN ({UNIT_BOXES}) b ON b.admin_id = u.admin_id LEFT JOIN ({LAYER}) l ON l.layer = c_custkey"


def unit_boxes(fx: Fixtures) -> DataFrame:
    """Box of each unit in degrees: admin_id, tw, ts, te, tn."""
    return fx.admin_points.groupBy("admin_id").agg((30 + F.min("x") * 0.1).alias("tw"), (20 - F.max("y") * 0.1).alias("ts"), (30 + F.max("x") * 0.1).alias("te"), (20 - F.min("y") * 0.1).alias("tn"))


def items_of(fx: Fixtures) -> DataFrame:
    """Items with an asset, with their layer and source."""
    return fx.stac_items.where("href is not null").join(fx.table("orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("layer"), F.col("o_orderpriority").alias("source")), "item_id")


def layer_audit(fx: Fixtures) -> DataFrame:
    """Each layer's share of the box of its own unit: a layer is what all its items have in
    common, which may be nothing; one without items has no file."""
    boxes = items_of(fx).groupBy("layer").agg(F.max("west").alias("w"), F.max("south").alias("s"), F.min("east").alias("e"), F.min("north").alias("n"))
    units = F.broadcast(unit_boxes(fx).join(fx.admin_units.select("admin_id", "iso3"), "admin_id"))
    every = fx.table("customer").select(F.col("c_custkey").alias("layer"), (F.col("c_nationkey") + 1).cast("long").alias("admin_id")).join(units, "admin_id").join(boxes, "layer", "left")
    bounded = (F.col("w") < F.col("e")) & (F.col("s") < F.col("n"))
    cover = F.round(grid.bbox_coverage(tuple(F.col(c) for c in ("tw", "ts", "te", "tn")), tuple(F.col(c) for c in "wsen")), 3)
    status = F.when(F.col("w").isNull(), "missing_file").when(~bounded, "error: no bounds").otherwise("ok")
    return every.select("layer", "iso3", status.alias("status"), F.coalesce(F.when(bounded, cover), F.lit(0.0)).alias("pct"))


@query("layer_coverage_audit", f"SELECT *, pct >= 99.999 AS complete FROM ({LAYER_AUDIT})")
def _(fx: Fixtures) -> DataFrame:
    return layer_audit(fx).withColumn("complete", F.col("pct") >= 99.999)


COUNTRY_BOXES = f"SELECT iso3, min(tw) AS tw, min(ts) AS ts, max(te) AS te, max(tn) AS tn FROM ({UNIT_BOXES}) JOIN admin_units USING (admin_id) GROUP BY iso3"


@query("hazard_coverage_by_country", f"SELECT b.iso3, x.source, coalesce(items, 0) AS items, coalesce(best, 0) AS best_pct, CASE WHEN items IS NULL THEN 'missing' WHEN best >= 99.999 THEN 'full' WHEN best > 0 THEN 'partial' ELSE 'none' END AS status FROM ({COUNTRY_BOXES}) b CROSS JOIN (SELECT DISTINCT o_orderpriority AS source FROM orders) x LEFT JOIN (SELECT u.iso3, o_orderpriority AS source, count(*) AS items, max(round(100 * greatest(0, least(east, te) - greatest(west, tw)) * greatest(0, least(north, tn) - greatest(south, ts)) / ((te - tw) * (tn - ts)), 6)) AS best FROM stac_items JOIN orders ON o_orderkey = item_id JOIN customer ON c_custkey = o_custkey JOIN admin_units u ON u.admin_id = c_nationkey + 1 JOIN ({COUNTRY_BOXES}) k ON k.iso3 = u.iso3 WHERE href IS NOT NULL AND o_totalprice > 400000 GROUP BY u.iso3, o_orderpriority) i ON i.iso3 = b.iso3 AND i.source = x.source")
def _(fx: Fixtures) -> DataFrame:
    """A row for each country and source: its items of large orders, and the best share of the
    country's box that one of them covers."""
    boxes = F.broadcast(unit_boxes(fx).join(fx.admin_units.select("admin_id", "iso3"), "admin_id").groupBy("iso3").agg(F.min("tw").alias("tw"), F.min("ts").alias("ts"), F.max("te").alias("te"), F.max("tn").alias("tn")))
    sources = F.broadcast(fx.table("orders").select(F.col("o_orderpriority").alias("source")).distinct())
    country = fx.table("customer").select(F.col("c_custkey").alias("layer"), (F.col("c_nationkey") + 1).cast("long").alias("admin_id")).join(F.broadcast(fx.admin_units.select("admin_id", "iso3")), "admin_id")
    large = fx.table("orders").where("o_totalprice > 400000").select(F.col("o_orderkey").alias("item_id"))
    cover = F.round(grid.bbox_coverage(tuple(F.col(c) for c in ("tw", "ts", "te", "tn")), tuple(F.col(c) for c in ("west", "south", "east", "north"))), 6)
    found = items_of(fx).join(large, "item_id", "left_semi").join(country, "layer").join(boxes, "iso3").groupBy("iso3", "source").agg(F.count("*").alias("items"), F.max(cover).alias("best"))
    every = boxes.select("iso3").join(sources, F.lit(True)).join(found, ["iso3", "source"], "left")
    status = F.when(F.col("items").isNull(), "missing").when(F.col("best") >= 99.999, "full").when(F.col("best") > 0, "partial").otherwise("none")
    return every.select("iso3", "source", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("best", F.lit(0.0)).alias("best_pct"), status.alias("status"))


GRID_A = "SELECT admin_id, min(lon) - 0.05e0 AS w, max(lat) + 0.05e0 AS n, max(col_no) - min(col_no) + 1 AS cols, max(row_no) - min(row_no) + 1 AS rows_ FROM population_cells JOIN admin_cells USING (cell_id) GROUP BY admin_id"
GRID_B = "SELECT admin_id, min(lon) - 0.05e0 AS w, max(lat) + 0.05e0 AS n, max(col_no) - min(col_no) + 1 AS cols, max(row_no) - min(row_no) + 1 AS rows_ FROM population_cells JOIN admin_cells USING (cell_id) WHERE CAST(floor(row_no / 2) * 10 + floor(col_no / 5) AS BIGINT) IN (SELECT hcell_id FROM flood_obs) GROUP BY admin_id"


@query("grid_match", f"SELECT a.admin_id, coalesce(abs(a.w - b.w) <= 1e-9 AND abs(a.n - b.n) <= 1e-9, false) AS same_corner, coalesce(a.cols = b.cols AND a.rows_ = b.rows_, false) AS same_shape FROM ({GRID_A}) a LEFT JOIN ({GRID_B}) b ON a.admin_id = b.admin_id")
def _(fx: Fixtures) -> DataFrame:
    """The grid of each unit's population against the grid of what the flood layer covers."""
    cells = fx.population_cells.join(fx.admin_cells.select("cell_id", "admin_id"), "cell_id")

    def definition(df: DataFrame, tail: str) -> DataFrame:
        return df.groupBy("admin_id").agg((F.min("lon") - 0.05).alias("w" + tail), (F.max("lat") + 0.05).alias("n" + tail), (F.max("col_no") - F.min("col_no") + 1).alias("c" + tail), (F.max("row_no") - F.min("row_no") + 1).alias("r" + tail))

    seen = cells.withColumn("hcell_id", align.hazard_cell(F.col("row_no"), F.col("col_no"), 2, 5, 10)).join(fx.flood_obs.select("hcell_id").distinct(), "hcell_id", "left_semi")
    both = definition(cells, "").join(definition(seen, "2"), "admin_id", "left")
    corner = (F.abs(F.col("w") - F.col("w2")) <= 1e-9) & (F.abs(F.col("n") - F.col("n2")) <= 1e-9)
    return both.select("admin_id", F.coalesce(corner, F.lit(False)).alias("same_corner"), F.coalesce((F.col("c") == F.col("c2")) & (F.col("r") == F.col("r2")), F.lit(False)).alias("same_shape"))


# Every check from one table of rules

#: Bands of the checked hazards from the loosest to the strictest.
LOOSER = {"drought": tuple(str(t) for t in sorted(DROUGHT_AT, reverse=True)), "heat": tuple(str(t) for t in sorted(HEAT_AT)), "flood": (str(FLOOD_AT),)}
CHECKED = f"SELECT concat_ws('_', iso3, hazard) AS run_id, * FROM ({DROUGHT} UNION ALL {HEAT} UNION ALL {bands_sql('flood', {str(FLOOD_AT): FLOOD_ANY})}) JOIN admin_units USING (admin_id)"
COARSE = "SELECT cell_id, admin_id, c.iso3, CASE WHEN pop > 9000 THEN 9000e0 ELSE pop END AS pop, least_spei, flood_days, {heat} FROM population_cells JOIN admin_cells c USING (cell_id) LEFT JOIN (SELECT hcell_id, min(value) AS least_spei FROM hazard_monthly WHERE month_start IN ({months}) GROUP BY hcell_id) d ON d.hcell_id = floor(row_no / 3) * 10 + floor(col_no / 5) LEFT JOIN ({flood}) f ON f.hcell_id = floor(row_no / 2) * 10 + floor(col_no / 5)"
_HEAT_FLAGS = ", ".join(f"floor(row_no / 2) * 10 + floor(col_no / 5) IN ({ISLANDS.format(t=t)}) AS heat_{t}" for t in HEAT_AT) + f", (c.iso3, floor(row_no / 2) * 10 + floor(col_no / 5)) IN (SELECT (iso3, CAST(hcell_id AS DOUBLE)) FROM ({RELATIVE})) AS heat_p95"
_RECORDS = {("drought", str(t)): f"least_spei <= {t}" for t in DROUGHT_AT} | {("heat", str(t)): f"heat_{t}" for t in HEAT_AT} | {("heat", "p95"): "heat_p95", ("flood", str(FLOOD_AT)): f"flood_days > {FLOOD_AT}"}
RECORDED = "WITH k AS MATERIALIZED (" + COARSE.format(heat=_HEAT_FLAGS, months=MONTHS, flood=FLOOD_DAYS) + ") " + " UNION ALL ".join(f"SELECT concat_ws('_', iso3, '{h}') AS run_id, '{h}' AS hazard, '{t}' AS threshold, {dec('pop')} AS recorded_total, {dec(f'CASE WHEN coalesce({c}, false) THEN pop ELSE 0 END')} AS recorded_affected FROM k GROUP BY iso3" for (h, t), c in _RECORDS.items())
_RANK = "CASE " + " ".join(f"WHEN hazard = '{h}' AND threshold = '{t}' THEN {k}" for h, some in LOOSER.items() for k, t in enumerate(some)) + " END"
_SUMS = f"SELECT run_id, hazard, threshold, count(*) FILTER (WHERE pop_affected < -1e-6) AS c1, count(*) FILTER (WHERE NOT coalesce(pct_affected BETWEEN -1e-6 AND 100.0001, false)) AS c2, count(*) FILTER (WHERE pop_affected > pop_total + 1e-6) AS c3, count(*) FILTER (WHERE pop_affected + 1e-6 < stricter) AS c4, count(*) FILTER (WHERE pop_total <= 0) AS c5, {dec('pop_affected')} AS affected, {dec('pop_total')} AS total FROM (SELECT a.*, (SELECT max(b.pop_affected) FROM x b WHERE b.run_id = a.run_id AND b.admin_id = a.admin_id AND b.hazard = a.hazard AND b.rnk = a.rnk + 1) AS stricter FROM x a) GROUP BY run_id, hazard, threshold"
_STATUS = "CASE WHEN {b} IS NULL OR {a} IS NULL THEN 'WARN' WHEN abs({a} - {b}) <= greatest({t}, 1e-9 * greatest(abs({a}), abs({b}))) THEN 'PASS' WHEN abs({a} - {b}) / greatest(abs({b}), 1) <= {w} THEN 'WARN' ELSE 'FAIL' END"
_ABS, _REL = "CASE WHEN hazard IN ('drought', 'heat') THEN 1e-2 ELSE 1.0 END", "CASE WHEN hazard IN ('drought', 'heat') THEN 0.005 ELSE 0.05 END"
_ROWS = [(n, f"CASE WHEN {c} > 0 THEN '{level}' ELSE 'PASS' END", c, "NULL") for n, c, level in (("non_negative", "c1", "FAIL"), ("pct_bounds", "c2", "FAIL"), ("exposed_within_total", "c3", "FAIL"), ("monotonic", "c4", "FAIL"), ("zero_population", "c5", "WARN"))]
_ROWS += [("table_vs_recorded_sum", _STATUS.format(a="affected", b="recorded_affected", t=_ABS, w=_REL), "affected", "recorded_affected"), ("table_vs_recorded_total", _STATUS.format(a="total", b="recorded_total", t=_ABS, w=_REL), "total", "recorded_total"), ("table_vs_recorded_share", _STATUS.format(a="(affected / nullif(total, 0))", b="(recorded_affected / nullif(recorded_total, 0))", t="1e-3", w="0.05"), "affected / nullif(total, 0)", "recorded_affected / nullif(recorded_total, 0)")]
_JOINED = f"x AS MATERIALIZED (SELECT *, {_RANK} AS rnk FROM ({CHECKED})), r AS MATERIALIZED ({RECORDED}), s AS (SELECT * FROM ({_SUMS}) LEFT JOIN r USING (run_id, hazard, threshold))"
CHECK_SQL = f"WITH {_JOINED} " + " UNION ALL ".join(f"SELECT run_id, hazard, threshold, '{n}' AS name, {status} AS status, round(CAST({value} AS DOUBLE), 6) AS value, round(CAST({record} AS DOUBLE), 6) AS recorded FROM s" for n, status, value, record in _ROWS)


def checked_runs(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """(summary, record) of three hazards: a run is a country and hazard. The record was made
    of the cells themselves, of a population raster whose cells hold 9,000 people at most."""
    country = F.broadcast(fx.admin_units.select("admin_id", "iso3"))
    run = F.concat_ws("_", "iso3", "hazard")
    cells, bands = hazard_cells(fx, ("drought", "heat", "flood"))
    cells = files.stored(cells.select("cell_id", "iso3", "pop", "spei", "utci", "p95", "flood_days"))
    summary = zonal.exposure_bands(cells, fx.admin_cells, fx.admin_units, bands).join(country, "admin_id").withColumn("run_id", run)
    capped = cells.drop("iso3").withColumn("pop", F.least("pop", F.when(F.col("pop").isNotNull(), 9000.0))).join(fx.admin_cells.select("cell_id", "iso3"), "cell_id")
    hits = F.array(*[F.struct(F.lit(h).alias("hazard"), F.lit(t).alias("threshold"), F.coalesce(c, F.lit(False)).alias("hit")) for (h, t), c in bands.items()])
    sums = capped.withColumn("b", F.explode(hits)).groupBy("iso3", "b.hazard", "b.threshold").agg(S.dsum(F.col("pop")).alias("recorded_total"), S.dsum(F.when(F.col("b.hit"), F.col("pop")).otherwise(0.0)).alias("recorded_affected"))
    return summary, sums.select(run.alias("run_id"), "hazard", "threshold", "recorded_total", "recorded_affected")


@query("check_every_rule", CHECK_SQL)
def _(fx: Fixtures) -> DataFrame:
    """Each rule of each run, hazard and threshold, with both tiers of tolerance."""
    return checks.check_table(*checked_runs(fx), LOOSER).withColumns({"value": F.round("value", 6), "recorded": F.round("recorded", 6)})


@query("check_run_rollup", f"SELECT run_id, count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failures, count(*) FILTER (WHERE status = 'WARN') AS warnings, CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({CHECK_SQL}) GROUP BY run_id")
def _(fx: Fixtures) -> DataFrame:
    return checks.rolled_up(checks.check_table(*checked_runs(fx), LOOSER))


@query("check_row_flags", f"SELECT *, negative OR zero OR missing OR below OR above OR exceeds AS any_flag FROM (SELECT run_id, hazard, threshold, admin_id, pop_total < 0 OR pop_affected < 0 AS negative, pop_total = 0 AS zero, pct_affected IS NULL AS missing, coalesce(pct_affected < 0, false) AS below, coalesce(pct_affected > 100, false) AS above, pop_affected > pop_total AS exceeds FROM ({CHECKED}))")
def _(fx: Fixtures) -> DataFrame:
    return checks.row_flags(checked_runs(fx)[0])


@query("check_quality_rows", f"WITH {_JOINED} SELECT run_id, hazard, threshold, units, total, affected, min_pct, max_pct, round(affected - recorded_affected, 4) AS diff, round(100 * (affected - recorded_affected) / nullif(recorded_affected, 0), 6) AS diff_pct FROM s JOIN (SELECT run_id, hazard, threshold, count(*) AS units, round(min(pct_affected), 6) AS min_pct, round(max(pct_affected), 6) AS max_pct FROM x GROUP BY ALL) USING (run_id, hazard, threshold)")
def _(fx: Fixtures) -> DataFrame:
    return checks.quality_rows(*checked_runs(fx))


# All flags of the output contract

PASSED = f"SELECT DISTINCT sid, iso3 FROM (SELECT sid, event_id, admin_id FROM (SELECT sid, event_id, (lon - 30) / 0.1e0 AS px, (20 - lat) / 0.1e0 AS py FROM track_points) p JOIN ({EDGES}) e ON (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) GROUP BY sid, event_id, admin_id HAVING count(*) % 2 = 1) JOIN admin_units USING (admin_id)"
STORM_FLAGS = f"SELECT iso3, bool_or(threshold = 63 AND expected AND method = 'none') AS missing, bool_or(threshold = 63 AND method = 'external') AS replaced, bool_or(method = 'external') AS other_method, bool_or(threshold <> 63 AND expected AND method = 'none') AS incomplete, bool_or(provisional) AS provisional FROM ({PASSED}) p JOIN ({METHODS}) m ON m.sid = p.sid JOIN (SELECT sid, {PROVISIONAL} AS provisional FROM track_points GROUP BY sid) v ON v.sid = p.sid GROUP BY iso3"
QUALIFIED = f"SELECT DISTINCT iso3 FROM (SELECT event_id, iso3 FROM ({SHAKEN}) GROUP BY event_id, iso3 HAVING max(mmi) >= {QUAKE_AT[0]})"


@query("quality_flags_by_unit", f"SELECT u.admin_id, CASE WHEN coalesce(missing, false) THEN 'incomplete' WHEN coalesce(replaced, false) THEN 'fallback' ELSE 'complete' END AS flag_windradii, coalesce(provisional, false) AS flag_provisional, coalesce(incomplete, false) AS flag_severity_incomplete, coalesce(other_method, false) AS flag_method_fallback, coalesce(t, 0) <= 0 AS flag_zero_population, q.iso3 IS NULL AS flag_no_qualifying_events FROM admin_units u LEFT JOIN ({STORM_FLAGS}) s ON s.iso3 = u.iso3 LEFT JOIN ({QUALIFIED}) q ON q.iso3 = u.iso3 LEFT JOIN (SELECT admin_id, {dec('pop')} AS t FROM population_cells JOIN admin_cells USING (cell_id) GROUP BY admin_id) p ON p.admin_id = u.admin_id")
def _(fx: Fixtures) -> DataFrame:
    """The six flags of each unit: of the storms that pass through its country, of its whole
    population, and of the events that count there."""
    places = fx.track_points.select(F.struct("sid", "event_id").alias("point_id"), ((F.col("lon") - 30) / 0.1).alias("px"), ((20 - F.col("lat")) / 0.1).alias("py"))
    country = F.broadcast(fx.admin_units.select("admin_id", "iso3"))
    passed = grid.points_in_units(places, fx.admin_points).select(F.col("point_id.sid").alias("sid"), "admin_id").distinct().join(country, "admin_id").select("sid", "iso3").distinct()
    storms = band_methods(fx).join(fx.track_points.groupBy("sid").agg(provisional().alias("provisional")), "sid")
    first, none, other = F.col("threshold") == 63, F.col("expected") & (F.col("method") == "none"), F.col("method") == "external"
    flags = passed.join(storms, "sid").groupBy("iso3").agg(F.bool_or(first & none).alias("missing"), F.bool_or(first & other).alias("replaced"), F.bool_or(other).alias("other_method"), F.bool_or(~first & none).alias("incomplete"), F.bool_or("provisional").alias("provisional"))
    _, counts = counted_quakes(*shaken_cells(fx, gated_catalog(fx)))
    counted = counts.select("iso3").distinct().withColumn("counted", F.lit(True))
    people = zonal.labelled_sum(fx.population_cells, fx.admin_cells, fx.admin_units, {"t": F.col("pop")})
    u = fx.admin_units.select("admin_id", "iso3").join(F.broadcast(flags), "iso3", "left").join(F.broadcast(counted), "iso3", "left").join(people, "admin_id")
    some = lambda c: F.coalesce(c, F.lit(False))
    radii = F.when(some("missing"), "incomplete").when(some("replaced"), "fallback").otherwise("complete")
    return u.select("admin_id", radii.alias("flag_windradii"), some("provisional").alias("flag_provisional"), some("incomplete").alias("flag_severity_incomplete"), some("other_method").alias("flag_method_fallback"), (F.col("t") <= 0).alias("flag_zero_population"), F.col("counted").isNull().alias("flag_no_qualifying_events"))
