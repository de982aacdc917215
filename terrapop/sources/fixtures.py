"""Adapters from the given tables to the domain tables.

Each is one SQL text that Spark and DuckDB read alike, so that a query and its oracle
start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _radii() -> str:
    """Wind radii in nautical miles of three agencies, three speeds and four quadrants.
    ``usa`` lacks some kinds of rows, ``bom`` and ``xyz`` have some of those."""
    has = {("usa", 34): "event_type <> 'error'", ("usa", 50): "event_type NOT IN ('error', 'view')", ("usa", 64): "event_type IN ('click', 'purchase')", ("bom", 34): "event_type IN ('error', 'view')", ("bom", 50): "event_type = 'error'", ("bom", 64): "value > 60", ("xyz", 34): "value > 10", ("xyz", 50): "event_type = 'view' AND value > 90", ("xyz", 64): "event_type = 'purchase'"}
    size = {34: "1", 50: "0.6e0", 64: "0.35e0"}
    base = {"usa": 5, "bom": 4, "xyz": 6}
    return ", ".join(f"CASE WHEN {has[a, kt]} THEN ({base[a] + k} + value / 20) * {size[kt]} END AS {a}_r{kt}_{q}" for a in base for kt in size for k, q in enumerate(("ne", "se", "sw", "nw")))


RADII = _radii()
ADAPTERS = {
    "population_cells": """
        SELECT c_custkey AS cell_id, CAST(floor(c_custkey / 50) AS BIGINT) AS row_no, c_custkey % 50 AS col_no,
               30 + (c_custkey % 50 + 0.5e0) * 0.1e0 AS lon, 20 - (floor(c_custkey / 50) + 0.5e0) * 0.1e0 AS lat,
               CASE WHEN c_custkey % 97 = 0 THEN -9999e0 ELSE c_acctbal END AS pop_raw,
               CASE WHEN c_custkey % 97 <> 0 AND c_acctbal >= 0 THEN c_acctbal END AS pop
        FROM customer""",
    "admin_cells": """
        SELECT c_custkey AS cell_id, CAST(c_nationkey + 1 AS BIGINT) AS admin_id, n_name AS pcode, r_name AS iso3
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "admin_units": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS admin_id, n_name AS pcode, r_name AS iso3, 1 AS admin_level
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "admin_points": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS admin_id, k AS seq,
               CAST((n_nationkey % 5) * 10 + CASE k WHEN 0 THEN 0 WHEN 1 THEN 8 WHEN 2 THEN 10 WHEN 3 THEN 10 ELSE 0 END AS DOUBLE) AS x,
               CAST(floor(n_nationkey / 5) * 6 + CASE k WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 6 ELSE 0 END AS DOUBLE) AS y
        FROM nation CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) AS corners""",
    "hazard_monthly": """
        SELECT l_suppkey AS hcell_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, (avg(l_quantity) - 25.5e0) / 10 AS value
        FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "hazard_daily": """
        SELECT user_id AS hcell_id, CAST(ts AS DATE) AS day, max(value) / 2 AS value
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "flood_obs": """
        SELECT user_id AS hcell_id, ts AS acq_ts, CASE event_type WHEN 'error' THEN 255 WHEN 'view' THEN 0 ELSE 1 END AS pix FROM events""",
    "conflict_events": """
        SELECT event_id, ts AS event_ts, CAST(ts AS DATE) AS event_date,
               CASE event_type WHEN 'click' THEN 'Battles' WHEN 'purchase' THEN 'Explosions/Remote violence'
                    WHEN 'error' THEN 'Violence against civilians' WHEN 'signup' THEN 'Riots' ELSE 'Protests' END AS event_type,
               CAST(floor(value / 100) AS BIGINT) AS fatalities, 30 + ((event_id * 7919) % 5000) / 1000e0 AS longitude, 20 - ((event_id * 104729) % 3000) / 1000e0 AS latitude
        FROM events""",
    "track_points": f"""
        SELECT event_id, user_id AS sid, ts AS iso_time, 30 + (user_id % 50) * 0.1e0 + day(ts) * 0.02e0 AS lon,
               20 - floor(user_id / 50) * 0.1e0 - day(ts) * 0.01e0 AS lat,
               CASE event_type WHEN 'purchase' THEN 'xyz' ELSE 'bom' END AS wmo_agency,
               CASE WHEN event_type = 'view' AND value < 20 THEN 'tcvitals_a' ELSE 'archive' END AS usa_agency,
               value / 3 AS usa_wind, value / 3.5e0 AS wmo_wind, CASE WHEN event_type = 'view' THEN value / 2.9e0 END AS bom_wind,
               {RADII},
               CASE floor(user_id / 10) % 3 WHEN 0 THEN CASE event_type WHEN 'signup' THEN 'PROVISIONAL' WHEN 'click' THEN 'spur-merge' ELSE 'MAIN' END
                    WHEN 1 THEN CASE event_type WHEN 'click' THEN 'PROVISIONAL_spur' ELSE 'MAIN' END
                    ELSE CASE event_type WHEN 'view' THEN 'x-spur' END END AS track_type,
               concat('storm-', CAST(user_id % 97 AS VARCHAR(10)), '-', CAST(day(ts) % 10 AS VARCHAR(10))) AS name
        FROM events""",
    "external_events": """
        SELECT o_orderkey AS ext_id, concat('Storm ', CAST(o_custkey % 97 AS VARCHAR(10)), '-24') AS event_name,
               CAST(DATE '2023-12-01' + INTERVAL 1 DAY * CAST(floor(o_totalprice) % 60 AS INTEGER) AS DATE) AS from_date,
               CAST(DATE '2023-12-03' + INTERVAL 1 DAY * CAST(floor(o_totalprice) % 60 AS INTEGER) AS DATE) AS to_date
        FROM orders""",
    "external_buffers": """
        SELECT o_orderkey AS ext_id, label, CAST(floor(o_custkey / 50) AS BIGINT) AS row_no, o_custkey % 50 AS col_no, (150 - label) / 30 AS reach
        FROM orders CROSS JOIN (SELECT 60 AS label UNION ALL SELECT 90 UNION ALL SELECT 120) AS labels
        WHERE o_orderstatus = 'F' AND (label = 60 OR o_orderpriority = '1-URGENT' OR (label = 90 AND o_orderpriority = '2-HIGH'))""",
    "quake_products": """
        SELECT l_partkey AS event_id, l_orderkey * 10 + l_linenumber AS update_time, l_quantity AS preferred_weight,
               CASE l_returnflag WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END AS status,
               CASE WHEN l_tax < 0.02 THEN 'download/shape.zip' WHEN l_tax < 0.04 THEN 'download/grid.xml.zip' ELSE 'download/grid.xml' END AS content,
               CASE WHEN l_discount > 0.005 THEN concat('https://host.invalid/', CAST(l_orderkey AS VARCHAR(20))) END AS url
        FROM lineitem""",
    "admin_layers": """
        SELECT level, upper(substr(c_mktsegment, 1, 3)) AS iso3, count(*) AS features
        FROM customer CROSS JOIN (SELECT 0 AS level UNION ALL SELECT 1 UNION ALL SELECT 2) AS levels
        WHERE level < 2 OR c_mktsegment <> 'MACHINERY' GROUP BY level, upper(substr(c_mktsegment, 1, 3))""",
    "grid_table": """
        SELECT r_regionkey AS grid_id, 30 - r_regionkey * 0.07e0 AS x0, 20 + r_regionkey * 0.03e0 AS y0,
               CASE r_regionkey WHEN 0 THEN 0.1e0 WHEN 1 THEN 0.25e0 WHEN 2 THEN 0.7e0 WHEN 3 THEN 0.05e0 ELSE 0.25e0 END AS dx,
               CASE r_regionkey WHEN 0 THEN 0.1e0 WHEN 1 THEN 0.25e0 WHEN 2 THEN 0.3e0 WHEN 3 THEN 0.15e0 ELSE 0.25e0 END AS dy,
               CASE r_regionkey WHEN 0 THEN 50 WHEN 1 THEN 21 WHEN 2 THEN 8 WHEN 3 THEN 90 ELSE 21 END AS cols,
               CASE r_regionkey WHEN 0 THEN 400 WHEN 1 THEN 130 WHEN 2 THEN 90 WHEN 3 THEN 200 ELSE 130 END AS rows,
               CASE r_regionkey WHEN 4 THEN 'EPSG:32636' ELSE 'EPSG:4326' END AS crs
        FROM region""",
    "layer_cells": """
        SELECT g AS grid_id, CAST(floor(k / w) AS BIGINT) AS row_no, CAST(k % w AS BIGINT) AS col_no, max(v) AS value
        FROM (SELECT 1 + l_suppkey % 4 AS g, l_partkey AS k, CASE l_suppkey % 4 WHEN 0 THEN 21 WHEN 1 THEN 8 WHEN 2 THEN 90 ELSE 21 END AS w, l_quantity AS v FROM lineitem) AS cells
        GROUP BY g, floor(k / w), k % w""",
    "shake_cells": """
        SELECT l_partkey AS event_id, l_suppkey AS hcell_id, max(l_quantity * l_discount * 1.6e0) AS mmi
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "quake_catalog": """
        SELECT p_partkey AS event_id, replace(p_name, 'widget', 'scenario') AS title, p_size / 10e0 AS magnitude,
               CASE WHEN p_type = 'SMALL' THEN 'quarry blast' ELSE 'earthquake' END AS event_type,
               CASE WHEN p_size > 45 THEN 'origin,phase-data' ELSE 'origin,shakemap' END AS types,
               CASE WHEN p_size > 3 THEN concat('https://host.invalid/detail/', p_brand) END AS detail
        FROM part""",
    "manifest": """
        SELECT c_custkey AS file_order, CASE WHEN c_custkey % 53 = 0 THEN 'X1' ELSE lower(substr(c_mktsegment, 1, 3)) END AS iso3_text,
               CASE WHEN c_custkey % 41 = 0 THEN 'not-a-date' ELSE '2001-08-01' END AS as_of_text,
               CAST(c_nationkey % 14 AS VARCHAR(10)) AS lookback_text, CAST(c_custkey % 5 AS VARCHAR(10)) AS level_text
        FROM customer""",
    "stac_items": """
        SELECT o_orderkey AS item_id, o_orderdate AS item_ts, 30 + (o_custkey % 40) * 0.1e0 AS west, 20 - (o_custkey % 25) * 0.1e0 AS north,
               31 + (o_custkey % 40) * 0.1e0 AS east, 19.4e0 - (o_custkey % 25) * 0.1e0 AS south,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat(CAST(o_custkey AS VARCHAR(20)), '/', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20))) END AS href
        FROM orders""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def names_in(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def with_adapters(sql: str) -> str:
    """DuckDB text: ``sql`` (a query, or one that starts with ``WITH``) after the adapters
    that it names."""
    head = ", ".join(f"{n} AS ({ADAPTERS[n]})" for n in names_in(sql, ADAPTERS))
    if not head:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"


class Fixtures:
    """The given tables and the domain tables over one folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL over given tables, adapters and ``frames``."""
        needed = {n: getattr(self, n) if n in ADAPTERS else self.table(n) for n in names_in(text, (*ADAPTERS, *TABLES)) if n not in frames}
        for n in needed:
            text = re.sub(rf"(?<![.\w{{]){n}\b(?!\.)", f"{{{n}}}", text)
        return self.spark.sql(text, **needed, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ADAPTERS:
            raise AttributeError(name)
        text = ADAPTERS[name]
        frames = {n: self.table(n) for n in TABLES if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)}
        for n in frames:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **frames)
