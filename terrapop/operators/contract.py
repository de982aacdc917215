"""The summary table that all hazards share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapop.schemas import CONTRACT, require_columns

#: Hazard, pipeline id, rule.
METHODS = (
    ("flood", "flood-days", "flood_days > threshold"),
    ("drought", "drought-spei", "any month SPEI3 <= threshold"),
    ("heat", "heat-utci", "3 consecutive days UTCI > threshold"),
    ("earthquake", "earthquake-mmi", "maximum MMI >= threshold"),
    ("cyclone", "cyclone-wind", "inside a wind swath"),
    ("violence", "violence-buffer", "buffered events >= threshold"),
)


def methods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(METHODS), "hazard string, pipeline_id string, rule string")


def standardize(units: DataFrame, hazard: str, start: str, end: str) -> DataFrame:
    """Canonical columns first, then what else the table has. ``units`` needs iso3,
    admin_id, pcode, admin_level, pop_total, pop_affected, pct_affected."""
    require_columns(units, ("iso3", "admin_id", "pcode", "pop_total", "pop_affected", "pct_affected"), f"{hazard} summary")
    rule = dict((h, r) for h, _, r in METHODS)[hazard]
    out = units.withColumns({"hazard": F.lit(hazard), "period_start": F.lit(start).cast("date"), "period_end": F.lit(end).cast("date"), "rule": F.lit(rule), "run_id": F.concat_ws("_", "iso3", F.lit(start), F.lit(end), F.lit(hazard))})
    return out.select(*CONTRACT, *[c for c in units.columns if c not in CONTRACT])


def standardize_bands(units: DataFrame, start: str, end: str) -> DataFrame:
    """The contract table of many hazards at once: ``units`` also has ``hazard`` and, kept
    behind the canonical columns, ``threshold``."""
    require_columns(units, ("hazard", "iso3", "admin_id", "pcode", "pop_total", "pop_affected", "pct_affected"), "summary")
    rules = F.broadcast(methods(units.sparkSession).select("hazard", "rule"))
    out = units.join(rules, "hazard").withColumns({"period_start": F.lit(start).cast("date"), "period_end": F.lit(end).cast("date"), "run_id": F.concat_ws("_", "iso3", F.lit(start), F.lit(end), F.col("hazard"))})
    return out.select(*CONTRACT, *[c for c in units.columns if c not in CONTRACT])
