"""Column guards and the contract of the unit summary table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

CONTRACT = ("run_id", "hazard", "iso3", "period_start", "period_end", "admin_level", "admin_id", "pcode", "pop_total", "pop_affected", "pct_affected", "rule")


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> DataFrame:
    """``df``, or ValueError if it lacks a column."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df
