"""All registered queries of the library."""

from . import basic, batch, cyclone, geometry, indicators, streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
