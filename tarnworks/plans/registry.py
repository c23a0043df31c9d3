"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from tarnworks.plans import catalog, cells, depth, masks, scans, snow, tables, zonal  # noqa: F401  registers its queries
from tarnworks.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
