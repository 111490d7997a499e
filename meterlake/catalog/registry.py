"""All queries; importing a catalog module registers its queries."""

from __future__ import annotations

from meterlake.catalog import cleaning, insight, models, rollups, scoring, sources, streams  # noqa: F401
from meterlake.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
