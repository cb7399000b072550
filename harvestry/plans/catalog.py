"""All registered queries."""

from harvestry.plans import (  # noqa: F401
    analytics, enrichment, extraction, frontier, items, monitoring, publishing,
    streams)
from harvestry.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
