"""All registered queries."""

from sessionlake.plans.catalog import changes, clustering, conforming, files, lake, tiles, zones
from sessionlake.plans.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "changes", "clustering", "conforming", "files", "lake", "tiles", "zones",
]
