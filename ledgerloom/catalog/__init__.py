"""Demonstration queries by family; importing a family registers its queries."""

from ledgerloom.catalog import changes, columns, lookups, messages, raw_files, upserts, versions, warehouse
from ledgerloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "columns", "lookups", "messages", "raw_files", "upserts",
           "versions", "warehouse"]
