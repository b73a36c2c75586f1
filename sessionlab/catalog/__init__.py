"""Named queries over the driver tables, each with the SQL that gives the same rows."""

from sessionlab.catalog.registry import load_queries, load_sql

__all__ = ["load_queries", "load_sql"]
