"""Narrow-to-wide reporting lake on PySpark.

Filings are kept as narrow rows, one row per reported item, and published as
wide relations, one row per filing and one column per item.  Every operator is a
DataFrame-in, DataFrame-out function; jobs in ``plans`` and ``streaming`` wire
them to files and catalog tables.
"""

from narrowlake.model import COLLECTIONS, ENTITY, KV, SERIES_PREFIXES, Context, Roles

__all__ = ["COLLECTIONS", "ENTITY", "KV", "SERIES_PREFIXES", "Context", "Roles"]
