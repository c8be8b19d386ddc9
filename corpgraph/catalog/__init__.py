"""Registered queries of the integration engine over the star-schema tables, and their DuckDB oracles.

The tables hold no companies or committees, so operators run on stand-ins made from
whole tables. A stand-in is one SQL text that Spark and DuckDB read alike.
"""

from corpgraph.catalog import brands, companies, people, sources, streams, tables, temporal  # noqa: F401
from corpgraph.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
