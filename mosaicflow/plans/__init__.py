"""Queries over the driver's tables, one a registered operator."""

from __future__ import annotations


def all_queries():  # noqa: ANN201
    """Queries and their SQL, by name."""
    from . import catalogue_queries, detail_queries, polygon_queries, raster_queries, spatial_queries  # noqa: F401
    from .registry import ORACLE_SQL, QUERIES

    return dict(QUERIES), dict(ORACLE_SQL)
