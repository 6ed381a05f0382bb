"""Registered queries over the driver's tables, each with the SQL that states its result."""

from __future__ import annotations

from kerbside.catalog.base import ORACLES, QUERIES
from kerbside.catalog import (  # noqa: F401  (importing registers the queries)
    dashboard,
    functions,
    layers,
    maps,
    models,
    relational,
    serving,
    sources,
    streams,
    tables,
)

__all__ = ["ORACLES", "QUERIES"]
