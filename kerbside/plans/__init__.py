"""Whole computations: layers, backfill, dashboard, map, features, scoring and forecast."""
