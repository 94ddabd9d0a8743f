"""Importing this module registers every query."""

from workload import geometry_queries, mart_queries, warehouse_queries  # noqa: F401
