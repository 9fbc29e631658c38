"""Runnable queries over the provided tables, each beside the SQL that states its expected result."""

from importlib import import_module

from kpiloom.catalog.registrar import EXPECTED, QUERIES

for _part in ("intake", "metrics", "quality", "insights", "serving", "requirements", "sales", "storage"):
    import_module(f"kpiloom.catalog.{_part}")

__all__ = ["EXPECTED", "QUERIES"]
