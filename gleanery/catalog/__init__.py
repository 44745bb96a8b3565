"""Queries over the star-schema and page tables, each with the SQL that states the same result."""

from __future__ import annotations

from importlib import import_module

from gleanery.catalog.core import ORACLES, QUERIES

for _section in ("rows", "joins", "aggregates", "sets", "text", "incremental", "files"):
    import_module(f"gleanery.catalog.{_section}")

__all__ = ["ORACLES", "QUERIES"]
